"""The operators that SQL can express, as DuckDB SQL over the same tables.

Document ids are taken as unique here; the operators themselves need not have that.
"""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text):
    return (
        f"regexp_extract_all(translate({text}, '{UPPER}', '{UPPER.lower()}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


LINE_DEDUP = """
WITH parts AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents
),
occurrences AS (
    SELECT doc_id, i, parts[i] AS line
    FROM (SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i FROM parts)
    WHERE trim(parts[i]) <> ''
),
lines AS (
    SELECT line, count(*) AS n, min((doc_id, i)) AS first FROM occurrences GROUP BY line
),
places AS (
    SELECT line, first, length(line) AS size, unnest(generate_series(1, length(line))) AS pos
    FROM lines WHERE length(line) >= 16
),
variants AS (
    SELECT line, first, size, pos, substring(line, 1, pos - 1) || substring(line, pos + 1) AS rest FROM places
),
near AS (
    SELECT a.line FROM variants a JOIN variants b ON a.rest = b.rest AND a.pos = b.pos AND a.size = b.size
    WHERE b.first < a.first
    UNION
    SELECT a.line FROM variants a JOIN lines b ON a.rest = b.line WHERE b.first < a.first AND length(b.line) >= 16
    UNION
    SELECT a.line FROM lines a JOIN variants b ON b.rest = a.line WHERE b.first < a.first AND length(a.line) >= 16
),
gone AS (
    SELECT o.doc_id, list(o.i) AS gone
    FROM occurrences o JOIN lines l ON l.line = o.line LEFT JOIN near n ON n.line = o.line
    WHERE n.line IS NOT NULL OR l.first <> (o.doc_id, o.i)
    GROUP BY o.doc_id
),
cut AS (
    SELECT p.doc_id, coalesce(p.text, '') AS text, coalesce(p.parts, []) AS parts, coalesce(g.gone, []) AS gone
    FROM parts p LEFT JOIN gone g ON g.doc_id = p.doc_id
),
kept AS (
    SELECT doc_id, text, parts, gone,
           [parts[i] FOR i IN generate_series(1, len(parts)) IF NOT list_contains(gone, i)] AS kept
    FROM cut
)
SELECT doc_id, CAST(len([x FOR x IN parts IF trim(x) <> '']) AS BIGINT) AS n_lines,
       CAST(len([x FOR x IN kept IF trim(x) <> '']) AS BIGINT) AS n_kept,
       sha256(CASE WHEN len(gone) > 0 THEN array_to_string(kept, chr(10)) ELSE text END) AS text_sha256
FROM kept
"""

DECONTAMINATE = f"""
WITH items AS (SELECT item_id, {words('text')} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, len(part) AS size, array_to_string(part, ' ') AS part
    FROM (SELECT item_id, w[i:i + 9] AS part
          FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0))
),
docs AS (SELECT doc_id, coalesce({words('text')}, []) AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
hits AS (
    SELECT d.doc_id, d.i, d.size, v.item_id
    FROM (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS part
          FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
                FROM docs, sizes WHERE len(w) >= size)) d
    JOIN windows v ON v.part = d.part AND v.size = d.size
),
hit_words AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS pos FROM (SELECT DISTINCT doc_id, i, size FROM hits))
    GROUP BY doc_id
),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(f.n_items, 0) AS n_items, sha256(coalesce(f.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h ON h.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id
"""

CHAT_ROTATION = r"""
WITH messages AS (
    SELECT DISTINCT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
           CASE WHEN turn IS NULL THEN row_number() OVER () END AS own_row
    FROM conversations
),
placed AS (
    SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1) AS place,
           regexp_replace(text, '<\|(im_start|im_end)\|>', '<\\|\1\\|>', 'g') AS safe_text,
           regexp_replace(role, '<\|(im_start|im_end)\|>', '<\\|\1\\|>', 'g') AS safe_role
    FROM messages
),
pieces AS (
    SELECT p.conv_id, s.speaker, p.place // 512 AS part, p.place, p.role = s.speaker AS own,
           CASE WHEN p.role = s.speaker THEN '<|im_start|>assistant' || chr(10)
                ELSE '<|im_start|>user name=' || safe_role || chr(10) END AS head,
           safe_text || '<|im_end|>' AS body
    FROM placed p JOIN (SELECT DISTINCT conv_id, role AS speaker FROM messages) s
        ON s.conv_id IS NOT DISTINCT FROM p.conv_id
),
spans AS (
    SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
        PARTITION BY conv_id, speaker, part ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    ), 0) + length(head) AS start
    FROM pieces
)
SELECT conv_id, speaker, CAST(part AS INT) AS part, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       string_agg(head || body || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg(CAST(start AS VARCHAR) || ':' || CAST(start + length(body) AS VARCHAR), ','
                           ORDER BY place) FILTER (own), '') AS mask
FROM spans GROUP BY conv_id, speaker, part
"""

JACCARD_JOIN = f"""
WITH RECURSIVE docs AS (SELECT doc_id, text, coalesce({words('text')}, []) AS w FROM documents),
texts AS (
    SELECT row_number() OVER () AS t, * FROM (
        SELECT text, any_value(w) AS w, min(doc_id) AS first, count(*) AS n_copies
        FROM docs WHERE len(w) > 0 GROUP BY text
    )
),
grams AS (
    SELECT DISTINCT t, array_to_string(w[i:i + 4], ' ') AS gram
    FROM (SELECT t, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM texts)
),
sizes AS (SELECT t, count(*) AS n FROM grams GROUP BY t),
links AS (
    SELECT a, b FROM (
        SELECT x.t AS a, y.t AS b, count(*) AS common FROM grams x JOIN grams y ON x.gram = y.gram AND x.t <> y.t GROUP BY 1, 2
    ) JOIN sizes m ON m.t = a JOIN sizes n ON n.t = b
    WHERE 10 * common >= 8 * (m.n + n.n - common)
),
reach AS (
    SELECT t AS a, t AS b FROM texts UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
),
classes AS (SELECT r.a AS t, min(x.first) AS class_id FROM reach r JOIN texts x ON x.t = r.b GROUP BY r.a),
counted AS (SELECT a AS t, count(*) AS n_links FROM links GROUP BY a)
SELECT d.doc_id, c.class_id, coalesce(k.n_links, 0) AS n_links, x.n_copies
FROM docs d JOIN texts x ON x.text = d.text JOIN classes c ON c.t = x.t LEFT JOIN counted k ON k.t = x.t
UNION ALL SELECT doc_id, doc_id, CAST(0 AS BIGINT), CAST(1 AS BIGINT) FROM docs WHERE len(w) = 0
"""

TOP_K = """
WITH vectors AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
        AND len([x FOR x IN embedding IF NOT isfinite(x)]) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

MIX = r"""
WITH docs AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
),
drawn AS (
    SELECT *, md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(source, '') || '|' || size) AS draw FROM docs
),
sources AS (
    SELECT source, CAST(source_size AS BIGINT) AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM (SELECT source, sum(size) AS source_size FROM docs GROUP BY source)
),
levels AS (
    SELECT 2 * source_size / weight AS ratio,
           (1.5 * sum(CAST(source_size AS DOUBLE)) OVER ()
               - coalesce(sum(CAST(2 * source_size AS DOUBLE)) OVER earlier, 0))
               / sum(weight) OVER (ORDER BY 2 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources
    WINDOW earlier AS (ORDER BY 2 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
    SELECT *, floor(target / nullif(source_size, 0)) AS whole FROM (
        SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE),
            weight * (SELECT min_by(level, ratio) FROM levels WHERE level <= ratio)) AS target FROM sources
    )
),
picked AS (
    SELECT d.*, t.source_size, t.target, coalesce(t.whole, 0) AS whole,
           t.target - coalesce(t.whole, 0) * t.source_size AS rest,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id ROWS UNBOUNDED PRECEDING) AS upto
    FROM drawn d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source
),
more AS (SELECT *, 2 * upto - size <= 2 * rest AND rest > 0 AS more FROM picked),
gaps AS (SELECT *, rest - coalesce(sum(size) FILTER (more) OVER (PARTITION BY source), 0) AS gap FROM more),
swaps AS (
    SELECT doc_id, source FROM gaps WHERE size > 0 AND size < 2 * abs(gap) AND more = (gap < 0)
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(size - abs(gap)), draw, doc_id) = 1
)
SELECT g.doc_id, g.size, g.source_size, g.target,
       CAST((g.whole + CAST(g.more <> (s.doc_id IS NOT NULL) AS INT)) * g.size AS BIGINT) AS taken, g.source
FROM gaps g LEFT JOIN swaps s ON s.doc_id = g.doc_id AND s.source IS NOT DISTINCT FROM g.source
"""

def vector_codes(parts=8, entries=16, rounds=6):
    """One step per round, each comparing every part with every entry."""
    distance = """
        SELECT v.id, v.part, c.entry, sum((v.x - c.x) * (v.x - c.x)) AS far
        FROM parts v JOIN c{r} c ON c.part = v.part AND c.pos = v.pos GROUP BY v.id, v.part, c.entry"""
    nearest = f"""
        SELECT id, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM ({distance}) GROUP BY id, part"""
    steps = "".join(f""",
    a{r} AS MATERIALIZED ({nearest.format(r=r)}),
    c{r + 1} AS MATERIALIZED (
        SELECT c.part, c.entry, c.pos, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
            SELECT a.part, a.entry, v.pos, CAST(floor(CAST(sum(v.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
            FROM a{r} a JOIN parts v ON v.id = a.id AND v.part = a.part GROUP BY a.part, a.entry, v.pos
        ) m ON m.part = c.part AND m.entry = c.entry AND m.pos = c.pos)""" for r in range(rounds))
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label,
               [CAST(floor({4096} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
        WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
            AND len([x FOR x IN embedding IF NOT isfinite(x)]) = 0
    ),
    parts AS MATERIALIZED (
        SELECT id, CAST((i - 1) // (len(v) // {parts}) AS INT) AS part, CAST((i - 1) % (len(v) // {parts}) AS INT) AS pos, v[i] AS x
        FROM (SELECT id, v, unnest(generate_series(1, len(v))) AS i FROM kept)
    ),
    c0 AS MATERIALIZED (SELECT part, CAST(id - 1 AS INT) AS entry, pos, x FROM parts WHERE id <= {entries}){steps},
    coded AS ({nearest.format(r=rounds)}),
    rows AS (
        SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
        FROM coded GROUP BY id
    )
    SELECT k.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
           (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
    FROM kept k JOIN rows r ON r.id = k.id
    """


COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
        SELECT lang, unnest(regexp_split_to_array(translate(text, '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents WHERE text IS NOT NULL
    )
),
grams AS MATERIALIZED (
    SELECT lang, size, part, count(*) AS f FROM (
        SELECT lang, size, w[i:i + size - 1] AS part
        FROM (SELECT lang, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
              FROM pieces, (SELECT unnest([1, 2, 3]) AS size) WHERE len(w) >= size)
    ) GROUP BY lang, size, part
),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang),
cuts AS (
    SELECT g.lang, g.size, g.part, g.f AS a, k, l.f AS l, r.f AS r,
           (CAST(1000000 AS HUGEINT) * g.f * g.f) // (CAST(l.f AS HUGEINT) * r.f) AS score
    FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM grams WHERE size > 1 AND f >= 10) g
    JOIN grams l ON l.lang = g.lang AND l.part = g.part[1:k]
    JOIN grams r ON r.lang = g.lang AND r.part = g.part[k + 1:]
),
candidates AS (
    SELECT lang, size, part, a, arg_min(l, (score, k)) AS l, arg_min(r, (score, k)) AS r, CAST(min(score) AS BIGINT) AS score
    FROM cuts GROUP BY lang, size, part, a
),
inner_parts AS (
    SELECT lang, part, max(a) AS longer FROM (
        SELECT lang, part[1:2] AS part, a FROM candidates WHERE size = 3
        UNION ALL SELECT lang, part[2:3], a FROM candidates WHERE size = 3
    ) GROUP BY lang, part
),
kept AS (
    SELECT c.lang, array_to_string(c.part, ' ') AS phrase, a, l, r, score
    FROM candidates c LEFT JOIN inner_parts i ON i.lang = c.lang AND i.part = c.part
    WHERE NOT coalesce(100 * i.longer >= 50 * c.a, false)
)
SELECT k.lang, row_number() OVER best AS rank, phrase, a, l, r, n, score
FROM kept k JOIN totals t ON t.lang = k.lang
WINDOW best AS (PARTITION BY k.lang ORDER BY score DESC, a DESC, encode(phrase))
QUALIFY row_number() OVER best <= 2000
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '[^\x20\x09-\x0D]+'), []) AS w
    FROM documents
),
texts AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY min(doc_id)) AS t, w, min(doc_id) AS first FROM docs WHERE len(w) > 0 GROUP BY w
),
grams AS (
    SELECT DISTINCT t, w[i:i + 1] AS gram
    FROM (SELECT t, w, unnest(generate_series(1, greatest(len(w) - 1, 1))) AS i FROM texts)
),
sizes AS (SELECT t, count(*) AS n FROM grams GROUP BY t),
links AS MATERIALIZED (
    SELECT a, b FROM (
        SELECT x.t AS a, y.t AS b, count(*) AS common FROM grams x JOIN grams y ON x.gram = y.gram AND x.t <> y.t GROUP BY 1, 2
    ) JOIN sizes m ON m.t = a JOIN sizes n ON n.t = b
    WHERE 100 * common >= 80 * (m.n + n.n - common)
),
reach AS (
    SELECT t AS a, t AS b FROM texts UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
),
heads AS (SELECT r.a AS t, min(x.first) AS head FROM reach r JOIN texts x ON x.t = r.b GROUP BY r.a)
SELECT d.doc_id, s.n AS n_shingles, h.head AS component_id, d.doc_id = h.head AS kept
FROM docs d JOIN texts x ON x.w = d.w JOIN sizes s ON s.t = x.t JOIN heads h ON h.t = x.t
UNION ALL SELECT doc_id, CAST(0 AS BIGINT), doc_id, true FROM docs WHERE len(w) = 0
"""

ORACLES = {
    "op1_line_dedup": LINE_DEDUP,
    "op2_decontaminate": DECONTAMINATE,
    "op6_chat_rotation": CHAT_ROTATION,
    "op8_jaccard_join": JACCARD_JOIN,
    "op9_top_k": TOP_K,
    "op10_mix": MIX,
    "op11_vector_codes": vector_codes(),
    "op12_collocations": COLLOCATIONS,
    "op13_near_duplicates": NEAR_DUPLICATES,
}
