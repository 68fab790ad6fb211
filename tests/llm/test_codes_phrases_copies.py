"""Vector codes, collocations and near-duplicates against plain Python on small cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill.llm import codes, copies, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, lang string, uid long, k1 string, tokens string, chunk string, f int, times int"


def documents(spark, rows):
    """doc_id, text and lang, with further columns named like those inside the operators."""
    return spark.createDataFrame([(*r, 7, "k", "t", "c", 1, 2) for r in rows], DOCS)


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """vec_id, code, error of each kept row and the hash, comparing every part with every entry."""
    kept = [(i, lab, v) for i, lab, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max(len(v) for *_, v in kept) // parts) * parts
    whole = [[int(np.floor(4096 * x)) for x in v] + [0] * (width - len(v)) for *_, v in kept]
    cuts = [[tuple(v[p * width // parts:(p + 1) * width // parts]) for p in range(parts)] for v in whole]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, np.array(whole[k], np.int32).tobytes()))[:entries]
    books = [[cuts[k][p] for k in first] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            homes = defaultdict(list)
            for c in cuts:
                homes[nearest(c[p], books[p])[1]].append(c[p])
            for e, members in homes.items():
                books[p][e] = tuple(sum(x) // len(members) for x in zip(*members, strict=True))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cuts]
    return [(k[0], k[1], "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f)) for k, f in zip(kept, found, strict=True)], digest


def test_codes_equal_plain_k_means(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 3 or None, [float(x) for x in rng.normal(0, 0.3, 16).round(1)]) for i in range(150)]
    rows += [(3, 1, rows[3][2]), (None, 2, rows[4][2]), (900, 1, None), (901, 1, [0.5, None]), (902, 1, [float("nan")] * 16),
             (903, None, [float("inf")] * 16), (904, 2, []), (905, 2, [0.25] * 3)]
    made = [(i, lab, v, "c", 1, 2) for i, lab, v in rows]
    out = codes.compress(spark.createDataFrame(made, "vec_id long, label int, embedding array<float>, code string, v int, far int")).collect()
    theirs, digest = plain_codes([(i, lab, v and [None if x is None else float(np.float32(x)) for x in v]) for i, lab, v in rows])
    assert sorted(((r["vec_id"], r["label"], r["code"], r["error"]) for r in out), key=repr) == sorted(theirs, key=repr)
    sums = defaultdict(int)
    for _, label, _, error in theirs:
        sums[label] += error
    assert all(r["label_error"] == sums[r["label"]] and r["codebooks_sha256"] == digest for r in out)


def test_codes_edges(spark):
    kind = "vec_id long, label int, embedding array<double>"
    assert codes.compress(spark.createDataFrame([], kind)).count() == 0
    assert codes.compress(spark.createDataFrame([(1, 1, None)], kind)).count() == 0
    few = codes.compress(spark.createDataFrame([(1, 1, []), (2, None, []), (2, None, [])], kind)).collect()
    assert [(r["code"], r["error"], r["label_error"]) for r in few] == [("00" * 8, 0, 0)] * 3
    same = codes.compress(spark.createDataFrame([(i, 1, [1.0] * 8) for i in range(40)], kind)).collect()
    assert {(r["code"], r["error"]) for r in same} == {("00" * 8, 0)}
    with pytest.raises(ValueError, match="pass 64 bits"):
        codes.compress(spark.createDataFrame([(1, 1, [1e300] * 8)], kind))


def test_rings_skip_and_stay_exact():
    rng = np.random.default_rng(9)
    entries = rng.integers(-50, 50, (16, 3))
    vectors = rng.integers(-60, 60, (3000, 3))
    every = ((vectors[:, None] - entries[None]) ** 2).sum(axis=2)
    start = rng.integers(0, 16, len(vectors))
    radii = [np.sqrt(every[start == e, e].max()) for e in range(16)]
    own, far = codes.moved(vectors, start, entries, codes.balls(entries, radii))
    assert (own == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()
    # From the right entries most balls have few neighbours.
    close = codes.balls(entries, [np.sqrt(every[own == e, e].max(initial=0)) for e in range(16)])
    again, _ = codes.moved(vectors, own, entries, close)
    assert (again == own).all() and sum(len(near) for near, _ in close) < 16 * 15


def plain_phrases(rows, least, keep=2000):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for size in (1, 2, 3):
                f.update((lang or "und", tuple(w[i:i + size])) for i in range(len(w) - size + 1))
    often = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    out = defaultdict(list)
    for (lang, p), a in often.items():
        longer = [b for (other, q), b in often.items() if other == lang and len(q) > len(p) and p in (q[:2], q[1:])]
        if any(100 * b >= 50 * a for b in longer):
            continue
        score, _, l, r = min(
            (10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))
        )
        out[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted(
        (lang, i, p.decode(), -a, l, r, n[lang], -score)
        for lang, found in out.items() for i, (score, a, p, l, r) in enumerate(sorted(found)[:keep], 1)
    )


@pytest.mark.parametrize("trigger", [1, 3, 24, 10**6])
def test_phrases_equal_plain_counts(spark, trigger):
    pick = random.Random(trigger)
    words = ["New", "york", "city", "is", "a", "Ä", "b\x00d", "x-y", "the", " z"]
    rows = [(i, " ".join(pick.choice(words) + pick.choice(["", "", ".", ",\t", "\n"]) for _ in range(pick.randrange(60))), pick.choice(["en", "de", None, "und"])) for i in range(80)]
    rows += [(i, "the passage that many rows share, and once more", "en") for i in range(30)]
    rows += [(200, None, "fr"), (201, "", "fr"), (202, " \t.,", "fr"), (203, "la " * 20_000, "fr"), (1, "the city is", "en"), (1, "the city is", "en")]
    got = phrases.collocations(documents(spark, rows), least=5, trigger=trigger)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, 5)


def test_phrases_flushed_and_kept(spark, monkeypatch):
    assert phrases.collocations(documents(spark, [])).count() == 0
    rows = [(i, "one two three four five six seven eight nine ten one two", "en") for i in range(12)]
    monkeypatch.setattr(phrases, "HELD", 2)
    got = phrases.collocations(documents(spark, rows), least=10, keep=3)
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, 10, keep=3)


def test_chunks_hold_every_gram_once():
    text = " ".join(f"w{i * i % 37}" for i in range(500)) + ". end here"
    tokens = [*phrases.tokens_of(text), b".", b"."]
    for trigger in (1, 5, 50, 10**9):
        cut = phrases.chunks_of(text, trigger=trigger)
        grams = [tuple(c.split(b" ")[i:i + 3]) for c in cut for i in range(len(c.split(b" ")) - 2)]
        assert grams == [tuple(tokens[i:i + 3]) for i in range(len(tokens) - 2)]
    # A shared passage is cut at the same places after the first trigger in it.
    one, two = (set(phrases.chunks_of(head + text, trigger=5)) for head in ("first words ", "other ones. here "))
    assert len(one - two) <= 1


def plain_components(rows, size=2, percent=80):
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[i:i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    head = {}
    for i, r in enumerate(rows):
        own = (r[0] is None, r[0] or 0)
        head[find(i)] = min(head.get(find(i), own), own)
    ends = [None if head[find(i)][0] else head[find(i)][1] for i in range(len(rows))]
    return sorted(((r[0], len(s), e, r[0] == e) for r, s, e in zip(rows, sets, ends, strict=True)), key=repr)


def edited(pick, words, changes):
    words = list(words)
    for _ in range(changes):
        words[pick.randrange(len(words))] = f"e{pick.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [3, 1000])
def test_copies_equal_plain_comparison(spark, block):
    pick = random.Random(4)
    texts = [[f"w{pick.randrange(400)}" for _ in range(pick.choice([3, 8, 40, 120, 300]))] for _ in range(25)]
    rows = [(pick.randrange(10**6), edited(pick, pick.choice(texts), pick.randrange(12)), "en") for _ in range(150)]
    chain = [f"c{i}" for i in range(200)]  # each text is linked with the next ones only
    rows += [(2000 - i, " ".join(chain[7 * i:7 * i + 100]), "en") for i in range(12)]
    rows += [(500 + i, edited(pick, chain, 4), "en") for i in range(60)]
    rows += [(1, None, "en"), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (5, "one"), (None, "one"), (None, "lone words here"),
             (None, "lone words here"), (6, "a b"), (7, "A\nB"), (8, "a b " * 30_000), (9, "b a " * 30_000)]
    rows = [(r[0], r[1], "en") for r in rows]
    got = copies.near_duplicates(documents(spark, rows), block=block)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = sorted((tuple(r) for r in got.collect()), key=repr)
    # Rows of a null component are kept.
    theirs = [(i, n, c, True if i is None and c is None else k) for i, n, c, k in plain_components(rows)]
    assert found == sorted(theirs, key=repr)


@pytest.mark.parametrize("block", [2, 5])
def test_copies_inside_a_block_of_a_long_list(spark, block):
    pick, chain = random.Random(6), [f"c{i}" for i in range(600)]
    ids = pick.sample(range(1000), 70)
    rows = [(ids[i], " ".join(chain[7 * i:7 * i + 100]), "en") for i in range(70)]  # linked with the next ones only
    got = copies.near_duplicates(documents(spark, rows), block=block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_components(rows)


def test_rows_of_a_block_meet_each_other_and_every_other_block_once(spark):
    rows = spark.createDataFrame([(t, k, -k) for t, n in ((1, 40), (2, 3)) for k in range(n)], "token long, k1 long, k2 long")
    cells = defaultdict(list)
    for r in copies.blocked(rows, block=10).collect():
        cells[r["token"], r["i"], r["j"]].append((r["k1"], r["block"]))
    met = Counter((t, *sorted((a, b))) for (t, i, j), cell in cells.items() for n, (a, x) in enumerate(cell) for b, y in cell[:n]
                  if i == j or x != y)
    assert len(met) == 40 * 39 // 2 + 3 and set(met.values()) == {1}


def test_tokens_name_their_coordinate(spark):
    """Minima of small sets often pass 2^31, which is negative as an integer."""
    rows = documents(spark, [(i, f"w{i // 2} v" + " u" * (i % 2), "en") for i in range(60)])
    sets = copies.signed(rows).withColumn("uid", F.lit(0)).cache()
    minima = {(r["k1"], r["k2"]): r["tokens"] for r in sets.collect()}
    posted = [(minima[r["k1"], r["k2"]], t) for r in copies.postings(sets, 1).collect() for t in r["prefix"]]
    assert any(m[t >> 32] < 0 for m, t in posted) and all(m[t >> 32] & 0xFFFFFFFF == t & 0xFFFFFFFF for m, t in posted)


def test_copies_edges(spark):
    assert copies.near_duplicates(documents(spark, [])).count() == 0
    one = copies.near_duplicates(documents(spark, [(1, None, None)])).collect()
    assert [tuple(r) for r in one] == [(1, 0, 1, True)]
    assert copies.needed_matches(100) == copies.COORDINATES


def test_every_pair_meets_in_one_list(spark):
    """A pair above the match threshold shares a posted token of both."""
    pick = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = documents(spark, [(i, edited(pick, base, i % 6), "en") for i in range(40)])
    sets = copies.signed(rows).dropDuplicates(["k1", "k2"]).withColumn("uid", F.lit(0)).cache()
    needed = copies.needed_matches()
    posted = {(r["k1"], r["k2"]): set(r["prefix"]) for r in copies.postings(sets, needed).collect()}
    tokens = {(r["k1"], r["k2"]): set(enumerate(r["tokens"])) for r in sets.collect()}
    pairs = [(a, b) for a in tokens for b in tokens if a < b and len(tokens[a] & tokens[b]) >= needed]
    assert pairs and all(posted[a] & posted[b] for a, b in pairs)
    assert sets.select(F.size("tokens")).distinct().collect()[0][0] == copies.COORDINATES
    with pytest.raises(ValueError, match="64 coordinates"):
        copies.near_duplicates(rows, coordinates=65)
