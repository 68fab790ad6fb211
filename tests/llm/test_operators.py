"""Small cases of the training-data operators against plain Python."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill.llm import chats, decontamination, languages, lines, mixing, neighbours, personal, quality, similar, urls

DOCS = "doc_id long, text string, lang string, source string, kind string"
LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "en", "a", "extra") for r in rows], DOCS)


def edge_rows():
    return [(1, None), (2, ""), (3, " \n "), (4, LONG), (4, LONG), (None, LONG), (5, "x" * 30_000)]


def test_lines_keep_the_earliest(spark):
    rows = [(2, "a line of some length\nshort\n\nlast"), (1, "a line of same length\nshorn"), (3, "short"), *edge_rows()[:3]]
    out = {r["doc_id"]: r for r in lines.dedup_lines(documents(spark, rows)).filter("text is not null").collect()}
    assert out[2]["text"] in ("short\n\nlast", "\n\nlast", "")
    assert lines.dedup_lines(documents(spark, edge_rows())).count() == 7
    assert lines.dedup_lines(documents(spark, [])).count() == 0


def test_lines_one_edit(spark):
    base = "the quick brown fox jumps"
    rows = [(1, base), (2, base.replace("quick", "quack")), (3, base + "s"), (4, base[:-1]), (5, base + "!!"), (6, base)]
    out = {r["doc_id"]: r["n_kept"] for r in lines.dedup_lines(documents(spark, rows)).collect()}
    # 5 is one edit away from 3 only by a change at the end and one more: two edits from all.
    assert out[1] == 1 and out[2] == out[3] == out[4] == out[6] == 0 and out[5] == 1


def test_benchmark_windows(spark):
    items = spark.createDataFrame([(1, LONG), (2, "Short item!"), (3, None), (4, "")], "item_id long, text string")
    rows = [(1, "zz " + LONG.upper() + " zz"), (2, "a short, ITEM here"), (3, "shorts item"), *edge_rows()[:3]]
    one = decontamination.find_overlap(documents(spark, rows), items)
    two = decontamination.find_overlap(documents(spark, rows), items, block_bytes=60)
    for found in (one, two):
        out = {r["doc_id"]: r for r in decontamination.digest(found).filter("n_words > 0").collect()}
        assert (out[1]["n_words"], out[1]["n_hit"], out[1]["n_items"]) == (18, 16, 1)
        assert (out[2]["n_hit"], out[2]["items_sha256"]) == (2, hashlib.sha256(b"2").hexdigest())
        assert not out[3]["contaminated"]
    spans = {r["doc_id"]: r["spans"] for r in one.filter("doc_id = 2 and n_words > 0").collect()}
    assert [(s["first"], s["last"]) for s in spans[2]] == [(2, 13)]
    assert decontamination.clean(documents(spark, edge_rows()), items).count() == 4
    assert decontamination.find_overlap(documents(spark, rows), items.limit(0)).filter("size(words) > 0").count() == 0


def test_benchmark_blocks_one_at_a_time(spark, monkeypatch):
    seen, blocks, stored = [], decontamination.blocks, decontamination.stored

    def read(*args):
        for items in blocks(*args):
            seen.append("block")
            yield items

    monkeypatch.setattr(decontamination, "blocks", read)
    monkeypatch.setattr(decontamination, "stored", lambda df, name: (seen.append(name), stored(df, name))[1])
    items = spark.createDataFrame([(1, LONG), (2, "Short item!")], "item_id long, text string")
    found = decontamination.find_overlap(documents(spark, [(1, LONG), (2, "a short item")]), items, block_bytes=30)
    assert seen == ["texts", *["block", "pass"] * 4]
    assert {r["doc_id"]: r["items"] for r in found.collect()} == {1: ["1"], 2: ["2"]}


def test_personal_data(spark):
    text = "é mail a.b@c.de, 10.0.0.256 and 10.0.0.25, card 4111 1111 1111 1111 +1 (743) 555-3824"
    out = personal.digest(personal.find_personal_data(documents(spark, [(9, text), *edge_rows()])))
    got = {r["doc_id"]: r for r in out.filter("doc_id = 9").collect()}[9]
    assert got["spans"] == ",".join((
        "email:7:15", f"ip:{text.index('10.0.0.25,')}:{text.index('10.0.0.25,') + 9}",
        f"card:{text.index('4111')}:{text.index('4111') + 19}", f"phone:{text.index('+1')}:{len(text)}",
    ))
    assert out.count() == 8 and out.filter("spans <> ''").count() == 1


def test_contexts_find_unseen_numbers(spark):
    rows = [(i, f"please call our office on +1 555 100 {1000 + i} today") for i in range(12)]
    rows += [(50, "please call our office on 555-0199-22 today"), (51, "room 555-0199-23 is free")]
    out = {r["doc_id"]: r["n_found"] for r in personal.digest(personal.find_personal_data(documents(spark, rows))).collect()}
    assert out[50] == 1 and out[51] == 0 and sum(out.values()) == 1


def test_contexts_find_spaced_numbers(spark):
    cards = [c for c in (f"4111 1111 1111 {i:04}" for i in range(1000, 1400)) if sum(
        d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(int(x) for x in reversed(c) if x != " ")
    ) % 10 == 0][:20]
    rows = [(i, f"please call our office on +1 555 100 {1000 + i} today") for i in range(20)]
    rows += [(100 + i, f"please charge my credit card {c} now") for i, c in enumerate(cards)]
    spaced = {
        200: ("please call our office on ", "555 123 4567", " today", "phone"),
        201: ("please call our office on ", "(743) 555-3824", " today", "phone"),
        202: ("please charge my credit card ", "3782 822463 10005", " now", "card"),
        203: ("please call our office on ", "5550199221", " today", "phone"),
    }
    rows += [(i, a + b + c) for i, (a, b, c, _) in spaced.items()]
    rows += [(300, "there were 555 123 4568 stars"), (301, "sums of 3782 822463 10006 points")]
    out = {r["doc_id"]: r["spans"] for r in personal.digest(personal.find_personal_data(documents(spark, rows))).collect()}
    assert len(cards) == 20 and out[300] == out[301] == ""
    assert {i: out[i] for i in spaced} == {i: f"{k}:{len(a)}:{len(a) + len(b)}" for i, (a, b, _, k) in spaced.items()}


def test_url_rules(spark):
    pages = [
        (1, "http://A.Example.NET/en/x?q"), (2, "http://example.net/de"), (3, "http://b.org/fr/#x"),
        (4, "http://example.com/de/1"), (5, "nothing"), (6, None), (7, "x://net"), (8, "http://forg/fr/"),
    ]
    out = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string")).collect()}
    assert [out[i]["rule"] for i in range(1, 9)] == [
        "example.net/en/", "net/", "org/fr/", "example.com/de/", None, None, None, None,
    ]
    assert (out[1]["host"], out[1]["path"], out[5]["host"], out[6]["path"]) == ("a.example.net", "/en/x", "", "")
    assert {r["verdict"] for r in out.values()} <= {"allow", "block"}
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_languages(spark):
    rows = [(i, t, lang, "a", "") for i in range(40) for t, lang in (("the house and the tree", "en"), ("das haus und der baum", "de"))]
    rows += [(100, None, "en", "a", ""), (101, "12 !?", None, "a", ""), (102, "the tree and house", None, "a", "")]
    out = {r["doc_id"]: r["lang_pred"] for r in languages.identify(spark.createDataFrame(rows, DOCS)).filter("doc_id >= 100").collect()}
    assert out == {100: "und", 101: "und", 102: "en"}
    assert languages.identify(spark.createDataFrame([], DOCS)).count() == 0


def test_chat_perspectives(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "bot", "yo"), (1, 1, "bot", "yo"), (1, None, None, None)]
    out = {r["speaker"]: r for r in chats.rotate(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    assert set(out) == {"user", "bot", "unknown"} and out["bot"]["n_turns"] == 3
    for row in out.values():
        own = [row["text"][s["start"]:s["end"]] for s in row["mask"]]
        assert own == [{"user": "hi", "bot": "yo", "unknown": ""}[row["speaker"]] + "<|im_end|>"]
    assert out["user"]["text"].startswith("<|im_start|>assistant\nhi<|im_end|>\n<|im_start|>user name=bot\nyo")


def test_chat_parts(spark):
    turns = [(7, i, "ab"[i % 2], f"t{i}") for i in range(1300)]
    out = chats.rotate(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), turns_per_part=500)
    assert sorted((r["speaker"], r["part"], r["n_turns"]) for r in out.collect()) == [
        (s, p, n) for s in "ab" for p, n in ((0, 500), (1, 500), (2, 300))
    ]


def test_quality(spark):
    rows = [(i, "A good and quiet sentence of words. " * (1 + i % 3), "en", "a", "") for i in range(60)]
    rows += [(i, "BAD!! ### $$$ WORDS!! %%% " * (1 + i % 3), "en", "a", "") for i in range(60, 120)]
    docs = spark.createDataFrame([*rows, (500, None, "en", "a", "")], DOCS)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 120, 2)], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in quality.score_quality(docs, labels).collect()}
    assert all(out[i]["predicted"] == int(i < 60) for i in range(120)) and 0 <= out[500]["score"] <= 1
    assert quality.score_quality(docs, labels.limit(0)).filter("score = 0.5").count() == 121
    assert quality.keep_good(docs, labels).filter("doc_id between 60 and 119").count() == 0


def test_quality_learns_from_every_label(spark):
    """More examples than any sample of a fixed size: the threshold is the quantile of all of them."""
    x = (F.crc32(F.col("id").cast("string")) % 1000 / 1000).cast("float")
    made = spark.range(24_000).select(
        F.array(x, (x * x + F.col("id") % 7).cast("float")).alias("features"),
        (x + F.col("id") % 3 / 3 > 0.8).cast("double").alias("label"), F.col("id").cast("string").alias("key"),
    )
    weights, threshold, scale = quality.fit(made)
    rows = made.select("features", "label").toPandas()
    raw, label = np.array(rows["features"].to_list(), float) @ np.array(weights), rows["label"].to_numpy()
    assert threshold == pytest.approx(np.quantile(raw, 1 - label.mean()), abs=1e-9)
    assert scale == pytest.approx(abs(raw[label == 1].mean() - raw[label == 0].mean()) / 8, abs=1e-9)


def test_jaccard_classes(spark):
    words = [f"w{i}" for i in range(200)]
    near = " ".join([*words[:100], "zz", *words[101:]])
    rows = [(1, " ".join(words)), (2, near), (3, " ".join(words)), (8, LONG), (9, None), (10, ""), (11, "")]
    out = {r["doc_id"]: tuple(r)[1:4] for r in similar.jaccard_join(documents(spark, rows)).collect()}
    assert out[1] == (1, 1, 2) and out[2] == (1, 1, 1) and out[3] == (1, 1, 2)
    assert out[8] == (8, 0, 1) and out[10] == (10, 0, 1) and out[11][0] == 11
    assert {r["doc_id"] for r in similar.one_of_each(documents(spark, rows)).collect()} == {1, 8, 9, 10, 11}
    assert similar.one_of_each(documents(spark, edge_rows())).count() == 5
    assert similar.jaccard_join(documents(spark, [])).count() == 0


def parted_chain(spark):
    """Texts c, a, u, v, b that each hold the one before and a fifth more, in one
    bucket: a leads u and b leads v in parts of their own, and c leads a."""
    keys = spark.range(2000).select("id", F.pmod(F.xxhash64("id", "id"), F.lit(3)).alias("part")).orderBy("id").collect()
    words, sizes, key = [f"t0x{i}" for i in range(2250)], {"c": 1000, "a": 1220, "u": 1488, "v": 1816, "b": 2215}, {}
    for name, part in zip("cabuv", (2, 0, 1, 0, 1), strict=True):
        key[name] = next(r["id"] for r in keys if r["id"] > max(key.values(), default=-1) and r["part"] == part)
    texts = {key[name]: " ".join(words[:size]) for name, size in sizes.items()}
    keyed = documents(spark, texts.items()).withColumns({"k1": F.col("doc_id"), "k2": F.col("doc_id")})
    return similar.forest(keyed).withColumn("labels", F.array(F.lit(b"same" * 8))), key, texts


def test_parts_of_a_bucket_lose_no_link(spark):
    from gridmill.llm.components import components

    one, key, texts = parted_chain(spark)
    shingle = similar.Shingler()
    sets = {k: set(shingle(t).tolist()) for k, t in texts.items()}
    linked = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    label = {r["u"]["k1"]: r["v"]["k1"] for r in components(similar.candidate_edges(one, 7, leaders=2)).collect()}
    assert tuple(sorted((key["u"], key["v"]))) in linked
    assert all(label.get(i, i) == label.get(j, j) for i, j in linked)


def test_leaders_of_a_bucket_meet_in_blocks(spark):
    rows = spark.range(400).select(F.lit(1).alias("bucket"), F.col("id").alias("k1"), F.col("id").alias("k2"))
    groups = {}
    for r in similar.block_pairs(rows, 50).collect():
        groups.setdefault((r["i"], r["j"]), set()).add(r["k1"])
    assert len(groups) == 28 and max(map(len, groups.values())) < 200
    assert {(a, b) for g in groups.values() for a in g for b in g} == {(a, b) for a in range(400) for b in range(400)}
    assert {(r["i"], r["j"]) for r in similar.block_pairs(rows, 400).collect()} == {(0, 0)}


def test_top_k_is_exact(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    vectors = [[float(x) for x in v] for v in rng.normal(0, 0.3, (300, 8)).round(1)]
    rows = [*enumerate(vectors), (900, None), (901, [1.0, None]), (902, [float("nan")])]
    found = neighbours.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0, page=40)
    whole = np.floor(np.array(vectors, np.float32).astype(float) * 256).astype(int)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    for q in range(0, 300, 50):
        assert got[q] == sorted((-int(whole[q] @ whole[j]), j) for j in range(300) if j != q)[:5]


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 7), "en", s, "") for i in range(300) for s in ("a", "b", "c", None)]
    out = mixing.mix(spark.createDataFrame([*rows, (900, None, "en", "a", "")], DOCS))
    sums = out.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("t"), F.first("target").alias("want")).collect()
    assert all(abs(r["t"] - r["want"]) <= 7 for r in sums) and out.filter("copies > 2").count() == 0
    assert sum(r["want"] for r in sums) == pytest.approx(1.5 * out.agg(F.sum("size")).first()[0])
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
