"""Repeated rows of a mix, and the whole pipeline on a small folder."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from gridmill.llm import mixing
from gridmill.session import stored, table

KIND = "doc_id long, text string, lang string, source string, _key string, copies int, draw int, mass int, size int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, "k", 1, 2, 3, 4) for i, t, s in rows], KIND)


def test_repeated_rows_are_taken_alike(spark):
    rows = [(1, "w " * 10, "a"), (1, "w " * 10, "a"), (None, "w w w", None), (None, "w w w", None), (2, None, "b"), (3, "", "b")]
    rows += [(i, "w " * (1 + i % 5), "abc"[i % 3]) for i in range(10, 70)]
    rows += [(i, "w " * (1 + i % 5), "abc"[i % 3]) for i in range(10, 40)]
    docs = documents(spark, rows)
    plan = mixing.mix(docs)
    assert plan.count() == len(rows)
    out = mixing.mixed_documents(docs)
    assert out.columns == [*docs.columns, "copy"] and out.filter("_key <> 'k' or copies <> 1 or mass <> 3").count() == 0
    assert out.count() == plan.agg(F.sum("copies")).first()[0]
    held, taken = Counter((i, s) for i, _, s in rows), Counter((r["doc_id"], r["source"]) for r in out.collect())
    assert all(taken[k] <= 2 * held[k] and taken[k] % held[k] == 0 for k in taken)
    words = {s: sum(t.split().__len__() for _, t, z in rows if t and z == s) for s in ("a", "b", "c", None)}
    targets = {r["source"]: r["target"] for r in plan.collect()}
    got = Counter()
    for r in out.collect():
        got[r["source"]] += len((r["text"] or "").split())
    assert all(got[s] <= 2 * words[s] for s in words) and all(abs(got[s] - targets[s]) <= 10 for s in words)


def test_two_equal_rows(spark):
    docs = documents(spark, [(1, "w " * 10, "a"), (1, "w " * 10, "a")])
    assert mixing.mix(docs).agg(F.sum("copies")).first()[0] == mixing.mixed_documents(docs).count() <= 4
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_pipeline_on_a_small_folder(spark, tmp_path):
    good = " ".join(f"Quiet words number {i} make a good sentence here." for i in range(12))
    noise = "BAD!! ### $$$ WORDS!! %%% " * 5
    item = "what is the name of the tallest mountain on the other side of town"
    rows = [(i, f"Opening of text {i}.\n{good.replace('words', f'w{i} things')}\nTail {i * i} ends well.", f"s{i % 3}") for i in range(30)]
    rows += [(100 + i, noise + str(i), "s1") for i in range(30)]
    rows += [(200, rows[3][1], "s0"), (201, f"Opening.\n{item}\n{good.replace('words', 'other')}", "s2")]
    rows += [(300, None, "s0"), (301, "", None), (None, good.replace("good", "fine"), "s0"), (5, rows[5][1], "s2")]
    docs = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    stored_docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    stored_docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < 100), 0) for i in [*range(30), *range(100, 130)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen, frame = {}, table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES:
        frame = stored(stage(spark, frame, str(tmp_path)), "stage")
        seen[name] = Counter(r["doc_id"] for r in frame.select("doc_id").collect())
        if name != "mixing sources":
            assert frame.columns == stored_docs.columns
    assert not any(100 <= (i or 0) < 130 for i in seen["quality classifier"]) and seen["quality classifier"][3]
    assert 201 in seen["n-gram jaccard join"] and 201 not in seen["benchmark decontamination"]
    assert not (3 in seen["n-gram jaccard join"] and 200 in seen["n-gram jaccard join"])
    assert set(seen["mixing sources"]) <= set(seen["benchmark decontamination"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(r["doc_id"] for r in whole.select("doc_id").collect()) == seen["mixing sources"]
    assert whole.columns == [*stored_docs.columns, "copy"]
