"""What the pipeline shuffles and leaves on disk."""

import os
from collections import Counter

import pytest

from gridmill.llm import decontamination, lines, mixing, quality, similar
from gridmill.session import shared_folder

KIND = "doc_id long, text string, source string"


def made(spark, n, sources, kind=KIND):
    rows = [(i, "w " * ((i * 37) % 23), sources[(i * i) % len(sources)]) for i in range(n)]
    rows += rows[::7] + [(None, "w w w", s) for s in sources[:5]] * 2 + [(None, None, None), (5, "w", None), (5, "w w", None)]
    return spark.createDataFrame(rows, kind)


@pytest.mark.parametrize("limit", ["10m", "-1"])
@pytest.mark.parametrize("sources", [["a", "b", "c", None, ""], [f"s{i}" for i in range(300)]])
def test_rows_follow_the_plan_whatever_the_join(spark, limit, sources):
    docs = made(spark, 600, sources)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for settings in ({}, {"share": 1.1, "seed": "other"}, {"share": 0.4, "weights": (1, 3)}):
            plan = mixing.planned(docs, **settings).collect()
            out = mixing.mixed_documents(docs, **settings).withColumn("size", mixing.size_of())
            want = Counter({(r["doc_id"], r["source"], r["size"], c): r["n_rows"] for r in plan for c in range(1, r["copies"] + 1)})
            got = Counter((r["doc_id"], r["source"], r["size"], r["copy"]) for r in out.collect())
            assert got == want and sum(got.values())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_texts_are_not_shuffled_for_the_mix(spark):
    docs = made(spark, 6000, ["a", "b", "c", None])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        # Too little for a row per document, as a large mix is for any limit.
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32k")
        out = mixing.mixed_documents(docs)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan


def test_stages_leave_slim_frames_only(spark):
    text = " ".join(f"Quiet words number {i} make a good sentence here." for i in range(8))
    rows = [(i, f"Opening of text {i}.\n{text.replace('words', f'w{i % 20} things')}\nThe same tail ends it all.", "ab"[i % 2]) for i in range(40)]
    rows += [(100 + i, "BAD!! ### $$$ WORDS!! %%% " * 5 + str(i), "a") for i in range(40)]
    docs = spark.createDataFrame(rows, KIND)
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _, _ in rows], "doc_id long, quality int")
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "Quiet words number")], "item_id long, text string")
    base = shared_folder(spark).removeprefix("file://")

    def left_by(stage):
        before = set(os.listdir(base)) if os.path.isdir(base) else set()
        stage().write.format("noop").mode("overwrite").save()
        return {d.rsplit("-", 1)[0] for d in set(os.listdir(base)) - before}

    assert left_by(lambda: quality.keep_good(docs, labels)) == {"rejected"}
    assert left_by(lambda: lines.dedup_lines(docs)) == {"line-drops"}
    assert left_by(lambda: similar.jaccard_join(docs)) == {"merged"}
    assert left_by(lambda: similar.one_of_each(docs)) == {"classes", "copies"}
    assert left_by(lambda: decontamination.clean(docs, benchmark, block_bytes=16)) == {"hits"}
    assert left_by(lambda: mixing.mixed_documents(docs)) == {"cuts"}
