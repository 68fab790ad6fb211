"""The sorted prefix tries of the n-gram Jaccard join against plain Python."""

import random

from pyspark.sql import functions as F

from gridmill.llm import similar

LABELS = "tree int, label binary, k1 long, k2 long"


def common(a, b, floor):
    same = next((i for i in range(8) if a[4 * i:4 * i + 4] != b[4 * i:4 * i + 4]), 8)
    return same if same >= floor else 0


def test_matches_with_neighbours_over_partitions(spark):
    draw = random.Random(5)
    value = lambda: bytes([draw.randrange(2)] * 4)
    rows = [(t, b"".join(value() for _ in range(8)), i, i) for t in range(3) for i in range(200)]
    # A third of all labels lies below one node.
    rows += [(1, b"same" * 7 + bytes([i % 250] * 4), 500 + i, 0) for i in range(300)]
    out = {(r["tree"], r["k1"]): r["matched"] for r in similar.sorted_tries(spark.createDataFrame(rows, LABELS).repartition(7), 6).collect()}
    for t, label, k1, _ in rows:
        others = [common(label, b, 6) for u, b, k, _ in rows if u == t and k != k1]
        assert out[t, k1] == max(others)
    assert similar.sorted_tries(spark.createDataFrame([], LABELS), 6).count() == 0


def test_prefixes_are_shortened_where_it_costs_least(spark):
    # Tree 3 would gain many members at depth 7, tree 5 none.
    rows = [(t, b"", i, 0, 8) for t in range(32) for i in range(3)]
    rows += [(t, b"", 10 + i, 0, 7) for t in range(32) if t != 5 for i in range(50 if t == 3 else 2)]
    tries = spark.createDataFrame(rows, LABELS + ", matched int")
    depths = similar.shortened(tries, similar.prefix_depth())
    assert depths[3] == 8 and depths[5] == 7 and set(depths) == {7, 8}
    assert similar.met(depths) >= similar.RECALL
    longer = [d if t != 5 else 8 for t, d in enumerate(depths)]
    assert similar.met(longer) < similar.RECALL
    assert similar.shortened(tries.limit(0), 7, recall=0.9) == [8] * 32


def test_recall_of_pairs_at_the_threshold(spark):
    rows = []
    for i in range(500):
        words = [f"w{i}x{j}" for j in range(54)]
        rows += [(2 * i, " ".join(words[:44])), (2 * i + 1, " ".join(words))]  # 40 of 50 shingles
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in similar.jaccard_join(docs).collect()}
    met = sum(out[2 * i] == out[2 * i + 1] == (2 * i, 1) for i in range(500))
    assert met >= 495 and all(c in (d, d - 1) for d, (c, _) in out.items())
    assert similar.jaccard_join(docs.withColumn("text", F.lit(None).cast("string"))).agg(F.sum("n_links")).first()[0] == 0


def test_clashing_columns_of_kept_documents(spark):
    names = ["_uid", "_touched", "_p", "_map", "row", "uid", "words", "touched", "k1"]
    text = "one two three four five six seven eight"
    rows = [(1, text, *names), (1, text, *names), (2, text + "!", *names), (3, None, *names), (4, "else", *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    left = similar.one_of_each(docs).orderBy("doc_id").collect()
    assert [tuple(r) for r in left] == [rows[0], rows[3], rows[4]]
