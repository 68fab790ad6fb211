"""Line dedup and top-k search against plain Python, with edge rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill.llm import common, lines, neighbours


def one_edit(a, b):
    """Whether at most one character is put in, left out or changed."""
    if abs(len(a) - len(b)) > 1:
        return False
    start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    same = len(a) == len(b)
    a, b = sorted((a[start:], b[start:]), key=len)
    return a[1:] == b[1:] if same else a == b[1:]


def test_lines_equal_all_pairs(spark):
    draw = random.Random(7)
    bases = ["".join(draw.choices("abé ", k=n)).strip() or "a" for n in (17, 18, 40, 41, 120, 700) for _ in range(4)]

    def edited(line, times):
        for _ in range(times):
            i = draw.randrange(len(line) + 1)
            line = draw.choice([line[:i] + "b" + line[i:], line[:i] + "é" + line[i + 1:], line[:i] + line[i + 1:]])
        return line

    made = [edited(draw.choice(bases), draw.choice((0, 1, 1, 2))) for _ in range(400)]
    # First and last places, and lines around the least length.
    made += ["x" * 17, "x" * 16, "x" * 15, "y" + "x" * 16, "x" * 16 + "y", "short", "shorn"]
    draw.shuffle(made)
    rows = [(i // 5, "\n".join(made[i:i + 5])) for i in range(0, len(made), 5)]
    out = {r["doc_id"]: r for r in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc, text in rows:
        kept = []
        for j, line in enumerate(text.split("\n")):
            earlier = made[:doc * 5 + j]
            gone = line in earlier or (len(line) >= 16 and any(len(e) >= 16 and one_edit(line, e) for e in earlier))
            if not gone or not line.strip(" "):
                kept.append(line)
        assert (out[doc]["text"], out[doc]["n_kept"]) == ("\n".join(kept), sum(x.strip(" ") != "" for x in kept))


def test_clashing_names_pass_through(spark):
    names = ["gone", "_p", "_bucket", "_map", "_left", "_uid", "_touched", "row", "uid", "touched", "parts", "left", "line"]
    rows = [(1, "one line of some length", *names), (2, "one line of some lengths", *names), (3, None, *names)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = lines.dedup_lines(docs).orderBy("doc_id").collect()
    assert [r["n_kept"] for r in out] == [1, 0, 0]
    assert all([r[n] for n in names] == names for r in out)
    gone = docs.filter("doc_id = 2").select(common.uid().alias("uid"))
    left = common.drop_rows(docs, gone).orderBy("doc_id").collect()
    assert [tuple(r) for r in left] == [rows[0], rows[2]]


@pytest.mark.parametrize("page", [8, 40, 4096])
def test_search_with_levels_and_edge_rows(spark, page):
    rng = np.random.default_rng(3)
    vectors = np.vstack([rng.normal(c, 0.2, (150, 6)) for c in (-1, 0, 2)] + [np.tile(rng.normal(0, 1, 6), (120, 1))])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(None, [9.0] * 6), (700, [])]  # a null id is a candidate, an empty vector scores 0
    rows += [(50, rows[50][1]), (701, [1.0, 2.0])]  # a repeated query, a short vector
    table = spark.createDataFrame(
        [(*r, "kept out") for r in rows + [(800, None), (850, [float("inf")] * 6), (851, [1.0, None])]],
        "vec_id long, embedding array<double>, v string",
    )
    found = neighbours.top_k(table, F.col("vec_id") % 50 == 0, page=page, query_block=4)
    whole = [(i, np.floor(np.array([*v, *[0] * (6 - len(v))]) * 256).astype(int)) for i, v in rows]
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"] is None, r["vec_id"]))
    asked = {i: v for i, v in whole if i is not None and i % 50 == 0}
    assert set(got) == set(asked)
    for q, v in asked.items():
        want = sorted((-int(v @ other), i is None, i or 0) for i, other in whole if i != q)[:5]
        assert [(s, n, i or 0) for s, n, i in got[q]] == want


def test_search_of_large_numbers(spark):
    """Beyond 2^53 products are of integers, beyond 64 bits an error."""
    made = lambda scale: spark.createDataFrame(
        [(0, [scale, 1.0]), (1, [scale, 2.0]), (2, [scale, 3.0])], "vec_id long, embedding array<double>"
    )
    out = neighbours.top_k(made(2.0**21), F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in out] == [(2, 2**58 + 3 * 2**16), (1, 2**58 + 2 * 2**16)]
    with pytest.raises(ValueError, match="64 bits"):
        neighbours.top_k(made(1e19), F.col("vec_id") == 0)
    assert neighbours.top_k(made(1.0).limit(0), F.col("vec_id") == 0).count() == 0
