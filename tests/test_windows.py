"""Row-based windows: chunks equal the plain window, global numbering, gaps."""

import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill.operators import windows as W
from tests.conftest import rows


def series(spark, n, skew=False):
    """Unique times; with `skew` most of them fall on one day, other days are sparse."""
    base = datetime.datetime(2024, 1, 1)
    step = lambda i: i * 17 if skew and i % 10 else i * 7201
    data = [(base + datetime.timedelta(seconds=step(i), microseconds=i), float(i * i % 101)) for i in range(n)]
    return spark.createDataFrame(data, "ts timestamp, v double")


def columns(window):
    return {
        **W.lags("v", (1, 7), window, "lag"),
        "avg3": W.rolling_mean("v", window, 3), "max7": W.rolling_max("v", window, 7),
        "min7": W.rolling_min("v", window, 7),
        "before3": W.rolling_mean("v", window, 3, shifted=True),
    }


@pytest.mark.parametrize("skew", [False, True])
@pytest.mark.parametrize("chunk, bucket", [
    (7, None), (50, None), (10_000, None), (7, "day"),
])
def test_chunked_equals_plain(spark, skew, chunk, bucket):
    bucket = F.to_date("ts") if bucket else None
    df = series(spark, 600, skew)
    plain = df.select("*", *[c.alias(n) for n, c in columns(W.ordered("ts")).items()])
    chunked = W.chunked(df, "ts", 7, columns, bucket=bucket, rows_per_chunk=chunk)
    assert rows(chunked, *plain.columns) == rows(plain)


def test_chunk_must_hold_the_reach(spark):
    with pytest.raises(ValueError):
        W.chunked(series(spark, 3), "ts", 8, columns, rows_per_chunk=7)


def test_chunked_has_no_global_window_over_rows(spark):
    plan = W.chunked(series(spark, 50), "ts", 7, columns, rows_per_chunk=10)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert sum("_chunk" in line for line in windows) >= 1
    assert [line for line in windows if "_chunk" not in line and "partitionBy" in line] == []


def test_numbering_follows_the_order(spark):
    df = W.numbered(series(spark, 300, True), "ts", F.to_date("ts"))
    ordered = [r["row_num"] for r in df.orderBy("ts").collect()]
    assert ordered == list(range(1, 301))


def test_lags_and_fallback(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 5)], "d int, v double")
    window = W.ordered("d")
    made = df.select(
        "d", W.lags("v", (2,), window, "a")["a_2"].alias("null_kept"),
        W.lags("v", (2,), window, "a", True)["a_2"].alias("own"),
    )
    assert rows(made) == [(1, None, 1.0), (2, None, 2.0), (3, 1.0, 1.0), (4, 2.0, 2.0)]


def test_frames_count_rows_and_densify_fills_dates(spark):
    days = [datetime.date(2024, 1, d) for d in (1, 2, 5)]
    df = spark.createDataFrame([(d, float(d.day)) for d in days], "date date, v double")
    lag = W.lags("v", (1,), W.ordered("date"), "v")["v_1"]
    assert [r[0] for r in df.orderBy("date").select(lag).collect()] == [None, 1.0, 2.0]
    dense = W.densify(df)
    assert dense.count() == 5
    assert [r[0] for r in dense.orderBy("date").select(lag).collect()] == [None, 1.0, 2.0, None, None]


def test_partitioned_window_restarts(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("b", 3, 3.0)], "k string, d int, v double")
    lag = W.lags("v", (1,), W.ordered("d", ["k"]), "v")["v_1"]
    assert rows(df.select("k", "d", lag.alias("p"))) == [("a", 1, None), ("a", 2, 1.0), ("b", 3, None)]


def test_even_buckets_split_a_hot_stretch(spark):
    df = W.even_buckets(series(spark, 3000, True), "ts", 16)
    sizes = [r["count"] for r in df.groupBy("bucket").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 3000 / 16 * 2
    numbers = W.even_buckets(spark.range(100), "id", 4)
    assert numbers.groupBy("bucket").count().count() == 4
    assert W.even_buckets(spark.range(0), "id", 4).count() == 0
    ordered = [r["row_num"] for r in W.numbered(df, "ts", "bucket").orderBy("ts").collect()]
    assert ordered == list(range(1, 3001))


def test_chunks_per_group_with_a_hot_group_and_nulls(spark):
    df = series(spark, 900, True).withColumn("k", F.when(F.second("ts") < 40, "hot").when(F.second("ts") < 55, F.concat(F.lit("k"), F.minute("ts"))))
    late = spark.createDataFrame([(None, float(i), k) for i, k in enumerate(["hot", None, "k1"])], df.schema)
    df = df.unionByName(late)
    plain = df.select("*", *[c.alias(n) for n, c in columns(W.ordered("ts", ["k"])).items()])
    chunked = W.chunked(df, "ts", 7, columns, by=["k"], rows_per_chunk=20)
    assert rows(chunked, *plain.columns) == rows(plain) and chunked.count() == 903


def test_numbering_shuffles_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "t")
    series(spark, 100).withColumn("k", F.lit("a")).write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = W.numbered(spark.read.parquet(path), "ts", F.to_date("ts"), by=["k"])
        lines = out._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    scan = next(i for i in range(join, len(lines)) if "Scan parquet" in lines[i])
    assert sum("Exchange" in line for line in lines[join:scan]) == 1


@pytest.mark.parametrize("span, chunk", [(1, 5), (5, 5), (7, 3), (12, 4), (50, 7), (64, 100), (1000, 10)])
def test_long_frames_equal_plain(spark, span, chunk):
    data = [(i % 3 if i % 5 else 7, i, None if i % 11 == 0 else float((i * 37) % 101) / 4) for i in range(220)]
    df = spark.createDataFrame([*data, (9, 1, None), (None, 1, 2.5), (None, 2, 1.5)], "k int, t int, v double").repartition(5)
    frame = Window.partitionBy("k").orderBy("t").rowsBetween(1 - span, 0)
    plain = df.select(
        "*", F.avg("v").over(frame).alias("rolling_avg"), F.max("v").over(frame).alias("rolling_max"),
        F.min("v").over(frame).alias("rolling_min"), F.count("v").over(frame).alias("rolling_count"),
    )
    made = W.long_rolling(df, "t", "v", span, by=["k"], rows_per_chunk=chunk, scale=2)
    assert made.columns == plain.columns and rows(made) == rows(plain)


def test_long_frames_of_one_series(spark):
    df = series(spark, 500, True)
    frame = Window.orderBy("ts").rowsBetween(-99, 0)
    plain = df.select("*", F.max("v").over(frame).alias("rolling_max"))
    made = W.long_rolling(df, "ts", "v", 100, rows_per_chunk=30)
    assert rows(made, *plain.columns) == rows(plain)
    assert made.filter("rolling_count <> least(100, 500)").count() == 99
    assert W.long_rolling(df.limit(0), "ts", "v", 100).count() == 0
    with pytest.raises(ValueError):
        W.long_rolling(df, "ts", "v", 0)


def test_long_frames_grow_row_by_row(spark, monkeypatch):
    plans, keep = [], W.stored

    def stored(df, purpose):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, purpose)

    monkeypatch.setattr(W, "stored", stored)
    made = W.long_rolling(series(spark, 500, True), "ts", "v", 100, rows_per_chunk=30)
    plans.append(made._jdf.queryExecution().optimizedPlan().toString())
    # A frame up to the following end would be gone through anew for every row of a chunk.
    assert any("specifiedwindowframe" in p for p in plans) and not any("unboundedfollowing" in p for p in plans)
