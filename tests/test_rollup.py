"""Roll-ups against brute force, also with one hot group."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmill.operators import reports, rollup
from gridmill.streaming.serving import serving_view
from tests.conftest import rows


@pytest.fixture(scope="module")
def skewed(spark):
    random.seed(5)
    data = [("hot", random.choice([random.expovariate(0.01), 7.0])) for _ in range(3000)]
    data += [(f"k{i % 40}", round(random.gauss(50, 20), 1)) for i in range(2000)]
    data += [("single", 3.5), ("pair", 1.0), ("pair", 2.0), ("empty", None), ("same", 4.0), ("same", 4.0)]
    data += [("nan", float("nan")), ("nan", 2.0), (None, 9.0), (None, 1.0), (None, None)]
    return data, spark.createDataFrame(data, "k string, v double").repartition(6).persist()


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
def test_summary_is_exact(skewed, accuracy):
    data, frame = skewed
    got = {r["k"]: r for r in rollup.summary(frame, "v", ["k"], accuracy=accuracy).collect()}
    groups = {}
    for k, v in data:
        groups.setdefault(k, [])
        if v is not None and v == v:
            groups[k].append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        row = got[k]
        assert row["count"] == len(values)
        if not values:
            assert set(row[c] for c in ("mean", "std", "min", "p25", "p50", "p75", "max")) == {None}
            continue
        assert row["mean"] == pytest.approx(np.mean(values))
        assert (row["min"], row["max"]) == (min(values), max(values))
        if len(values) > 1:
            assert row["std"] == pytest.approx(np.std(values, ddof=1), abs=1e-9)
        else:
            assert row["std"] is None
        for q in (25, 50, 75):
            assert row[f"p{q}"] == pytest.approx(np.percentile(values, q)), (k, q)


def test_summary_of_a_whole_table(skewed):
    data, frame = skewed
    values = [v for _, v in data if v is not None and v == v]
    row = rollup.summary(frame, "v", quantiles=(0.1, 0.5, 0.99), accuracy=200).first()
    assert row["count"] == len(values)
    assert [row[p] for p in ("p10", "p50", "p99")] == pytest.approx(list(np.percentile(values, [10, 50, 99])))


def test_summary_of_several_columns(spark):
    frame = spark.createDataFrame([(None, 1.0, 5), ("a", None, 7), (None, 3.0, 6)], "k string, x double, y int")
    got = rollup.summary(frame, ["x", "y"], ["k"], quantiles=(0.5,)).select("k", "column", "count", "p50").collect()
    assert set(map(tuple, got)) == {(None, "x", 2, 2.0), ("a", "x", 0, None), (None, "y", 2, 5.5), ("a", "y", 1, 7.0)}
    none = rollup.summary(frame.filter("false"), ["x", "y"])
    assert rows(none, "column", "count", "p50") == [("x", 0, None), ("y", 0, None)]
    assert rollup.summary(frame.filter("false"), "x", ["k"]).count() == 0


def test_describe(spark):
    frame = spark.createDataFrame([(1, "b"), (3, "a"), (None, None)], "n int, s string")
    got = [tuple(r) for r in rollup.describe(frame).collect()]
    assert got == [("n", 2, 2.0, pytest.approx(2**0.5), "1", "3"), ("s", 2, None, None, "a", "b")]
    assert [r["count"] for r in rollup.describe(frame.filter("false")).collect()] == [0, 0]


def test_daily_flavours_differ(spark, at):
    frame = spark.createDataFrame(
        [("a", at("2024-01-01 00:00"), 1.0), ("b", at("2024-01-01 00:00"), 2.0), ("a", at("2024-01-01 01:00"), 6.0)],
        "customer_id string, full_timestamp timestamp, load_percentage double",
    )
    by_system = rollup.daily_energy(rollup.system_rollup(frame)).first()
    by_reading = rollup.daily_readings(frame).first()
    assert by_system["total_daily_energy"] == by_reading["total_daily_energy"] == 9.0
    assert (by_system["avg_daily_load"], by_reading["avg_daily_load"]) == (4.5, 3.0)
    assert (by_system["total_daily_customers"], by_reading["customer_count"]) == (3, 2)
    assert by_system["date"] == "2024-01-01" and by_reading["date"] == datetime.date(2024, 1, 1)
    approximate = rollup.daily_readings(frame, approximate=True).first()
    assert approximate["customer_count"] == 2


def test_peak_takes_the_earliest_of_ties(spark, at):
    frame = spark.createDataFrame(
        [("a", at("2024-01-01 02:15"), 5.0), ("a", at("2024-01-01 01:30"), 5.0), ("a", at("2024-01-01 01:00"), 4.0)],
        "k string, ts timestamp, v double",
    )
    assert rows(rollup.peak_interval(frame, ["k"], "ts", "v")) == [
        ("a", 5.0, at("2024-01-01 01:30"), "01:30")]


def test_monthly_average_skips_nan_and_merges(spark, at):
    frame = spark.createDataFrame(
        [(at("2024-01-05"), 1.0), (at("2023-01-09"), 4.0), (at("2024-01-06"), float("nan")), (at("2024-03-01"), 8.0)],
        "ts timestamp, v double",
    )
    assert rows(rollup.monthly_average(frame, "ts", "v")) == [(1, "January", 2.5), (3, "March", 8.0)]
    halves = [rollup.monthly_partials(frame.filter(c), "ts", "v") for c in ("v < 3", "v >= 3")]
    assert rows(rollup.merge_monthly(halves[0].unionByName(halves[1]))) == [(1, "January", 2.5), (3, "March", 8.0)]


def test_latest_snapshot_pushes_the_maximum(spark, tmp_path, at):
    frame = spark.createDataFrame([(i, at("2024-01-01") + datetime.timedelta(hours=i % 5)) for i in range(20)], "id int, ts timestamp")
    frame.write.parquet(str(tmp_path / "t"))
    out = reports.latest_snapshot(spark.read.parquet(str(tmp_path / "t")), "ts", [F.col("id").desc()], 3)
    assert [r["id"] for r in out.collect()] == [19, 14, 9]
    assert "PushedFilters: [IsNotNull(ts)" in out._jdf.queryExecution().executedPlan().toString()


def test_coverage_maxima_are_independent(spark, at):
    frame = spark.createDataFrame([(at("2024-01-01 10:45"),), (at("2024-01-01 11:15"),)], "ts timestamp")
    assert tuple(reports.coverage(frame, "ts").first())[1:] == (2, 11, 45)


def test_first_customers(spark):
    frame = spark.createDataFrame([(3, "b"), (1, "c"), (2, "a"), (4, "c")], "pos int, k string")
    assert [r["k"] for r in reports.first_customers(frame, "k", "pos", 2).collect()] == ["c", "a"]
    out = reports.customer_comparison(frame, "k", "pos", ["pos"], 2)
    assert rows(out) == [("a", 2), ("c", 1), ("c", 4)]
    assert rows(reports.customer_profile(frame, "k", "pos"), "pos") == [(1,), (4,)]
    assert rows(reports.customer_profile(frame, "k", "pos", "b"), "pos") == [(3,)]


def test_serving_view_prefers_the_newer_layer(spark):
    batch = spark.createDataFrame([(1, 10.0), (2, 20.0)], "d int, v double")
    speed = spark.createDataFrame([(2, 21.0), (3, 30.0)], "d int, v double")
    assert rows(serving_view(batch, speed, ["d"], ["v"]), "d", "v") == [(1, 10.0), (2, 21.0), (3, 30.0)]


def test_log_pivot(spark, at):
    frame = spark.createDataFrame(
        [("r1", "rmse", "1", at("2024-01-01")), ("r1", "rmse", "2", at("2024-01-02")), ("r2", "mae", "3", at("2024-01-01"))],
        "run_id string, key string, value string, ts timestamp",
    )
    assert rows(reports.log_pivot(frame, ["rmse", "mae"])) == [("r1", "2", None), ("r2", None, "3")]


def test_cardinalities(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "x int, y string")
    assert rows(rollup.cardinalities(frame, ["x", "y"])) == [("x", 2), ("y", 2)]
