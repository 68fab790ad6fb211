import datetime

import pytest
from pyspark.sql import functions as F

from gridmill.operators import gates, metadata
from tests.conftest import rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def readings(spark):
    start = datetime.datetime(2016, 1, 1)
    data = [(f"c{i % 5}", start + datetime.timedelta(hours=7 * i), float(i)) for i in range(600)]
    return spark.createDataFrame(data, "customer_id string, full_timestamp timestamp, load_percentage double").withColumn(
        "date", F.to_date("full_timestamp"))


def test_extremes_come_from_footers(spark, readings, tmp_path):
    path = str(tmp_path / "flat")
    readings.repartition(3).write.parquet(path)
    found = metadata.extremes(spark, path, "date")
    assert "PushedAggregation: [MIN(date), MAX(date), COUNT(*)]" in plan(found)
    assert rows(found) == [(datetime.date(2016, 1, 1), datetime.date(2016, 6, 23), 600)]
    # No statistics are kept for times: the column is read, the result is the same.
    times = metadata.extremes(spark, path, "full_timestamp")
    assert "PushedAggregation: []" in plan(times) or "PushedAggregation" not in plan(times)
    newest = datetime.datetime(2016, 1, 1) + datetime.timedelta(hours=7 * 599)
    assert times.first()["newest"] == newest
    assert metadata.newest_rows(spark, path, "date", "full_timestamp").first()["newest"] == newest
    # Other reads keep their own settings.
    assert "BatchScan" not in plan(spark.read.parquet(path))


@pytest.mark.parametrize("season, year", [("spring", 2016), ("summer", 2016), ("autumn", 2015)])
def test_gate_equals_the_one_that_reads(spark, readings, tmp_path, season, year):
    path = str(tmp_path / "dated")
    readings.write.partitionBy("date").parquet(path)
    made = metadata.availability(spark, path, season, year, min_rows=300)
    assert rows(made) == rows(gates.availability(readings, "full_timestamp", season, year, min_rows=300))
    counted = metadata.rows_between(spark, path, "2016-02-01", "2016-02-29")
    assert "PushedAggregation: [COUNT(*)]" in plan(counted)
    assert counted.first()[0] == readings.filter("month(date) = 2").count()


def test_empty_table(spark, readings, tmp_path):
    path = str(tmp_path / "none")
    readings.limit(0).write.parquet(path)
    found = metadata.extremes(spark, path, "date").first()
    assert found["newest"] is None and not found["row_count"]
    assert metadata.newest_rows(spark, path, "date", "full_timestamp").first()["newest"] is None
