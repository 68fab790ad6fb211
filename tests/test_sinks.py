"""Table sinks and the shared folder."""

import datetime

import pytest
from pyspark.sql import functions as F

from gridmill import schemas
from gridmill.session import new_folder, shared_folder, stored
from gridmill.sinks import tables
from tests.conftest import rows


@pytest.fixture
def readings(spark, at):
    data = [(f"c{i % 7}", "P", 1, i % 24, 0, i % 96, float(i), at("2016-01-01") + datetime.timedelta(hours=i))
            for i in range(60)]
    return spark.createDataFrame(data, schemas.READINGS)


def test_create_is_repeatable_and_append_appends(spark, readings):
    spark.sql("DROP TABLE IF EXISTS sink_readings")
    for _ in range(2):
        tables.create_readings_table(spark, "sink_readings")
    tables.write_readings(readings, "sink_readings")
    tables.write_readings(readings, "sink_readings")
    table = spark.table("sink_readings")
    assert table.count() == 120
    assert table.filter(F.to_date("full_timestamp") != F.col("date")).count() == 0
    pruned = table.filter("date = '2016-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in pruned
    spark.sql("DROP TABLE sink_readings")


def test_layout_splits_a_hot_date(spark, at, tmp_path):
    hot = spark.range(0, 200_000, 1, 8).select(
        F.concat(F.lit("customer "), F.xxhash64("id")).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, at("2016-01-02")).otherwise(at("2016-01-01")).alias("full_timestamp"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200KB")
    try:
        path = tmp_path / "t"
        tables.append_files(tables.readings_layout(hot), str(path), partition_by=["date"])
    finally:
        spark.conf.set(key, before)
    for date in ("2016-01-01", "2016-01-02"):
        assert len(list((path / f"date={date}").glob("*.parquet"))) > 1
    written = spark.read.parquet(str(path))
    assert written.count() == 200_000
    one_file = str(next((path / "date=2016-01-01").glob("*.parquet")))
    ids = [r[0] for r in spark.read.parquet(one_file).select("customer_id").collect()]
    assert ids == sorted(ids)


def test_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "p string, v int")
    tables.replace_partitions(frame, path, ["p"])
    tables.replace_partitions(spark.createDataFrame([("b", 9)], "p string, v int"), path, ["p"])
    assert rows(spark.read.parquet(path), "p", "v") == [("a", 1), ("a", 2), ("b", 9)]


def test_append_modes(spark, tmp_path):
    frame = spark.range(3)
    path = str(tmp_path / "t")
    tables.append_files(frame, path)
    tables.append_files(frame, path)
    assert spark.read.parquet(path).count() == 6
    spark.sql("DROP TABLE IF EXISTS sink_plain")
    tables.append_table(frame, "sink_plain")
    tables.append_table(frame, "sink_plain")
    assert spark.table("sink_plain").count() == 6
    spark.sql("DROP TABLE sink_plain")


def test_typed_result(spark):
    frame = spark.createDataFrame([(1, 12.345, 9.96, "x")], "house_id long, house_size double, location_score double, rooms string")
    types = {k: schemas.PREDICTION_TYPES[k] for k in ("house_id", "house_size", "location_score", "rooms")}
    out = tables.typed_result(frame, types)
    assert [t for _, t in out.dtypes] == ["int", "decimal(10,2)", "decimal(3,1)", "int"]
    row = out.first()
    assert (str(row["house_size"]), str(row["location_score"]), row["rooms"]) == ("12.35", "10.0", None)


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    configured = str(tmp_path / "shared")
    conf = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == (conf or shared_folder(spark))
    assert new_folder(spark, "x") != new_folder(spark, "x")

    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: configured + "/")

    assert shared_folder(Session) == configured

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        shared_folder(Cluster)


def test_stored_keeps_rows(spark):
    assert rows(stored(spark.range(5), "kept")) == [(i,) for i in range(5)]
