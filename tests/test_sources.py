"""CSV readings, ranges, JDBC and topic options."""

import pytest
from pyspark.sql import functions as F

from gridmill import schemas
from gridmill.sinks import messages as message_sink
from gridmill.sinks import tables
from gridmill.sources import jdbc
from gridmill.sources import messages as M
from gridmill.sources import readings as R
from tests.conftest import rows


def test_csv_readings_drop_bad_rows(spark, tmp_path, at):
    (tmp_path / "a.csv").write_text(
        "c1,2016-01-01 00:30:00,1.5\nc2,never,1\nc3,2016-01-01,x\n,2016-01-01,1\nc4,2016-01-02,2\n"
    )
    out = R.read_csv_readings(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "timestamp", "double"]
    assert rows(out) == [("c1", at("2016-01-01 00:30"), 1.5), ("c4", at("2016-01-02"), 2.0)]


def test_range_includes_both_days_and_reaches_the_scan(spark, tmp_path, at):
    frame = spark.createDataFrame(
        [(at("2016-01-31 23:59"),), (at("2016-02-01"),), (at("2016-02-02 23:59:59.9"),),
         (at("2016-02-03"),), (None,)], "ts timestamp",
    )
    assert R.between(frame, "ts", "2016-02-01", "2016-02-02").count() == 2
    assert R.between(frame, "ts").count() == 4
    assert R.between(frame, "ts", end="2016-02-01").count() == 2
    frame.write.parquet(str(tmp_path / "t"))
    plan = R.between(spark.read.parquet(str(tmp_path / "t")), "ts", "2016-02-01", "2016-02-02")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_union_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("x", 1)], "b string, a int")
    assert rows(R.union_frames([a, b])) == [(1, "x"), (1, "x")]


def test_jdbc_scan_options():
    plain = jdbc.scan_options("jdbc:x", "readings", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "readings", "fetchsize": "10000", "user": "u"}
    assert jdbc.scan_options("jdbc:x", query=" SELECT 1 ")["dbtable"] == "(SELECT 1) AS scanned"
    assert jdbc.scan_options("jdbc:x", "selected_rows")["dbtable"] == "selected_rows"
    with pytest.raises(ValueError):
        jdbc.scan_options("jdbc:x", "t", query="SELECT 1")
    split = jdbc.scan_options("jdbc:x", "t", column="id", lower=0, upper=9, partitions=3)
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "3")
    with pytest.raises(ValueError):
        jdbc.scan_options("jdbc:x", "t", column="id")
    assert tables.jdbc_options("jdbc:x", "t")["batchsize"] == "10000"


def test_topic_options():
    assert M.topic_options("h:1", "t")["subscribe"] == "t"
    assert M.topic_options("h:1", pattern="t.*")["subscribePattern"] == "t.*"
    with pytest.raises(ValueError):
        M.topic_options("h:1")


HOUSES = [
    ("1", '{"house_id": 1, "house_size": 80.5, "location_score": 7.5, "price": 9, '
          '"timestamp": "2024-01-02T03:04:05.678901"}'),
    ("2", '{"house_id": 2, "timestamp": "2024-01-02T03:04:05"}'),
    ("3", '{"house_id": "many", "price": 5}'),
    ("4", "no json"),
]


def test_house_messages(spark, at):
    frame = spark.createDataFrame(HOUSES, "key string, value string").withColumn(
        "timestamp", F.lit("2024-01-01").cast("timestamp")
    ).withColumn("value", F.col("value").cast("binary"))
    out = M.decode_houses(frame)
    assert rows(out, "kafka_key", "house_id", "price", "timestamp") == [
        ("1", 1, 9, at("2024-01-02 03:04:05.678901")), ("2", 2, None, None),
        ("3", None, 5, None), ("4", None, None, None),
    ]
    typed = tables.typed_result(out, schemas.HOUSE_TYPES)
    assert typed.schema["house_size"].dataType.simpleString() == "decimal(10,2)"
    assert float(typed.filter("house_id = 1").first()["location_score"]) == 7.5


def test_message_rows_round_trip(spark):
    frame = spark.createDataFrame([(7, 1.5, None)], "house_id int, size double, note string")
    key, value = message_sink.message_rows(frame, "house_id").first()
    assert (key, value) == ("7", '{"house_id":7,"size":1.5}')


ENVELOPES = [
    '{"batch_id": 1, "records": [{"customer_id": "a", "day": 3, "load_percentage": 1.5, '
    '"timestamp": "2016-01-03 00:15:00", "batch_id": "b1"}, '
    '{"customer_id": "b", "load_percentage": "high", "timestamp": "soon"}]}',
    '{"batch_id": 2, "records": []}', '{"batch_id": 3, "records": null}', '{"batch_id": 4}',
    "{broken", '{"batch_id": "five", "records": [{"customer_id": "c"}]}', None,
]


def test_envelopes(spark, at):
    frame = spark.createDataFrame([(v,) for v in ENVELOPES], "value string")
    out = M.decode_readings(frame)
    assert rows(out, "customer_id", "day_num", "load_percentage", "full_timestamp", "batch_id") == [
        ("a", 3, 1.5, at("2016-01-03 00:15"), "b1"), ("b", None, None, None, None),
        ("c", None, None, None, None),
    ]
    assert M.rejected_messages(frame).count() == 5
    full = M.readings_of_records(M.explode_records(M.decode_envelopes(frame)))
    assert rows(full) == rows(out)


def test_json_is_decoded_once_per_message(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([(v,) for v in ENVELOPES], "value string").write.parquet(path)
    plan = M.decode_readings(spark.read.parquet(path))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("from_json") == 1


def test_routing(spark):
    frame = spark.createDataFrame(
        [("light", "{}"), ("light", None), ("light", "[1"), ("sound", "{}")],
        "sensor string, value string",
    )
    chosen = M.routed(M.with_topic(frame, "sensor"))
    assert rows(chosen, "topic", "value") == [
        ("sensor-topic-light", "[1"), ("sensor-topic-light", "{}"),
    ]
    good, bad = M.split_rejects(chosen, schemas.HOUSE)
    assert (good.count(), rows(bad, "value")) == (1, [("[1",)])
