"""Stream jobs: equal to batch, restartable, repeatable per batch."""

import json
import os

import pytest
from pyspark.sql import functions as F

from gridmill import schemas
from gridmill.sources import messages as M
from gridmill.streaming import jobs as S
from tests.conftest import rows

READING = ("customer_id", "interval_idx", "load_percentage", "full_timestamp")


def record(customer, hour, load, month="01"):
    return {
        "raw_data": f"res_{customer}", "file_name": "f.txt", "line_number": 1,
        "customer_id": customer, "profile_type": "P", "year": 2016, "month": "January",
        "month_num": int(month), "day": 1, "date": f"2016-{month}-01", "hour": hour, "minute": 0,
        "interval_idx": hour * 4, "timestamp": f"2016-{month}-01 {hour:02d}:00:00",
        "load_percentage": load, "batch_id": "b",
    }


def put(folder, name, *envelopes):
    lines = [e if isinstance(e, str) else json.dumps({"batch_id": 1, "records": e}) for e in envelopes]
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "inbox"
    folder.mkdir()
    put(folder, "1.txt", [record("a", 1, 1.0), record("b", 1, 2.0)], "{broken", [])
    put(folder, "2.txt", [record("a", 2, 3.0, "02")])
    return folder


def stream(spark, inbox, per_trigger=1):
    return M.stream_files(spark, str(inbox), fmt="text", files_per_trigger=per_trigger).withColumn(
        "timestamp", F.current_timestamp())


def run(job):
    job.awaitTermination()
    return job


def test_stream_equals_batch_and_restarts(spark, inbox, tmp_path):
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    job = run(S.ingest_readings(stream(spark, inbox), table, state, available_now=True))
    assert job.lastProgress["batchId"] >= 0
    batch = M.decode_readings(spark.read.text(str(inbox)))
    out = spark.read.parquet(table)
    assert rows(out, *READING) == rows(batch, *READING) and out.count() == 3
    assert out.filter("created_at IS NULL").count() == 0
    assert rows(out.select("ingest_batch").distinct()) == [(0,), (1,)]  # one file per trigger

    run(S.ingest_readings(stream(spark, inbox), table, state, available_now=True))
    assert spark.read.parquet(table).count() == 3
    put(inbox, "3.txt", [record("c", 5, 9.0)])
    run(S.ingest_readings(stream(spark, inbox), table, state, available_now=True))
    assert spark.read.parquet(table).count() == 4


def test_repeated_batch_replaces_itself_and_empty_is_skipped(spark, inbox, tmp_path):
    table = str(tmp_path / "table")
    batch = S.readings_stream(spark.read.text(str(inbox)))
    write = S.batch_writer(table)
    write(batch, 7)
    write(batch, 7)
    write(batch.filter("false"), 8)
    assert spark.read.parquet(table).count() == 3
    assert sorted(n for n in os.listdir(table)) == ["ingest_batch=7"]


def test_late_copies_are_dropped_on_request(spark, inbox, tmp_path):
    untimed = [{**record("a", 1, load), "timestamp": "soon"} for load in (7.0, 8.0)]
    put(inbox, "3.txt", [record("a", 1, 1.0), *untimed])
    keep, drop = str(tmp_path / "keep"), str(tmp_path / "drop")
    run(S.ingest_readings(stream(spark, inbox, 9), keep, str(tmp_path / "s1"), available_now=True))
    run(S.ingest_readings(stream(spark, inbox, 9), drop, str(tmp_path / "s2"), late_by="60 days",
                          available_now=True))
    assert (spark.read.parquet(keep).count(), spark.read.parquet(drop).count()) == (6, 5)


def test_processing_time_trigger(spark, inbox, tmp_path):
    table = str(tmp_path / "table")
    job = S.ingest_readings(stream(spark, inbox), table, str(tmp_path / "s"), trigger="1 second",
                            name="timed_ingest")
    try:
        job.processAllAvailable()
        assert job.name == "timed_ingest"
    finally:
        job.stop()
    assert spark.read.parquet(table).count() == 3


def test_fan_out(spark, inbox, tmp_path):
    path = str(tmp_path / "tables")
    run(S.fan_out(stream(spark, inbox), path, str(tmp_path / "s"), available_now=True))
    put(inbox, "3.txt", [record("d", 3, 6.0)])
    run(S.fan_out(stream(spark, inbox), path, str(tmp_path / "s"), available_now=True))
    assert rows(S.monthly_average_table(spark, path)) == [(1, "January", 3.0), (2, "February", 3.0)]
    detail = spark.read.parquet(f"{path}/load_data_detail")
    assert detail.count() == 4 and dict(detail.dtypes)["year"] == "string"
    assert rows(spark.read.parquet(f"{path}/raw_data"), "raw_data")[0] == ("res_a",)
    S.fanout_writer(path)(spark.read.text(str(inbox / "3.txt")), 2)  # batch 2 again
    assert rows(S.monthly_average_table(spark, path))[0] == (1, "January", 3.0)


def test_topics_are_routed_with_rejects(spark, tmp_path):
    inbox = tmp_path / "topics"
    inbox.mkdir()
    (inbox / "1.json").write_text("\n".join(json.dumps(m) for m in [
        {"topic": "sensor-topic-light", "value": '{"house_id": 1}'},
        {"topic": "sensor-topic-light", "value": "oops"},
        {"topic": "sensor-topic-light", "value": None},
        {"topic": "sensor-topic-gyroscope", "value": '{"house_id": 2}'},
        {"topic": "weather", "value": '{"house_id": 3}'},
    ]))
    messages = M.stream_files(spark, str(inbox), "topic string, value string", "json")
    path = str(tmp_path / "out")
    run(S.route_topics(messages, path, str(tmp_path / "s"), schemas.HOUSE, available_now=True))
    assert rows(spark.read.parquet(f"{path}/routed"), "topic", "house_id") == [
        ("sensor-topic-gyroscope", 2), ("sensor-topic-light", 1)]
    assert rows(spark.read.parquet(f"{path}/rejected"), "value") == [("oops",)]


def test_fan_out_survives_bad_input(spark, tmp_path):
    inbox, path = tmp_path / "inbox", str(tmp_path / "tables")
    inbox.mkdir()
    someday = {**record("a", 1, 4.0), "date": "someday"}
    untimed = {**record("b", 1, 5.0), "timestamp": "soon"}
    put(inbox, "1.txt", [someday, untimed, record("c", 1, 1e13), record("c", 1, 1e-7)], "{broken", [])
    run(S.fan_out(stream(spark, inbox), path, str(tmp_path / "s"), available_now=True))
    months = {r["month_num"]: r["avg_load_percentage"] for r in S.monthly_average_table(spark, path).collect()}
    assert months == {None: 5.0, 1: pytest.approx((4.0 + 1e13 + 1e-7) / 3)}
    detail = spark.read.parquet(f"{path}/load_data_detail")
    assert (detail.count(), detail.filter("date IS NULL").count()) == (4, 1)
    assert spark.read.parquet(f"{path}/rejected").count() == 2


def test_a_batch_is_read_once(spark, inbox, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    for name, write in (
        ("table", S.batch_writer(str(tmp_path / "t"))), ("tables", S.fanout_writer(str(tmp_path / "f"))),
    ):
        before = seen.value
        watched = spark.read.text(str(inbox)).mapInPandas(look, "value string")
        write(S.readings_stream(watched) if name == "table" else watched, 0)
        assert seen.value - before == 4


def test_micro_batches_are_read_by_every_core(spark, monkeypatch):
    from checks import queries as Q

    seen, plain = [], Q.M.stream_files

    def stream_files(spark, path, schema, files_per_trigger):
        written = len([f for f in os.listdir(path) if f.endswith(".parquet")])
        seen.append((written, files_per_trigger))
        return plain(spark, path, schema, files_per_trigger=files_per_trigger)

    monkeypatch.setattr(Q.M, "stream_files", stream_files)
    out = Q.stream_compacted(spark, "/root/testdata/sf0.001")
    width = spark.sparkContext.defaultParallelism
    assert seen == [(3 * width, width), (5 * width, width)]  # three batches, then two more
    monkeypatch.undo()
    assert out.count() == Q.stream_bronze(spark, "/root/testdata/sf0.001").count()
