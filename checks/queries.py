"""One query per operator, each over whole tables of a data folder."""

import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from checks import inputs as I
from gridmill import fixed, schemas
from gridmill.functions import calendar as C
from gridmill.functions import numbers as N
from gridmill.functions import text as X
from gridmill.ml import evaluate, models, registry, split
from gridmill.operators import distinct, features, gaps, gates, incremental, metadata, reports, rollup, windows
from gridmill.plans import jobs
from gridmill.session import new_folder, stored
from gridmill.sinks import layout, manifest
from gridmill.sinks import messages as message_sink
from gridmill.sinks import tables
from gridmill.sources import dayfiles, ledger
from gridmill.sources import messages as M
from gridmill.sources import readings as R
from gridmill.streaming import jobs as S
from gridmill.streaming import late
from gridmill.streaming.serving import serving_view

SCALE = 2  # digits of the money and load columns: sums become exact


# --- sources --------------------------------------------------------------
def wide_unpivot(spark, folder):
    lines = I.wide_lines(spark, folder)
    out = dayfiles.unpivot_lines(lines, keep=("event_id",))
    return out.select(
        "event_id", "customer_id", "profile_type", "day_num", "hour", "minute", "interval_idx",
        F.col("load_percentage").cast("double").alias("load_percentage"),
        F.col("full_timestamp").cast("timestamp_ntz").alias("full_timestamp"),
    )


def _day_files(spark, folder, lines_per_block=10_000):
    """Lines written as one file per event type and block of event ids, so that
    no file outgrows a task; returns the folder.

    Files of views have no header, those of errors hold no data row, and those
    of purchases carry the header below their rows.
    """
    written = new_folder(spark, "day-files")
    rows = I.wide_lines(spark, folder).select(
        "event_type", F.floor(F.col("event_id") / lines_per_block).alias("block"), "event_id", "line"
    )
    header = rows.filter("event_type <> 'view'").groupBy("event_type", "block").agg(
        F.when(F.col("event_type") == "purchase", F.max("event_id") + 1)
        .otherwise(F.lit(-1)).alias("event_id")
    ).withColumn("line", F.lit(fixed.HEADER_LINE))
    (
        rows.unionByName(header)
        .repartition("event_type", "block")
        .sortWithinPartitions("event_type", "block", "event_id")
        .select("event_type", "block", "line")
        .write.partitionBy("event_type", "block")
        .text(written)
    )
    return written


def file_ingest_report(spark, folder):
    written = _day_files(spark, folder)
    report = dayfiles.file_report(dayfiles.read_lines(spark, written, pattern="part-{}"))
    return report.select(
        F.regexp_extract("file", "event_type=([a-z]+)", 1).alias("event_type"),
        F.regexp_extract("file", "block=([0-9]+)", 1).cast("bigint").alias("block"),
        "lines", "row_lines", "readings", "header_ok", "header_with_id", "valid", "loaded",
    )


def day_file_readings(spark, folder):
    """Readings of the valid files; their names carry no number, so the day is 1."""
    readings = dayfiles.read_day_files(spark, _day_files(spark, folder), pattern="part-{}")
    return readings.select(
        "customer_id", "profile_type", "day_num", "interval_idx",
        F.col("load_percentage").cast("double").alias("load_percentage"),
    )


def ledger_ingest(spark, folder):
    """The day files taken in twice, one of them damaged at first and mended before a third time."""
    work, written = new_folder(spark, "ledger"), _day_files(spark, folder)
    names = dayfiles.read_lines(spark, written, pattern="part-{}").select("file").distinct()
    first = names.filter("file LIKE '%event_type=click/%'").agg(F.min("file")).first()[0]
    whole = stored(spark.read.text(first), "whole-file")
    run = lambda: ledger.ingest(spark, written, work, pattern="part-{}")

    def put(lines):
        """One file in place of another; its lines keep their order."""
        made = new_folder(spark, "one-file")
        lines.coalesce(1).write.text(made)
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        files = place(first).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        part = next(name for name, _ in manifest.listed(spark, made) if name.startswith("part-"))
        files.delete(place(first), False)
        files.rename(place(f"{made}/{part}"), place(first))

    put(whole.filter(F.col("value").startswith(fixed.HEADER_PREFIX) | F.col("value").contains("view") | (F.crc32("value") % 2 == 0)))
    run(), run()
    put(whole)
    run()
    return ledger.readings(spark, work).select(
        "customer_id", "profile_type", "day_num", "interval_idx",
        F.col("load_percentage").cast("double").alias("load_percentage"),
    )


def discovered_files(spark, folder):
    """Which day files of the first 60 days there are: a file is written for each day of the events."""
    work, made = new_folder(spark, "discover"), new_folder(spark, "by-day")
    days = I.wide_lines(spark, folder).select("day_num", "line").repartition("day_num")
    days.write.partitionBy("day_num").text(made)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = place(made).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place(work))
    for day, _ in manifest.listed(spark, made):
        if day.startswith("day_num="):
            part = next(name for name, _ in manifest.listed(spark, f"{made}/{day}") if name.startswith("part-"))
            files.rename(place(f"{made}/{day}/{part}"), place(f"{work}/{fixed.DAY_FILE_PATTERN.format(day[8:])}"))
    return dayfiles.discover_day_files(spark, work, days=range(1, 61)).select("day_num", "file_name", "present")


def written_table(spark, folder):
    """The readings table after an append, a repeated append of one type and the
    replacement of the dates from the 29th on."""
    path = f"{new_folder(spark, 'written')}/readings"
    readings = tables.readings_layout(I.readings(spark, folder))
    tables.append_files(readings, path, partition_by=["date"])
    tables.append_files(readings.filter("profile_type = 'view'"), path, partition_by=["date"])
    late = readings.filter("date >= DATE '2024-01-29'")
    tables.replace_partitions(late, path, ["date"])
    return spark.read.parquet(path).groupBy("date", "profile_type").agg(
        F.count(F.lit(1)).alias("record_count"), N.total("load_percentage", SCALE).alias("load_sum")
    )


def two_key_table(spark, folder):
    """The readings written in Morton order of customer and time, read back per date and customer."""
    path = f"{new_folder(spark, 'two-keys')}/readings"
    layout.write_two_keys(I.readings(spark, folder), path)
    return spark.read.parquet(path).groupBy("date", "customer_id").agg(
        F.count(F.lit(1)).alias("record_count"), N.total("load_percentage", SCALE).alias("load_sum")
    )


def missing_days(spark, folder):
    dates = I.load(spark, folder, "orders").select(F.to_date("o_orderdate").alias("date"))
    return dayfiles.missing_dates(dates)


def csv_cast_filter(spark, folder):
    events = I.load(spark, folder, "events")
    kind = F.col("event_type")
    strings = events.select(
        F.when(kind == "signup", F.lit(None)).otherwise(F.col("user_id").cast("string")).alias("_c0"),
        F.when(kind == "view", F.lit("yesterday")).otherwise(F.col("ts").cast("string")).alias("_c1"),
        F.when(kind == "click", F.lit("12,5")).otherwise(F.col("value").cast("string")).alias("_c2"),
    )
    return R.typed_readings(strings).withColumn(
        "full_timestamp", F.col("full_timestamp").cast("timestamp_ntz")
    )


def table_count(spark, folder):
    return rollup.table_count(I.load(spark, folder, "events"))


def kafka_batch_parse(spark, folder):
    # Integers with nulls leave as doubles: frames of other tools have no such integers.
    return M.decode_houses(I.house_messages(spark, folder)).select(
        "kafka_key", F.col("house_id").cast("double").alias("house_id"), "house_size",
        "location_score", F.col("price").cast("double").alias("price"), "house_timestamp",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "kafka_timestamp",
    )


def _stream_columns(df):
    return df.select(
        "customer_id", "profile_type", "day_num", "hour", "minute", "interval_idx",
        "load_percentage",
        F.col("full_timestamp").cast("timestamp_ntz").alias("full_timestamp"),
        "batch_id",
        F.col("processing_timestamp").cast("timestamp_ntz").alias("processing_timestamp"),
    )


def envelope_explode(spark, folder):
    events = I.load(spark, folder, "events")
    return _stream_columns(M.decode_readings(I.envelope_messages(events)))


def rejected_messages(spark, folder):
    messages = I.envelope_messages(I.load(spark, folder, "events"))
    return M.rejected_messages(messages).select(F.col("key").cast("bigint").alias("event_id"), "sensor")


def _event_stream(spark, folder, name):
    """The table as a stream: as a glob, the path may be one file or a folder of part files."""
    schema = I.load(spark, folder, name).schema
    return M.stream_files(spark, f"{folder}/{{{name}.parquet}}", schema, files_per_trigger=2)


def stream_bronze(spark, folder):
    """The stream job over all events until nothing is left, then its table."""
    work = new_folder(spark, "stream")
    messages = I.envelope_messages(_event_stream(spark, folder, "events"))
    job = S.ingest_readings(messages, f"{work}/table", f"{work}/state", available_now=True)
    job.awaitTermination()
    return _stream_columns(spark.read.parquet(f"{work}/table"))


def stream_compacted(spark, folder):
    """Events as a stream of small files into a table with a commit log: micro-batches
    are merged, then more come, and readers take the newest version."""
    work = new_folder(spark, "compacted")
    events = I.load(spark, folder, "events")
    width = spark.sparkContext.defaultParallelism  # files of a batch, so that every core writes and reads

    def ingest(rows, batches):
        rows.repartition(batches * width).write.mode("append").parquet(f"{work}/inbox")
        messages = I.envelope_messages(M.stream_files(spark, f"{work}/inbox", events.schema, files_per_trigger=width))
        S.ingest_logged(messages, f"{work}/table", f"{work}/state", available_now=True).awaitTermination()

    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    ingest(events.filter(early), 3)
    S.compact_readings(spark, f"{work}/table")
    ingest(events.filter(~F.coalesce(early, F.lit(False))), 2)
    return _stream_columns(manifest.read(spark, f"{work}/table"))


def stream_sorted(spark, folder):
    """Hourly readings in three micro-batches, every tenth of them a batch late: per date the first
    copies of a customer's hour, the further copies, and the readings more than a day late."""
    work, rows = new_folder(spark, "sorted"), I.hourly_readings(spark, folder)
    reached = lambda text: (F.col("full_timestamp") >= F.lit(text).cast("timestamp_ntz")).cast("int")
    turn = F.least(F.lit(2), reached("2024-01-11") + reached("2024-01-21") + (F.col("event_id") % 10 == 0).cast("int"))
    for i in range(3):
        rows.filter(turn == i).coalesce(1).write.mode("append").parquet(f"{work}/inbox")
        stream = M.stream_files(spark, f"{work}/inbox", rows.schema)
        late.ingest_sorted(stream, f"{work}/tables", f"{work}/state", "1 day", available_now=True).awaitTermination()
    day = F.to_date("full_timestamp").alias("date")
    found = {name: manifest.read(spark, f"{work}/tables/{name}") for name in ("accepted", "duplicates", "late")}
    one = F.lit(1).cast("long")
    parts = [
        found["accepted"].select(day, one.alias("accepted"), (one * 0).alias("duplicates"), (one * 0).alias("late")),
        found["duplicates"].select(day, (one * 0).alias("accepted"), F.col("copies").alias("duplicates"), (one * 0).alias("late")),
        found["late"].select(day, (one * 0).alias("accepted"), (one * 0).alias("duplicates"), one.alias("late")),
    ]
    return R.union_frames(parts).groupBy("date").agg(*[F.sum(c).alias(c) for c in ("accepted", "duplicates", "late")])


def _fan_out(spark, folder):
    """Folder of the tables that the fan-out job makes of all orders."""
    work = new_folder(spark, "fanout")
    orders = _event_stream(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.lit("meter").alias("event_type"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("value"),
    )
    job = S.fan_out(I.damaged_messages(orders), work, f"{work}/state", available_now=True, scale=SCALE)
    job.awaitTermination()
    return work


def monthly_merge(spark, folder):
    """The fan-out job over all orders, then the merged monthly averages."""
    return S.monthly_average_table(spark, _fan_out(spark, folder))


def fanout_detail(spark, folder):
    """Load details of the fan-out job, damaged messages included."""
    return spark.read.parquet(f"{_fan_out(spark, folder)}/load_data_detail").select(
        "customer_id", "year", "month_num", "month_name", "day", "date", "hour", "load_percentage"
    )


def fanout_raw(spark, folder):
    """Raw lines of all records, and the messages without one."""
    work = _fan_out(spark, folder)
    raw = spark.read.parquet(f"{work}/raw_data").select(F.lit("raw").alias("kind"), F.col("raw_data").alias("text"))
    return raw.unionByName(spark.read.parquet(f"{work}/rejected").select(F.lit("rejected").alias("kind"), F.col("value").alias("text")))


def topic_route(spark, folder):
    messages = M.with_topic(I.envelope_messages(I.load(spark, folder, "events")), "sensor", "topic-")
    chosen = M.routed(messages, "topic-(click|error|view)")
    good, bad = M.split_rejects(chosen, schemas.ENVELOPE)
    tagged = good.select("topic", F.lit("routed").alias("outcome")).unionByName(
        bad.select("topic", F.lit("rejected").alias("outcome"))
    )
    return tagged.groupBy("topic", "outcome").agg(F.count(F.lit(1)).alias("message_count"))


# --- sinks ----------------------------------------------------------------
def to_kafka_rows(spark, folder):
    orders = I.load(spark, folder, "orders")
    rows = message_sink.message_rows(orders, "o_orderkey")
    back = F.from_json("value", "o_custkey bigint, o_totalprice double, o_orderstatus string")
    return rows.select("key", back.alias("v")).select("key", "v.*")


def decimal_result(spark, folder):
    parts = I.load(spark, folder, "part").select(
        F.col("p_partkey").alias("house_id"),
        (F.col("p_retailprice") / 8).alias("house_size"),
        (F.col("p_size") / 4).alias("location_score"),
        F.col("p_size").alias("age_years"),
        F.col("p_size").alias("rooms"),
        F.round("p_retailprice", 0).alias("predicted_price"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("prediction_timestamp"),
    )
    typed = tables.typed_result(parts, schemas.PREDICTION_TYPES)
    return typed.withColumns({
        "house_size": F.col("house_size").cast("double"),
        "location_score": F.col("location_score").cast("double"),
        "prediction_timestamp": F.col("prediction_timestamp").cast("timestamp_ntz"),
    })


def serving_union(spark, folder):
    readings = I.readings(spark, folder)
    layer = lambda start, end, name: rollup.daily_readings(
        R.between(readings, "full_timestamp", start, end), scale=SCALE
    ).select("date", "total_daily_energy", "record_count", F.lit(name).alias("layer"))
    batch, speed = layer(None, "2024-01-20", "batch"), layer("2024-01-16", None, "speed")
    return serving_view(batch, speed, ["date"], ["total_daily_energy", "record_count", "layer"])


# --- projections and filters ----------------------------------------------
def filter_gt(spark, folder):
    customer = I.load(spark, folder, "customer")
    return customer.filter(F.col("c_acctbal") > 3000).select("c_custkey", "c_name", "c_acctbal")


def expr_bonus(spark, folder):
    supplier = I.load(spark, folder, "supplier")
    return supplier.select(
        "s_suppkey", F.col("s_acctbal").alias("balance"),
        F.expr("s_acctbal * CAST(0.1 AS DOUBLE)").alias("bonus"),
    )


def season_filter(spark, folder):
    daily = rollup.daily_readings(I.order_readings(spark, folder), scale=SCALE)
    return gates.season_filter(daily, "summer").select(
        "date", "total_daily_energy", "customer_count", "month"
    )


def date_range_daily(spark, folder):
    first, last = C.season_dates("autumn", 1997)
    inside = R.between(I.order_readings(spark, folder), "full_timestamp", first, last)
    return rollup.daily_readings(inside, scale=SCALE)


def latest_snapshot(spark, folder):
    readings = I.load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("customer_id"), F.col("o_orderdate").alias("full_timestamp"),
        F.hour("o_orderdate").alias("hour"), F.minute("o_orderdate").alias("minute"),
        F.col("o_totalprice").alias("load_percentage"),
    )
    order = [F.col("hour").desc(), F.col("minute").desc(), F.col("customer_id").asc()]
    return reports.latest_snapshot(readings, "full_timestamp", order)


def freshness(spark, folder):
    events = I.load(spark, folder, "events")
    return gates.freshness(events, "ts", as_of=events.select(F.max("ts")).scalar(), minutes=60)


def customer_profile(spark, folder):
    return reports.customer_profile(I.readings(spark, folder), "customer_id", "event_id").select(
        "event_id", "customer_id", "full_timestamp", "load_percentage"
    )


def expected_load(spark, folder):
    out = features.residuals(I.order_readings(spark, folder))
    return out.select(
        "o_orderkey", F.round("expected_load", 6).alias("expected_load"),
        F.round("residual", 6).alias("residual"),
    )


# --- aggregations ---------------------------------------------------------
def system_rollup(spark, folder):
    return rollup.system_rollup(I.hourly_readings(spark, folder), scale=SCALE)


def daily_total_energy(spark, folder):
    system = rollup.system_rollup(I.hourly_readings(spark, folder), scale=SCALE)
    return rollup.daily_energy(system, scale=SCALE).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )


def incremental_daily(spark, folder):
    """Daily energy from three batches: every tenth reading comes a batch late, and the
    second batch is replaced after a damaged first try."""
    path = new_folder(spark, "incremental")
    rows = I.hourly_readings(spark, folder)
    third = lambda text: (F.col("full_timestamp") >= F.lit(text).cast("timestamp_ntz")).cast("int")
    batch = F.least(F.lit(2), third("2024-01-11") + third("2024-01-21") + (F.col("event_id") % 10 == 0).cast("int"))
    batches = [rows.filter(batch == i) for i in range(3)]
    for name, content in (
        ("1st", batches[0]), ("2nd", batches[1].filter("profile_type = 'click'")), ("3rd", batches[2]), ("2nd", batches[1]),
    ):
        incremental.add_batch(content, path, name, scale=SCALE)
        incremental.refresh(spark, path, scale=SCALE)
    return incremental.daily(spark, path).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def daily_silver(spark, folder):
    return rollup.daily_readings(I.readings(spark, folder), scale=SCALE)


def monthly_customers(spark, folder):
    """Distinct customers per month from what days keep: bitmaps, and whether sketches stay within their bound."""
    rows = I.order_readings(spark, folder).withColumn("date", F.to_date("full_timestamp"))
    early = rows.filter("date < DATE '1995-01-01'")
    known = stored(distinct.extend_dictionary(early), "customers-1")
    dictionary = stored(distinct.extend_dictionary(rows, known), "customers-2")
    month = F.trunc("date", "month").alias("month")
    bits = stored(distinct.bitmaps(rows, dictionary, ["date"]), "daily-bits").withColumn("month", month)
    sketched = stored(distinct.sketches(rows, ["date"]), "daily-sketches").withColumn("month", month)
    both = distinct.bitmap_counts(bits, ["month"]).join(distinct.sketch_counts(sketched, ["month"]), "month")
    off = F.abs(F.col("customer_estimate") - F.col("customer_count"))
    return both.select("month", "customer_count", (off <= distinct.sketch_error() * F.col("customer_count")).alias("within_bound"))


def coverage_gaps(spark, folder):
    return gaps.coverage_gaps(I.order_readings(spark, folder), 1996)


def sql_daily_by_season(spark, folder):
    daily = rollup.seasonal_daily(I.order_readings(spark, folder), 1996, "spring", scale=SCALE)
    return daily


def seasonal_sql_text(spark, folder):
    """The SQL text of the seasonal roll-up, run on a view."""
    I.order_readings(spark, folder).createOrReplaceTempView("order_readings")
    daily = spark.sql(rollup.seasonal_daily_sql("order_readings", 1996, "spring"))
    return daily.withColumn("avg_load_percentage", F.round("avg_load_percentage", 6))


def monthly_average(spark, folder):
    return rollup.monthly_average(
        I.order_readings(spark, folder), "full_timestamp", "load_percentage", scale=SCALE
    )


def daily_energy_stats(spark, folder):
    return rollup.energy_stats(daily_total_energy(spark, folder), scale=SCALE)


def date_span(spark, folder):
    return rollup.value_span(I.readings(spark, folder), "full_timestamp")


def avg_by_group(spark, folder):
    customer = I.load(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
    )
    return rollup.averages_by(customer, ["nation"], ["balance"], scale=SCALE)


def coverage_report(spark, folder):
    return reports.coverage(I.readings(spark, folder), "full_timestamp")


def order_extremes(spark, folder):
    """First and last order date and the number of orders, from the footers of a written table."""
    path = f"{new_folder(spark, 'dated')}/orders"
    dated = I.load(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    dated.write.parquet(path)
    return metadata.extremes(spark, path, "date")


def season_from_footers(spark, folder):
    """The season gate of a table partitioned by date, here the last day of the month, without reading rows."""
    path = f"{new_folder(spark, 'dated')}/readings"
    dated = I.order_readings(spark, folder).withColumn("date", F.last_day("full_timestamp"))
    dated.repartition("date").write.partitionBy("date").parquet(path)
    return R.union_frames([metadata.availability(spark, path, s, 1997) for s in fixed.MODEL_SEASONS])


def _rounded_summary(df):
    return df.withColumns({
        "std": F.round("std", 6),
        **{p: F.round(p, 6) for p in ("p25", "p50", "p75")},
    })


def describe_profile(spark, folder):
    return _rounded_summary(rollup.summary(
        I.readings(spark, folder), "load_percentage", by=["customer_id"], scale=SCALE
    ))


def describe_table(spark, folder):
    return _rounded_summary(rollup.summary(
        I.load(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], scale=SCALE
    ))


def describe_missing(spark, folder):
    """Event values per customer, where the key of signups and the values of every fifth customer are missing."""
    events = I.readings(spark, folder)
    return _rounded_summary(rollup.summary(
        events.select(
            F.when(F.col("profile_type") != "signup", F.col("customer_id")).alias("customer_id"),
            F.when(F.col("customer_id").cast("int") % 5 != 0, F.col("load_percentage"))
            .when(F.col("event_id") % 2 == 0, F.lit(float("nan"))).alias("load"),
        ),
        "load", by=["customer_id"], scale=SCALE,
    ))


def describe_columns(spark, folder):
    """Whole-table description of numbers and texts."""
    customer = I.load(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return rollup.describe(customer).withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


def peak_interval(spark, folder):
    return rollup.peak_interval(
        I.readings(spark, folder), ["customer_id"], "full_timestamp", "load_percentage"
    )


def peak_interval_nan(spark, folder):
    """Peaks where the values of errors are NaN."""
    load = F.when(F.col("profile_type") == "error", F.lit(float("nan"))).otherwise(F.col("load_percentage"))
    readings = I.readings(spark, folder).withColumn("load_percentage", load)
    return rollup.peak_interval(readings, ["customer_id"], "full_timestamp", "load_percentage")


def cardinality(spark, folder):
    return rollup.cardinalities(
        I.readings(spark, folder), ["customer_id", "profile_type", "load_percentage"]
    )


def prediction_report(spark, folder):
    return reports.prediction_report(
        I.load(spark, folder, "orders"), "o_totalprice", "o_orderdate", scale=SCALE
    )


# --- windows, features, splits --------------------------------------------
def _order_daily(spark, folder):
    system = rollup.system_rollup(I.order_readings(spark, folder), scale=SCALE)
    return rollup.daily_energy(system, scale=SCALE)


def _rounded(df, names=("month_sin", "month_cos", "dayofweek_sin", "dayofweek_cos")):
    return df.withColumns({n: F.round(n, 10) for n in names})


def features_ml(spark, folder):
    featured = features.forecast_features(_order_daily(spark, folder), scale=SCALE).dropna()
    return _rounded(featured).drop("timestamp")


def features_silver(spark, folder):
    daily = rollup.daily_readings(I.order_readings(spark, folder), scale=SCALE)
    rows, _ = features.silver_training_rows(daily, scale=SCALE)
    return _rounded(rows)


def chunked_window(spark, folder):
    """Lags and rolling values of the long timestamp series, many window tasks."""
    value = "total_system_load"
    system = rollup.system_rollup(I.readings(spark, folder), scale=SCALE)
    series = stored(system.select("full_timestamp", value), "system-series")
    return windows.chunked(
        series, "full_timestamp", reach=30, rows_per_chunk=1000,
        columns=lambda w: {
            **windows.lags(value, (1, 7, 30), w, "load_lag"),
            "rolling_avg_30": windows.rolling_mean(value, w, 30, SCALE),
            "rolling_max_7": windows.rolling_max(value, w, 7),
            "rolling_min_7": windows.rolling_min(value, w, 7),
        },
    )


def shifted_window(spark, folder):
    """Rolling values per customer that leave the current row out."""
    value = "load_percentage"
    readings = I.readings(spark, folder).select("event_id", "customer_id", "full_timestamp", value)
    return windows.chunked(
        readings, ["full_timestamp", "event_id"], reach=7, by=["customer_id"],
        columns=lambda w: {
            "avg_before_3": windows.rolling_mean(value, w, 3, SCALE, shifted=True),
            "max_before_7": windows.rolling_max(value, w, 7, shifted=True),
        },
    ).select("event_id", "customer_id", "avg_before_3", "max_before_7")


def long_window(spark, folder):
    """Frames of 50,000 rows over all lines in one series, far longer than a chunk."""
    line = I.load(spark, folder, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    return windows.long_rolling(
        line, ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"], "l_extendedprice", 50_000, rows_per_chunk=8_000, scale=SCALE
    )


def tied_window(spark, folder):
    """Windows over all events in one series, ordered by the hour, which many share, and the id."""
    value = "load_percentage"
    readings = I.hourly_readings(spark, folder).select("event_id", "full_timestamp", value)
    return windows.chunked(
        readings, ["full_timestamp", "event_id"], reach=7, rows_per_chunk=2000,
        columns=lambda w: {**windows.lags(value, (1, 5), w, "lag"), "max_7": windows.rolling_max(value, w, 7)},
    ).select("event_id", "lag_1", "lag_5", "max_7")


def dense_series(spark, folder):
    daily = rollup.daily_readings(I.order_readings(spark, folder), scale=SCALE)
    dense = windows.densify(daily.select("date", "total_daily_energy", "record_count"))
    return dense.withColumn("record_count", F.col("record_count").cast("double"))


def chrono_split(spark, folder):
    featured = features.forecast_features(_order_daily(spark, folder), scale=SCALE)
    return split.chronological(featured).select("date", "row_num", "split")


def split_sizes(spark, folder):
    return rollup.split_sizes(chrono_split(spark, folder))


def random_split(spark, folder):
    """Sizes of a random split: complete, without overlap, near the asked shares."""
    train, test = split.random_parts(I.load(spark, folder, "orders").select("o_orderkey"))
    both = train.withColumn("is_train", F.lit(1)).unionByName(test.withColumn("is_train", F.lit(0)))
    return both.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("o_orderkey").alias("key_count"),
        F.abs(F.avg("is_train") - 0.8).alias("off"),
    ).select("row_count", "key_count", (F.col("off") < 0.05).alias("near"))


def hash_split(spark, folder):
    orders = I.load(spark, folder, "orders")
    return split.hashed(orders, "o_orderkey").select("o_orderkey", "split")


# --- top-k, unions, counts ------------------------------------------------
def latest_predictions(spark, folder):
    orders = I.load(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return reports.newest(orders, "o_orderdate", "o_orderkey")


def customer_comparison(spark, folder):
    readings = I.readings(spark, folder).withColumn(
        "interval_idx", F.hour("full_timestamp") * 4 + N.int_div(F.minute("full_timestamp"), 15)
    )
    return reports.customer_comparison(
        readings, "customer_id", "event_id", ["event_id", "interval_idx", "load_percentage"], 5
    )


def union_days(spark, folder):
    readings = I.readings(spark, folder)
    halves = [
        R.between(readings, "full_timestamp", None, "2024-01-15"),
        R.between(readings, "full_timestamp", "2024-01-10", None),
    ]
    return R.union_frames(halves)


def table_counts(spark, folder):
    names = ("orders", "events", "lineitem", "customer")
    return reports.table_counts({n: I.load(spark, folder, n) for n in names})


# --- scalar functions -----------------------------------------------------
def day_from_name(spark, folder):
    orders = I.load(spark, folder, "orders")
    day = F.dayofyear("o_orderdate").cast("string")
    stem = F.when(F.col("o_orderstatus") == "P", F.lit("x1")).otherwise(day)
    path = F.concat(F.lit("/data/load_2016/cyme_load_timeseries_day_"), stem, F.lit(".txt"))
    return orders.select("o_orderkey", path.alias("path")).withColumn(
        "day_num", X.day_from_name("path")
    )


def day_number_to_date(spark, folder):
    orders = I.load(spark, folder, "orders")
    date = C.day_number_date(F.dayofyear("o_orderdate"))
    return orders.select(
        "o_orderkey", date.alias("date"), F.month(date).alias("month"),
        C.month_name(date).alias("month_name"),
    )


def calendar_columns(spark, folder):
    readings = I.order_readings(spark, folder)
    ts = "full_timestamp"
    return readings.select(
        "o_orderkey",
        *[c.alias(n) for n, c in C.calendar_parts(ts).items()],
        F.dayofmonth(ts).alias("day"),
        C.weekday_sunday0(ts).alias("dow"),
        C.weekday_monday0(ts).alias("weekday"),
        C.weekend_sunday1(F.dayofweek(ts)).alias("is_weekend"),
        C.clock_label(F.hour(ts), F.minute(ts)).alias("clock"),
    )


def parse_iso_ts(spark, folder):
    events = I.load(spark, folder, "events")
    whole = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    iso = F.when(F.col("event_type") == "click", whole).otherwise(F.date_format("ts", I.ISO))
    return events.select("event_id", iso.alias("iso")).select(
        "event_id",
        C.parse_iso_micros("iso").cast("timestamp_ntz").alias("strict"),
        C.parse_timestamp("iso").cast("timestamp_ntz").alias("free"),
        C.parse_timestamp(F.substring("iso", 1, 10)).cast("timestamp_ntz").alias("midnight"),
    )


def cyclic_features(spark, folder):
    orders = I.load(spark, folder, "orders").select(
        "o_orderkey", F.month("o_orderdate").alias("month"),
        C.weekday_sunday1("o_orderdate").alias("dayofweek"),
    )
    return _rounded(orders.withColumns(features.calendar_features()))


def seasonal_features(spark, folder):
    daily = rollup.seasonal_daily(I.order_readings(spark, folder), 1998, "summer", scale=SCALE)
    return features.seasonal_features(daily).select(
        "date", "avg_load_percentage", "month", "day", "day_of_week",
        F.round("month_sin", 10).alias("month_sin"), F.round("day_sin", 10).alias("day_sin"),
        "is_weekend",
    )


def rounding(spark, folder):
    line = I.load(spark, folder, "lineitem")
    return line.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.round("l_extendedprice", 0).cast("int").alias("whole"),
        F.round("l_extendedprice", 1).alias("tenth"),
        N.clamp("l_quantity", 10.0, 40.0).alias("clamped"),
        N.int_div("l_orderkey", 7).alias("sevenths"),
        (F.col("l_orderkey") % 7).alias("rest"),
    )


def json_props(spark, folder):
    events = I.load(spark, folder, "events")
    back = F.from_json("props", "k int")
    return events.select("event_id", back["k"].alias("k"))


def season_of_month(spark, folder):
    orders = I.load(spark, folder, "orders")
    return orders.groupBy(C.model_season(F.month("o_orderdate")).alias("season")).agg(
        F.count(F.lit(1)).alias("order_count"), F.min(F.month("o_orderdate")).alias("first_month")
    )


def sample_days(spark, folder):
    daily = rollup.daily_readings(I.order_readings(spark, folder), scale=SCALE)
    return daily.filter(C.is_sample_day("date")).select(
        "date", F.dayofyear("date").alias("day_num"), "record_count"
    )


# --- gates and registry ---------------------------------------------------
def availability_gate(spark, folder):
    return gates.availability_by_season(
        I.order_readings(spark, folder), "full_timestamp", 2001, fixed.MIN_TRAINING_ROWS
    )


def minimum_rows(spark, folder):
    daily = rollup.daily_readings(I.readings(spark, folder), scale=SCALE)
    return gates.enough_rows(daily)


def pick_model(spark, folder):
    """Model per month, where a season counts as registered once its gate opens."""
    gate = availability_gate(spark, folder)
    names = F.create_map(*[F.lit(x) for pair in fixed.SEASON_MODELS.items() for x in pair])
    registered = gate.filter("available").select(names[F.col("season")].alias("name"))
    months = I.load(spark, folder, "orders").select(F.month("o_orderdate").alias("month")).distinct()
    return registry.pick_model(months, registered)


def pick_version(spark, folder):
    """Orders as registry rows: customers as models, order keys as versions."""
    production = F.when(F.col("o_orderstatus") == "P", "Production").otherwise("None")
    versions = I.load(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("name"), F.col("o_orderkey").alias("version"),
        production.alias("stage"), F.concat(F.lit("m/"), "o_orderkey").alias("path"),
    )
    return registry.pick_version(versions)


def run_log_pivot(spark, folder):
    runs = I.load(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("key"),
        F.col("value").cast("string").alias("value"), "ts",
    )
    return reports.log_pivot(runs, ("click", "error", "purchase", "signup", "view"))


def newest_run(spark, folder):
    """Orders as runs: customers as models, orders without a finished status saved no files."""
    orders = I.load(spark, folder, "orders")
    path = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("m/"), "o_orderkey"))
    facts = F.explode(F.array(
        F.struct(F.lit("model_name").alias("key"), F.col("o_custkey").cast("string").alias("value")),
        F.struct(F.lit("model_path").alias("key"), path.alias("value")),
    ))
    runs = orders.select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("run_id"), F.lit("param").alias("kind"), facts.alias("fact"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    ).select("run_id", "kind", "fact.*", "ts")
    return registry.newest_run(runs).select("name", "run_id", "path")


# --- models ---------------------------------------------------------------
def standard_scale(spark, folder):
    orders = I.load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return models.standardized(orders, ["o_totalprice"], "_z").select(
        "o_orderkey", F.round("o_totalprice_z", 8).alias("z")
    )


def _price_line(spark, folder):
    line = I.load(spark, folder, "lineitem")
    model = models.linear_pipeline(["l_quantity"], "l_extendedprice", regParam=0.0).fit(line)
    return line, model


def ols_fit(spark, folder):
    _, model = _price_line(spark, folder)
    return models.coefficients(spark, model, ["l_quantity"]).withColumn(
        "estimate", F.round("estimate", 4)
    )


def saved_model(spark, folder):
    """The fitted line saved, loaded again and applied."""
    line, model = _price_line(spark, folder)
    path = registry.save_model(model, f"{new_folder(spark, 'model')}/line")
    loaded = PipelineModel.load(path)
    return loaded.transform(line).select("l_quantity", F.round("prediction", 4).alias("prediction")).distinct()


def score_batch(spark, folder):
    line, model = _price_line(spark, folder)
    as_of = line.select(F.max("l_shipdate")).scalar()
    return models.score(
        model, line, ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"], as_of=as_of
    )


def score_by_season(spark, folder):
    """Orders scored by the model of their season as of their date: spring in two versions, summer,
    and the general model where the season has none yet."""
    orders = I.load(spark, folder, "orders").select("o_orderkey", "o_orderdate", (F.col("o_custkey") % 50).cast("double").alias("x"))
    models_folder, x = new_folder(spark, "registry"), F.col("x")
    for name, label, since in (
        (fixed.SEASON_MODELS["spring"], 2 * x + 1, "1993-01-01"), (fixed.SEASON_MODELS["summer"], 5 - 3 * x, "1994-07-01"),
        (fixed.GENERAL_MODEL, x / 2, "1992-06-01"), (fixed.SEASON_MODELS["spring"], 2 * x + 11, "1996-03-01"),
    ):
        line = models.linear_pipeline(["x"], "y", regParam=0.0).fit(orders.withColumn("y", label))
        since = datetime.datetime.fromisoformat(since).replace(tzinfo=datetime.UTC)
        registry.register_model(spark, models_folder, line, name, valid_from=since)
    scored = jobs.score_by_season(spark, orders, models_folder, "o_orderdate", ["o_orderkey"], "predicted_load")
    return scored.withColumn("predicted_load", F.round("predicted_load", 4))


def eval_metrics(spark, folder):
    featured = features.forecast_features(_order_daily(spark, folder), scale=SCALE)
    rows = evaluate.naive_forecast(split.chronological(featured))
    return evaluate.metrics(rows, fixed.TARGET, scale=SCALE)


def overfit_gap(spark, folder):
    return evaluate.overfit_gap(eval_metrics(spark, folder))


def _fit(pipeline, rows):
    """Fit on the training rows, which the passes of the fit share through the cache."""
    training = rows.filter("split = 'train'").persist()
    try:
        return pipeline.fit(training)
    finally:
        training.unpersist()


def gbt_forecast(spark, folder):
    """Boosted trees on the daily order series, stopped by its validation rows, all splits scored."""
    featured = features.forecast_features(_order_daily(spark, folder))
    rows = split.chronological(featured)
    names = features.forecast_feature_names(featured)
    learned = split.with_validation(rows).persist()
    try:
        model = models.boosted_pipeline(names, validation="is_validation").fit(learned)
    finally:
        learned.unpersist()
    return model.transform(rows).select("date", "split", fixed.TARGET, "prediction")


def gbt_importances(spark, folder):
    featured = features.forecast_features(_order_daily(spark, folder))
    rows = split.chronological(featured)
    names = features.forecast_feature_names(featured)
    model = _fit(models.boosted_pipeline(names), rows)
    return models.importances(spark, model, names).filter("rank <= 10")


def rf_seasonal(spark, folder):
    """The spring forest on calendar features, all days scored."""
    daily = rollup.seasonal_daily(I.order_readings(spark, folder), 1998, "spring")
    rows = split.hashed(features.seasonal_features(daily), "date")
    pipeline = models.forest_pipeline(fixed.SEASONAL_FEATURES, "avg_load_percentage", "spring")
    model = _fit(pipeline, rows)
    return model.transform(rows).select("date", "split", "avg_load_percentage", "prediction")


def rf_autumn(spark, folder):
    """The autumn forest on the silver features, evaluated per split."""
    first, last = C.season_dates("autumn", 1998)
    inside = R.between(I.order_readings(spark, folder), "full_timestamp", first, last)
    daily = gates.season_filter(rollup.daily_readings(inside), "autumn")
    rows, missing = features.silver_training_rows(daily)
    rows = split.hashed(rows, "date")
    names = [c for c in fixed.SILVER_FEATURES if c not in missing]
    model = _fit(models.forest_pipeline(names, fixed.TARGET, "autumn"), rows)
    return evaluate.metrics(model.transform(rows), fixed.TARGET)


QUERIES = {
    f.__name__: f
    for f in (
        wide_unpivot, file_ingest_report, day_file_readings, ledger_ingest, discovered_files, written_table, two_key_table, missing_days, csv_cast_filter, table_count,
        kafka_batch_parse, envelope_explode, rejected_messages, stream_bronze, stream_compacted, stream_sorted, monthly_merge, fanout_detail, fanout_raw,
        topic_route, to_kafka_rows, decimal_result, serving_union, filter_gt, expr_bonus,
        season_filter, date_range_daily, latest_snapshot, freshness, customer_profile,
        expected_load, system_rollup, daily_total_energy, incremental_daily, daily_silver, monthly_customers, coverage_gaps, order_extremes, season_from_footers, sql_daily_by_season, seasonal_sql_text,
        monthly_average, daily_energy_stats, date_span, avg_by_group, coverage_report,
        describe_profile, describe_table, describe_missing, describe_columns, peak_interval, peak_interval_nan, cardinality, prediction_report,
        features_ml, features_silver, chunked_window, shifted_window, long_window, tied_window, dense_series,
        chrono_split, split_sizes, hash_split, random_split, latest_predictions, customer_comparison,
        union_days, table_counts, day_from_name, day_number_to_date, calendar_columns,
        parse_iso_ts, cyclic_features, seasonal_features, rounding, json_props,
        season_of_month, sample_days, availability_gate, minimum_rows, pick_model,
        pick_version, newest_run, run_log_pivot, standard_scale, ols_fit, saved_model, score_batch, score_by_season, eval_metrics,
        overfit_gap, gbt_forecast, gbt_importances, rf_seasonal, rf_autumn,
    )
}
