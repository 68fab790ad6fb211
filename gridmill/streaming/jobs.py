"""Streams from message topics or watched folders into tables.

Each micro-batch replaces its own partition `ingest_batch=<id>`, so a batch
that runs again after a failure leaves no duplicates, and a restart on the same
checkpoint neither loses nor repeats messages.
"""

from pyspark.sql import functions as F

from gridmill import fixed
from gridmill.operators.rollup import merge_monthly, monthly_partials
from gridmill.sinks import manifest
from gridmill.sources import messages as M


def readings_stream(messages, late_by=None):
    """Readings of an envelope stream, stamped with the ingest time.

    With `late_by` (such as "1 hour") copies of a customer's reading are dropped
    as long as the watermark keeps their state, and so are readings that come
    later than that. Readings without a readable time are never copies.
    """
    readings = M.decode_readings(messages)
    if late_by is not None:
        timed = readings.filter(F.col("full_timestamp").isNotNull())
        untimed = readings.filter(F.col("full_timestamp").isNull())
        kept = timed.withWatermark("full_timestamp", late_by).dropDuplicatesWithinWatermark(
            ["customer_id", "full_timestamp"]
        )
        readings = kept.unionByName(untimed)
    return readings.withColumn("created_at", F.current_timestamp())


def replace_batch(df, path, batch_id, partition_by=()):
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_by)
        .parquet(f"{path}/ingest_batch={batch_id}")
    )


def batch_writer(path):
    """Micro-batch sink that skips empty batches; a batch is computed once."""

    def write(batch, batch_id):
        batch = batch.persist()
        try:
            if not batch.isEmpty():
                replace_batch(batch, path, batch_id)
        finally:
            batch.unpersist()

    return write


def logged_writer(path):
    """Micro-batch sink into a table with a commit log, see `sinks.manifest`.

    Batches are numbered upwards, so a batch that runs again after its commit is
    known by its number even where it was merged with others meanwhile; one that
    failed before its commit left nothing that readers see.
    """

    def write(batch, batch_id):
        spark = batch.sparkSession
        done = lambda parts: any(p["upto"] is not None and p["upto"] >= batch_id for p in parts)
        if done(manifest.live(spark, path)[1]):
            return
        part = manifest.write_part(batch, path, f"batch-{batch_id}", batch_id)
        manifest.commit(spark, path, lambda parts: [] if done(parts) or not part["rows"] else [manifest.added(part)])

    return write


def start(stream, write, checkpoint, trigger=fixed.STREAM_TRIGGER, available_now=False, name=None):
    """Start a stream in append mode: every `trigger`, or once over what is there."""
    writer = stream.writeStream.foreachBatch(write).outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    if name is not None:
        writer = writer.queryName(name)
    chosen = {"availableNow": True} if available_now else {"processingTime": trigger}
    return writer.trigger(**chosen).start()


def ingest_readings(messages, path, checkpoint, late_by=None, **options):
    """Envelope messages into the readings table at `path`."""
    return start(readings_stream(messages, late_by), batch_writer(path), checkpoint, **options)


def ingest_logged(messages, path, checkpoint, late_by=None, **options):
    """Envelope messages into a table whose parts can be merged while the stream runs."""
    return start(readings_stream(messages, late_by), logged_writer(path), checkpoint, **options)


def compact_readings(spark, path, small_rows=10_000_000):
    """Merge the small parts of `ingest_logged`, laid out by date, customer and time."""
    def arrange(rows):
        dated = rows.withColumn("_date", F.to_date("full_timestamp")).hint("rebalance", F.col("_date"))
        return dated.sortWithinPartitions("_date", "customer_id", "full_timestamp").drop("_date")

    return manifest.compact(spark, path, small_rows, arrange)


# --- fan-out --------------------------------------------------------------
def fanout_writer(path, scale=None):
    """One micro-batch into four tables: raw records, load details, monthly parts, rejects.

    The batch is decoded once and kept for the writes. Monthly averages are
    stored as sums and counts per batch and merged on reading, so late or
    repeated batches cannot distort them; `scale` makes the sums decimals.
    Messages without a record go to `rejected` as they came. A record whose date
    or time cannot be read keeps its other cells; without a time it has no month.
    """

    def write(messages, batch_id):
        decoded = messages.select(
            F.col("value").cast("string").alias("value"), M.envelope_records("value").alias("records")
        ).persist()
        try:
            if decoded.isEmpty():
                return
            records = decoded.filter(F.size("records") > 0).select(F.explode("records").alias("record")).select("record.*")
            replace_batch(
                records.select("raw_data", "file_name", "line_number"), f"{path}/raw_data", batch_id
            )
            replace_batch(
                records.select(
                    "customer_id", "profile_type", F.col("year").cast("string").alias("year"),
                    "month_num", F.col("month").alias("month_name"), "day",
                    F.try_to_date("date").alias("date"), "timestamp", "hour", "minute",
                    "interval_idx", "load_percentage",
                ),
                f"{path}/load_data_detail", batch_id,
            )
            dated = records.withColumn("_at", F.try_to_timestamp("timestamp"))
            replace_batch(
                monthly_partials(dated, "_at", "load_percentage", scale=scale), f"{path}/monthly_parts", batch_id
            )
            rejected = decoded.filter(F.coalesce(F.size("records"), F.lit(0)) <= 0)
            replace_batch(rejected.select("value"), f"{path}/rejected", batch_id)
        finally:
            decoded.unpersist()

    return write


def fan_out(messages, path, checkpoint, trigger=fixed.FANOUT_TRIGGER, scale=None, **options):
    return start(messages, fanout_writer(path, scale), checkpoint, trigger=trigger, **options)


def monthly_average_table(spark, path):
    """Monthly averages over all batches of a fan-out."""
    return merge_monthly(spark.read.parquet(f"{path}/monthly_parts"))


# --- topics ---------------------------------------------------------------
def topic_writer(path, schema, pattern=fixed.SENSOR_TOPIC_PATTERN):
    """Messages of the matching topics into one partition per topic, unreadable
    ones into a reject table."""

    def write(messages, batch_id):
        messages = messages.persist()
        try:
            if messages.isEmpty():
                return
            good, bad = M.split_rejects(M.routed(messages, pattern), schema)
            replace_batch(good.select("topic", "data.*"), f"{path}/routed", batch_id, ["topic"])
            replace_batch(bad, f"{path}/rejected", batch_id)
        finally:
            messages.unpersist()

    return write


def route_topics(messages, path, checkpoint, schema, **options):
    return start(messages, topic_writer(path, schema), checkpoint, **options)
