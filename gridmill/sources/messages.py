"""Message topics: batch and stream scans, JSON decoding, routing.

Every function below the two scans takes a frame with `key`, `value`,
`timestamp` (and `topic`), whatever it was read from.
"""

from pyspark.sql import functions as F

from gridmill import fixed, schemas
from gridmill.functions.calendar import parse_iso_micros, parse_timestamp


def topic_options(servers, topic=None, pattern=None):
    """Subscription by name or by regular expression."""
    if (topic is None) == (pattern is None):
        raise ValueError("give either a topic or a topic pattern")
    chosen = {"subscribe": topic} if topic is not None else {"subscribePattern": pattern}
    return {"kafka.bootstrap.servers": servers, **chosen}


def read_topic(spark, servers, topic=None, pattern=None):
    """All messages of a topic so far."""
    options = topic_options(servers, topic, pattern)
    return (
        spark.read.format("kafka").options(**options).option("startingOffsets", "earliest").load()
    )


def stream_topic(spark, servers, topic=fixed.READINGS_TOPIC, pattern=None,
                 starting="latest", per_trigger=None):
    """Messages of a topic from `starting` on, at most `per_trigger` per micro-batch if set."""
    topic = None if pattern is not None else topic
    reader = spark.readStream.format("kafka").options(**topic_options(servers, topic, pattern))
    if per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.option("startingOffsets", starting).load()


def stream_files(spark, folder, schema=None, fmt="parquet", files_per_trigger=None, glob=None):
    """New files of a folder as a stream (directory watcher, and topic stand-in)."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder)


# --- decoding -------------------------------------------------------------
def decode_rows(messages, schema):
    """Flat JSON messages to columns, with message key and broker time."""
    return messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.from_json(F.col("value").cast("string"), schema).alias("data"),
        F.col("timestamp").alias("kafka_timestamp"),
    ).select("kafka_key", "data.*", "kafka_timestamp")


def decode_houses(messages):
    """House messages with their ISO event time parsed."""
    rows = decode_rows(messages, schemas.HOUSE)
    return rows.withColumnRenamed("timestamp", "house_timestamp").withColumn(
        "timestamp", parse_iso_micros("house_timestamp")
    )


def decode_envelopes(messages, schema=schemas.ENVELOPE):
    return messages.select(
        F.from_json(F.col("value").cast("string"), schema).alias("data")
    ).select("data.*")


def envelope_records(value):
    """Records of an envelope message; null where it cannot be read."""
    return F.from_json(F.col(value).cast("string"), schemas.ENVELOPE)["records"]


def explode_records(envelopes):
    """One row per record; envelopes with null or no records yield none.

    The outer explode with the filter behind it keeps the optimizer from
    testing the array below the explode, where it would decode the JSON again.
    """
    return (
        envelopes.select(
            "batch_id", "record_count", "processing_timestamp",
            F.posexplode_outer("records").alias("_position", "record"),
        )
        .filter(F.col("_position").isNotNull())
        .drop("_position")
    )


def rejected_messages(messages):
    """Messages that yield no record: unreadable JSON, null or empty records."""
    return messages.filter(F.coalesce(F.size(envelope_records("value")), F.lit(0)) <= 0)


def readings_of_records(exploded):
    """Readings of exploded records; `day_num` is the day of the month here."""
    record = lambda name: F.col(f"record.{name}")
    return exploded.select(
        record("customer_id"),
        record("profile_type"),
        record("day").alias("day_num"),
        record("hour"),
        record("minute"),
        record("interval_idx"),
        record("load_percentage"),
        parse_timestamp(record("timestamp")).alias("full_timestamp"),
        record("batch_id"),
        parse_timestamp(record("processing_timestamp")).alias("processing_timestamp"),
    )


def decode_readings(messages):
    """Envelope messages straight to readings, decoding only the fields in use."""
    return readings_of_records(explode_records(decode_envelopes(messages, schemas.READING_ENVELOPE)))


# --- routing --------------------------------------------------------------
def with_topic(df, sensor, prefix="sensor-topic-"):
    """Topic name of each message from the name of its sensor."""
    return df.withColumn("topic", F.concat(F.lit(prefix), F.col(sensor)))


def routed(messages, pattern=fixed.SENSOR_TOPIC_PATTERN):
    """Messages of the matching topics; messages without a value are ignored."""
    return messages.filter(F.col("topic").rlike(f"^{pattern}$") & F.col("value").isNotNull())


def split_rejects(messages, schema):
    """(parsed, rejected): messages that are a JSON object, and the others."""
    parsed = messages.withColumn("data", F.from_json(F.col("value").cast("string"), schema))
    raw = F.col("value").cast("string")
    readable = F.try_parse_json(raw).isNotNull() & F.startswith(F.trim(raw), F.lit("{"))
    good = parsed.filter(readable)
    bad = messages.filter(~readable)
    return good, bad
