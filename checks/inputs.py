"""Shapes of the shared tables that play meter data. All are row-wise, so each
query works on every row of its table."""

from pyspark.sql import functions as F

from gridmill.session import table

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def load(spark, folder, name):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return table(spark, folder, name)


def readings(spark, folder):
    """Events as readings, one timestamp per event."""
    return event_readings(load(spark, folder, "events"))


def event_readings(events):
    return events.select(
        F.col("event_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("profile_type"),
        F.col("ts").alias("full_timestamp"),
        F.col("value").alias("load_percentage"),
    )


def hourly_readings(spark, folder):
    """Events as readings on the hour, so that customers share timestamps."""
    hour = F.date_trunc("hour", "full_timestamp").cast("timestamp_ntz")
    return readings(spark, folder).withColumn("full_timestamp", hour)


def order_readings(spark, folder):
    """Orders as readings over several years, spread over the hours of a day."""
    return load(spark, folder, "orders").select(
        F.col("o_orderkey"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("profile_type"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int")))
        .alias("full_timestamp"),
        F.col("o_totalprice").alias("load_percentage"),
    )


def wide_lines(spark, folder):
    """Each event as a wide text line; some lines and cells are malformed."""
    kind = F.col("event_type")
    body = F.concat_ws(
        ",",
        F.concat(F.lit("res_"), "user_id"),
        F.when(kind == "view", F.lit(" ")).otherwise(kind),
        F.lit("a,b,c,d,e,f,g,h,i"),
        F.col("value").cast("string"), F.lit(""), F.col("event_id").cast("string"), F.lit("NONE"),
        F.col("user_id").cast("string"), F.lit("zz"), F.lit(" "), F.lit(" null"),
        F.concat(F.lit(" "), F.col("value").cast("string")),
    )
    short = F.concat_ws(",", F.concat(F.lit("res_"), "user_id"), F.lit("P,a,b"))
    line = (
        F.when(kind == "signup", short)
        .when(kind == "error", F.concat(F.lit("# "), body))
        .when(kind == "purchase", F.concat(F.lit(" "), body))
        .otherwise(body)
    )
    return load(spark, folder, "events").select(
        "event_id", "event_type", F.dayofyear("ts").alias("day_num"), line.alias("line")
    )


def envelope_messages(events):
    """Each event as one JSON envelope message.

    Clicks carry two records, signups none, errors are not valid JSON, and the
    event time of purchases is unreadable. Works on batch and streaming frames.
    """
    kind = F.col("event_type")
    record = F.struct(
        F.concat(F.lit("line "), "event_id").alias("raw_data"),
        F.lit("day_1.txt").alias("file_name"),
        F.col("event_id").cast("int").alias("line_number"),
        F.col("user_id").cast("string").alias("customer_id"),
        kind.alias("profile_type"),
        F.year("ts").alias("year"),
        F.date_format("ts", "MMMM").alias("month"),
        F.month("ts").alias("month_num"),
        F.dayofmonth("ts").alias("day"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("event_id").cast("string").alias("interval_id"),
        (F.hour("ts") * 4).alias("interval_idx"),
        F.hour("ts").alias("hour"),
        F.minute("ts").alias("minute"),
        F.when(kind == "purchase", F.lit("soon")).otherwise(F.date_format("ts", ISO))
        .alias("timestamp"),
        F.col("value").alias("load_percentage"),
        F.concat(F.lit("b"), "event_id").alias("batch_id"),
        F.date_format("ts", ISO).alias("processing_timestamp"),
    )
    one = F.array("_record")
    later = F.col("_record").withField("interval_idx", F.col("_record.interval_idx") + 1)
    records = (
        F.when(kind == "click", F.array("_record", later))
        .when(kind == "signup", F.slice(one, 1, 0))
        .otherwise(one)
    )
    envelope = F.struct(
        F.col("_record.interval_id").alias("interval_id"),
        F.col("event_id").cast("int").alias("batch_id"),
        F.when(kind == "click", 2).when(kind == "signup", 0).otherwise(1).alias("record_count"),
        F.col("_record.processing_timestamp").alias("processing_timestamp"),
        records.alias("records"),
    )
    return events.withColumn("_record", record).select(
        F.col("event_id").cast("string").alias("key"),
        F.when(kind == "error", F.lit("{not json")).otherwise(F.to_json(envelope)).alias("value"),
        F.col("ts").alias("timestamp"),
        kind.alias("sensor"),
    )


def damaged_messages(events):
    """Envelope messages, of which some cannot be read: of the ids, those divisible
    by 17 are no JSON, by 13 have a word as date, by 11 a NaN load, by 7 a load of 1e13."""
    made = envelope_messages(events)
    key = F.col("key").cast("bigint")
    swap = lambda name, text: F.regexp_replace(
        "value", f'"{name}":("[^"]*"|[^,}}]*)', f'"{name}":{text}'
    )
    return made.withColumn(
        "value",
        F.when(key % 17 == 0, F.lit("{not json")).when(key % 13 == 0, swap("date", '"someday"'))
        .when(key % 11 == 0, swap("load_percentage", '"NaN"')).when(key % 7 == 0, swap("load_percentage", "1.0E13"))
        .otherwise(F.col("value")),
    )


def house_messages(spark, folder):
    """Parts as house messages with a key and a broker time."""
    part = load(spark, folder, "part")
    moment = F.timestamp_micros(
        F.lit(1_700_000_000_000_000) + F.col("p_partkey") * F.lit(1_234_567)
    )
    iso = F.when(F.col("p_type") == "ECONOMY", F.date_format(moment, "yyyy-MM-dd HH:mm:ss"))
    house = F.struct(
        F.col("p_partkey").cast("int").alias("house_id"),
        F.col("p_retailprice").alias("house_size"),
        (F.col("p_size") / 10).alias("location_score"),
        (F.col("p_size") * 1000).alias("price"),
        iso.otherwise(F.date_format(moment, ISO)).alias("timestamp"),
    )
    broken = F.col("p_type") == "PROMO"
    return part.select(
        F.col("p_partkey").cast("string").alias("key"),
        F.when(broken, F.lit('{"house_id": "many"}')).otherwise(F.to_json(house)).alias("value"),
        moment.cast("timestamp_ntz").alias("timestamp"),
    )
