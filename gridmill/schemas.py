"""Explicit schemas of the data contract: fixed column names, types and order."""

from pyspark.sql import types as T

READINGS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("profile_type", T.StringType(), True),
    T.StructField("day_num", T.IntegerType(), False),
    T.StructField("hour", T.IntegerType(), False),
    T.StructField("minute", T.IntegerType(), False),
    T.StructField("interval_idx", T.IntegerType(), False),
    T.StructField("load_percentage", T.FloatType(), True),
    T.StructField("full_timestamp", T.TimestampType(), False),
])

CSV_READINGS = T.StructType([
    T.StructField(name, T.StringType(), True)
    for name in ("customer_id", "full_timestamp", "load_percentage")
])

ENVELOPE_RECORD = T.StructType([
    T.StructField("raw_data", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("line_number", T.IntegerType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("profile_type", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.StringType()),
    T.StructField("month_num", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("date", T.StringType()),
    T.StructField("interval_id", T.StringType()),
    T.StructField("interval_idx", T.IntegerType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("minute", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("load_percentage", T.DoubleType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("processing_timestamp", T.StringType()),
])

ENVELOPE = T.StructType([
    T.StructField("interval_id", T.StringType()),
    T.StructField("batch_id", T.IntegerType()),
    T.StructField("record_count", T.IntegerType()),
    T.StructField("processing_timestamp", T.StringType()),
    T.StructField("records", T.ArrayType(ENVELOPE_RECORD)),
])

# The part of an envelope that readings are made of.
READING_ENVELOPE = T.StructType([
    *[f for f in ENVELOPE.fields if f.name != "records"],
    T.StructField("records", T.ArrayType(T.StructType([
        f for f in ENVELOPE_RECORD.fields
        if f.name in (
            "customer_id", "profile_type", "day", "hour", "minute", "interval_idx",
            "timestamp", "load_percentage", "batch_id", "processing_timestamp",
        )
    ]))),
])

HOUSE = T.StructType([
    T.StructField("house_id", T.IntegerType()),
    T.StructField("house_size", T.DoubleType()),
    T.StructField("location_score", T.DoubleType()),
    T.StructField("price", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType(), True),
    T.StructField("ts", T.TimestampType(), False),
])

MODELS = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("stage", T.StringType(), True),
    T.StructField("path", T.StringType(), False),
    T.StructField("run_id", T.StringType(), True),
    T.StructField("ts", T.TimestampType(), False),
])

# Column types of the decimal-typed result tables.
PREDICTION_TYPES = {
    "house_id": "int",
    "house_size": "decimal(10,2)",
    "location_score": "decimal(3,1)",
    "age_years": "int",
    "rooms": "int",
    "predicted_price": "int",
    "prediction_timestamp": "timestamp",
}
HOUSE_TYPES = {
    "house_id": "int",
    "house_size": "decimal(10,2)",
    "location_score": "decimal(3,1)",
    "price": "int",
    "timestamp": "timestamp",
}
