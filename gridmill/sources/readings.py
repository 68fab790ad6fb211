"""Headerless CSV readings, stored tables and unions of day frames."""

from functools import reduce

from pyspark.sql import functions as F

from gridmill import schemas
from gridmill.functions.calendar import parse_timestamp


def typed_readings(strings, id_col=0, time_col=1, load_col=2, allow_nan=True):
    """Positional text columns to typed readings; rows with any bad cell go.

    Every number that parses stays; without `allow_nan`, NaN and infinite ones
    are bad cells too.
    """
    names = strings.columns
    typed = strings.select(
        F.col(names[id_col]).cast("string").alias("customer_id"),
        parse_timestamp(F.col(names[time_col])).alias("full_timestamp"),
        F.col(names[load_col]).try_cast("double").alias("load_percentage"),
    )
    for name in typed.columns:
        typed = typed.filter(F.col(name).isNotNull())
    if not allow_nan:
        typed = typed.filter(F.abs("load_percentage") < float("inf"))
    return typed


def read_csv_readings(spark, path, **options):
    """Readings of headerless `customer_id,timestamp,load` files."""
    return typed_readings(spark.read.schema(schemas.CSV_READINGS).csv(path), **options)


def union_frames(frames):
    """Bag union by column name; duplicates stay."""
    return reduce(lambda left, right: left.unionByName(right), frames)


def between(df, ts, start=None, end=None):
    """Rows from the start date to the end date, both included, both optional.

    The test is a half-open range on the stored column, so that it reaches the
    scan as a pushed filter and prunes files and row groups.
    """
    kept = df.filter(F.col(ts).isNotNull())
    kind = df.schema[ts].dataType.simpleString()
    if start is not None:
        kept = kept.filter(F.col(ts) >= F.lit(str(start)).cast(kind))
    if end is not None:
        kept = kept.filter(F.col(ts) < F.date_add(F.lit(str(end)).cast("date"), 1).cast(kind))
    return kept
