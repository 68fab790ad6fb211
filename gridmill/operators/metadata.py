"""Newest values and counts from file footers instead of rows.

Parquet keeps extremes and row counts per row group. A scan with aggregate push
down answers from them and reads no column; the plan shows it as
`PushedAggregation`. It takes numbers, dates and booleans that are no partition
columns; for other types, such as timestamps, the same call reads the column.
"""

from pyspark.sql import functions as F

from gridmill.functions import calendar as C


def footer_reader(spark):
    """A session beside this one whose Parquet scans push aggregates down; other reads keep their settings."""
    beside = spark.newSession()
    beside.conf.set("spark.sql.sources.useV1SourceList", "")
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return beside


def extremes(spark, path, column):
    """One row with `oldest`, `newest` and `row_count` of a column.

    Without values the extremes are null, and a count without any footer to answer it is null too.
    """
    return footer_reader(spark).read.parquet(path).agg(
        F.min(column).alias("oldest"), F.max(column).alias("newest"),
        F.count(F.lit(1)).alias("row_count"),
    )


def rows_between(spark, path, first, last, date="date"):
    """Rows of a date-partitioned table from one date to another, both included: listing and footers only."""
    inside = F.col(date).between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))
    return footer_reader(spark).read.parquet(path).filter(inside).agg(F.count(F.lit(1)).alias("row_count"))


def newest_rows(spark, path, date, ts):
    """The newest `ts` of a table that also holds its date: the newest date comes from the
    footers, and only files that may hold it are read for the time."""
    newest = extremes(spark, path, date).first()["newest"]
    rows = spark.read.parquet(path)
    return rows.filter(F.col(date) == F.lit(newest)).agg(F.max(ts).alias("newest"))


def availability(spark, path, season, year, min_rows=1, date="date"):
    """The gate of `gates.availability` for a table partitioned by date, without reading rows.

    The newest date is the newest folder with rows; a date without rows in its
    files does not count.
    """
    first, last = C.season_dates(season, year)
    # Partition values only; one row per date is left.
    dates = spark.read.parquet(path).groupBy(date).agg(F.count(F.lit(1)).alias("n"))
    latest = dates.filter(F.col("n") > 0).agg(F.max(date).alias("latest"))
    counted = rows_between(spark, path, first, last, date).first()["row_count"] or 0  # null where no footer answers
    required = F.lit(last).cast("date")
    return latest.select(
        F.lit(season).alias("season"), required.alias("required"), "latest",
        F.lit(counted).cast("long").alias("season_rows"),
        F.coalesce(F.col("latest") >= required, F.lit(False)).alias("available"), F.lit(counted >= min_rows).alias("enough"),
    )
