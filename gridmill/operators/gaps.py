"""Gaps and islands: days without readings inside a season, and the runs between them."""

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill import fixed
from gridmill.functions import calendar as C
from gridmill.sources.readings import between


def season_calendar(spark, year, seasons=None):
    """season, first_day, last_day and days of each season of a year."""
    seasons = fixed.MODEL_SEASONS if seasons is None else seasons
    ends = spark.createDataFrame(
        [(s, *C.season_dates(s, year)) for s in seasons], "season string, first_day string, last_day string"
    )
    dated = ends.select("season", *[F.to_date(c).alias(c) for c in ("first_day", "last_day")])
    return dated.withColumn("days", F.date_diff("last_day", "first_day") + 1)


def day_presence(readings, year, ts="full_timestamp", by=("customer_id",), seasons=None):
    """The different (season, key, date) of the readings of a year's seasons.

    A key that holds many readings leaves one row per date and task, so from
    here on it has as many rows as the seasons have days.
    """
    seasons = fixed.MODEL_SEASONS if seasons is None else seasons
    ends = [C.season_dates(s, year) for s in seasons]
    inside = between(readings, ts, min(a for a, _ in ends), max(b for _, b in ends))
    return (
        inside.select(*by, F.to_date(ts).alias("date")).distinct()
        .join(F.broadcast(season_calendar(readings.sparkSession, year, seasons)),  # a row per season
              F.col("date").between(F.col("first_day"), F.col("last_day")))
        .select("season", *by, "date", "first_day", "last_day", "days")
    )


def islands(presence, by=("customer_id",)):
    """Runs of consecutive dates per season and key: first and last date, and length.

    Dates less their position are equal inside a run.
    """
    keys = ["season", *by]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("date"))
    run = F.date_sub("date", place)
    return presence.withColumn("_run", run).groupBy(*keys, "_run", "first_day", "last_day", "days").agg(
        F.min("date").alias("run_start"), F.max("date").alias("run_end"), F.count(F.lit(1)).alias("run_days")
    ).drop("_run")


def gaps(runs, by=("customer_id",)):
    """Runs of missing days, those before the first and after the last reading included."""
    order = Window.partitionBy("season", *by).orderBy("run_start")
    after = F.lead(F.date_sub("run_start", 1), 1).over(order)
    before = F.lag("run_end").over(order)
    both = runs.withColumn("_gaps", F.array_compact(F.array(
        F.when(before.isNull(), F.struct(F.col("first_day").alias("gap_start"), F.date_sub("run_start", 1).alias("gap_end"))),
        F.struct(F.date_add("run_end", 1).alias("gap_start"), F.coalesce(after, F.col("last_day")).alias("gap_end")),
    )))
    return both.select("season", *by, F.explode("_gaps").alias("g")).select(
        "season", *by, "g.*", (F.date_diff("g.gap_end", "g.gap_start") + 1).alias("gap_days")
    ).filter("gap_days > 0")


def coverage_gaps(readings, year, ts="full_timestamp", by=("customer_id",), seasons=None):
    """Per season and key: days present and missing, runs, the longest run and the longest gap.

    Every key with a reading in one of the seasons has a row for each that it
    has readings in; readings without a time are left out.
    """
    runs = islands(day_presence(readings, year, ts, by, seasons), by)
    keys = ["season", *by]
    order = Window.partitionBy(*keys).orderBy("run_start")
    before = F.coalesce(F.lag("run_end").over(order), F.date_sub("first_day", 1))
    seen = runs.withColumn("_gap", F.date_diff("run_start", before) - 1)
    found = seen.groupBy(*keys, "days", "last_day").agg(
        F.sum("run_days").alias("days_present"), F.count(F.lit(1)).alias("runs"),
        F.max("run_days").alias("longest_run"), F.max("_gap").alias("_gap"), F.max("run_end").alias("_end"),
    )
    return found.select(
        *keys, "days_present", (F.col("days") - F.col("days_present")).alias("missing_days"), "runs", "longest_run",
        F.greatest("_gap", F.date_diff("last_day", "_end")).cast("long").alias("longest_gap"),
    )


def complete(readings, year, season, allowed_missing=0, allowed_gap=0, ts="full_timestamp"):
    """One gate row for all readings of a season: days missing, the longest gap and the verdict.

    Unlike `gates.availability` it sees holes before the last day. Without
    readings every day is missing.
    """
    first, last = (datetime.date.fromisoformat(d) for d in C.season_dates(season, year))
    days = F.lit((last - first).days + 1).cast("long")
    found = coverage_gaps(readings.withColumn("_all", F.lit(True)), year, ts, ("_all",), [season])
    return found.agg(
        F.coalesce(F.max("missing_days"), days).alias("missing_days"),
        F.coalesce(F.max("longest_gap"), days).alias("longest_gap"),
    ).select(
        F.lit(season).alias("season"), "missing_days", "longest_gap",
        ((F.col("missing_days") <= allowed_missing) & (F.col("longest_gap") <= allowed_gap)).alias("complete"),
    )
