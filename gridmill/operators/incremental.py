"""Daily energy kept up to date: batches add partial aggregates, and only the dates
that new or replaced batches touch are computed again.

`<path>/partials` holds one part per batch with a row per timestamp, laid out by
date; `<path>/daily` holds the result and, as `upto`, the version of the partials
that it reflects. Both are tables with a commit log, so a stop in between leaves
the older result, and the next `refresh` takes up what is missing.
"""

from pyspark.sql import functions as F

from gridmill.functions import calendar as C
from gridmill.functions.numbers import exact
from gridmill.operators.rollup import daily_energy
from gridmill.sinks import manifest


def system_partials(readings, ts="full_timestamp", load="load_percentage", customer="customer_id", scale=None):
    """Per timestamp the sum, count and extremes of the loads and the number of readings: what
    system rows of several batches merge from."""
    value = exact(load, scale)
    return readings.groupBy(F.col(ts).alias("full_timestamp")).agg(
        F.sum(value).alias("load_sum"), F.count(value).alias("load_count"),
        F.max(load).alias("load_max"), F.min(load).alias("load_min"), F.count(customer).alias("customers"),
    )


def merge_system(partials):
    """The system series of all partial aggregates together, as `rollup.system_rollup` makes it."""
    series = partials.groupBy("full_timestamp").agg(
        F.sum("load_sum").cast("double").alias("total_system_load"),
        F.try_divide(F.sum("load_sum").cast("double"), F.sum("load_count").cast("double")).alias("avg_system_load"),
        F.max("load_max").alias("max_system_load"),
        F.min("load_min").alias("min_system_load"),
        F.sum("customers").alias("active_customers"),
    )
    return series.select("*", *[c.alias(n) for n, c in C.calendar_parts("full_timestamp").items()])


def add_batch(readings, path, batch, scale=None, **columns):
    """Store the partial aggregates of a batch in place of earlier ones under its name; returns the version.

    Late readings of any date may be among them. Readings without a time are in
    no date and left out, as in the full roll-up's dated rows.
    """
    rows = system_partials(readings, scale=scale, **columns).filter(F.col("full_timestamp").isNotNull())
    dated = rows.withColumn("day", F.to_date("full_timestamp"))
    # A date's rows go to one file of the batch: one row per timestamp, so few.
    return manifest.append(dated.repartition("day"), f"{path}/partials", batch, replace=True, partition_by=["day"])


def touched_dates(spark, path, after, upto):
    """Dates of the parts that the versions after one and up to another added or removed.

    Dates are folder names; no column of the parts is read.
    """
    source = f"{path}/partials"
    parts = [r["part"] for r in manifest.changes(spark, source, after, upto).select("part").distinct().collect()]
    if not parts:
        return []
    days = manifest.read(spark, source, parts=[{"part": p} for p in parts]).select("day").distinct()
    return sorted(r["day"] for r in days.collect())


def partials_of(spark, path, days, version=None):
    """The partial aggregates of some dates; other dates' files are not opened."""
    return manifest.read(spark, f"{path}/partials", version).filter(F.col("day").isin(days))


def refresh(spark, path, scale=None):
    """Bring the daily table up to date; returns the dates that were computed again.

    A date without readings any more goes. The other dates are copied as they
    are, one row each. Of two jobs at once the one with the newer partials wins.
    """
    source, target = f"{path}/partials", f"{path}/daily"
    version, parts = manifest.live(spark, source)
    old = manifest.live(spark, target)[1]
    after = max((p["upto"] for p in old), default=0)
    days = touched_dates(spark, path, after, version)
    if not days:
        return []
    if parts:
        rows = daily_energy(merge_system(partials_of(spark, path, days, version)), scale=scale)
        if old:
            kept = manifest.read(spark, target, parts=old).filter(~F.to_date("date").isin(days))
            rows = kept.unionByName(rows)
    else:
        rows = manifest.read(spark, target, parts=old).filter(F.lit(False))
    # One row per date: a century is a small file.
    part = manifest.write_part(rows.coalesce(1), target, "daily", version)
    manifest.commit(spark, target, lambda now: [] if any(p["upto"] >= version for p in now) else [
        *map(manifest.removed, now), manifest.added(part)
    ])
    return days


def daily(spark, path, version=None):
    """The daily table as `refresh` left it, or an earlier version of it."""
    return manifest.read(spark, f"{path}/daily", version)
