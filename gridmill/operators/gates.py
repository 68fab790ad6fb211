"""Quality gates. A gate is a one-row frame; reading it is the caller's action."""

from pyspark.sql import functions as F

from gridmill import fixed
from gridmill.functions import calendar as C


def season_filter(daily, season, month="month"):
    """Rows of a model season; an unknown season keeps everything."""
    months = fixed.MODEL_SEASONS.get(season)
    return daily if months is None else daily.filter(F.col(month).isin(*months))


def availability(readings, ts, season, year, min_rows=1):
    """Whether the newest reading reaches the season's last day, and whether
    the season has rows. Days are compared as dates; gaps inside are not seen."""
    first, last = C.season_dates(season, year)
    in_season = F.to_date(ts).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    found = readings.agg(
        F.max(F.to_date(ts)).alias("latest"), F.count_if(in_season).alias("season_rows")
    )
    return found.select(
        F.lit(season).alias("season"),
        F.lit(last).cast("date").alias("required"),
        "latest",
        "season_rows",
        F.coalesce(F.col("latest") >= F.lit(last).cast("date"), F.lit(False)).alias("available"),
        (F.col("season_rows") >= min_rows).alias("enough"),
    )


def availability_by_season(readings, ts, year, min_rows=1):
    """The gate for every model season in one pass over the readings."""
    day = F.to_date(ts)
    ends = {s: C.season_dates(s, year) for s in fixed.MODEL_SEASONS}
    found = readings.agg(
        F.max(day).alias("latest"),
        *[
            F.count_if(day.between(F.lit(a).cast("date"), F.lit(b).cast("date"))).alias(s)
            for s, (a, b) in ends.items()
        ],
    )
    rows = F.array(*[
        F.struct(
            F.lit(s).alias("season"),
            F.lit(b).cast("date").alias("required"),
            F.col(s).alias("season_rows"),
        )
        for s, (_, b) in ends.items()
    ])
    return (
        found.select("latest", F.explode(rows).alias("s"))
        .select("s.*", "latest")
        .withColumn("available", F.coalesce(F.col("latest") >= F.col("required"), F.lit(False)))
        .withColumn("enough", F.col("season_rows") >= min_rows)
    )


def freshness(predictions, ts, as_of=None, minutes=5):
    """Rows newer than `as_of` minus some minutes, and the verdict.

    `as_of` is a column (default: the current time), so a run can be repeated.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    edge = as_of - F.expr(f"INTERVAL {int(minutes)} MINUTES")
    counted = predictions.filter(F.col(ts) > edge).agg(F.count(F.lit(1)).alias("recent_rows"))
    return counted.withColumn("fresh", F.col("recent_rows") > 0)


def enough_rows(df, minimum=fixed.MIN_TRAINING_ROWS):
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "enough", F.col("row_count") >= minimum
    )
