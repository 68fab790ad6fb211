"""Reports: snapshots, coverage, newest rows, counts, profiles."""

from pyspark.sql import functions as F

from gridmill.functions.numbers import mean


def at_latest(df, ts):
    """Rows at the greatest timestamp of the table.

    The maximum is a scalar subquery: its value reaches the scan as a filter,
    so the second scan skips row groups.
    """
    latest = df.select(F.max(ts).alias("latest")).scalar()
    return df.filter(F.col(ts) == latest)


def latest_snapshot(df, ts, order, limit=5):
    """First rows of the latest snapshot in the given order."""
    return at_latest(df, ts).orderBy(*order).limit(limit)


def newest(df, ts, tie_break, limit=5):
    """The newest rows, ties by key; a top-k per task, then one of the survivors."""
    return df.orderBy(F.col(ts).desc(), F.col(tie_break).asc()).limit(limit)


def coverage(readings, ts, limit=10):
    """Rows, last hour and last minute of the newest dates. The last minute is
    the greatest minute of the date, not that of its last hour."""
    return (
        readings.groupBy(F.to_date(ts).alias("data_date"))
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.max(F.hour(ts)).alias("last_hour"),
            F.max(F.minute(ts)).alias("last_minute"),
        )
        .orderBy(F.col("data_date").desc())
        .limit(limit)
    )


def table_counts(tables):
    """Row counts of several tables, one row each."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    report = rows[0]
    for row in rows[1:]:
        report = report.unionByName(row)
    return report


def prediction_report(predictions, price, ts, scale=None):
    """Count, extremes, rounded average and newest time of predictions."""
    return predictions.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.round(mean(price, scale), 0).alias("avg_price"),
        F.max(ts).alias("last_prediction"),
    )


def first_customers(readings, customer, position, limit=10):
    """The first customers in order of appearance (`limit` rows)."""
    return (
        readings.groupBy(customer)
        .agg(F.min(position).alias("first_position"))
        .orderBy("first_position", customer)
        .limit(limit)
    )


def customer_comparison(readings, customer, position, columns, limit=10):
    """Readings of the first customers. The customer list has `limit` rows, so
    broadcasting it is bounded by that setting."""
    chosen = first_customers(readings, customer, position, limit).select(customer)
    return readings.join(F.broadcast(chosen), customer, "left_semi").select(customer, *columns)


def customer_profile(readings, customer, position, chosen=None):
    """Readings of one customer, by default of the one that appears first."""
    if chosen is not None:
        return readings.filter(F.col(customer) == F.lit(chosen))
    first = readings.select(F.min_by(customer, position).alias("first")).scalar()
    return readings.filter(F.col(customer) == first)


def newest_per_key(frames, keys, version, columns):
    """One row per key over several frames, the one with the greatest version.

    A struct maximum combines map-side, so a key with many rows never gathers.
    """
    stacked = frames[0].select(*keys, version, *columns)
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame.select(*keys, version, *columns))
    newest_row = stacked.groupBy(*keys).agg(F.max(F.struct(version, *columns)).alias("_newest"))
    return newest_row.select(*keys, "_newest.*")


def log_pivot(runs, keys, run="run_id", key="key", value="value", ts="ts"):
    """Wide run log: the latest value of each listed key per run."""
    return runs.groupBy(run).pivot(key, list(keys)).agg(F.max_by(value, ts))
