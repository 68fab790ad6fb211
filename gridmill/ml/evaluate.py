"""Regression metrics of all splits in one aggregation."""

from pyspark.sql import functions as F

from gridmill import fixed


def metrics(predictions, label, prediction="prediction", by=("split",), scale=None):
    """RMSE, MAE, R2 and rows per group; null labels or predictions are skipped.

    The total sum of squares comes from the mergeable population variance. With
    `scale` all sums are exact decimals instead.
    """
    rows = predictions.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    n = F.count(F.lit(1))
    if scale is None:
        error = F.col(label) - F.col(prediction)
        squares, absolute = F.sum(error * error), F.sum(F.abs(error))
        spread = F.var_pop(label) * n
    else:
        kind = f"decimal(18,{scale})"
        y, p = F.col(label).cast(kind), F.col(prediction).cast(kind)
        error = (y - p).cast(kind)
        squares = F.sum(error * error).cast("double")
        absolute = F.sum(F.abs(error)).cast("double")
        first = F.sum(y).cast("double")
        spread = F.sum(y * y).cast("double") - first * first / n
    return rows.groupBy(*by).agg(
        n.alias("row_count"),
        F.sqrt(squares / n).alias("rmse"),
        (absolute / n).alias("mae"),
        (F.lit(1.0) - F.try_divide(squares, spread)).alias("r2"),
    )


def overfit_gap(split_metrics, limit=fixed.OVERFIT_GAP):
    """Train R2 minus test R2, and whether it exceeds the limit (three rows in)."""
    of = lambda name: F.max(F.when(F.col("split") == name, F.col("r2")))
    return split_metrics.agg((of("train") - of("test")).alias("gap")).withColumn(
        "overfit", F.col("gap") > limit
    )


def naive_forecast(daily, target=fixed.TARGET, lag_column="energy_lag_7"):
    """The value of seven rows before as prediction, the yardstick for models."""
    return daily.withColumn("prediction", F.col(lag_column))
