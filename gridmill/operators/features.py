"""Feature sets for daily series."""

from pyspark.sql import functions as F

from gridmill import fixed
from gridmill.functions import calendar as C
from gridmill.functions.numbers import cyclic, linear_phase, ratio, ratio_or
from gridmill.operators import windows as W


def history(target, window, fallback, scale=None, shifted=False):
    """Lags, rolling statistics and trends of the target over one ordered window.

    The default frames end at the current row, so trends contain the target
    itself; `shifted` frames end one row earlier and do not.
    """
    made = W.lags(target, fixed.LAG_STEPS, window, "energy_lag", fallback)
    for span in fixed.AVERAGE_SPANS:
        made[f"rolling_avg_{span}d"] = W.rolling_mean(target, window, span, scale, shifted)
    span = fixed.EXTREME_SPAN
    made[f"rolling_max_{span}d"] = W.rolling_max(target, window, span, shifted)
    made[f"rolling_min_{span}d"] = W.rolling_min(target, window, span, shifted)
    return made


def trends(target):
    return {
        f"energy_trend_{span}d": F.col(target) - F.col(f"rolling_avg_{span}d")
        for span in fixed.TREND_SPANS
    }


def calendar_features(month="month", weekday="dayofweek"):
    return {
        "month_sin": cyclic(month, 12, F.sin),
        "month_cos": cyclic(month, 12, F.cos),
        "dayofweek_sin": cyclic(weekday, 7, F.sin),
        "dayofweek_cos": cyclic(weekday, 7, F.cos),
        "is_weekend": C.weekend_sunday1(weekday),
        "is_summer": C.flag_summer(month),
        "is_winter": C.flag_winter(month),
    }


def forecast_features(daily, target=fixed.TARGET, order="date", partition_by=(),
                      scale=None, shifted=False):
    """Feature set of the forecast model; rows without full lags keep nulls."""
    window = W.ordered(order, partition_by)
    return (
        daily.withColumns(history(target, window, False, scale, shifted))
        .withColumns(calendar_features())
        .withColumn("peak_to_avg_ratio", ratio("peak_daily_load", "avg_daily_load"))
        .withColumns(trends(target))
    )


def forecast_feature_names(featured, target=fixed.TARGET):
    """Every column but the keys and the target."""
    return [c for c in featured.columns if c not in ("date", "timestamp", target)]


def silver_features(daily, target=fixed.TARGET, order="date", partition_by=(),
                    scale=None, shifted=False):
    """Feature set of the seasonal store: missing history falls back to the row
    itself, the load ratio to one, and remaining numeric nulls to zero."""
    window = W.ordered(order, partition_by)
    dated = daily.withColumns({
        "month": F.month("date"), "dayofweek": C.weekday_sunday1("date"), "year": F.year("date"),
    })
    return (
        dated.withColumns(history(target, window, True, scale, shifted))
        .withColumns(calendar_features())
        .withColumn("peak_to_avg_ratio", ratio_or("peak_daily_load", "avg_daily_load"))
        .withColumns(trends(target))
        .fillna(0)
    )


def silver_training_rows(daily, target=fixed.TARGET, names=fixed.SILVER_FEATURES, **options):
    """(rows, missing): the listed features that exist, target and date; and the
    listed features that do not exist."""
    featured = silver_features(daily, target, **options)
    wanted = [*names, target, "date"]
    present = [c for c in wanted if c in featured.columns]
    rows = featured.filter(F.col("rolling_avg_30d").isNotNull()).select(*present)
    return rows, [c for c in wanted if c not in featured.columns]


def seasonal_features(daily):
    """Calendar features of the seasonal models (phases are not wrapped in a sine)."""
    return daily.withColumns({
        "month_sin": linear_phase("month", 6),
        "day_sin": linear_phase("day", 15),
        "is_weekend": C.weekend_sunday0("day_of_week"),
    })


def residuals(readings, ts="full_timestamp", load="load_percentage"):
    """Expected load of each reading and the distance to it."""
    return readings.withColumn("expected_load", C.expected_load(ts)).withColumn(
        "residual", F.col(load) - F.col("expected_load")
    )
