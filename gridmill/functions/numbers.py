"""Numeric expressions: exact sums, guarded ratios, encodings, rounding."""

from pyspark.sql import functions as F

from gridmill import fixed


def as_column(value):
    return F.col(value) if isinstance(value, str) else value


def exact(value, scale):
    """The value as a decimal with `scale` digits, or unchanged without a scale.

    Decimal sums do not depend on the order of addition, so totals repeat bit
    for bit whatever the partitioning; doubles are the faster default. What does
    not fit becomes null.
    """
    column = as_column(value)
    return column if scale is None else column.try_cast(f"decimal(18,{scale})")


def total(value, scale=None):
    return F.sum(exact(value, scale)).cast("double")


def mean(value, scale=None):
    column = as_column(value)
    if scale is None:
        return F.avg(column)
    return F.try_divide(total(column, scale), F.count(column).cast("double"))


def missing_to_null(value):
    return F.nanvl(as_column(value).cast("double"), F.lit(None).cast("double"))


def cyclic(value, period, wave):
    """sin/cos position of a calendar field within its period (sin or cos as `wave`)."""
    return wave(as_column(value) * F.lit(2.0) * F.lit(fixed.PI) / F.lit(float(period)))


def linear_phase(value, half_period):
    """Calendar field scaled by pi over half its period, without a sine."""
    return as_column(value) * F.lit(fixed.PI) / F.lit(float(half_period))


def ratio(top, bottom):
    """Division with null for a zero divisor."""
    return F.try_divide(as_column(top), as_column(bottom))


def ratio_or(top, bottom, default=1.0):
    """Division for positive divisors, `default` otherwise (null divisors too)."""
    bottom = as_column(bottom)
    return F.when(bottom > 0, F.try_divide(as_column(top), bottom)).otherwise(F.lit(default))


def clamp(value, low, high):
    return F.greatest(F.lit(low), F.least(F.lit(high), as_column(value)))


def int_div(value, divisor):
    """Floor division of integers."""
    return F.floor(as_column(value) / F.lit(divisor)).cast("int")
