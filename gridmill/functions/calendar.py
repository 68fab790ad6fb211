"""Calendar expressions. Three weekday and three season conventions coexist;
each has its own name so that a caller cannot mix them up."""

from functools import reduce

from pyspark.sql import functions as F

from gridmill import fixed
from gridmill.functions.numbers import as_column, clamp

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _flag(condition):
    """1 where the condition holds, 0 elsewhere, also for nulls."""
    return F.when(condition, 1).otherwise(0)


# --- weekdays -------------------------------------------------------------
def weekday_sunday1(ts):
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(as_column(ts))


def weekday_sunday0(ts):
    """0 = Sunday .. 6 = Saturday, the SQL EXTRACT(DOW) numbering."""
    return F.dayofweek(as_column(ts)) - 1


def weekday_monday0(ts):
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(as_column(ts))


def weekend_sunday1(weekday):
    return _flag(as_column(weekday).isin(1, 7))


def weekend_sunday0(weekday):
    return as_column(weekday).isin(0, 6).cast("int")


# --- seasons --------------------------------------------------------------
def model_season(month):
    """Season whose model serves a month; anything else is the general season."""
    month = as_column(month)
    chain = reduce(
        lambda acc, item: acc.when(month.isin(*item[1]), F.lit(item[0])),
        fixed.MODEL_SEASONS.items(),
        F,
    )
    return chain.otherwise(F.lit(fixed.GENERAL_SEASON))


def flag_summer(month):
    return _flag(as_column(month).isin(*fixed.FLAG_SUMMER_MONTHS))


def flag_winter(month):
    return _flag(as_column(month).isin(*fixed.FLAG_WINTER_MONTHS))


def season_dates(season, year):
    """First and last day of a model season, as ISO strings."""
    months = fixed.MODEL_SEASONS.get(season, range(1, 13))
    last = fixed.SEASON_LAST_DAY.get(season, "12-31")
    return f"{year}-{min(months):02d}-01", f"{year}-{last}"


# --- parts, parsing, building --------------------------------------------
def calendar_parts(ts):
    """Named calendar columns of a timestamp."""
    ts = as_column(ts)
    return {
        "date": F.date_format(ts, "yyyy-MM-dd"),
        "hour": F.hour(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "dayofweek": weekday_sunday1(ts),
    }


def month_name(value):
    return F.date_format(as_column(value), "MMMM")


def day_number_date(day, year=fixed.FIRST_DAY.year):
    """Date of the n-th day of a year (1-based)."""
    return F.date_add(F.make_date(F.lit(year), F.lit(1), F.lit(1)), as_column(day).cast("int") - 1)


def interval_hour(index, minutes=fixed.MINUTES_PER_CELL):
    return F.floor(as_column(index) * minutes / 60).cast("int")


def interval_minute(index, minutes=fixed.MINUTES_PER_CELL):
    return F.pmod(as_column(index) * minutes, F.lit(60)).cast("int")


def interval_time(day, index, year=fixed.FIRST_DAY.year, minutes=fixed.MINUTES_PER_CELL):
    """Start of an interval; an index past the day runs into the next one."""
    midnight = day_number_date(day, year).cast("timestamp")
    return midnight + F.make_dt_interval(mins=(as_column(index) * minutes).cast("int"))


def clock_label(hour, minute):
    return F.format_string("%02d:%02d", as_column(hour), as_column(minute))


def parse_timestamp(text):
    return F.try_to_timestamp(as_column(text))


def parse_iso_micros(text):
    """Timestamp of an ISO string with a fraction; null for any other shape."""
    return F.try_to_timestamp(as_column(text), F.lit(ISO_MICROS))


def is_sample_day(date):
    """Every fourth day of a month from its first, eight days at most."""
    day = F.dayofmonth(as_column(date))
    last = 1 + fixed.SAMPLE_DAY_STEP * (fixed.SAMPLE_DAYS_PER_MONTH - 1)
    return ((day - 1) % fixed.SAMPLE_DAY_STEP == 0) & (day <= last)


def sample_day_numbers(year=fixed.FIRST_DAY.year):
    """Day-of-year numbers chosen by `is_sample_day` (a small list of settings)."""
    import datetime

    step, count = fixed.SAMPLE_DAY_STEP, fixed.SAMPLE_DAYS_PER_MONTH
    start = datetime.date(year, 1, 1)
    days = (start + datetime.timedelta(n) for n in range(366))
    return [
        d.timetuple().tm_yday
        for d in days
        if d.year == year and (d.day - 1) % step == 0 and d.day <= 1 + step * (count - 1)
    ]


# --- expected load --------------------------------------------------------
def expected_load(ts):
    """Typical load of a timestamp: base x season x hour x weekend, clamped."""
    ts = as_column(ts)
    month, hour = F.month(ts), F.hour(ts)
    seasons, hours = fixed.PROFILE_SEASON_FACTORS, fixed.PROFILE_HOUR_FACTORS
    season = (
        F.when(month.isin(*fixed.PROFILE_WINTER_MONTHS), seasons["winter"])
        .when(month.isin(*fixed.PROFILE_SUMMER_MONTHS), seasons["summer"])
        .otherwise(seasons["other"])
    )
    at_peak = reduce(
        lambda acc, span: acc | hour.between(*span), fixed.PROFILE_PEAK_HOURS, F.lit(False)
    )
    at_night = (hour >= fixed.PROFILE_NIGHT_FROM) | (hour <= fixed.PROFILE_NIGHT_TO)
    of_day = F.when(at_peak, hours["peak"]).when(at_night, hours["night"]).otherwise(hours["other"])
    weekend = F.when(weekday_monday0(ts) >= 5, fixed.PROFILE_WEEKEND_FACTOR).otherwise(1.0)
    return clamp(F.lit(fixed.PROFILE_BASE) * season * of_day * weekend, *fixed.PROFILE_BOUNDS)
