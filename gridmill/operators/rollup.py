"""Roll-ups. Every aggregate combines map-side, so a hot key shuffles one row
per task; distinct counts first collapse to (group, value) pairs.

`scale` switches sums from doubles to decimals with that many digits.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill.functions import calendar as C
from gridmill.functions.numbers import exact, mean, missing_to_null, total
from gridmill.session import stored


def system_rollup(readings, ts="full_timestamp", load="load_percentage",
                  customer="customer_id", scale=None):
    """One row per timestamp over all customers, with calendar columns."""
    series = readings.groupBy(F.col(ts).alias("full_timestamp")).agg(
        total(load, scale).alias("total_system_load"),
        mean(load, scale).alias("avg_system_load"),
        F.max(load).alias("max_system_load"),
        F.min(load).alias("min_system_load"),
        F.count(customer).alias("active_customers"),
    )
    return series.select("*", *[c.alias(n) for n, c in C.calendar_parts("full_timestamp").items()])


def daily_energy(system, scale=None):
    """One row per date of the system series; `avg_daily_load` is the mean of
    the system totals."""
    daily = system.groupBy("date").agg(
        total("total_system_load", scale).alias("total_daily_energy"),
        mean("total_system_load", scale).alias("avg_daily_load"),
        F.max("total_system_load").alias("peak_daily_load"),
        F.min("total_system_load").alias("min_daily_load"),
        F.sum("active_customers").alias("total_daily_customers"),
        mean("active_customers", None if scale is None else 0).alias("avg_daily_customers"),
    )
    day = F.col("date").try_cast("timestamp")
    return daily.select(
        "*",
        day.alias("timestamp"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        C.weekday_sunday1(day).alias("dayofweek"),
    )


def daily_readings(readings, ts="full_timestamp", load="load_percentage",
                   customer="customer_id", scale=None, approximate=False):
    """One row per date straight from readings; `avg_daily_load` is the mean of
    the single readings. Customers are counted exactly unless `approximate`."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    daily = readings.groupBy(F.to_date(ts).alias("date")).agg(
        total(load, scale).alias("total_daily_energy"),
        mean(load, scale).alias("avg_daily_load"),
        F.max(load).alias("peak_daily_load"),
        distinct(customer).alias("customer_count"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return daily.select(
        "*",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "yyyy-MM-dd").alias("date_str"),
    )


def seasonal_daily(readings, year, season, ts="full_timestamp", load="load_percentage", scale=None):
    """Daily average, extremes and count of one season of one year.

    Year and months are a half-open time range, which the scan can prune on.
    """
    first, last = C.season_dates(season, year)
    kind = readings.schema[ts].dataType.simpleString()
    inside = readings.filter(
        (F.col(ts) >= F.lit(first).cast(kind))
        & (F.col(ts) < F.date_add(F.lit(last).cast("date"), 1).cast(kind))
    )
    daily = inside.groupBy(F.to_date(ts).alias("date")).agg(
        mean(load, scale).alias("avg_load_percentage"),
        F.min(load).alias("min_load_percentage"),
        F.max(load).alias("max_load_percentage"),
        F.count(F.lit(1)).alias("record_count"),
    )
    return daily.select(
        "*",
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        C.weekday_sunday0("date").alias("day_of_week"),
    )


def seasonal_daily_sql(view, year, season, ts="full_timestamp", load="load_percentage"):
    """The same roll-up as SQL text for a registered view or table."""
    first, last = C.season_dates(season, year)
    return f"""
        SELECT to_date({ts}) AS date,
               avg({load}) AS avg_load_percentage,
               min({load}) AS min_load_percentage,
               max({load}) AS max_load_percentage,
               count(*) AS record_count,
               month(to_date({ts})) AS month,
               day(to_date({ts})) AS day,
               dayofweek(to_date({ts})) - 1 AS day_of_week
        FROM {view}
        WHERE {ts} >= '{first}' AND {ts} < date_add(DATE '{last}', 1)
        GROUP BY to_date({ts})
    """


def monthly_average(readings, ts, load, scale=None):
    """Average load per calendar month, all years together; NaN loads count as missing."""
    return readings.groupBy(
        F.month(ts).alias("month"), C.month_name(ts).alias("month_name")
    ).agg(mean(missing_to_null(load), scale).alias("avg_load_percentage"))


def monthly_partials(readings, ts, load, by=(), scale=None):
    """Sum and count per month: the parts that averages merge from. NaN loads count as missing."""
    value = exact(missing_to_null(load), scale)
    return readings.groupBy(
        *by, F.month(ts).alias("month_num"), C.month_name(ts).alias("month_name")
    ).agg(F.sum(value).alias("load_sum"), F.count(value).alias("load_count"))


def merge_monthly(partials):
    """Averages of all partial sums so far."""
    return partials.groupBy("month_num", "month_name").agg(
        F.try_divide(F.sum("load_sum").cast("double"), F.sum("load_count").cast("double"))
        .alias("avg_load_percentage")
    )


def value_span(df, column, low="start_date", high="end_date"):
    return df.agg(F.min(column).alias(low), F.max(column).alias(high))


def energy_stats(daily, column="total_daily_energy", scale=None):
    return daily.agg(
        mean(column, scale).alias("avg_daily_energy"),
        F.min(column).alias("min_daily_energy"),
        F.max(column).alias("max_daily_energy"),
    )


def averages_by(df, by, columns, scale=None):
    """Group averages named `avg_<column>`."""
    return df.groupBy(*by).agg(*[mean(c, scale).alias(f"avg_{c}") for c in columns])


def cardinalities(df, columns):
    """One row per column: its name as `column` and its `distinct_values`, nulls left out.

    The table is read once. Every row yields its values, which collapse to one
    row per distinct value and task before they are shuffled.
    """
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]))
    # Grouping without an aggregate collapses the values map-side.
    distinct = df.select(cells.alias("_cell")).select("_cell.*").distinct()
    return distinct.groupBy("column").agg(F.count("value").alias("distinct_values"))


def peak_interval(readings, by, ts, load):
    """Time, clock label and size of the highest load per group, earliest on ties; NaN counts as missing."""
    peak = readings.groupBy(*by).agg(
        F.max(F.struct(F.when(~F.isnan(load), F.col(load)).alias("load"), (-F.unix_micros(F.col(ts).cast("timestamp"))).alias("early")))
        .alias("peak")
    )
    at = F.timestamp_micros(-F.col("peak.early"))
    return peak.select(
        *by,
        F.col("peak.load").alias("peak_load"),
        at.cast("timestamp_ntz").alias("peak_time"),
        C.clock_label(F.hour(at), F.minute(at)).alias("peak_clock"),
    )


def table_count(df, name="row_count"):
    return df.agg(F.count(F.lit(1)).alias(name))


def split_sizes(df, split="split"):
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("row_count"))


def summary(df, column, by=(), quantiles=(0.25, 0.5, 0.75), scale=None, accuracy=10_000):
    """count, mean, std, min, exact interpolated quantiles and max per group.

    `column` is a name, or a list of names for one row per group and column (then
    with the name as `column`). Null and NaN values count as missing; null keys
    are a group, a group of missing values only and an empty frame count 0.

    Two passes, whatever the size: the first sketches each group map-side and
    brackets every quantile, the second keeps single values only inside the
    brackets (some 6 / `accuracy` of the rows for each) and collapses what lies
    between two brackets to one cell. Cells are ordered by range, so a group
    with many of them is spread over tasks; ranks are exact counts. A cell knows
    its least and greatest value, which covers ranks at the edge of a bracket.
    """
    columns = [column] if isinstance(column, str) else list(column)
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    names = [f"_v{i}" for i in range(len(columns))]
    keyed = df.select(key.alias("_key"), *[missing_to_null(c).alias(n) for c, n in zip(columns, names, strict=True)])
    margin = 3 / accuracy
    fractions = F.array(*[F.lit(min(max(q + m, 0.0), 1.0)) for q in quantiles for m in (-margin, margin)])
    stats = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.count(n).alias("count"), mean(n, scale).alias("mean"),
            F.stddev_samp(n).alias("std"), F.min(n).alias("min"), F.max(n).alias("max"),
            F.percentile_approx(n, fractions, F.lit(accuracy)).alias("_marks"),
        )
        for c, n in zip(columns, names, strict=True)
    ]).alias("_stats")
    # Without keys, the aggregate of an empty frame is still one row.
    firsts = keyed.groupBy("_key").agg(stats) if by else keyed.agg(stats).withColumn("_key", key)
    groups = stored(firsts.select("_key", F.inline("_stats")), "summary-groups")
    here = ["_key", "column"]

    values = keyed.select("_key", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(n).alias("v")) for c, n in zip(columns, names, strict=True)
    ])).alias("_one")).select("_key", F.col("_one.column").alias("column"), F.col("_one.v").alias("_v"))
    v, inside = F.col("_v"), F.lit(False)
    for i in range(len(quantiles)):
        inside = inside | v.between(F.col("_marks")[2 * i], F.col("_marks")[2 * i + 1])
    below = F.array_max(F.filter("_marks", lambda m: m < v))
    cells = (
        values.filter(v.isNotNull()).join(groups.select(*here, "count", "_marks"), here)
        .select(*here, "count", "_v", F.when(inside, v).otherwise(below).alias("_at"), (~inside).alias("_gap"))
        .groupBy(*here, "count", "_at", "_gap")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    )
    dealt = cells.repartitionByRange(*here, "_at", "_gap").withColumn("_deal", F.spark_partition_id())
    dealt = stored(dealt, "summary-cells")
    earlier = Window.partitionBy(*here).orderBy("_deal").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*here, "_deal").agg(F.sum("_n").alias("_rows")).select(
        *here, "_deal", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    upto = Window.partitionBy(*here, "_deal").orderBy("_at", "_gap").rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("_upto", F.sum("_n").over(upto)).join(starts, [*here, "_deal"])

    # Wanted zero-based ranks: below and above each quantile position.
    position = lambda q: (F.col("count") - 1) * F.lit(q)
    ranks = F.array_distinct(F.array(*[f(position(q)) for q in quantiles for f in (F.floor, F.ceil)]))
    end = F.col("_start") + F.col("_upto")
    found = F.filter(ranks, lambda r: (r >= end - F.col("_n")) & (r < end))
    at_rank = (
        F.when(F.col("_rank") == F.col("_end") - F.col("_n"), F.col("_low"))
        .when(F.col("_rank") == F.col("_end") - 1, F.col("_high"))
        .when(F.col("_low") == F.col("_high"), F.col("_low"))
        .otherwise(F.raise_error(F.lit("a rank lies outside its bracket: lower `accuracy`")).cast("double"))
    )
    at = (
        placed.select(*here, "_n", "_low", "_high", end.alias("_end"), F.explode(found).alias("_rank"))
        .groupBy(*here)
        .agg(F.map_from_entries(F.collect_list(F.struct("_rank", at_rank))).alias("_ranked"))
    )

    def value(q):
        low, high = F.col("_ranked")[F.floor(position(q))], F.col("_ranked")[F.ceil(position(q))]
        return F.when(low == high, low).otherwise(low + (high - low) * (position(q) - F.floor(position(q))))

    return groups.join(at, here, "left").select(
        *[F.col("_key")[k].alias(k) for k in by], *([] if isinstance(column, str) else ["column"]),
        "count", "mean", "std", "min", *[value(q).alias(f"p{round(q * 100)}") for q in quantiles], "max",
    )


def describe(df, columns=None):
    """count, mean, std, min and max of every column, one row each and one pass.

    Text and other columns without numbers have no mean and std; extremes are
    shown as text.
    """
    numeric = ("byte", "short", "integer", "long", "float", "double", "decimal")
    rows = []
    for field in df.schema:
        if columns is None or field.name in columns:
            c, none = F.col(field.name), F.lit(None).cast("double")
            is_number = field.dataType.typeName() in numeric
            rows.append(F.struct(
                F.lit(field.name).alias("column"), F.count(c).alias("count"),
                (F.avg(c).cast("double") if is_number else none).alias("mean"),
                (F.stddev_samp(c) if is_number else none).alias("std"),
                F.min(c).cast("string").alias("min"), F.max(c).cast("string").alias("max"),
            ))
    return df.agg(F.array(*rows).alias("_rows")).select(F.inline("_rows"))
