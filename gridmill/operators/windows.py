"""Row-based windows over ordered series.

Frames and lags count rows, so a missing date shifts them; `densify` fills the
gaps where calendar distance is wanted. A window without partition columns
runs in one task, and one with them runs each group in one task: use them on
series with one row per date, and `chunked` on longer ones.
"""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill.functions.numbers import as_column, exact
from gridmill.session import stored


def ordered(order, partition_by=()):
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*partition_by).orderBy(*order)


def lags(column, steps, window, prefix, fallback=False):
    """Earlier values; the first rows get null, or their own value with `fallback`."""
    own = as_column(column)
    made = {}
    for step in steps:
        earlier = F.lag(own, step).over(window)
        made[f"{prefix}_{step}"] = F.coalesce(earlier, own) if fallback else earlier
    return made


def trailing(window, span, shifted=False):
    """The last `span` rows, the current one included unless `shifted`."""
    return window.rowsBetween(-span, -1) if shifted else window.rowsBetween(1 - span, 0)


def rolling_mean(column, window, span, scale=None, shifted=False):
    frame = trailing(window, span, shifted)
    if scale is None:
        return F.avg(as_column(column)).over(frame)
    return F.try_divide(
        F.sum(exact(column, scale)).over(frame).cast("double"),
        F.count(as_column(column)).over(frame).cast("double"),
    )


def rolling_max(column, window, span, shifted=False):
    return F.max(as_column(column)).over(trailing(window, span, shifted))


def rolling_min(column, window, span, shifted=False):
    return F.min(as_column(column)).over(trailing(window, span, shifted))


def densify(daily, date="date"):
    """A row for every date between the first and the last; added rows are null,
    rows without a date stay."""
    span = daily.agg(F.min(date).alias("_a"), F.max(date).alias("_b"))
    calendar = span.select(F.explode(F.sequence("_a", "_b")).alias(date))
    return calendar.join(daily, date, "full")


def even_buckets(df, column, parts, name="bucket"):
    """At most `parts` buckets of about equal row count along a column; nulls come first.

    A sketch of the column proposes the bounds, which come to the driver as at
    most `parts` numbers and go back as constants: a stretch that holds a third
    of all rows gets a third of the buckets, and every pass sees the same ones.
    Equal values share a bucket, so the column should tell most rows apart.
    """
    kind = df.schema[column].dataType.simpleString()
    value = F.col(column)
    if kind == "date" or kind.startswith("timestamp"):
        value = F.unix_micros(value.cast("timestamp"))
    value = value.cast("double")
    fractions = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = df.agg(F.percentile_approx(value, fractions, F.lit(parts * 20))).first()[0] or []
    if not cuts:
        return df.withColumn(name, F.lit(-1))
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    bucketizer = Bucketizer(
        splits=splits, inputCol="_order", outputCol="_place", handleInvalid="keep"
    )
    placed = bucketizer.transform(df.withColumn("_order", F.coalesce(value, F.lit(float("-inf")))))
    return placed.withColumn(
        name, F.when(F.col(column).isNull(), -1).otherwise(F.col("_place").cast("int"))
    ).drop("_order", "_place")


def numbered(df, order, bucket, name="row_num", by=()):
    """Row number over a total order (within the groups of `by`), without one
    task per order or group.

    `bucket` is a column or expression that does not decrease along the order,
    see `even_buckets`. Rows are numbered inside their bucket and shifted by the
    sizes of all earlier buckets, which are one row per group and bucket.
    """
    order = [order] if isinstance(order, str) else list(order)
    # One struct as key: null parts compare equal in it, and the row numbers and
    # the join share its partitioning, so the rows are shuffled once.
    key = F.struct(*by, as_column(bucket).alias("_bucket"))
    marked = df.withColumn("_key", key)
    sizes = marked.groupBy("_key").agg(F.count(F.lit(1)).alias("_size"))
    earlier = (
        Window.partitionBy(*[F.col("_key")[k] for k in by])
        .orderBy(F.col("_key")["_bucket"])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select(
        "_key", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_key").orderBy(*order)
    return (
        marked.withColumn("_place", F.row_number().over(inside))
        .join(starts, "_key")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .select(*df.columns, name)
    )


def chunked(df, order, reach, columns, by=(), bucket=None, rows_per_chunk=100_000):
    """Row-based window columns over long series, many tasks per series.

    `columns` maps a window to named columns that look back at most `reach`
    rows. Each series (one per group of `by`) is cut into chunks of equal row
    count; a chunk also gets the last `reach` rows of the chunk before, which
    are dropped again. The result equals the same window over whole series, and
    a group with a third of all rows is spread like any other rows.

    Without a `bucket` for the numbering, rows are dealt to partitions by range
    of the complete order and stored once, so equal values of its first column
    are split by the others. With one, the frame is read twice: store costly
    ones first.
    """
    if reach > rows_per_chunk:
        raise ValueError("a chunk must hold at least `reach` rows")
    kept = df.columns
    if bucket is None:
        spread = [order] if isinstance(order, str) else list(order)
        dealt = df.repartitionByRange(*spread).withColumn("_even", F.spark_partition_id())
        df, bucket = stored(dealt, "dealt"), "_even"
    rows = numbered(df, order, bucket, "_row", by)
    home = F.floor((F.col("_row") - 1) / rows_per_chunk)
    is_tail = (F.col("_row") - 1) % rows_per_chunk >= rows_per_chunk - reach
    copies = F.when(is_tail, F.array(home, home + 1)).otherwise(F.array(home))
    spread = rows.withColumn("_home", home).withColumn("_chunk", F.explode(copies))
    window = Window.partitionBy(*by, "_chunk").orderBy("_row")
    made = columns(window)
    return (
        spread.select(*kept, "_home", "_chunk", *[c.alias(n) for n, c in made.items()])
        .filter(F.col("_home") == F.col("_chunk"))
        .drop("_home", "_chunk")
    )


def long_rolling(df, order, value, span, by=(), bucket=None, rows_per_chunk=100_000, scale=None, prefix="rolling"):
    """Mean, max, min and count of the last `span` rows, the current one included, for frames of any length.

    `chunked` copies the rows a frame looks back on; here a frame may cover many
    chunks and nothing is copied. Of each chunk only its total, count and extremes
    are kept beside running ones inside it. A frame's sum is the difference of
    two running totals; its extremes are those of the first chunk from the
    frame's first row on, of the whole chunks between, and of the last chunk up to
    the current row. One join brings the values at the frame's first row.

    Nulls are left out as in SQL frames. Adds `<prefix>_avg`, `_max`, `_min` and
    `_count`. With `scale` sums are decimals; differences of double totals keep
    fewer digits than a frame summed by itself. `order` must tell rows of a
    series apart, `bucket` as in `chunked`.
    """
    if span < 1:
        raise ValueError("a frame holds at least one row")
    kept = df.columns
    size = min(rows_per_chunk, span)
    if bucket is None:
        spread = [order] if isinstance(order, str) else list(order)
        df = stored(df.repartitionByRange(*spread).withColumn("_even", F.spark_partition_id()), "dealt")
        bucket = "_even"
    names = ["_by"]  # one struct as key: null parts compare equal in it
    rows = numbered(df, order, bucket, "_row", by).select(
        *kept, (F.struct(*by) if by else F.lit(0)).alias("_by"), "_row", F.floor((F.col("_row") - 1) / size).alias("_chunk"), exact(value, scale).alias("_v")
    )
    upto = Window.partitionBy(*names, "_chunk").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    # Backwards, so that it grows row by row too: a frame up to the following end is gone through anew for every row.
    onward = Window.partitionBy(*names, "_chunk").orderBy(F.desc("_row")).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumns({
        "_sum": F.coalesce(F.sum("_v").over(upto), F.lit(0)), "_n": F.count("_v").over(upto),
        "_max": F.max(value).over(upto), "_min": F.min(value).over(upto),
        "_smax": F.max(value).over(onward), "_smin": F.min(value).over(onward),
    })
    inside = stored(inside, "running")
    # One row per chunk and series: what earlier chunks hold, and the extremes of the whole ones between.
    ends = inside.filter((F.col("_row") - 1) % size == 0).select(*names, "_chunk", F.col("_smax").alias("_cmax"), F.col("_smin").alias("_cmin"))
    totals = inside.groupBy(*names, "_chunk").agg(F.max_by(F.struct("_sum", "_n"), "_row").alias("_t"))
    chunks = totals.join(ends, [*names, "_chunk"])
    before = Window.partitionBy(*names).orderBy("_chunk")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    whole = span // size
    between = {}
    for label, count in (("a", whole - 1), ("b", whole)):
        for kind, pick in (("max", F.max), ("min", F.min)):
            frame = before.rowsBetween(-count, -1)
            between[f"_{label}{kind}"] = pick(f"_c{kind}").over(frame) if count > 0 else F.lit(None).cast(df.schema[value].dataType)
    chunks = chunks.select(
        *names, "_chunk", F.coalesce(F.sum("_t._sum").over(earlier), F.lit(0)).alias("_sum0"),
        F.coalesce(F.sum("_t._n").over(earlier), F.lit(0)).alias("_n0"), *[c.alias(n) for n, c in between.items()],
    )
    placed = inside.join(chunks, [*names, "_chunk"])
    counts = F.col("_v").isNotNull().cast("long")
    starts = placed.select(
        *names, (F.col("_row") + span - 1).alias("_row"), F.col("_chunk").alias("_first"), "_smax", "_smin",
        (F.col("_sum0") + F.col("_sum") - F.coalesce("_v", F.lit(0))).alias("_sum1"), (F.col("_n0") + F.col("_n") - counts).alias("_n1"),
    )
    joined = placed.drop("_smax", "_smin").join(starts, [*names, "_row"], "left")
    n = F.col("_n0") + F.col("_n") - F.coalesce("_n1", F.lit(0))
    total_ = (F.col("_sum0") + F.col("_sum") - F.coalesce("_sum1", F.lit(0))).cast("double")
    gap = F.col("_chunk") - F.coalesce("_first", F.lit(-1)) - 1  # whole chunks inside the frame
    extreme = lambda kind, pick: pick(f"_{kind}", f"_s{kind}", F.when(gap < whole, F.col(f"_a{kind}")).otherwise(F.col(f"_b{kind}")))
    return joined.select(
        *kept,
        F.when(n > 0, F.try_divide(total_, n.cast("double"))).alias(f"{prefix}_avg"),
        extreme("max", F.greatest).alias(f"{prefix}_max"), extreme("min", F.least).alias(f"{prefix}_min"),
        n.alias(f"{prefix}_count"),
    ).drop("_even")
