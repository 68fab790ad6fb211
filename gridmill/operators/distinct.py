"""Distinct counts that can be merged over days: exact bitmaps and sketches.

Distinct counts of days do not add up to those of a month. What is kept per day
can be merged instead: bitmaps over a dictionary of the values, which stay
exact, or HyperLogLog sketches of fixed size.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill.session import stored

SKETCH_BITS = 12  # 4,096 registers


def sketch_error(lg_k=SKETCH_BITS):
    """Relative error that an estimate keeps in all but a few of a thousand cases (three deviations)."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def extend_dictionary(values, known=None, column="customer_id"):
    """(column, number) of all values, null left out: those of `known` keep their number, others follow.

    Numbers run on without gaps, so bitmaps stay dense. New values are dealt by
    range and numbered inside their partition; only one row per partition is
    summed up to know where each begins.
    """
    new = values.select(column).filter(F.col(column).isNotNull()).distinct()
    first = 0
    if known is not None:
        known = known.select(column, "number")
        new = new.join(known, column, "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    dealt = stored(new.repartitionByRange(column).withColumn("_deal", F.spark_partition_id()), "new-values")
    before = Window.orderBy("_deal").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_deal").agg(F.count(F.lit(1)).alias("_n")).select(
        "_deal", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + first).alias("_start")
    )
    inside = Window.partitionBy("_deal").orderBy(column)
    numbered = dealt.withColumn("_in", F.row_number().over(inside) - 1).join(starts, "_deal").select(
        column, (F.col("_start") + F.col("_in")).cast("long").alias("number")
    )
    return numbered if known is None else known.unionByName(numbered)


def bitmaps(rows, dictionary, by, column="customer_id"):
    """One row per group and bucket of 32,768 numbers: a bitmap of the values there.

    Values meet the dictionary after they are distinct per group, so a frequent
    value is no hot key. Values that the dictionary lacks are an error of the
    caller and would be lost, so they raise.
    """
    pairs = rows.filter(F.col(column).isNotNull()).select(*by, column).distinct()
    number = F.coalesce("number", F.raise_error(F.concat(F.lit("not in the dictionary: "), F.col(column).cast("string"))).cast("long"))
    placed = pairs.join(dictionary.select(column, "number"), column, "left").withColumn("_place", number + 1)
    return placed.groupBy(*by, F.bitmap_bucket_number("_place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("bits")
    )


def merged_bitmaps(bits, by):
    """Bitmaps of coarser groups."""
    return bits.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bits, by, name="customer_count"):
    """Exact distinct values per group of the bitmaps below it."""
    return merged_bitmaps(bits, by).groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def sketches(rows, by, column="customer_id", lg_k=SKETCH_BITS):
    """One HyperLogLog sketch per group; nulls are left out."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))


def sketch_counts(sketched, by, name="customer_estimate"):
    """Estimated distinct values per group of the sketches below it."""
    return sketched.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
