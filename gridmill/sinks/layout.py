"""Files that serve filters on a customer and filters on a time alike.

A sort by customer and time keeps a customer together and spreads every hour
over all row groups. Here the bits of a customer's hash and of the time within
the date are interleaved (Morton order), so a row group holds a share of the
customers for a share of the day. Extremes then rule row groups out by time, and
a bloom filter per row group by customer.
"""

from pyspark.sql import functions as F

BITS = 16


def spread(value):
    """The lowest 16 bits of a whole number, each followed by a free one."""
    out = value.cast("long").bitwiseAND(F.lit(0xFFFF))
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        out = out.bitwiseOR(F.shiftleft(out, shift)).bitwiseAND(F.lit(mask))
    return out


def morton(a, b):
    """Interleaved bits of two numbers below 65,536."""
    return F.shiftleft(spread(a), 1).bitwiseOR(spread(b))


def two_key_layout(readings, customer="customer_id", ts="full_timestamp"):
    """Readings with their `date`, by date and in Morton order of customer and time inside it.

    A date that holds a large share of the rows is split over tasks by range of
    the order, which keeps the files apart too. Null customers and times are a group of their own.
    """
    dated = readings.withColumn("date", F.to_date(ts))
    who = F.pmod(F.xxhash64(customer), F.lit(1 << BITS))
    second = F.unix_timestamp(F.col(ts).cast("timestamp")) - F.unix_timestamp(F.col("date").cast("timestamp"))
    when = F.coalesce(F.floor(second * F.lit(1 << BITS) / 86_400), F.lit(0))
    placed = dated.withColumn("_place", morton(who, when))
    return placed.repartitionByRange("date", "_place").sortWithinPartitions("date", "_place").drop("_place")


def write_two_keys(readings, path, customer="customer_id", ts="full_timestamp", mode="append", **options):
    """Write the layout with a bloom filter on the customer, partitioned by date."""
    laid = two_key_layout(readings, customer, ts)
    bloom = {f"parquet.bloom.filter.enabled#{customer}": "true", **options}
    laid.write.mode(mode).options(**bloom).partitionBy("date").parquet(path)
