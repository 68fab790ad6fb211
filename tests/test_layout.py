import datetime
import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from gridmill.sinks import layout
from tests.conftest import rows

SMALL = {"parquet.block.size": "16384", "parquet.page.size": "4096", "parquet.block.size.row.check.min": "100", "parquet.enable.dictionary": "false"}


def readings(spark, n=60_000):
    start = F.lit(datetime.datetime(2016, 1, 1)).cast("timestamp")
    return spark.range(n).select(
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(400)).cast("string")).alias("customer_id"),
        F.timestamp_seconds(F.unix_timestamp(start) + F.col("id") * 7919 % 86_400).cast("timestamp_ntz").alias("full_timestamp"),
        F.col("id").cast("double").alias("load_percentage"),
    )


def groups(path, customer, low, high):
    """(row groups, those that hold the customer, those whose times may meet the range)."""
    n = held = met = 0
    for name in glob.glob(f"{path}/date=*/*.parquet"):
        file = pq.ParquetFile(name)
        for i in range(file.num_row_groups):
            part = file.read_row_group(i, ["customer_id", "full_timestamp"])
            times = part["full_timestamp"].to_pylist()
            n, held, met = n + 1, held + (customer in part["customer_id"].to_pylist()), met + (min(times) < high and max(times) >= low)
    return n, held, met


def test_morton_interleaves(spark):
    made = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (3, 5), (65_535, 65_535)], "a int, b int")
    bits = lambda x: f"{x:016b}"
    for a, b, code in rows(made.select("a", "b", layout.morton(F.col("a"), F.col("b")).alias("m"))):
        assert code == int("".join(x + y for x, y in zip(bits(a), bits(b), strict=True)), 2)


def test_fewer_row_groups_for_both_filters(spark, tmp_path):
    frame = readings(spark)
    ours, sorted_ = str(tmp_path / "ours"), str(tmp_path / "sorted")
    layout.write_two_keys(frame.coalesce(1), ours, **SMALL)
    dated = frame.withColumn("date", F.to_date("full_timestamp"))
    dated.coalesce(1).sortWithinPartitions("date", "customer_id", "full_timestamp").write.options(**SMALL).partitionBy("date").parquet(sorted_)
    low, high = datetime.datetime(2016, 1, 1, 10), datetime.datetime(2016, 1, 1, 11)
    (n, held, met), (m, held_before, met_before) = groups(ours, "c7", low, high), groups(sorted_, "c7", low, high)
    assert n >= 16 and m >= 16 and held < n / 2 and met < n / 2
    assert met_before == m and held / n + met / n < held_before / m + met_before / m
    whole = spark.read.parquet(ours)
    assert whole.count() == 60_000 and rows(whole.filter("customer_id = 'c7'"), *frame.columns) == rows(frame.filter("customer_id = 'c7'"))


def test_null_keys_and_no_rows(spark, tmp_path):
    frame = spark.createDataFrame([(None, None, 1.0), ("a", None, 2.0), (None, datetime.datetime(2016, 1, 1), 3.0)],
                                  "customer_id string, full_timestamp timestamp_ntz, load_percentage double")
    assert layout.two_key_layout(frame).count() == 3 and layout.two_key_layout(frame.limit(0)).count() == 0
