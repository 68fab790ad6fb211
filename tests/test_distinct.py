import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridmill.operators import distinct
from tests.conftest import rows


def days(spark, *found):
    return spark.createDataFrame(list(found), "day int, customer_id string")


def test_dictionary_keeps_and_extends(spark):
    first = distinct.extend_dictionary(days(spark, (1, "b"), (1, "a"), (1, "b"), (2, None)))
    assert sorted(r["number"] for r in first.collect()) == [0, 1]
    again = distinct.extend_dictionary(days(spark, (3, "c"), (3, "a"), (3, "d")), first)
    old, new = dict(rows(first)), dict(rows(again))
    assert {k: new[k] for k in old} == old and sorted(new.values()) == [0, 1, 2, 3]
    assert distinct.extend_dictionary(days(spark), first).count() == 2
    assert distinct.extend_dictionary(days(spark)).count() == 0


def test_dense_numbers_over_partitions(spark):
    many = spark.range(100_000).select(F.col("id").cast("string").alias("customer_id")).repartition(7)
    numbers = distinct.extend_dictionary(many).agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()
    assert tuple(numbers) == (0, 99_999, 100_000)


def test_months_from_daily_bitmaps(spark):
    rows_ = spark.range(200_000).select(
        (F.col("id") % 60).cast("int").alias("day"), ((F.col("id") * 7919) % 70_001).cast("string").alias("customer_id")
    )
    dictionary = distinct.extend_dictionary(rows_).cache()
    daily = distinct.bitmaps(rows_, dictionary, ["day"]).withColumn("month", F.floor(F.col("day") / 30))
    assert daily.count() == 60 * 3
    exact = rows_.groupBy(F.floor(F.col("day") / 30).alias("month")).agg(F.count_distinct("customer_id"))
    assert rows(distinct.bitmap_counts(daily, ["month"])) == rows(exact)
    assert rows(distinct.bitmap_counts(distinct.merged_bitmaps(daily, ["month"]), ["month"])) == rows(exact)
    sketched = distinct.sketches(rows_, ["day"]).withColumn("month", F.floor(F.col("day") / 30))
    for (_, n), (_, estimate) in zip(rows(exact), rows(distinct.sketch_counts(sketched, ["month"])), strict=True):
        assert abs(estimate - n) <= distinct.sketch_error() * n


def test_null_and_unknown_values(spark):
    found = days(spark, (1, None), (1, "a"), (2, None))
    dictionary = distinct.extend_dictionary(days(spark, (1, "a")))
    assert rows(distinct.bitmap_counts(distinct.bitmaps(found, dictionary, ["day"]), ["day"])) == [(1, 1)]
    with pytest.raises(PySparkException, match="not in the dictionary: b"):
        distinct.bitmaps(days(spark, (1, "b")), dictionary, ["day"]).collect()
