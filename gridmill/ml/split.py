"""Train, validation and test splits."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill import fixed


def chronological(featured, order="date", test_days=fixed.TEST_DAYS,
                  validation_days=fixed.VALIDATION_DAYS):
    """Complete rows with `row_num` and `split`: oldest train, newest test.

    A series shorter than `test_days` + 30 tests on a quarter of its rows, ten
    at least. One row per date comes in, so the global numbering stays small.
    """
    clean = featured.dropna()
    rows = F.count(F.lit(1)).over(Window.partitionBy())
    short = F.greatest(F.lit(10), F.floor(F.col("_rows") / 4))
    test = F.when(F.col("_rows") < test_days + 30, short).otherwise(F.lit(test_days))
    train = F.col("_rows") - test - validation_days
    return (
        clean.withColumns({
            "row_num": F.row_number().over(Window.orderBy(order)), "_rows": rows,
        })
        .withColumn("_train", train)
        .withColumn(
            "split",
            F.when(F.col("row_num") <= F.col("_train"), "train")
            .when(F.col("row_num") <= F.col("_train") + validation_days, "val")
            .otherwise("test"),
        )
        .drop("_rows", "_train")
    )


def with_validation(split_rows, name="is_validation"):
    """Training and validation rows, the latter marked for early stopping."""
    return split_rows.filter(F.col("split").isin("train", "val")).withColumn(name, F.col("split") == "val")


def parts(split_rows, names=("train", "val", "test")):
    return {name: split_rows.filter(F.col("split") == name) for name in names}


def require_training_rows(split_rows):
    """Row counts per split; raises when no row is left to train on."""
    counted = split_rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    sizes = {row["split"]: row["n"] for row in counted.collect()}
    if not sizes.get("train"):
        raise ValueError(f"no training rows are left after the split: {sizes}")
    return sizes


def random_parts(df, weights=(0.8, 0.2), seed=fixed.SPLIT_SEED):
    """Spark's own random split; repeats only for the same partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def hashed(df, *keys, train_share=0.8, seed=fixed.SPLIT_SEED):
    """Split by a hash of the key: the same rows whatever the partitioning."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    place = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10000
    return df.withColumn(
        "split", F.when(place < int(train_share * 10000), "train").otherwise("test")
    )
