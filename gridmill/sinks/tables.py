"""Table sinks. No sink counts its input first: that would run the plan twice."""

from pyspark.sql import functions as F


def append_table(df, name, mode="append"):
    df.write.mode(mode).saveAsTable(name)


def append_files(df, path, mode="append", partition_by=()):
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def append_run(df, path, run):
    """Append under the name of a run: a run that is repeated replaces its own rows only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/run={run}")


def create_readings_table(spark, name, location=None):
    """Readings table laid out by date.

    Date partitions and the sort of `write_readings` take the place of
    secondary indexes on time and customer.
    """
    where = f"LOCATION '{location}'" if location else ""
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} (
            customer_id STRING, profile_type STRING, day_num INT, hour INT, minute INT,
            interval_idx INT, load_percentage FLOAT, full_timestamp TIMESTAMP,
            created_at TIMESTAMP, date DATE
        ) USING parquet PARTITIONED BY (date) {where}
    """)


def readings_layout(readings):
    """Readings arranged for the table: by date, then customer and time.

    Rebalancing groups the rows of a date into files of the advisory size: a
    date that holds a large share of all rows is split over many tasks, small
    dates share one.
    """
    dated = readings.withColumn("created_at", F.current_timestamp()).withColumn(
        "date", F.to_date("full_timestamp")
    )
    return dated.hint("rebalance", F.col("date")).sortWithinPartitions(
        "date", "customer_id", "full_timestamp"
    )


def write_readings(readings, name, mode="append"):
    columns = readings.sparkSession.table(name).columns
    readings_layout(readings).select(*columns).write.mode(mode).insertInto(name)


def replace_partitions(df, path, partition_by):
    """Replace only the partitions present in the input."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def typed_result(df, types):
    """Columns of a result table with their declared types; null where unfit."""
    return df.select(*[F.col(name).try_cast(kind).alias(name) for name, kind in types.items()])


def jdbc_options(url, table, batch_size=10000, **properties):
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **properties}


def write_jdbc(df, url, table, mode="append", **options):
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode(mode).save()
