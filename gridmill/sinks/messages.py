"""Message sink: rows as JSON documents under a text key."""

from pyspark.sql import functions as F


def message_rows(df, key):
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value")
    )


def write_topic(df, key, servers, topic):
    (
        message_rows(df, key)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
