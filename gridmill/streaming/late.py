"""Readings sorted as they arrive: first copies, repeated copies and late ones, none lost.

Spark's own watermark drops late rows and `dropDuplicatesWithinWatermark` drops
copies without a trace. Here each micro-batch is compared with what was accepted
before it, and every reading ends in one of three tables with a commit log:

    <path>/accepted     the first copy of each key and time, and readings without a time
    <path>/duplicates   how many further copies came, per key and time
    <path>/late         readings older than the newest one of earlier batches less the allowed delay
    <path>/marks        the newest time of each batch

The state is the accepted table itself: only rows that a reading in time can
meet are read, a range on the time that prunes files. The work is a grouping
and one join per batch, without Python rows.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.sinks import manifest
from gridmill.streaming.jobs import start

BATCH = "ingest_batch"


def _before(spark, path, batch_id, schema):
    """Rows that batches before this one left, also where parts were merged since."""
    return manifest.read(spark, path, schema=schema).filter(F.col(BATCH) < batch_id)


def edge_of(spark, path, batch_id, ts_type, late_by):
    """The time before which readings of this batch are late; null for the first batch."""
    marks = _before(spark, f"{path}/marks", batch_id, f"newest {ts_type}, {BATCH} long")
    return marks.agg((F.max("newest") - F.expr(f"INTERVAL {late_by}")).cast(ts_type)).first()[0]


def sort_batch(batch, accepted, edge, keys=("customer_id",), ts="full_timestamp"):
    """(accepted, duplicates, late) of one batch.

    `accepted` holds earlier first copies. Of copies within the batch the least
    row by all columns is the first, whatever the partitioning. A key with very
    many copies combines map-side and is no hot group.
    """
    late = F.lit(False) if edge is None else F.coalesce(F.col(ts) < F.lit(edge), F.lit(False))
    key = [*keys, ts]
    timed = batch.filter(F.col(ts).isNotNull() & ~late)
    groups = timed.groupBy(F.struct(*key).alias("_key")).agg(
        F.min(F.struct(*batch.columns)).alias("_row"), F.count(F.lit(1)).alias("_n")
    )
    state = accepted if edge is None else accepted.filter(F.col(ts) >= F.lit(edge))
    known = state.filter(F.col(ts).isNotNull()).select(F.struct(*key).alias("_key"), F.lit(1).alias("_known"))
    met = groups.join(known, "_key", "left")
    new = F.col("_known").isNull()
    first = met.filter(new).select("_row.*").unionByName(batch.filter(F.col(ts).isNull()))
    copies = met.select("_key.*", (F.col("_n") - new.cast("long")).alias("copies")).filter("copies > 0")
    return first, copies, batch.filter(late)


def sorting_writer(path, late_by="1 hour", keys=("customer_id",), ts="full_timestamp"):
    """Micro-batch sink into the three tables.

    A batch that runs again after a failure finds the state as it was before
    it, and adds to the tables that lack it only.
    """

    def write(batch, batch_id):
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            schema = T.StructType([*batch.schema.fields, T.StructField(BATCH, T.LongType())])
            edge = edge_of(spark, path, batch_id, batch.schema[ts].dataType.simpleString(), late_by)
            accepted = _before(spark, f"{path}/accepted", batch_id, schema)
            first, copies, late = sort_batch(batch, accepted, edge, keys, ts)
            newest = batch.agg(F.max(ts).alias("newest")).filter("newest IS NOT NULL")
            for name, rows in (("duplicates", copies), ("late", late), ("accepted", first), ("marks", newest)):
                done = lambda parts: any(p["upto"] is not None and p["upto"] >= batch_id for p in parts)
                target = f"{path}/{name}"
                if not done(manifest.live(spark, target)[1]):
                    part = manifest.write_part(rows.withColumn(BATCH, F.lit(batch_id).cast("long")), target, batch_id, batch_id)
                    manifest.commit(spark, target, lambda parts: [] if done(parts) or not part["rows"] else [manifest.added(part)])
        finally:
            batch.unpersist()

    return write


def ingest_sorted(readings, path, checkpoint, late_by="1 hour", keys=("customer_id",), ts="full_timestamp", **options):
    """A stream of readings into the accepted, duplicates and late tables."""
    return start(readings, sorting_writer(path, late_by, keys, ts), checkpoint, **options)
