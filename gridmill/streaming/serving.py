"""Serving view over the batch layer and the speed layer."""

from pyspark.sql import functions as F

from gridmill.operators.reports import newest_per_key


def serving_view(batch, speed, keys, columns, version="version"):
    """One row per key from both layers; the newer version wins.

    Frames without a version column get one: the speed layer is newer.
    """
    layers = []
    for rank, frame in enumerate((batch, speed)):
        if version not in frame.columns:
            frame = frame.withColumn(version, F.lit(rank))
        layers.append(frame)
    return newest_per_key(layers, keys, version, columns)
