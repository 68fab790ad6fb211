"""Session defaults and the shared working folder."""

import contextvars
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FOLDERS = {}
#: Folder of the innermost `stored_alone` that is at work in this thread.
_STEPS = contextvars.ContextVar("steps", default=None)


def build_session(app_name="gridmill", master=None, **conf):
    """A session with the settings results depend on; sizing is left to submit.

    UTC keeps calendar columns independent of the host. Adaptive execution
    sizes shuffles and splits skewed join partitions at run time.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256MB")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark):
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(_LOCAL_FOLDERS[app])
    return _LOCAL_FOLDERS[app]


def new_folder(spark, purpose, below=None):
    """A fresh path (not created yet) below the shared folder, or below another one."""
    return f"{below or shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def table(spark, folder, name):
    """One Parquet table of a data folder."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def stored(df, purpose):
    """The frame written once below the shared folder and read back.

    Used where one result feeds several branches that must see the same rows:
    the lineage ends at files that survive lost executors.
    """
    path = new_folder(df.sparkSession, purpose, _STEPS.get())
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_alone(spark, make, purpose):
    """The frame that `make()` returns as `stored`, without the frames stored on the way.

    What `make` stores is deleted once its result is written, so it must hand
    out no other frame that reads them.
    """
    steps = new_folder(spark, f"{purpose}-steps", _STEPS.get())
    try:
        outside = _STEPS.set(steps)
        try:
            made = make()
        finally:
            _STEPS.reset(outside)
        return stored(made, purpose)
    finally:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(steps)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
