"""Re-runnable ingest of day files: a ledger of what is in the table.

`<path>/readings` holds one part per run with the file of every reading,
`<path>/ledger` the files each run has read with their size and time. A reading
counts if the newest ledger entry of its file names its run. So a folder can be
ingested again and again: files that are known are skipped, a changed file takes
the place of its earlier readings, and a run that stopped before its ledger
entry has no readings that count.
"""

import uuid

from pyspark.sql import functions as F

from gridmill import fixed
from gridmill.session import stored
from gridmill.sinks import manifest
from gridmill.sources import dayfiles

ENTRIES = "file string, size long, modified timestamp, loaded boolean, readings long, run string, run_number long"


def listing(spark, folder, days=None, pattern=fixed.DAY_FILE_PATTERN):
    """file, size and modified of the files there are; no file is opened."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", dayfiles.day_glob(pattern, days)).load(folder)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
    )


def entries(spark, path):
    """The newest ledger entry of every file."""
    rows = manifest.read(spark, f"{path}/ledger", schema=ENTRIES)
    newest = F.max_by(F.struct("size", "modified", "loaded", "readings", "run", "run_number"), "run_number")
    return rows.groupBy("file").agg(newest.alias("e")).select("file", "e.*")


def pending(files, known):
    """Files that the ledger does not have, or has with another size or time."""
    return files.join(known.select("file", "size", "modified"), ["file", "size", "modified"], "left_anti")


def ingest(spark, folder, path, days=None, pattern=fixed.DAY_FILE_PATTERN, run=None, header="head"):
    """Readings of new and changed day files into the table at `path`; returns the run's ledger entries.

    Only pending files are opened. Bad files leave an entry without readings, so
    they are read again when they change and not before. A run that is repeated
    under its name replaces what it wrote.
    """
    run = run or uuid.uuid4().hex
    done = [p for p in manifest.live(spark, f"{path}/ledger")[1] if p["key"] == run]
    known = entries(spark, path).filter(F.col("run") != run) if done else entries(spark, path)
    files = stored(pending(listing(spark, folder, days, pattern), known), "pending-files")
    # The names of new files: their listing is on the driver already.
    names = [r["file"] for r in files.select("file").collect()]
    if not names:
        return spark.createDataFrame([], ENTRIES)
    report = stored(dayfiles.file_report(dayfiles.read_lines(spark, names, days, pattern)), "file-report")
    readings = dayfiles.read_day_files(
        spark, names, days, pattern, header=header, report=report, keep=("file",)
    ).withColumn("run", F.lit(run))
    manifest.append(readings, f"{path}/readings", run, replace=True)
    number = 1 + max((p["upto"] for p in manifest.live(spark, f"{path}/ledger")[1]), default=0)
    made = files.join(report.select("file", "loaded", "readings"), "file", "left").select(
        "file", "size", "modified", F.coalesce("loaded", F.lit(False)).alias("loaded"),
        F.coalesce(F.when(F.col("loaded"), F.col("readings")), F.lit(0)).alias("readings"),
        F.lit(run).alias("run"), F.lit(number).cast("long").alias("run_number"),
    )
    manifest.append(made.coalesce(1), f"{path}/ledger", run, replace=True, upto=number)
    return entries(spark, path).filter(F.col("run") == run)


def readings(spark, path, schema=None):
    """The readings that count, with their file and run."""
    rows = manifest.read(spark, f"{path}/readings", schema=schema)
    return rows.join(entries(spark, path).select("file", "run"), ["file", "run"], "left_semi")


def drop_superseded(spark, path):
    """Take runs out of the table of which no reading counts any more; returns their names.

    Run it while no ingest is under way: one that has not entered its files yet looks superseded.
    """
    named = {r["run"] for r in entries(spark, path).select("run").distinct().collect()}
    gone = []

    def change(parts):
        gone[:] = [p["key"] for p in parts if p["key"] not in named]
        return [manifest.removed(p) for p in parts if p["key"] in gone]

    manifest.commit(spark, f"{path}/readings", change)
    return sorted(gone)
