"""Wide day files: one text line per customer-day, one cell per quarter hour.

Lines stay in Spark from the scan to the readings: one multi-path text scan,
expressions for the parse, one aggregation per file for the header rules.
"""

from pyspark.sql import functions as F

from gridmill import fixed
from gridmill.functions import calendar as C
from gridmill.functions import text as X


def day_glob(pattern=fixed.DAY_FILE_PATTERN, days=None):
    """Glob for all day files of a pattern, or for the given day numbers."""
    return pattern.format("*" if days is None else "{" + ",".join(str(d) for d in days) + "}")


def read_lines(spark, folder, days=None, pattern=fixed.DAY_FILE_PATTERN):
    """Lines with their file and their position in scan order.

    `scan_id` grows by one per line inside a file block. It is taken before
    any filter, so differences within a block are line distances.
    """
    return (
        spark.read.option("pathGlobFilter", day_glob(pattern, days))
        .text(folder)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("scan_id"),
        )
    )


def unpivot_lines(lines, line="line", day="day_num", keep=(), keep_missing=False, allow_nan=False):
    """Readings of wide lines: a narrow transformation, no shuffle.

    `day` names the day-number column. With `keep_missing` the cells without a
    value stay as rows with a null load (the exploration view of a file).
    """
    wide = (
        lines.filter(X.starts_with_word(line, fixed.ROW_PREFIX))
        .withColumn("_parts", X.head_and_values(line))
        .select(
            F.col("_parts")[0].alias("customer_id"),
            X.blank_to_null(F.col("_parts")[1]).alias("profile_type"),
            F.col(day).cast("int").alias("day_num"),
            *keep,
            # A line without value cells has no such element and yields no row.
            F.posexplode(F.split(X.compact(F.get("_parts", F.lit(fixed.META_CELLS))), ","))
            .alias("interval_idx", "_cell"),
        )
    )
    known = X.is_number("_cell", allow_nan)
    wide = wide.filter((F.col("_cell") != "") if keep_missing else known)
    load = F.when(known, X.number("_cell")) if keep_missing else X.number("_cell")
    return wide.select(
        "customer_id",
        "profile_type",
        "day_num",
        C.interval_hour("interval_idx").alias("hour"),
        C.interval_minute("interval_idx").alias("minute"),
        "interval_idx",
        load.cast("float").alias("load_percentage"),
        C.interval_time(F.col("day_num"), "interval_idx").alias("full_timestamp"),
        *keep,
    )


def file_report(lines):
    """One row per file: line counts, header check, readings, verdict.

    The header line must come within the first lines of the file. Line numbers
    do not exist in a distributed scan, but a file's first block is read in
    order by one task, so the distance of two scan ids inside it is a line
    distance; one hash aggregation per file yields every rule at once.
    """
    stripped = X.stripped("line")
    is_header = F.startswith(stripped, F.lit(fixed.HEADER_PREFIX))
    is_row = F.startswith(stripped, F.lit(fixed.ROW_PREFIX))
    values = F.get(X.head_and_values("line"), F.lit(fixed.META_CELLS))
    readings = F.when(is_row, F.coalesce(X.count_numbers(X.compact(values)), F.lit(0))).otherwise(0)
    in_head = F.col("block_start") == 0
    per_file = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(is_row).alias("row_lines"),
        F.sum(readings).alias("readings"),
        F.min(F.when(in_head, F.col("scan_id"))).alias("_first"),
        F.min(F.when(in_head & is_header, F.col("scan_id"))).alias("_header"),
        F.max(F.startswith("line", F.lit(fixed.HEADER_PREFIX)) & F.contains("line", F.lit("ID")))
        .alias("header_with_id"),
    )
    early = F.col("_header") - F.col("_first") < fixed.HEADER_WITHIN_LINES
    return (
        per_file.withColumn("header_ok", F.coalesce(early, F.lit(False)))
        .withColumn("valid", (F.col("lines") >= 2) & F.col("header_ok") & (F.col("row_lines") > 0))
        .withColumn("loaded", F.col("valid") & (F.col("readings") > 0))
        .withColumn("file_name", X.file_name("file"))
        .drop("_first", "_header")
    )


def report_totals(report):
    """Files read, files loaded and readings of a file report."""
    return report.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if("loaded").alias("loaded_files"),
        F.coalesce(F.sum(F.when(F.col("loaded"), F.col("readings"))), F.lit(0)).alias("readings"),
    )


def read_day_files(spark, folder, days=None, pattern=fixed.DAY_FILE_PATTERN, header="head",
                   report=None, **options):
    """Readings of all valid day files of a folder.

    `header="head"` wants the header line near the top of the file,
    `header="id"` a header line naming the ID field anywhere, `None` skips the
    check and its pass over the text. Bad files are left out as a whole. A file
    report that is stored already saves that pass too.
    """
    lines = read_lines(spark, folder, days, pattern)
    if header is not None:
        rule = {"head": "valid", "id": "header_with_id"}[header]
        report = file_report(lines) if report is None else report
        good = report.filter(F.col(rule)).select("file")
        # One row per file. The planner broadcasts the list if its size allows,
        # which spares shuffling the text.
        lines = lines.join(good, "file", "left_semi")
    return unpivot_lines(
        lines.withColumn("day_num", X.day_from_name("file")), **options
    )


def discover_day_files(spark, folder, days=None, pattern=fixed.DAY_FILE_PATTERN):
    """Expected day files with a flag telling which exist.

    The listing is a scan that reads paths only, never file contents.
    """
    days = C.sample_day_numbers() if days is None else list(days)
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", day_glob(pattern))
        .load(folder)
        .select("path", X.file_name("path").alias("file_name"))
    )
    prefix, suffix = pattern.split("{}")
    expected = spark.createDataFrame([(d,) for d in days], "day_num int").select(
        "day_num", F.concat(F.lit(prefix), F.col("day_num"), F.lit(suffix)).alias("file_name")
    )
    return expected.join(found, "file_name", "left").withColumn("present", F.col("path").isNotNull())


def missing_dates(dates, date="date"):
    """Dates between the first and the last one that have no row.

    The expected side is one row per calendar date between the extremes.
    """
    span = dates.agg(F.min(date).alias("first"), F.max(date).alias("last"))
    expected = span.select(F.explode(F.sequence("first", "last")).alias(date))
    return expected.join(dates.select(date).distinct(), date, "left_anti")
