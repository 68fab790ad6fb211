"""Wide day files: cell rules, file rules, discovery."""

import datetime

import pytest
from pyspark.sql import functions as F

from gridmill import fixed
from gridmill.functions import text as X
from gridmill.plans import jobs
from gridmill.sources import dayfiles
from tests.conftest import rows

HEADER = fixed.HEADER_LINE
META = "P,a,b,c,d,e,f,g,h,i"


def unpivot(spark, *lines, day=1, **options):
    frame = spark.createDataFrame([(line, day) for line in lines], "line string, day_num int")
    return dayfiles.unpivot_lines(frame, **options)


@pytest.mark.parametrize("line, expected", [
    (f"res_1,{META},1.5,,2.5,NONE,3,zz, ,4", [(0, 1.5), (1, 2.5), (3, 3.0), (5, 4.0)]),
    (f" res_2,{META},null,7", [(1, 7.0)]),
    ("res_3,P,a,b", []),
    (f"res_4,{META},", []),
    (f"res_5,{META}", []),
    (f"res_6,{META},, ,\t,5\r", [(0, 5.0)]),
    (f"res_7,{META},1_0,1f,0x1p3,nan,inf,-2e1,+.5,5.", [(0, 10.0), (5, -20.0), (6, 0.5), (7, 5.0)]),
    (f"res_8,{META},1 2, 3 ,none,4", [(1, 3.0), (3, 4.0)]),
    (f"load_9,{META},1", []),
])
def test_cells(spark, line, expected):
    assert rows(unpivot(spark, line), "interval_idx", "load_percentage") == expected


def test_identity_columns(spark):
    out = unpivot(spark, f" res_2,,{META[2:]},7", f"res_1,  ,{META[2:]},7", f"res_0, P,{META[2:]},7")
    assert rows(out, "customer_id", "profile_type") == [
        (" res_2", None), ("res_0", " P"), ("res_1", None),
    ]


def test_clock_and_overflow_past_the_day(spark):
    line = "res_1," + META + "," + ",".join(str(i) for i in range(97))
    out = {r["interval_idx"]: r for r in unpivot(spark, line, day=60).collect()}
    assert len(out) == 97
    assert (out[5]["hour"], out[5]["minute"]) == (1, 15)
    assert out[5]["full_timestamp"] == datetime.datetime(2016, 2, 29, 1, 15)
    assert (out[96]["hour"], out[96]["minute"]) == (24, 0)
    assert out[96]["full_timestamp"] == datetime.datetime(2016, 3, 1)


def test_missing_cells_can_stay(spark):
    out = unpivot(spark, f"res_1,{META},None,2,nan", keep_missing=True)
    assert rows(out, "interval_idx", "load_percentage") == [(0, None), (1, 2.0), (2, None)]
    out = unpivot(spark, f"res_1,{META},None,inf", allow_nan=True)
    assert rows(out, "interval_idx", "load_percentage") == [(1, float("inf"))]


def test_number_count_agrees_with_unpivot(spark):
    line = f"res_1,{META},1,2,3,x,4,NONE,,5_0,6"
    frame = spark.createDataFrame([(line,)], "line string").select(
        X.count_numbers(X.compact(X.head_and_values("line")[11])).alias("n")
    )
    assert frame.first()["n"] == unpivot(spark, line).count() == 6


@pytest.mark.parametrize("path, day", [
    ("/x/cyme_load_timeseries_day_123.txt", 123), ("day_7.csv.gz", 7), ("/a_9/nothing.txt", 1),
    ("load_x.txt", 1), ("42", 42), ("", 1),
])
def test_day_from_name(spark, path, day):
    frame = spark.createDataFrame([(path,)], "path string").select(X.day_from_name("path"))
    assert frame.first()[0] == day


@pytest.fixture
def folder(tmp_path):
    line = f"res_1,{META},1,2"
    files = {
        1: [HEADER, line],
        2: [HEADER, line, f"res_2,{META},3", "res_3,too,short"],
        3: ["no header", line],
        4: ["x"] * 9 + [HEADER, line],
        5: ["x"] * 10 + [HEADER, line],
        6: [HEADER, "nothing here"],
        7: [HEADER],
        8: [HEADER, f"res_1,{META},NONE"],
        9: ["  " + HEADER, line],
    }
    for day, lines in files.items():
        (tmp_path / fixed.DAY_FILE_PATTERN.format(day)).write_text("\n".join(lines) + "\n")
    (tmp_path / "cyme_load_timeseries_day_extra.txt").write_text("\n".join([HEADER, line]))
    (tmp_path / "other.txt").write_text("\n".join([HEADER, line]))
    return str(tmp_path)


def test_file_report(spark, folder):
    report = dayfiles.file_report(dayfiles.read_lines(spark, folder))
    got = {
        r["file_name"].removesuffix(".txt").split("_")[-1]:
            (r["lines"], r["row_lines"], r["readings"], r["header_ok"], r["valid"], r["loaded"])
        for r in report.collect()
    }
    assert got == {
        "1": (2, 1, 2, True, True, True),
        "2": (4, 3, 3, True, True, True),
        "3": (2, 1, 2, False, False, False),
        "4": (11, 1, 2, True, True, True),
        "5": (12, 1, 2, False, False, False),
        "6": (2, 0, 0, True, False, False),
        "7": (1, 0, 0, True, False, False),
        "8": (2, 1, 0, True, True, False),
        "9": (2, 1, 2, True, True, True),
        "extra": (2, 1, 2, True, True, True),
    }
    totals = dayfiles.report_totals(report).first()
    assert tuple(totals) == (10, 5, 11)


def test_read_day_files_leaves_bad_files_out(spark, folder):
    out = dayfiles.read_day_files(spark, folder)
    assert rows(out.groupBy("day_num").count()) == [(1, 4), (2, 3), (4, 2), (9, 2)]
    assert rows(dayfiles.read_day_files(spark, folder, days=[2, 3, 77]), "day_num", "customer_id") == [
        (2, "res_1"), (2, "res_1"), (2, "res_2"),
    ]
    every = dayfiles.read_day_files(spark, folder, days=[3, 5], header="id")
    assert rows(every.groupBy("day_num").count()) == [(5, 2)]
    assert dayfiles.read_day_files(spark, folder, days=[3], header=None).count() == 2


def test_files_of_many_blocks_keep_head_rule(spark, tmp_path):
    """A split file is checked by its first block only."""
    lines = [HEADER] + [f"res_{i},{META},{i}" for i in range(5000)]
    (tmp_path / fixed.DAY_FILE_PATTERN.format(1)).write_text("\n".join(lines))
    late = ["x"] * 4000 + [HEADER] + lines[1:]
    (tmp_path / fixed.DAY_FILE_PATTERN.format(2)).write_text("\n".join(late))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16KB")
    try:
        lines_df = dayfiles.read_lines(spark, str(tmp_path))
        assert lines_df.select("block_start").distinct().count() > 5
        report = {r["file_name"][-5]: r["valid"] for r in dayfiles.file_report(lines_df).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert report == {"1": True, "2": False}


def test_discovery(spark, folder):
    found = dayfiles.discover_day_files(spark, folder, days=[1, 2, 11])
    assert set(rows(found, "day_num", "present")) == {(1, True), (2, True), (11, False)}
    assert dayfiles.discover_day_files(spark, folder).count() == 96


def test_ingest_job(spark, folder):
    spark.sql("DROP TABLE IF EXISTS ingested")
    totals = jobs.ingest_day_files(spark, folder, "ingested").first()
    table = spark.table("ingested")
    assert totals["readings"] == table.count() == 11
    assert table.filter(F.col("created_at").isNull() | F.col("date").isNull()).count() == 0
    assert rows(table.select("date").distinct()) == [
        (datetime.date(2016, 1, d),) for d in (1, 2, 4, 9)
    ]
    spark.sql("DROP TABLE ingested")


TOKENS = ["1", "2.5", " 3 ", "", " ", "NONE", "null", "x", "-4e1", "1_0", "5.", ".5", "1f", "\t7", "1 2", "NaN"]


def by_the_rules(line):
    """The cell rules in plain words, one line at a time."""
    parts = line.split(",")
    if not line.strip().startswith("res_") or len(parts) < 12:
        return []
    kept = [cell.strip() for cell in parts[11:] if cell.strip()]
    found = []
    for place, cell in enumerate(kept):
        if cell.lower() not in ("none", "null", "nan"):
            try:
                found.append((parts[0], place, float(cell)))
            except ValueError:
                pass
    return found


def test_random_lines_follow_the_rules(spark):
    import random

    random.seed(11)
    lines = [
        ",".join([random.choice(["res_a", " res_b", "b"]), *META.split(",")[: random.choice([10, 10, 10, 4])],
                  *random.choices(TOKENS, k=random.randint(0, 100))])
        for _ in range(400)
    ]
    got = rows(unpivot(spark, *lines).withColumn("v", F.col("load_percentage").cast("double")),
               "customer_id", "interval_idx", "v")
    assert got == sorted((r for line in lines for r in by_the_rules(line)), key=repr)


def test_scan_needs_no_shuffle_and_no_unused_columns(spark, folder):
    plan = dayfiles.read_day_files(spark, folder, header=None)._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString() and "monotonically" not in plan.toString()
    checked = dayfiles.read_day_files(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in checked
