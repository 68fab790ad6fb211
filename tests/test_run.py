"""The command line, end to end on small files."""

import datetime

import pytest

from gridmill import fixed
from gridmill.plans import run


@pytest.fixture
def readings(spark, tmp_path):
    start = datetime.datetime(2016, 1, 1)
    lines = [
        f"c{c},{start + datetime.timedelta(days=d, hours=6 * h)},{20 + d % 7 + h + c}"
        for d in range(152) for h in range(4) for c in range(2)
    ]
    (tmp_path / "readings.csv").write_text("\n".join(lines))
    return str(tmp_path / "readings.csv")


def test_report(spark, readings):
    newest = run.main(["report", readings, "--csv"], spark)[0]
    assert newest["data_date"] == datetime.date(2016, 5, 31)
    assert (newest["record_count"], newest["last_hour"]) == (8, 18)


def test_season_and_score(spark, readings, tmp_path):
    registry = str(tmp_path / "registry")
    scores = run.main(["season", readings, registry, "spring", "2016", "--csv"], spark)
    assert scores["train_r2"] > 0.5
    assert run.main(["season", readings, registry, "summer", "2016", "--csv"], spark) is None
    rows = str(tmp_path / "rows")
    spark.createDataFrame(
        [(1, 3, 15, 2, 0.5, 0.1, 0)],
        "id int, month int, day int, day_of_week int, month_sin double, day_sin double, is_weekend int",
    ).write.parquet(rows)
    out = run.main(["score", rows, registry, fixed.SEASON_MODELS["spring"], str(tmp_path / "out"),
                    "--keep", "id", "--parquet"], spark)
    assert spark.read.parquet(out).columns == ["id", "predicted_price", "prediction_timestamp", "created_at"]


def test_ingest(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    line = "res_1,P,a,b,c,d,e,f,g,h,i,1,2"
    for day in (1, 5, 9):
        (folder / fixed.DAY_FILE_PATTERN.format(day)).write_text(f"FORMAT=ID\n{line}\n")
    spark.sql("DROP TABLE IF EXISTS run_readings")
    done = run.main(["ingest", str(folder), "run_readings", "--days", "1", "9"], spark)
    assert done == {"files": 2, "loaded_files": 2, "readings": 4}
    assert run.main(["report", "run_readings"], spark)[0]["record_count"] == 2
    spark.sql("DROP TABLE run_readings")


def test_stream_arguments():
    args = run.parser().parse_args(["stream", "s:1", "t", "c", "--topic", "x", "--per-trigger", "5", "--trigger", "1 minute"])
    assert (args.topic, args.starting, args.per_trigger, args.trigger) == ("x", "earliest", 5, "1 minute")
    assert run.parser().parse_args(["route", "s:1", "t", "c"]).per_trigger is None


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        run.parser().parse_args(["fanout", "s", "t", "c", "--topic", "x", "--pattern", "y"])
    with pytest.raises(SystemExit):
        run.parser().parse_args(["report", "x", "--csv", "--parquet"])
    with pytest.raises(SystemExit):
        run.parser().parse_args(["season", "x"])
