import os

import pytest

from gridmill import fixed
from gridmill.plans import jobs
from gridmill.sinks import manifest
from gridmill.sources import ledger
from tests.conftest import rows

META = "P,a,b,c,d,e,f,g,h,i"


def put(folder, day, *loads, header=True):
    lines = [fixed.HEADER_LINE] if header else []
    lines += [f"res_{i},{META},{load}" for i, load in enumerate(loads)]
    (folder / fixed.DAY_FILE_PATTERN.format(day)).write_text("\n".join(lines) + "\n")


def found(spark, path):
    return rows(ledger.readings(spark, path), "day_num", "customer_id", "load_percentage")


@pytest.fixture
def folder(tmp_path):
    made = tmp_path / "days"
    made.mkdir()
    put(made, 1, 1.0, 2.0)
    put(made, 5, 5.0)
    put(made, 9, 9.0, header=False)
    return made


def test_a_folder_can_be_ingested_again(spark, folder, tmp_path):
    path = str(tmp_path / "table")
    first = jobs.ingest_new_day_files(spark, str(folder), path).first()
    assert (first["files"], first["loaded_files"], first["readings"]) == (3, 2, 3)
    once = [(1, "res_0", 1.0), (1, "res_1", 2.0), (5, "res_0", 5.0)]
    assert found(spark, path) == once
    again = jobs.ingest_new_day_files(spark, str(folder), path).first()
    assert (again["files"], again["readings"]) == (0, 0) and found(spark, path) == once
    # A changed file takes the place of its readings, a new one comes in, a bad one is mended.
    put(folder, 1, 1.5)
    put(folder, 13, 13.0)
    put(folder, 9, 9.0)
    third = jobs.ingest_new_day_files(spark, str(folder), path).first()
    assert (third["files"], third["readings"]) == (3, 3)
    assert found(spark, path) == [(1, "res_0", 1.5), (13, "res_0", 13.0), (5, "res_0", 5.0), (9, "res_0", 9.0)]
    assert {r["readings"] for r in ledger.entries(spark, path).collect()} == {1}


def test_only_pending_files_are_opened(spark, folder, tmp_path):
    path = str(tmp_path / "table")
    ledger.ingest(spark, str(folder), path)
    known = folder / fixed.DAY_FILE_PATTERN.format(1)
    kept = os.stat(known)
    known.write_bytes(b"\xff" * kept.st_size)  # the same size and time: not read again
    os.utime(known, ns=(kept.st_atime_ns, kept.st_mtime_ns))
    put(folder, 21, 21.0)
    entries = ledger.ingest(spark, str(folder), path).collect()
    assert [r["readings"] for r in entries] == [1] and len(found(spark, path)) == 4


def test_a_stopped_run_does_not_count(spark, folder, tmp_path, monkeypatch):
    path, append = str(tmp_path / "table"), manifest.append

    def stop(df, where, *rest, **more):
        if where.endswith("/ledger"):
            raise RuntimeError("stopped")
        return append(df, where, *rest, **more)

    with monkeypatch.context() as broken:
        broken.setattr(manifest, "append", stop)
        with pytest.raises(RuntimeError):
            ledger.ingest(spark, str(folder), path, run="a")
    assert ledger.readings(spark, path).count() == 0
    ledger.ingest(spark, str(folder), path, run="b")
    assert len(found(spark, path)) == 3 and ledger.drop_superseded(spark, path) == ["a"]
    assert len(found(spark, path)) == 3
    # The same run again, and a retry under the name of the one that stopped.
    ledger.ingest(spark, str(folder), path, run="b")
    ledger.ingest(spark, str(folder), path, run="a")
    assert len(found(spark, path)) == 3


def test_superseded_runs_go(spark, folder, tmp_path):
    path = str(tmp_path / "table")
    ledger.ingest(spark, str(folder), path, run="a")
    for day, load in ((1, 2.5), (5, 3.5)):
        put(folder, day, load)
    put(folder, 9, 4.5, 5.5)
    ledger.ingest(spark, str(folder), path, run="b")
    assert ledger.drop_superseded(spark, path) == ["a"] and len(found(spark, path)) == 4
    assert ledger.drop_superseded(spark, path) == []


def test_days_and_empty_folder(spark, folder, tmp_path):
    path = str(tmp_path / "table")
    ledger.ingest(spark, str(folder), path, days=[5])
    assert found(spark, path) == [(5, "res_0", 5.0)]
    empty = tmp_path / "none"
    empty.mkdir()
    assert ledger.ingest(spark, str(empty), str(tmp_path / "other")).count() == 0
    assert ledger.entries(spark, str(tmp_path / "other")).count() == 0


def test_runs_of_appended_rows(spark, tmp_path):
    from gridmill.sinks import tables

    path = str(tmp_path / "scores")
    for run, n in (("a", 3), ("b", 2), ("a", 3)):
        tables.append_run(spark.range(n), path, run)
    assert spark.read.parquet(path).count() == 5
