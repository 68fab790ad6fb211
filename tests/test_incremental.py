import shutil

from pyspark.sql import functions as F

from gridmill.operators import incremental, rollup
from gridmill.sinks import manifest
from tests.conftest import rows


def readings(spark, at, *found):
    return spark.createDataFrame(
        [(c, at(t), v) for c, t, v in found], "customer_id string, full_timestamp timestamp_ntz, load_percentage double"
    )


def full(spark, *batches):
    whole = batches[0]
    for b in batches[1:]:
        whole = whole.unionByName(b)
    return rows(rollup.daily_energy(rollup.system_rollup(whole, scale=2), scale=2))


def test_late_and_replaced_batches(spark, at, tmp_path):
    path = str(tmp_path / "energy")
    first = readings(spark, at, ("a", "2024-01-01 01:00", 1.5), ("b", "2024-01-01 01:00", None), ("a", "2024-01-02 03:00", 4.0))
    second = readings(spark, at, ("c", "2024-01-01 01:00", 7.25), ("c", "2024-01-03 00:00", 1.0), ("d", "2024-01-03 00:00", 2.0))
    wrong = readings(spark, at, ("z", "2024-01-09 01:00", 1.0), ("z", "2024-01-02 03:00", 1.0))
    days = lambda found: [str(d) for d in found]
    incremental.add_batch(first, path, "1", scale=2)
    assert days(incremental.refresh(spark, path, scale=2)) == ["2024-01-01", "2024-01-02"]
    assert incremental.refresh(spark, path, scale=2) == []
    incremental.add_batch(wrong, path, "2", scale=2)
    assert days(incremental.refresh(spark, path, scale=2)) == ["2024-01-02", "2024-01-09"]
    assert rows(incremental.daily(spark, path)) == full(spark, first, wrong)
    incremental.add_batch(second, path, "2", scale=2)
    # Dates of the batch before and after it are computed again; the 9th has no readings any more.
    assert days(incremental.refresh(spark, path, scale=2)) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-09"]
    assert rows(incremental.daily(spark, path)) == full(spark, first, second)
    assert rows(incremental.daily(spark, path, 2)) == full(spark, first, wrong)


def test_untouched_dates_are_not_read(spark, at, tmp_path):
    path = str(tmp_path / "energy")
    first = readings(spark, at, *[("a", f"2024-01-{d:02d} 01:00", float(d)) for d in range(1, 10)])
    late = readings(spark, at, ("b", "2024-01-04 01:00", 3.0))
    incremental.add_batch(first, path, "1", scale=2)
    incremental.refresh(spark, path, scale=2)
    incremental.add_batch(late, path, "2", scale=2)
    frame = incremental.partials_of(spark, path, incremental.touched_dates(spark, path, 1, 2))
    read = [r[0] for r in frame.select(F.input_file_name()).distinct().collect()]
    assert len(read) == 2 and all("day=2024-01-04" in f for f in read)
    part = next(p for p in manifest.live(spark, f"{path}/partials")[1] if p["key"] == "1")
    for d in (1, 9):  # files of other dates may be gone for good
        shutil.rmtree(f"{manifest.part_path(f'{path}/partials', part['part'])}/day=2024-01-{d:02d}")
    assert [str(d) for d in incremental.refresh(spark, path, scale=2)] == ["2024-01-04"]
    assert rows(incremental.daily(spark, path)) == full(spark, first, late)


def test_a_stop_between_partials_and_daily(spark, at, tmp_path, monkeypatch):
    path = str(tmp_path / "energy")
    first, second = (readings(spark, at, (c, f"2024-01-0{d} 01:00", 2.0)) for c, d in (("a", 1), ("b", 2)))
    incremental.add_batch(first, path, "1", scale=2)
    incremental.refresh(spark, path, scale=2)
    incremental.add_batch(second, path, "2", scale=2)  # the job ends here and runs again
    assert rows(incremental.daily(spark, path)) == full(spark, first)
    incremental.add_batch(second, path, "2", scale=2)
    incremental.refresh(spark, path, scale=2)
    assert rows(incremental.daily(spark, path)) == full(spark, first, second)


def test_a_batch_may_become_empty(spark, at, tmp_path):
    path = str(tmp_path / "energy")
    only = readings(spark, at, ("a", "2024-01-01 01:00", 2.0))
    incremental.add_batch(only, path, "1", scale=2)
    incremental.refresh(spark, path, scale=2)
    incremental.add_batch(only.filter("false"), path, "1", scale=2)
    assert len(incremental.refresh(spark, path, scale=2)) == 1
    assert incremental.daily(spark, path).count() == 0
