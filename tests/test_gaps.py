import datetime
import random

import pytest
from pyspark.sql import functions as F

from gridmill.functions.calendar import season_dates
from gridmill.operators import gaps
from tests.conftest import rows


def readings(spark, found):
    made = [(c, d and datetime.datetime.combine(d, datetime.time(h))) for c, d, h in found]
    return spark.createDataFrame(made, "customer_id string, full_timestamp timestamp_ntz")


def plain(found, year=2015):
    out = []
    for season in ("spring", "summer", "autumn"):
        first, last = (datetime.date.fromisoformat(d) for d in season_dates(season, year))
        every = [first + datetime.timedelta(i) for i in range((last - first).days + 1)]
        for customer in {c for c, *_ in found}:
            seen = {d for c, d, _ in found if c == customer and d}
            text = "".join("x" if d in seen else "." for d in every)
            if "x" in text:
                runs = [len(r) for r in text.split(".") if r]
                out.append((season, customer, text.count("x"), text.count("."), len(runs), max(runs), max(len(g) for g in text.split("x"))))
    return sorted(out, key=repr)


def test_runs_and_gaps_equal_plain_python(spark):
    pick, day = random.Random(3), datetime.date(2015, 1, 1)
    found = [(f"c{i % 6}", day + datetime.timedelta(pick.randrange(i % 6 * 60 + 1, 380)), pick.randrange(24)) for i in range(900)]
    found += [("hot", day + datetime.timedelta(i), h) for i in range(-5, 380) for h in (1, 2)] + [("none", None, 0), ("c1", None, 0)]
    assert rows(gaps.coverage_gaps(readings(spark, found), 2015)) == plain(found)
    runs = gaps.islands(gaps.day_presence(readings(spark, found), 2015))
    missing = gaps.gaps(runs).groupBy("season", "customer_id").agg(F.sum("gap_days").alias("n"), F.max("gap_days").alias("m"))
    assert rows(missing) == sorted(((r[0], r[1], r[3], r[6]) for r in plain(found) if r[3]), key=repr)


def test_gate_sees_holes(spark):
    first, last = (datetime.date.fromisoformat(d) for d in season_dates("spring", 2016))
    every = [("a", first + datetime.timedelta(i), 0) for i in range((last - first).days + 1)]
    gate = lambda found, **more: tuple(gaps.complete(readings(spark, found), 2016, "spring", **more).first())
    assert gate(every) == ("spring", 0, 0, True)
    assert gate(every[:40] + every[43:]) == ("spring", 3, 3, False)
    assert gate(every[:40] + every[43:], allowed_missing=5, allowed_gap=3)[3]
    assert not gate(every[:40] + every[43:], allowed_missing=5, allowed_gap=2)[3]
    assert gate([("a", None, 0)]) == ("spring", len(every), len(every), False)


@pytest.mark.parametrize("found", [[], [("a", datetime.date(1999, 3, 3), 0)]])
def test_no_readings_in_the_year(spark, found):
    assert gaps.coverage_gaps(readings(spark, found), 2015).count() == 0
