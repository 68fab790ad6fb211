"""Calendar conventions, feature sets and their first rows."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from gridmill import fixed
from gridmill.functions import calendar as C
from gridmill.functions import numbers as N
from gridmill.operators import features, gates, rollup
from tests.conftest import rows


def daily(spark, n, start=datetime.date(2024, 1, 1), skip=()):
    data = []
    for i in range(n):
        day = start + datetime.timedelta(days=i)
        if i not in skip:
            value = float(100 + i * i % 37)
            data.append((str(day), day, value, value / 2 if i != 4 else 0.0, value, 1.0, 5, 5.0))
    return spark.createDataFrame(
        data, "date_str string, day date, total_daily_energy double, avg_daily_load double,"
        "peak_daily_load double, min_daily_load double, total_daily_customers long,"
        "avg_daily_customers double",
    )


def forecast_daily(spark, n):
    day = F.col("day").cast("timestamp")
    return daily(spark, n).withColumnRenamed("date_str", "date").select(
        "date", "total_daily_energy", "avg_daily_load", "peak_daily_load", "min_daily_load",
        "total_daily_customers", "avg_daily_customers", day.alias("timestamp"),
        F.month(day).alias("month"), F.year(day).alias("year"), F.dayofweek(day).alias("dayofweek"),
    )


def silver_daily(spark, n):
    return daily(spark, n).select(
        F.col("day").alias("date"), "total_daily_energy", "avg_daily_load", "peak_daily_load",
        F.lit(3).cast("long").alias("customer_count"), F.lit(9).cast("long").alias("record_count"),
        F.year("day").alias("year"), F.month("day").alias("month"), "date_str",
    )


def one(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_weekday_conventions(spark):
    sunday = F.lit("2024-01-07").cast("date")
    assert [one(spark, f(sunday)) for f in (C.weekday_sunday1, C.weekday_sunday0, C.weekday_monday0)] == [1, 0, 6]
    assert one(spark, C.weekend_sunday1(C.weekday_sunday1(sunday))) == 1
    assert one(spark, C.weekend_sunday0(C.weekday_sunday0(sunday))) == 1
    saturday = F.lit("2024-01-06").cast("date")
    assert one(spark, C.weekend_sunday1(C.weekday_sunday1(saturday))) == 1
    assert one(spark, C.weekend_sunday0(C.weekday_sunday0(saturday))) == 1


def test_season_conventions(spark):
    months = spark.createDataFrame([(m,) for m in [*range(1, 13), 0, None]], "m int")
    got = {r[0]: tuple(r)[1:] for r in months.select(
        "m", C.model_season("m"), C.flag_summer("m"), C.flag_winter("m")).collect()}
    assert [got[m][0] for m in (1, 5, 6, 9, 10, 12, 0, None)] == [
        "spring", "spring", "summer", "summer", "autumn", "autumn", "general", "general"]
    assert (got[1][1], got[7][1], got[7][2], got[1][2]) == (1, 0, 1, 0)
    assert got[None] == ("general", 0, 0)
    assert C.season_dates("spring", 2016) == ("2016-01-01", "2016-05-31")
    assert C.season_dates("anything", 2016) == ("2016-01-01", "2016-12-31")


def test_expected_load(spark):
    cases = {
        "2024-01-02 07:00": 35 * 1.4 * 1.5, "2024-01-06 07:00": 35 * 1.4 * 1.5 * 0.85,
        "2024-07-02 12:00": 35 * 1.3, "2024-04-02 23:30": 35 * 0.9 * 0.5,
        "2024-04-02 05:59": 35 * 0.9 * 0.5, "2024-04-02 06:00": 35 * 0.9 * 1.5,
    }
    frame = spark.createDataFrame([(k,) for k in cases], "t string")
    got = {r[0]: r[1] for r in frame.select("t", C.expected_load(F.col("t").cast("timestamp"))).collect()}
    assert got == {k: pytest.approx(v) for k, v in cases.items()}
    assert one(spark, N.clamp(F.lit(99.0), 10.0, 90.0)) == 90.0


def test_sample_days(spark):
    days = C.sample_day_numbers()
    assert len(days) == 96
    assert days[:9] == [1, 5, 9, 13, 17, 21, 25, 29, 32]
    assert 60 in days and days[-1] == 364
    year = spark.range(1, 367).select(C.day_number_date("id").alias("d"), "id")
    assert [r["id"] for r in year.filter(C.is_sample_day("d")).orderBy("id").collect()] == days


def test_ratios(spark):
    frame = spark.createDataFrame([(6.0, 2.0), (6.0, 0.0), (6.0, -2.0), (6.0, None)], "a double, b double")
    assert [tuple(r) for r in frame.select(N.ratio("a", "b"), N.ratio_or("a", "b")).collect()] == [
        (3.0, 3.0), (None, 1.0), (-3.0, 1.0), (None, 1.0)]


def test_forecast_features(spark):
    featured = features.forecast_features(forecast_daily(spark, 40))
    names = features.forecast_feature_names(featured)
    assert len(names) == 27
    got = [r.asDict() for r in featured.orderBy("date").collect()]
    target = [r["total_daily_energy"] for r in got]
    assert [got[0][f"energy_lag_{k}"] for k in fixed.LAG_STEPS] == [None] * 4
    assert got[10]["energy_lag_7"] == target[3]
    assert got[35]["rolling_avg_30d"] == pytest.approx(sum(target[6:36]) / 30)
    assert got[10]["rolling_max_7d"] == max(target[4:11])
    assert got[1]["rolling_avg_3d"] == pytest.approx(sum(target[:2]) / 2)
    assert got[4]["peak_to_avg_ratio"] is None
    assert got[9]["energy_trend_3d"] + got[9]["rolling_avg_3d"] == pytest.approx(target[9])
    assert got[9]["month_sin"] == pytest.approx(math.sin(1 * 2 * 3.14159 / 12), abs=1e-12)
    assert featured.dropna().count() == 33


def test_shifted_frames_do_not_see_the_row(spark):
    featured = features.forecast_features(forecast_daily(spark, 12), shifted=True)
    got = [r.asDict() for r in featured.orderBy("date").collect()]
    target = [r["total_daily_energy"] for r in got]
    assert got[0]["rolling_avg_3d"] is None
    assert got[9]["rolling_avg_3d"] == pytest.approx(sum(target[6:9]) / 3)


def test_silver_features_fill_the_first_rows(spark):
    rows_, missing = features.silver_training_rows(silver_daily(spark, 40))
    assert missing == []
    assert rows_.columns == [*fixed.SILVER_FEATURES, "total_daily_energy", "date"]
    first = rows_.orderBy("date").first()
    assert first["energy_lag_7"] == first["total_daily_energy"] == first["rolling_avg_30d"]
    assert rows_.count() == 40
    zero = rows_.filter("avg_daily_load = 0").first()
    assert zero["peak_to_avg_ratio"] == 1.0
    partial, missing = features.silver_training_rows(silver_daily(spark, 9).drop("customer_count"))
    assert missing == ["customer_count"] and "customer_count" not in partial.columns


def test_seasonal_features_have_no_sine(spark):
    frame = spark.createDataFrame([(6, 15, 0), (3, 30, 3)], "month int, day int, day_of_week int")
    got = rows(features.seasonal_features(frame), "month_sin", "day_sin", "is_weekend")
    assert got == [(3 * 3.14159 / 6, 30 * 3.14159 / 15, 0), (6 * 3.14159 / 6, 15 * 3.14159 / 15, 1)]


def test_sql_text_equals_operator(spark):
    frame = spark.createDataFrame(
        [("2016-05-31 23:45:00", 1.0), ("2016-06-01 00:00:00", 2.0), ("2016-05-31 00:00:00", 4.0),
         ("2015-03-01 00:00:00", 8.0)], "t string, load_percentage double",
    ).withColumn("full_timestamp", F.col("t").cast("timestamp")).drop("t")
    frame.createOrReplaceTempView("seasonal_readings")
    made = rollup.seasonal_daily(frame, 2016, "spring")
    text = spark.sql(rollup.seasonal_daily_sql("seasonal_readings", 2016, "spring"))
    assert rows(made, *text.columns) == rows(text)
    assert rows(made, "avg_load_percentage", "record_count", "day_of_week") == [(2.5, 2, 2)]


def test_gates(spark, at):
    frame = spark.createDataFrame([(at("2016-05-31 10:00"),), (at("2016-01-01"),)], "ts timestamp")
    gate = lambda season: gates.availability(frame, "ts", season, 2016).first()
    assert (gate("spring")["available"], gate("spring")["season_rows"]) == (True, 2)
    assert (gate("summer")["available"], gate("summer")["enough"]) == (False, False)
    empty = frame.filter("false")
    assert gates.availability(empty, "ts", "spring", 2016).first()["available"] is False
    by_season = {r["season"]: r["available"] for r in gates.availability_by_season(frame, "ts", 2016).collect()}
    assert by_season == {"spring": True, "summer": False, "autumn": False}


def test_season_filter_keeps_all_for_unknown(spark):
    frame = spark.createDataFrame([(1,), (7,), (11,)], "month int")
    assert gates.season_filter(frame, "general").count() == 3
    assert rows(gates.season_filter(frame, "summer")) == [(7,)]


def test_freshness(spark, at):
    frame = spark.createDataFrame([(at("2024-01-01 10:00"),), (at("2024-01-01 09:55"),)], "ts timestamp")
    check = lambda now: tuple(gates.freshness(frame, "ts", F.lit(now).cast("timestamp")).first())
    assert check("2024-01-01 10:00:00") == (1, True)
    assert check("2024-01-01 10:05:00") == (0, False)
    assert tuple(gates.freshness(frame.filter("false"), "ts").first()) == (0, False)
