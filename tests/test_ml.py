"""Splits, metrics, models and the registry."""

import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from gridmill import fixed, schemas
from gridmill.ml import evaluate, models, registry, split
from gridmill.plans import jobs
from tests.conftest import rows


@pytest.mark.parametrize("n, sizes", [
    (400, {"train": 325, "val": 15, "test": 60}), (90, {"train": 15, "val": 15, "test": 60}),
    (89, {"train": 52, "val": 15, "test": 22}), (23, {"val": 13, "test": 10}),
])
def test_chronological_sizes(spark, n, sizes):
    frame = spark.range(n).select(F.col("id").alias("date"), F.lit(1.0).alias("v"))
    out = split.chronological(frame)
    assert dict(rows(out.groupBy("split").count())) == sizes
    newest = out.agg(F.max("date"), F.max_by("split", "date")).first()
    assert newest[1] == "test"
    if "train" in sizes:
        assert split.require_training_rows(out) == sizes
        assert split.parts(out)["train"].count() == sizes["train"]
    else:
        with pytest.raises(ValueError):
            split.require_training_rows(out)


def test_incomplete_rows_are_not_split(spark):
    frame = spark.createDataFrame([(i, None if i < 7 else 1.0) for i in range(107)], "date int, v double")
    assert split.chronological(frame).count() == 100


def test_hash_split_ignores_partitioning(spark):
    frame = spark.range(5000)
    a = rows(split.hashed(frame.repartition(7), "id"))
    assert a == rows(split.hashed(frame.coalesce(1), "id"))
    share = sum(s == "train" for _, s in a) / 5000
    assert 0.77 < share < 0.83
    train, test = split.random_parts(frame)
    assert train.count() + test.count() == 5000


@pytest.fixture(scope="module")
def houses(spark):
    """House rows with a price that is linear in the features, with small noise."""
    base = spark.range(300).select(
        "id", (50 + F.col("id") * 37 % 150).cast("double").alias("house_size"),
        (1 + F.col("id") * 7 % 9).cast("double").alias("location_score"),
        (F.col("id") * 11 % 30).cast("double").alias("age_years"),
        (1 + F.col("id") % 5).cast("double").alias("rooms"),
    )
    price = (
        F.col("house_size") * 2500 + F.col("location_score") * 25000 - F.col("age_years") * 3000
        + F.col("rooms") * 15000 + 200000 + F.col("id") * 13 % 97
    )
    return base.withColumn("price", price).withColumn("split", F.when(F.col("id") % 5 < 4, "train").otherwise("test"))


COLUMNS = ["house_size", "location_score", "age_years", "rooms"]


def test_metrics_agree_with_spark_evaluators(spark, houses):
    rows_ = houses.withColumn("prediction", F.col("price") * 0.9 + F.col("id") * 10)
    got = {r["split"]: r for r in evaluate.metrics(rows_, "price").collect()}
    for name in ("train", "test"):
        for metric in ("rmse", "mae", "r2"):
            judge = RegressionEvaluator(labelCol="price", predictionCol="prediction", metricName=metric)
            assert got[name][metric] == pytest.approx(judge.evaluate(rows_.filter(F.col("split") == name)))
    exact = {r["split"]: r["r2"] for r in evaluate.metrics(rows_, "price", scale=2).collect()}
    assert exact["train"] == pytest.approx(got["train"]["r2"])


def test_overfit_gap(spark):
    frame = spark.createDataFrame([("train", 0.9), ("val", 0.8), ("test", 0.7)], "split string, r2 double")
    gap, flag = evaluate.overfit_gap(frame).first()
    assert gap == pytest.approx(0.2) and flag is True


def test_linear_model(spark, houses):
    model = models.linear_pipeline(COLUMNS, "price").fit(houses.filter("split = 'train'"))
    terms = dict(rows(models.coefficients(spark, model, COLUMNS)))
    assert terms["house_size"] == pytest.approx(2500, rel=0.01)
    scored = evaluate.metrics(model.transform(houses), "price")
    assert scored.filter("r2 < 0.999").count() == 0
    elastic = models.linear_pipeline(COLUMNS, "price", **fixed.ELASTIC_NET).fit(houses)
    assert elastic.stages[-1].getRegParam() == 0.3
    stamp = F.lit("2024-01-01").cast("timestamp")
    out = models.score(model, houses, ["id"], as_of=stamp)
    assert out.columns == ["id", "predicted_price", "prediction_timestamp"]
    assert out.filter("predicted_price <> floor(predicted_price)").count() == 0


def test_scaling(houses):
    out = models.standardized(houses, ["house_size", "rooms"]).agg(
        F.avg("house_size_scaled"), F.stddev("house_size_scaled"), F.avg("rooms_scaled")).first()
    assert tuple(out) == (pytest.approx(0, abs=1e-9), pytest.approx(1), pytest.approx(0, abs=1e-9))


def test_tree_settings():
    trees = models.boosted_pipeline(["a"]).getStages()[-1]
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getSubsamplingRate(), trees.getSeed()) == (100, 6, 0.8, 42)
    forest = {s: models.forest_pipeline(["a"], "y", s).getStages()[-1] for s in fixed.SEASON_MODELS}
    assert [(f.getNumTrees(), f.getMaxDepth()) for f in forest.values()] == [(50, 8), (100, 10), (100, 10)]


def test_forest_and_importances(spark, houses, tmp_path):
    pipeline = models.forest_pipeline(COLUMNS, "price", numTrees=5, maxDepth=4)
    model = pipeline.fit(houses)
    ranked = models.importances(spark, model, COLUMNS).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4]
    assert sum(r["importance"] for r in ranked) == pytest.approx(1)
    assert rows(model.transform(houses), "prediction") == rows(pipeline.fit(houses).transform(houses), "prediction")
    path = str(tmp_path / "m")
    registry.save_model(model, path)
    registry.save_model(model, path)  # overwrites
    assert rows(PipelineModel.load(path).transform(houses), "prediction") == rows(model.transform(houses), "prediction")


def test_registry(spark, houses, tmp_path):
    folder = str(tmp_path / "registry")
    model = models.linear_pipeline(COLUMNS, "price").fit(houses)
    assert registry.read_models(spark, folder).count() == 0
    assert registry.register_model(spark, folder, model, "m") == 1
    assert registry.register_model(spark, folder, model, "m", stage="Production") == 2
    assert registry.register_model(spark, folder, model, "m") == 3
    found = registry.read_models(spark, folder)
    assert rows(registry.pick_version(found), "name", "version", "stage") == [("m", 2, "Production")]
    assert rows(registry.pick_version(found, production_first=False), "version") == [(3,)]
    loaded = registry.load_model(spark, folder, "m")
    assert loaded is registry.load_model(spark, folder, "m")
    assert registry.load_model(spark, folder, "m", cached=False) is not loaded
    out = jobs.score_table(spark, houses, folder, "m", ["id"], str(tmp_path / "scored"))
    assert "created_at" in out.columns and spark.read.parquet(str(tmp_path / "scored")).count() == 300


def test_unregistered_model_falls_back_to_the_newest_run(spark, houses, tmp_path):
    folder = str(tmp_path / "registry")
    model = models.linear_pipeline(COLUMNS, "price").fit(houses)
    path = registry.save_model(model, f"{folder}/loose")
    registry.log_run(spark, folder, params={"model_name": "loose", "model_path": path}, metrics={"rmse": 1.5}, importances={"a": 0.5})
    registry.log_run(spark, folder, params={"model_name": "other", "model_path": "elsewhere"}, run_id="other")
    with pytest.raises(LookupError):
        registry.load_model(spark, folder, "none")
    with pytest.raises(LookupError):
        registry.load_model(spark, str(tmp_path / "nothing"), "none")
    assert registry.load_model(spark, folder, "loose").stages[-1].intercept == model.stages[-1].intercept
    logged = registry.read_runs(spark, folder).filter("run_id <> 'other'")
    assert rows(logged, "kind", "key", "value") == [
        ("importance", "a", "0.5"), ("metric", "rmse", "1.5"), ("param", "model_name", "loose"), ("param", "model_path", path),
        ("status", "status", "FINISHED")]


def test_pick_model(spark):
    months = spark.createDataFrame([(m,) for m in range(1, 13)], "month int")
    registered = spark.createDataFrame([("spring_energy_model",), ("spring_energy_model",), ("autumn_energy_model",)], "name string")
    got = dict(rows(registry.pick_model(months, registered), "month", "model"))
    assert len(got) == 12
    assert [got[m] for m in (1, 5, 6, 9, 10, 12)] == [
        "spring_energy_model"] * 2 + ["general_energy_model"] * 2 + ["autumn_energy_model"] * 2


@pytest.fixture(scope="module")
def year(spark):
    """A year of readings of a few meters, with weekly and seasonal swings."""
    start = datetime.datetime(2016, 1, 1)
    data = [
        (f"c{c}", start + datetime.timedelta(days=d, hours=h),
         30.0 + 5 * (d % 7 > 4) + 8 * abs(6 - (start + datetime.timedelta(days=d)).month) + h / 6 + c + d * 7 % 5)
        for d in range(366) for h in (0, 6, 12, 18) for c in range(3)
    ]
    return spark.createDataFrame(data, "customer_id string, full_timestamp timestamp, load_percentage double").persist()


def test_forecast_job(spark, year, tmp_path):
    folder = str(tmp_path / "registry")
    model, scores, run_id = jobs.train_forecast(spark, year, folder, maxIter=8, maxDepth=4)
    assert (scores["train_rows"], scores["val_rows"], scores["test_rows"]) == (284, 15, 60)
    assert scores["train_r2"] > 0.8
    logged = registry.read_runs(spark, folder).filter(F.col("run_id") == run_id)
    assert logged.filter("kind = 'importance'").count() == 27
    assert registry.read_models(spark, folder).count() == 1
    loaded = registry.load_model(spark, folder, "system_energy_forecaster", cached=False)
    assert len(loaded.stages) == 3


def test_seasonal_jobs(spark, year, tmp_path):
    folder = str(tmp_path / "registry")
    for season in ("spring", "autumn"):
        scores = jobs.train_seasonal(spark, year, season, 2016, folder, numTrees=5, maxDepth=4)
        assert {"train_rmse", "test_r2"} <= set(scores)
    assert jobs.train_seasonal(spark, year, "spring", 2017, folder) is None  # not complete yet
    assert jobs.train_seasonal(spark, year, "summer", 2016, folder, min_rows=500) is None
    assert rows(registry.read_models(spark, folder), "name", "version") == [
        ("autumn_energy_model", 1), ("spring_energy_model", 1)]
    rows_, names, label = jobs.seasonal_rows(year, "autumn", 2016)
    first = rows_.orderBy("date").first()
    assert label == "total_daily_energy" and len(names) == 25
    assert first["energy_lag_1"] == first["total_daily_energy"]  # September is cut off first


def test_models_as_of_a_time(spark, at):
    versions = spark.createDataFrame([
        ("spring_energy_model", 1, None, "s1", None, at("2020-01-01")), ("spring_energy_model", 2, None, "s2", None, at("2021-03-01")),
        ("spring_energy_model", 3, None, "s3", None, at("2021-03-01")), ("general_energy_model", 1, None, "g1", None, at("2019-06-01")),
        ("other", 9, None, "o9", None, at("2000-01-01")),
    ], schemas.MODELS)
    found = [(1, "2020-01-01"), (2, "2021-02-28"), (3, "2021-03-01"), (4, "2019-12-31"), (5, "2019-05-31"), (6, "2020-07-01"), (7, None)]
    frame = spark.createDataFrame([(i, t and at(t)) for i, t in found], "id int, ts timestamp")
    out = registry.as_of_model(frame, versions, "ts")
    assert rows(out, "id", "model_path", "version") == [
        (1, "s1", 1), (2, "s1", 1), (3, "s3", 3), (4, "g1", 1), (5, None, None), (6, "g1", 1), (7, None, None)]


def test_rows_are_scored_by_their_model(spark, at, tmp_path):
    folder = str(tmp_path / "registry")
    frame = spark.createDataFrame([(i, at(f"202{i % 3}-0{1 + i % 8}-01"), float(i)) for i in range(40)], "id int, ts timestamp, x double")
    for name, label, since in (("spring_energy_model", F.col("x") * 2, "2021-01-01"), ("general_energy_model", F.col("x") + 1, "2020-06-01")):
        model = models.linear_pipeline(["x"], "y", regParam=0.0).fit(frame.withColumn("y", label))
        registry.register_model(spark, folder, model, name, valid_from=at(since))
    out = {r["id"]: r for r in jobs.score_by_season(spark, frame, folder, "ts", ["id", "ts"]).collect()}
    assert len(out) == 40
    for i, r in out.items():
        spring = r["ts"].month <= 5 and r["ts"] >= at("2021-01-01")
        want = 2.0 * i if spring else i + 1.0 if r["ts"] >= at("2020-06-01") else None
        assert r["prediction"] == (want if want is None else pytest.approx(want, abs=1e-6))
    assert jobs.score_by_season(spark, frame.limit(0), folder, "ts", ["id"]).count() == 0


def test_no_model_at_all(spark, at, tmp_path):
    frame = spark.createDataFrame([(1, at("2021-01-01"))], "id int, ts timestamp")
    assert rows(jobs.score_by_season(spark, frame, str(tmp_path), "ts", ["id"])) == [(1, None, None, None)]


def test_boosting_stops_on_validation_rows(spark, tmp_path):
    # The validation rows follow another rule, so more trees soon make them worse.
    data = [(i, float(i % 17), float(i % 17) * (1 if i < 300 else -1), "train" if i < 300 else "val") for i in range(330)]
    frame = spark.createDataFrame(data, "id int, x double, total_daily_energy double, split string")
    learned = split.with_validation(frame)
    assert learned.filter("is_validation").count() == 30
    stopped = models.boosted_pipeline(["x"], validation="is_validation", maxIter=30).fit(learned)
    whole = models.boosted_pipeline(["x"], maxIter=30).fit(frame.filter("split = 'train'"))
    assert stopped.stages[-1].getNumTrees < 30 == whole.stages[-1].getNumTrees


def test_the_run_log_has_the_number_of_trees(spark, year, tmp_path):
    folder = str(tmp_path / "registry")
    model, _, run_id = jobs.train_forecast(spark, year, folder, maxIter=12, maxDepth=3)
    logged = registry.read_runs(spark, folder).filter((F.col("run_id") == run_id) & (F.col("key") == "trees")).first()["value"]
    assert int(logged) == model.stages[-1].getNumTrees <= 12
