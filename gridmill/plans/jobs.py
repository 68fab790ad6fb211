"""End-to-end jobs: ingest day files, forecast, seasonal training, scoring."""

import time
import uuid

from pyspark.sql import functions as F

from gridmill import fixed
from gridmill.functions.calendar import season_dates
from gridmill.ml import evaluate, models, registry, split
from gridmill.operators import features, gates, rollup
from gridmill.session import new_folder, stored
from gridmill.sinks import tables
from gridmill.sources import dayfiles, ledger
from gridmill.sources.readings import between, union_frames


def ingest_day_files(spark, folder, table=fixed.BATCH_READINGS_TABLE, days=None):
    """Day files into the readings table; returns the totals of the file report."""
    tables.create_readings_table(spark, table)
    report = stored(dayfiles.file_report(dayfiles.read_lines(spark, folder, days)), "file-report")
    readings = dayfiles.read_day_files(spark, folder, days, report=report)
    tables.write_readings(readings, table)
    return dayfiles.report_totals(report)


def ingest_new_day_files(spark, folder, path, days=None, run=None):
    """New and changed day files into the ledger's table; returns the totals of the run.

    Unlike `ingest_day_files` it can be run again at any time.
    """
    made = ledger.ingest(spark, folder, path, days, run=run)
    return dayfiles.report_totals(made)


def daily_series(readings, scale=None):
    """Readings to the daily series of the forecast, through the system series."""
    return rollup.daily_energy(rollup.system_rollup(readings, scale=scale), scale=scale)


def evaluate_splits(model, rows, label):
    """Metrics and row count per split as a dictionary, one aggregation over all predictions."""
    scored = evaluate.metrics(model.transform(rows), label)
    return {
        f"{row['split']}_{name}": row[metric]
        for row in scored.collect()
        for metric, name in (("rmse", "rmse"), ("mae", "mae"), ("r2", "r2"), ("row_count", "rows"))
    }


def train_forecast(spark, readings, folder, name="system_energy_forecaster", **settings):
    """Readings to a registered forecast model; returns model, metrics and run id.

    Boosting stops where the error of the validation rows rises; the run log has the
    number of trees. A series without validation rows gets all trees.
    """
    started = time.time()
    featured = features.forecast_features(daily_series(readings))
    rows = split.chronological(featured).persist()
    try:
        sizes = split.require_training_rows(rows)
        names = features.forecast_feature_names(featured)
        fitted_at = time.time()
        mark = "is_validation" if sizes.get("val") else None
        learned = split.with_validation(rows) if mark else rows.filter("split = 'train'")
        model = models.boosted_pipeline(names, validation=mark, **settings).fit(learned)
        fit_seconds = time.time() - fitted_at
        scores = evaluate_splits(model, rows, fixed.TARGET)
    finally:
        rows.unpersist()
    scores.update({f"{k}_rows": v for k, v in sizes.items()})
    scores.update(training_time=fit_seconds, total_time=time.time() - started)
    ranked = models.importances(spark, model, names).collect()
    run_id = uuid.uuid4().hex
    version = registry.register_model(spark, folder, model, name, run_id=run_id)
    path = registry.saved_path(folder, name, version)
    registry.log_run(
        spark, folder,
        params={**fixed.GBT, **settings, "trees": model.stages[-1].getNumTrees, "total_features": len(names),
                "feature_list": ", ".join(names), "model_name": name, "model_path": path},
        metrics=scores,
        importances={row["feature"]: row["importance"] for row in ranked},
        run_id=run_id,
    )
    return model, scores, run_id


def seasonal_rows(readings, season, year, ts="full_timestamp", load="load_percentage",
                  customer="customer_id"):
    """(rows, features, label) of a season's model. Spring and summer learn the
    average load from calendar fields, autumn the daily total from its history,
    cut to the season first."""
    if season == "autumn":
        first, last = season_dates(season, year)
        daily = rollup.daily_readings(between(readings, ts, first, last), ts, load, customer)
        rows, missing = features.silver_training_rows(gates.season_filter(daily, season))
        names = [c for c in fixed.SILVER_FEATURES if c not in missing]
        return rows, names, fixed.TARGET
    daily = rollup.seasonal_daily(readings, year, season, ts, load)
    return features.seasonal_features(daily), list(fixed.SEASONAL_FEATURES), "avg_load_percentage"


def train_seasonal(spark, readings, season, year, folder, min_rows=fixed.MIN_TRAINING_ROWS,
                   **settings):
    """Gate, train, evaluate and register one season's model.

    Returns None when the season is not complete or has too few days.
    """
    gate = gates.availability(readings, "full_timestamp", season, year).first()
    if not gate["available"]:
        return None
    rows, names, label = seasonal_rows(readings, season, year)
    rows = split.hashed(rows, "date").persist()
    try:
        if gates.enough_rows(rows, min_rows).first()["enough"] is False:
            return None
        model = models.forest_pipeline(names, label, season, **settings).fit(
            rows.filter("split = 'train'")
        )
        scores = evaluate_splits(model, rows, label)
        period = rows.agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
    finally:
        rows.unpersist()
    ranked = models.importances(spark, model, names).collect()
    run_id, name = uuid.uuid4().hex, fixed.SEASON_MODELS[season]
    version = registry.register_model(spark, folder, model, name, run_id=run_id)
    path = registry.saved_path(folder, name, version)
    registry.log_run(
        spark, folder,
        params={**fixed.SEASONAL_FOREST[season], **settings, "season": season,
                "target_year": year, "model_type": "RandomForestRegressor",
                "data_period": f"{period['first']} to {period['last']}",
                "model_name": name, "model_path": path},
        metrics=scores,
        importances={row["feature"]: row["importance"] for row in ranked},
        run_id=run_id,
    )
    return scores


def score_by_model(rows, keep, name="prediction"):
    """Predictions of rows that carry the model of each, see `registry.as_of_model`.

    The rows are written once by model and each model scores its own folder, so
    every row is read once more and scored once, whatever the number of models.
    Rows without a model stay with a null prediction.
    """
    spark = rows.sparkSession
    placed = rows.withColumn("_model", F.coalesce("model_path", F.lit("-")))
    path = new_folder(spark, "by-model")
    placed.write.partitionBy("_model").parquet(path)
    stored_rows = spark.read.schema(placed.schema).parquet(path)
    # One name per model version in use: registry metadata.
    used = [r["_model"] for r in stored_rows.select("_model").distinct().collect()]
    frames = []
    for model in used:
        own = stored_rows.filter(F.col("_model") == model)
        scored = registry.model_at(model).transform(own) if model != "-" else own.withColumn("prediction", F.lit(None).cast("double"))
        frames.append(scored.select(*keep, "model", "version", F.col("prediction").alias(name)))
    if not frames:
        return rows.select(*keep, "model", "version", F.lit(None).cast("double").alias(name))
    return union_frames(frames)


def score_by_season(spark, rows, folder, ts, keep, name="prediction"):
    """Score every row with its season's model in the version that was valid at its time."""
    return score_by_model(registry.as_of_model(rows, registry.read_models(spark, folder), ts), keep, name)


def score_table(spark, rows, folder, name, keep, path, run=None):
    """Score rows with a registered model and append the predictions; returns those appended.

    With the name of a `run` a retry replaces what the run appended before.
    """
    model = registry.load_model(spark, folder, name)
    scored = stored(models.score(model, rows, keep).withColumn("created_at", F.current_timestamp()), "scored")
    if run is None:
        tables.append_files(scored, path)
    else:
        tables.append_run(scored, path, run)
    return scored
