"""Run log and model registry as plain tables.

Runs are long rows (run, kind, key, value, time); models are rows (name,
version, stage, path). A single run writes a handful of rows, built on the
driver from its settings and scores.
"""

import datetime
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridmill import fixed, schemas
from gridmill.functions.calendar import model_season

_LOADED = {}


# --- run log --------------------------------------------------------------
def log_run(spark, folder, params=(), metrics=(), importances=(), status="FINISHED", run_id=None):
    """Append one run and return its id."""
    run_id = run_id or uuid.uuid4().hex
    now = datetime.datetime.now()
    kinds = (("param", params), ("metric", metrics), ("importance", importances))
    rows = [
        (run_id, kind, str(key), str(value), now)
        for kind, items in kinds
        for key, value in dict(items).items()
    ]
    rows.append((run_id, "status", "status", status, now))
    frame = spark.createDataFrame(rows, schemas.RUNS).coalesce(1)
    frame.write.mode("append").parquet(f"{folder}/runs")
    return run_id


def read_runs(spark, folder):
    return spark.read.schema(schemas.RUNS).parquet(f"{folder}/runs")


# --- registry -------------------------------------------------------------
def read_models(spark, folder):
    try:
        return spark.read.schema(schemas.MODELS).parquet(f"{folder}/models")
    except AnalysisException:
        return spark.createDataFrame([], schemas.MODELS)


def save_model(model, path):
    model.write().overwrite().save(path)
    return path


def saved_path(folder, name, version):
    return f"{folder}/saved/{name}/{version}"


def register_model(spark, folder, model, name, stage="None", run_id=None, valid_from=None):
    """Save a model under the next version of its name and record it; returns the version.

    `valid_from` is the time from which the version counts for scoring as of a
    time, the present one unless given.

    The model is written before its registry row, so a row always has files. One
    writer per name: two jobs at once would take the same version.
    """
    top = read_models(spark, folder).filter(F.col("name") == name).agg(F.max("version")).first()[0]
    version = (top or 0) + 1
    path = save_model(model, saved_path(folder, name, version))
    row = (name, version, stage, path, run_id, valid_from or datetime.datetime.now())
    frame = spark.createDataFrame([row], schemas.MODELS).coalesce(1)
    frame.write.mode("append").parquet(f"{folder}/models")
    return version


def pick_version(models, production_first=True):
    """One row per model name: a Production version before others, then the newest."""
    staged = (F.col("stage") == "Production") if production_first else F.lit(False)
    rank = F.struct(
        F.coalesce(staged, F.lit(False)).cast("int").alias("production"),
        F.col("version"), F.col("stage"), F.col("path"),
    )
    return models.groupBy("name").agg(F.max(rank).alias("top")).select(
        "name", "top.version", "top.stage", "top.path"
    )


def pick_model(months, models, month="month"):
    """Model name for each month: the season's if registered, else the general one.

    The registry is small metadata; the planner broadcasts it by its size.
    """
    season = model_season(month)
    named = months.withColumn("season", season)
    names = F.create_map(*[F.lit(x) for pair in fixed.SEASON_MODELS.items() for x in pair])
    wanted = named.withColumn("_wanted", names[F.col("season")])
    registered = models.select(F.col("name").alias("_wanted")).distinct().withColumn(
        "_found", F.lit(True)
    )
    return (
        wanted.join(registered, "_wanted", "left")
        .withColumn(
            "model", F.when(F.col("_found"), F.col("_wanted")).otherwise(F.lit(fixed.GENERAL_MODEL))
        )
        .drop("_wanted", "_found")
    )


def validity(models):
    """name, version, path and the half-open time in which each version is the newest of its name.

    Of versions that begin at the same time the highest counts.
    """
    begun = models.groupBy("name", F.col("ts").alias("valid_from")).agg(
        F.max(F.struct("version", "path")).alias("top")
    )
    # A name has as many rows as versions: registry metadata.
    until = F.lead("valid_from").over(Window.partitionBy("name").orderBy("valid_from"))
    return begun.select("name", "top.version", "top.path", "valid_from", until.alias("valid_to"))


def as_of_model(rows, models, ts, month=None):
    """Rows with the model (`model`, `version`, `model_path`) that serves each at its own time.

    That is the season's model in the version valid at `ts`, where there is none
    yet the general model's, and null where that has no version yet either. The
    time decides, not the order in which versions were registered later.
    """
    season = model_season(F.month(ts) if month is None else month)
    names = F.create_map(*[F.lit(x) for pair in fixed.SEASON_MODELS.items() for x in pair])
    moment = F.col(ts).cast("timestamp")
    made = rows.withColumn("_wanted", F.coalesce(names[season], F.lit(fixed.GENERAL_MODEL)))
    spans = validity(models)

    def side(prefix):
        return spans.select(*[F.col(c).alias(f"_{prefix}_{c}") for c in spans.columns])

    def valid(prefix, name):
        upto = F.col(f"_{prefix}_valid_to")
        return (F.col(f"_{prefix}_name") == name) & (moment >= F.col(f"_{prefix}_valid_from")) & (upto.isNull() | (moment < upto))

    joined = made.join(side("own"), valid("own", F.col("_wanted")), "left").join(
        side("any"), valid("any", F.lit(fixed.GENERAL_MODEL)) & F.col("_own_name").isNull(), "left"
    )
    chosen = lambda c: F.coalesce(f"_own_{c}", f"_any_{c}")
    return joined.select(
        *rows.columns, chosen("name").alias("model"), chosen("version").alias("version"), chosen("path").alias("model_path")
    )


def newest_run(runs):
    """One row per model name: the run that logged it last and the path it saved.

    Runs name their model in `model_name` and its files in `model_path`.
    """
    logged = lambda key: F.max_by(
        F.when((F.col("kind") == "param") & (F.col("key") == key), F.col("value")),
        F.when((F.col("kind") == "param") & (F.col("key") == key), F.col("ts")),
    )
    per_run = runs.groupBy("run_id").agg(
        logged("model_name").alias("name"), logged("model_path").alias("path"), F.max("ts").alias("ts")
    )
    newest = per_run.filter("name IS NOT NULL AND path IS NOT NULL").groupBy("name").agg(
        F.max(F.struct("ts", "run_id", "path")).alias("top")
    )
    return newest.select("name", "top.run_id", "top.path", "top.ts")


def load_model(spark, folder, name, production_first=True, cached=True):
    """The chosen version of a model, else what the newest run of that name saved."""
    row = pick_version(read_models(spark, folder).filter(F.col("name") == name), production_first)
    chosen = row.first()
    if chosen is None:
        try:
            chosen = newest_run(read_runs(spark, folder)).filter(F.col("name") == name).first()
        except AnalysisException:  # nothing was logged yet
            chosen = None
    if chosen is None:
        raise LookupError(f"no model is registered under {name}")
    return model_at(chosen["path"], cached)


def model_at(path, cached=True):
    if not cached:
        return PipelineModel.load(path)
    if path not in _LOADED:
        _LOADED[path] = PipelineModel.load(path)
    return _LOADED[path]
