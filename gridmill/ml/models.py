"""Pipelines, scoring and model reports on Spark ML."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from gridmill import fixed


def assembler(columns, output="features"):
    return VectorAssembler(inputCols=list(columns), outputCol=output)


def scaler(source="raw_features", output="scaled_features"):
    """Centre to mean zero and scale to sample standard deviation one."""
    return StandardScaler(inputCol=source, outputCol=output, withMean=True, withStd=True)


def boosted_pipeline(columns, label=fixed.TARGET, validation=None, **settings):
    """Boosted trees on scaled features.

    With `validation`, a boolean column, trees are added only as long as they
    lower the error on the rows marked by it, which no tree learns from.
    """
    held_out = {} if validation is None else {"validationIndicatorCol": validation}
    trees = GBTRegressor(
        featuresCol="scaled_features", labelCol=label, **{**fixed.GBT, **held_out, **settings}
    )
    return Pipeline(stages=[assembler(columns, "raw_features"), scaler(), trees])


def forest_pipeline(columns, label, season="spring", **settings):
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=label, **{**fixed.SEASONAL_FOREST[season], **settings}
    )
    return Pipeline(stages=[assembler(columns), forest])


def linear_pipeline(columns, label, **settings):
    linear = LinearRegression(
        featuresCol="features", labelCol=label, **{**fixed.RIDGE, **settings}
    )
    return Pipeline(stages=[assembler(columns), linear])


def standardized(df, columns, suffix="_scaled"):
    """The columns centred and scaled, one pass to fit and none to shuffle."""
    fitted = Pipeline(stages=[assembler(columns, "_raw"), scaler("_raw", "_scaled")]).fit(df)
    scaled = vector_to_array(F.col("_scaled"))
    return (
        fitted.transform(df)
        .withColumns({f"{c}{suffix}": scaled[i] for i, c in enumerate(columns)})
        .drop("_raw", "_scaled")
    )


def score(model, df, keep, digits=0, as_of=None, name="predicted_price"):
    """Rounded predictions stamped with the scoring time."""
    as_of = F.current_timestamp() if as_of is None else as_of
    return model.transform(df).select(
        *keep, F.round("prediction", digits).alias(name), as_of.alias("prediction_timestamp")
    )


# Model reports hold one row per feature, so they are built from model
# attributes on the driver.
def importances(spark, model, columns):
    """Features ranked by importance."""
    scores = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(columns, scores, strict=True), key=lambda pair: (-pair[1], pair[0]))
    rows = [(i, name, float(value)) for i, (name, value) in enumerate(ranked, 1)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def coefficients(spark, model, columns):
    """Intercept and coefficients of a linear pipeline."""
    linear = model.stages[-1]
    rows = [("intercept", float(linear.intercept))]
    rows += [(n, float(v)) for n, v in zip(columns, linear.coefficients, strict=True)]
    return spark.createDataFrame(rows, "term string, estimate double")
