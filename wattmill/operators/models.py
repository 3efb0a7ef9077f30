"""Regression models on Spark ML, with the settings in use as named presets."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmill.operators import levelwise, metrics
from wattmill.session import scratch_root


@dataclass(frozen=True)
class Settings:
    """Estimator settings under the names a boosted-tree user knows."""

    algorithm: str
    values: dict[str, Any] = field(default_factory=dict)

    def but(self, **changes: Any) -> Settings:
        return Settings(self.algorithm, {**self.values, **changes})


# Model settings.
TRAINING_GBT = Settings(
    "gbt", {"trees": 500, "depth": 6, "rate": 0.05, "rows": 0.8, "columns": 0.8, "min_leaf": 5, "seed": 42}
)
EARLY_STOP_GBT = Settings(
    "gbt",
    {"trees": 1200, "depth": 7, "rate": 0.02, "rows": 0.8, "columns": 0.8, "min_leaf": 10, "seed": 42, "tolerance": 0.001},
)
SECOND_GBT = Settings(
    "gbt",
    {"trees": 3000, "depth": 7, "rate": 0.01, "rows": 0.8, "columns": 0.8, "min_leaf": 20, "seed": 42, "tolerance": 0.001},
)
FOREST = Settings("forest", {"trees": 120, "depth": 12, "min_leaf": 5, "seed": 42})
FOREST_ROWS = 500_000
LINEAR = Settings("linear", {})
RIDGE = Settings("ridge", {"alpha": 1.0})
LASSO = Settings("lasso", {"alpha": 0.01})
ZERO_COEFFICIENT = 1e-6


def assemble(df: DataFrame, features: Sequence[str], into: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=into, handleInvalid="keep").transform(df)


def boosted(s: dict[str, Any], label: str, validation: str | None = None) -> GBTRegressor:
    """The settings as parameters of the library, which the fitted model carries."""
    stop = {"validationIndicatorCol": validation, "validationTol": s.get("tolerance", 0.01)} if validation else {}
    return GBTRegressor(
        labelCol=label, featuresCol="features", maxIter=s["trees"], maxDepth=s["depth"], stepSize=s["rate"],
        subsamplingRate=s["rows"], featureSubsetStrategy=str(s["columns"]), minInstancesPerNode=s["min_leaf"],
        seed=s["seed"], checkpointInterval=10, cacheNodeIds=True, **stop,
    )


def fit(
    df: DataFrame, settings: Settings, label: str = "log_target", validation: str | None = None, library: bool = False
) -> Model:
    """Fit on all rows of ``df`` (needs a ``features`` vector).

    With ``validation`` (a boolean column) boosting stops once the flagged rows
    stop gaining. Trees keep their row state in the shared folder, so a
    lost executor costs at most ten iterations. Boosted trees are grown by :mod:`levelwise`, with ``library`` by
    ``GBTRegressor`` itself: the same rules, other draws of rows and features, many times slower.
    """
    scratch_root(df.sparkSession)
    s = settings.values
    if settings.algorithm == "gbt" and library:
        return boosted(s, label, validation).fit(df)
    if settings.algorithm == "gbt":
        if validation is None:
            return levelwise.as_model(df.sparkSession, levelwise.grow(df, None, s, label), boosted(s, label))
        slack = s.get("tolerance", 0.01)
        grown = levelwise.grow(
            df.where(~F.col(validation)), df.where(validation), s, label, lambda errors: levelwise.within_tolerance(errors, slack), True
        )
        # the last tree is left out where it is the one that ended the growth
        kept = len(grown.errors) - levelwise.within_tolerance(grown.errors, slack)
        return levelwise.as_model(df.sparkSession, grown, boosted(s, label), max(kept, 1))
    if settings.algorithm == "forest":
        return RandomForestRegressor(
            labelCol=label, numTrees=s["trees"], maxDepth=s["depth"], minInstancesPerNode=s["min_leaf"], seed=s["seed"]
        ).fit(df)
    # all three work on the normal equations: one pass, whatever the number of rows and, for lasso, of steps over the sums
    line = LinearRegression(labelCol=label, standardization=False, maxIter=1000, tol=1e-9, solver="normal")
    if settings.algorithm == "ridge":
        # the library divides the squared loss by n and works on the label over its population deviation
        n, spread = df.agg(F.count(label), F.stddev_pop(label)).first()
        line = line.setElasticNetParam(0.0).setRegParam(s["alpha"] * (spread or 1.0) / max(n, 1))
    elif settings.algorithm == "lasso":
        line = line.setElasticNetParam(1.0).setRegParam(s["alpha"])
    else:
        line = line.setRegParam(0.0)
    return line.fit(df)


def predict(model: Model, df: DataFrame, into: str = "p") -> DataFrame:
    return model.transform(df).withColumnRenamed("prediction", into)


def importances(model: Model, features: Sequence[str], spark) -> DataFrame:
    """``(feature, importance)``, or absolute coefficients of a linear model; one row per feature."""
    weights = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    rows = [(f, abs(float(w))) for f, w in zip(features, weights.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double")


def top_features(table: DataFrame, n: int) -> DataFrame:
    return table.orderBy(F.desc("importance"), "feature").limit(n)


def zeroed(table: DataFrame) -> DataFrame:
    """How many coefficients a sparse model set to zero."""
    return table.agg(
        F.count_if(F.col("importance") < ZERO_COEFFICIENT).alias("zeroed"), F.count(F.lit(1)).alias("coefficients")
    )


def run_record(
    df: DataFrame, settings: Settings, features: Sequence[str], run_id: str, label: str = "log_target", library: bool = False
) -> tuple[Model, DataFrame]:
    """Fit on the training rows, score the others, and return the model with its one-row run record.

    The record has the shape the run history is read in: ``run_id, status,
    start_time, metrics, params``; appending it to the run table is the sink.
    """
    ready = assemble(df, features)
    train = ready.where(F.col("split") == "train")
    began = time.time()
    model = fit(train, settings, label, library=library)
    took = round(time.time() - began, 1)
    held = predict(model, ready.where(F.col("split") != "train"))
    scores = metrics.log_space(held.withColumn("y", F.col(label)), ["split"])
    counts = {r["split"]: r["n"] for r in df.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    params = {
        **{k: str(v) for k, v in settings.values.items()},
        "algorithm": settings.algorithm,
        "n_features": str(len(features)),
        **{f"n_{k}": str(v) for k, v in counts.items()},
    }
    names = ["rmse", "mae", "r2", "mape"]
    cells = F.array(*[F.struct(F.concat_ws("_", "split", F.lit(n)).alias("k"), F.col(n).alias("v")) for n in names])
    entries = scores.select(F.explode(cells).alias("e")).agg(F.map_from_entries(F.collect_list("e")).alias("m"))
    record = entries.select(
        F.lit(run_id).alias("run_id"),
        F.lit("FINISHED").alias("status"),
        F.current_timestamp().alias("start_time"),
        F.map_concat("m", F.create_map(F.lit("train_duration_sec"), F.lit(float(took)))).alias("metrics"),
        F.create_map(*[F.lit(x) for kv in params.items() for x in kv]).alias("params"),
    )
    return model, record


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(kind: type[Model] | None, path: str) -> Model:
    return (kind or PipelineModel).load(path)
