"""Boosting that stops with a patience: validation errors of every prefix of trees in one pass, the model cut at the best.

``GBTRegressor`` stops by a tolerance between neighbouring rounds. Here one fit grows until no better prefix came for ``patience``
trees or the preset's number is reached; the validation rows keep their rest beside the training rows, so the error of every prefix is
one sum per tree. Prefixes of a finished model are scored together in one pass that folds the squared errors into one sum per number
of trees, so what comes back is as long as the ensemble, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.operators import levelwise
from wattmill.operators import models as L

#: Trees without a better error before boosting ends.
PATIENCE = 60


@dataclass(frozen=True)
class Stopped:
    """The cut model, the number of its trees, the validation error (root mean square) of every prefix that was grown, and the model
before the cut."""

    model: GBTRegressionModel
    best: int
    errors: list[float]
    grown: int
    whole: GBTRegressionModel


def prefix_errors(model: GBTRegressionModel, rows: DataFrame, label: str = "log_target") -> list[float]:
    """Root mean squared error of the first 1, 2, ... trees on ``rows``; empty without rows."""
    scored = rows.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("double"))
    if scored.isEmpty():
        return []
    renamed = scored.select("features", F.col(label).alias(model.getLabelCol()))
    return [e**0.5 for e in model.evaluateEachIteration(renamed, "squared")]


def stopping_point(errors: Sequence[float], patience: int) -> tuple[int, bool]:
    """The best prefix (number of trees) up to the point where ``patience`` trees brought nothing, and whether that point was reached."""
    best = 0
    for at, error in enumerate(errors):
        if error < errors[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def cut(model: GBTRegressionModel, trees: int) -> GBTRegressionModel:
    """The ensemble of the first ``trees`` trees."""
    if not 1 <= trees <= len(model.trees):
        raise ValueError(f"the model has {len(model.trees)} trees, not {trees}")
    context = SparkSession.active().sparkContext
    java, jvm = model._java_obj, context._jvm
    kept = context._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, trees)
    weights = context._gateway.new_array(jvm.double, trees)
    for at in range(trees):
        kept[at], weights[at] = java.trees()[at], float(java.treeWeights()[at])
    short = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), kept, weights, java.numFeatures()))
    for name in ("featuresCol", "labelCol", "predictionCol"):
        short.set(short.getParam(name), model.getOrDefault(name))
    return short


def fit_patient(
    train: DataFrame, validation: DataFrame, settings: L.Settings, label: str = "log_target", patience: int = PATIENCE
) -> Stopped:
    """Fit on ``train`` until ``validation`` (both with ``features``) gained nothing for ``patience`` trees."""
    spark, known = train.sparkSession, validation.where(F.col(label).isNotNull())
    grown = levelwise.grow(train, known, settings.values, label, lambda errors: stopping_point(errors, patience)[1])
    whole = levelwise.as_model(spark, grown, L.boosted(settings.values, label))
    errors = [e**0.5 for e in grown.errors]
    best = stopping_point(errors, patience)[0] if errors else len(grown.trees)
    return Stopped(cut(whole, best), best, errors, len(grown.trees), whole)


def summed_trees(model: GBTRegressionModel, trees: int) -> Column:
    """Prediction of the first ``trees`` trees from the columns of :func:`by_tree`."""
    total: Column = F.lit(0.0)
    for at, weight in enumerate(model.treeWeights[:trees]):
        total = total + F.lit(float(weight)) * F.col(f"tree_{at}")
    return total


def by_tree(model: GBTRegressionModel, rows: DataFrame) -> DataFrame:
    """``rows`` with ``tree_0``, ``tree_1``, ...: what each tree predicts."""
    for at, tree in enumerate(model.trees):
        rows = tree.setFeaturesCol("features").setPredictionCol(f"tree_{at}").transform(rows)
    return rows



def errors_by_prefix(model: GBTRegressionModel, rows: DataFrame, label: str = "log_target") -> DataFrame:
    """``trees, error``: the root mean squared error of every prefix, summed from the single trees' predictions."""
    weighted = F.array(*[F.col(f"tree_{at}") * F.lit(float(w)) for at, w in enumerate(model.treeWeights)])
    told = by_tree(model, rows).select(F.col(label).cast("double").alias("y"), weighted.alias("each")).where("y is not null")

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        missed, n = np.zeros(len(model_weights)), 0
        for batch in batches:
            each = batch.column("each").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(model_weights))
            missed += ((batch.column("y").to_numpy()[:, None] - np.cumsum(each, axis=1)) ** 2).sum(axis=0)
            n += batch.num_rows
        trees = pa.array(np.arange(1, len(missed) + 1, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([trees, pa.array(missed), pa.array(np.full(len(missed), n))], ["trees", "missed", "n"])

    model_weights = list(model.treeWeights)
    parts = told.mapInArrow(folded, "trees int, missed double, n long").where("n > 0")
    return parts.groupBy("trees").agg(F.sqrt(F.sum("missed") / F.sum("n")).alias("error"))
