"""Patience: prefixes against tree-by-tree sums, the cut model against its own prefix."""

import pytest
from pyspark.sql import functions as F

from wattmill.operators import boosting as B
from wattmill.operators import models as L

SMALL = L.TRAINING_GBT.but(depth=3, rate=0.3, min_leaf=2, columns="all")


@pytest.fixture(scope="module")
def parts(spark):
    rows = spark.range(0, 1200, 1, 4).select(
        (F.rand(1) * 10).alias("a"), (F.rand(2) * 10).alias("b"), F.randn(3).alias("noise"), (F.col("id") % 4 == 0).alias("held")
    )
    rows = rows.withColumn("log_target", F.sin("a") + F.col("b") / 5 + F.col("noise"))
    rows = L.assemble(rows, ["a", "b"]).persist()
    return rows.where("not held"), rows.where("held")


def test_stopping_point():
    assert B.stopping_point([3, 2, 1, 2, 2, 0], 2) == (3, True)
    assert B.stopping_point([3, 2, 1, 2], 2) == (3, False)
    assert B.stopping_point([1, 1, 1], 2) == (1, True)
    assert B.stopping_point([5], 3) == (1, False)


def test_prefix_errors_equal_sums_over_trees(parts):
    train, held = parts
    model = L.fit(train, SMALL.but(trees=12))
    told = B.by_tree(model, held)
    want = told.agg(*[F.sqrt(F.avg(F.pow(F.col("log_target") - B.summed_trees(model, n), 2))) for n in range(1, 13)]).first()
    assert B.prefix_errors(model, held) == pytest.approx(list(want), rel=1e-9)
    assert [r["error"] for r in B.errors_by_prefix(model, held).orderBy("trees").collect()] == pytest.approx(list(want), rel=1e-9)


def test_cut_model_is_the_prefix(parts):
    train, held = parts
    model = L.fit(train, SMALL.but(trees=9))
    short = B.cut(model, 4)
    assert len(short.trees) == 4 and short.numFeatures == 2
    told = short.transform(B.by_tree(model, held))
    gap = told.agg(F.max(F.abs(F.col("prediction") - B.summed_trees(model, 4)))).first()[0]
    assert gap < 1e-9
    assert abs(sum(short.featureImportances.toArray()) - 1) < 1e-9
    with pytest.raises(ValueError):
        B.cut(model, 10)


def test_patience_ends_the_fit(parts, tmp_path):
    train, held = parts
    done = B.fit_patient(train, held, SMALL.but(trees=400), patience=6)
    assert done.grown < 400
    assert done.best == B.stopping_point(done.errors, 6)[0] == len(done.model.trees)
    error = done.model.transform(held).agg(F.sqrt(F.avg(F.pow(F.col("log_target") - F.col("prediction"), 2)))).first()[0]
    assert error == pytest.approx(done.errors[done.best - 1], rel=1e-9)
    longer = L.fit(train, SMALL.but(trees=done.grown * 2))
    assert B.prefix_errors(longer, held)[: done.grown] == pytest.approx(done.errors, rel=1e-12)
    L.save_model(done.model, f"{tmp_path}/model")
    again = L.load_model(B.GBTRegressionModel, f"{tmp_path}/model")
    assert len(again.trees) == done.best


def test_without_validation_rows(parts):
    train, held = parts
    done = B.fit_patient(train, held.limit(0), SMALL.but(trees=3), patience=2)
    assert (done.best, done.errors) == (3, [])
