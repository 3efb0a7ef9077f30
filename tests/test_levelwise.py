"""Level-wise boosting against a plain grower, on the driver and on executors, and the settings that the queries fit with."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattmill.operators import boosting as B
from wattmill.operators import levelwise as V
from wattmill.operators import models as L
from wattmill.plans.catalog import layers, models

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=800), rng.integers(0, 6, 800), rng.random(800)])
    y = np.sin(2 * x[:, 0]) + (x[:, 1] > 3) * x[:, 2] * 3 + rng.normal(size=800) / 5
    df = spark.createDataFrame([(*map(float, r), float(t), i) for i, (r, t) in enumerate(zip(x, y, strict=True))], "a double, b double, c double, log_target double, id long")
    return x, y, L.assemble(df, NAMES).repartition(5).persist()


def plain(x, y, depth, min_leaf, cuts):
    """Mean of ``y`` at the leaf of every row, all cuts tried on the rows themselves."""
    best = None
    for f in range(x.shape[1]) if depth else ():
        for cut in cuts[f]:
            low = x[:, f] <= cut
            if min(low.sum(), (~low).sum()) >= min_leaf:
                gain = y[low].sum() ** 2 / low.sum() + y[~low].sum() ** 2 / (~low).sum() - y.sum() ** 2 / len(y)
                if best is None or gain > best[0] + 1e-9:
                    best = gain, low
    if best is None or best[0] <= 1e-9:
        return np.full(len(y), y.mean())
    out = np.empty(len(y))
    for side in (best[1], ~best[1]):
        out[side] = plain(x[side], y[side], depth - 1, min_leaf, cuts)
    return out


def predicted(model, df):
    return np.array([r["p"] for r in L.predict(model, df).orderBy("id").select("p").collect()])


@pytest.mark.parametrize("local", [V.LOCAL_BYTES, 0])
def test_trees_equal_plain_growth(data, monkeypatch, local):
    x, y, df = data
    monkeypatch.setattr(V, "LOCAL_BYTES", local)
    settings = L.Settings("gbt", {"trees": 3, "depth": 3, "rate": 0.3, "rows": 1.0, "columns": "all", "min_leaf": 12, "seed": 1})
    model = L.fit(df, settings)
    cuts = V.feature_cuts(df.select(F.array(*NAMES).alias("x")), 3)
    assert [len(c) for c in cuts] == [31, 5, 31]
    want = plain(x, y, 3, 12, cuts)
    for _ in range(2):
        want = want + 0.3 * plain(x, 2 * (y - want), 3, 12, cuts)
    assert predicted(model, df) == pytest.approx(want, abs=1e-9)
    assert list(model.treeWeights) == [1.0, 0.3, 0.3] and abs(sum(model.featureImportances.toArray()) - 1) < 1e-9


def test_executors_grow_what_the_driver_grows(data, monkeypatch):
    _, _, df = data
    train, held = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    settings = L.TRAINING_GBT.but(trees=13, depth=4, rate=0.3)
    here = V.grow(train, held, settings.values, "log_target")
    monkeypatch.setattr(V, "LOCAL_BYTES", 0)
    monkeypatch.setattr(V, "KEPT", 4)
    there = V.grow(train.repartition(3), held, settings.values, "log_target")
    assert there.errors == pytest.approx(here.errors, rel=1e-9) and len(here.errors) == 13
    for a, b in zip(here.trees, there.trees, strict=True):
        assert a.feature.tolist() == b.feature.tolist() and a.bin.tolist() == b.bin.tolist() and a.q == pytest.approx(b.q)


def test_missing_features_are_refused_in_training_rows_only(data):
    x, y, df = data
    odd = L.assemble(df.select("id", "log_target", "b", "c", F.when(F.col("id") % 3 > 0, F.col("a")).alias("a")), NAMES)
    settings = L.TRAINING_GBT.but(trees=5, depth=3, rate=0.5)
    with pytest.raises(Exception, match="finite"):
        L.fit(odd, settings)
    with pytest.raises(Exception, match="finite"):
        L.fit(df.select("features", "log_target", "id").unionByName(odd.select("features", "log_target", "id")).withColumn("held", F.col("id") % 3 == 0), settings, validation="held")
    grown = V.grow(df, odd, settings.values, "log_target")
    model = V.as_model(df.sparkSession, grown, L.boosted(settings.values, "log_target"))
    assert np.mean((y - predicted(model, odd)) ** 2) == pytest.approx(grown.errors[-1], rel=1e-9)


def test_patience_grows_every_tree_once(data, monkeypatch):
    _, _, df = data
    made, grown_tree = [], V._grown_tree
    monkeypatch.setattr(V, "_grown_tree", lambda *a: made.append(a[-1]) or grown_tree(*a))
    done = B.fit_patient(df.where("id % 4 <> 0"), df.where("id % 4 = 0"), L.TRAINING_GBT.but(trees=300, rate=0.5, depth=3), patience=5)
    assert made == list(range(done.grown)) and done.grown == done.best + 5


class Seen(Exception):
    pass


@pytest.mark.parametrize(
    "plan, settings",
    [(models.fit_gbt, L.TRAINING_GBT), (layers.medallion, L.TRAINING_GBT), (models.experiment, L.EARLY_STOP_GBT), (models.fit_forest, L.FOREST)],
)
def test_queries_fit_the_whole_preset_on_all_training_rows(spark, monkeypatch, plan, settings):
    fit, told = L.fit, []

    def seen(df, chosen, *args, **kwargs):
        if chosen.algorithm != settings.algorithm:
            return fit(df, chosen, *args, **kwargs)
        told.append(chosen)
        raise Seen

    monkeypatch.setattr(L, "fit", seen)
    monkeypatch.setattr(L, "FOREST_ROWS", 10)
    monkeypatch.setattr(models.S, "sample_rows", None)
    with pytest.raises(Seen):
        plan(spark, "/root/testdata/sf0.001")
    assert told == [settings]
