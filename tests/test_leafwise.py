"""Leaf-wise boosting against a plain best-first grower and brute-force splits."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattmill.operators import leafwise as W


def plain_tree(x, g, leaves, min_leaf, cuts):
    """Best-first growth one leaf at a time, every cut tried on the rows themselves."""

    def best(rows):
        found = None
        for f in range(x.shape[1]):
            for b, cut in enumerate(cuts[f]):
                low = rows & (x[:, f] <= cut)
                high = rows & ~(x[:, f] <= cut)
                if low.sum() < min_leaf or high.sum() < min_leaf:
                    continue
                gain = g[low].sum() ** 2 / low.sum() + g[high].sum() ** 2 / high.sum() - g[rows].sum() ** 2 / rows.sum()
                if found is None or gain > found[0] + 1e-9:
                    found = (gain, f, b, low, high)
        return found

    open_, out = [np.ones(len(x), bool)], np.zeros(len(x))
    while len(open_) < leaves:
        splits = [(best(rows), k) for k, rows in enumerate(open_)]
        splits = [(s, k) for s, k in splits if s and s[0] > 1e-9]
        if not splits:
            break
        s, k = max(splits, key=lambda t: t[0][0])
        open_[k : k + 1] = [s[3], s[4]]
    for rows in open_:
        out[rows] = g[rows].mean()
    return out, len(open_)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=900), rng.integers(0, 6, 900), rng.random(900)])
    y = np.sin(2 * x[:, 0]) + (x[:, 1] > 3) * x[:, 2] * 3 + rng.normal(size=900) / 5
    names = ["a", "b", "c"]
    df = spark.createDataFrame([(*map(float, r), float(t), i) for i, (r, t) in enumerate(zip(x, y, strict=True))], "a double, b double, c double, y double, id long")
    return x, y, names, df.repartition(5).persist()


def predicted(model, df):
    return np.array([r["p"] for r in W.predict(model, df).orderBy("id").collect()])


@pytest.mark.parametrize("leaves", [2, 3, 7, 12])
def test_one_tree_equals_plain_best_first_growth(data, leaves):
    x, y, names, df = data
    model = W.fit_leafwise(df, names, "y", W.Growth(trees=1, rate=1.0, leaves=leaves, min_leaf=10, bins=16))
    want, count = plain_tree(x, y - y.mean(), leaves, 10, model.cuts)
    assert (model.trees[0].feature[np.unique(model.trees[0].landed(np.column_stack([W._interval(x[:, i], c) for i, c in enumerate(model.cuts)])))] == -1).all()
    assert count == leaves
    assert predicted(model, df) == pytest.approx(y.mean() + want, abs=1e-9)


def test_boosting_errors_rebase_and_patience(data, monkeypatch):
    x, y, names, df = data
    monkeypatch.setattr(W, "REBASE", 3)
    train, held = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    growth = W.Growth(trees=10, rate=0.4, leaves=6, min_leaf=10, bins=16, columns=0.7, rows=0.8)
    model = W.fit_leafwise(train, names, "y", growth, validation=held)
    assert len(model.errors) == 10
    truth = y[np.arange(900) % 4 == 0]
    for n in (1, 4, len(model.trees)):
        error = np.sqrt(np.mean((truth - predicted(model.cut(n), held)) ** 2))
        assert error == pytest.approx(model.errors[n - 1], rel=1e-9)
    assert model.errors[-1] < 0.5 * np.std(truth)
    assert len(model.trees) == int(np.argmin(model.errors)) + 1
    used = [set(t.feature[t.feature >= 0]) for t in model.trees]
    assert max(len(u) for u in used) <= 2 and len(set().union(*used)) == 3
    again = W.fit_leafwise(train.repartition(2), names, "y", growth, validation=held)
    assert again.errors == pytest.approx(model.errors, rel=1e-9)
    hasty = W.fit_leafwise(train, names, "y", W.Growth(trees=60, rate=1.0, leaves=30, min_leaf=2, bins=16), validation=held, patience=2)
    assert len(hasty.errors) < 60 and len(hasty.trees) == int(np.argmin(hasty.errors)) + 1


def test_nodes_importances_and_depth(spark, data):
    x, y, names, df = data
    model = W.fit_leafwise(df, names, "y", W.Growth(trees=2, leaves=9, depth=2, min_leaf=5, bins=8))
    assert all((t.feature >= 0).sum() <= 3 for t in model.trees)
    back = W.from_nodes(model.nodes(spark), model)
    assert predicted(back, df) == pytest.approx(predicted(model, df))
    assert sum(r["importance"] for r in model.importances(spark).collect()) == pytest.approx(1.0)


def test_missing_constant_and_empty(spark, data):
    x, y, names, df = data
    nulled = df.withColumn("a", F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 5 == 1, float("nan")).otherwise(F.col("a")))
    nulled = nulled.withColumn("y", F.when(F.col("id") % 7 > 0, F.col("y"))).withColumn("c", F.lit(None).cast("double")).withColumn("bins", F.lit("x"))
    model = W.fit_leafwise(nulled, names, "y", W.Growth(trees=2, leaves=4, bins=8))
    assert not np.isnan(predicted(model, nulled)).any()
    flat = W.fit_leafwise(df.withColumn("y", F.lit(2.5)), names, "y", W.Growth(trees=3))
    assert flat.trees == () and set(predicted(flat, df)) == {2.5}
    none = W.fit_leafwise(df.limit(0), names, "y", W.Growth(trees=3))
    assert (none.trees, none.base) == ((), 0.0)


def test_passes_predict_only_rows_of_the_asked_nodes(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x, y, u = rng.integers(0, 8, size=(500, 2)).astype(np.int16), rng.normal(size=500), rng.integers(-(2**62), 2**62, size=500)
    tree = W.Tree(*[np.array(a) for a in ([0, -1, 1, -1, -1], [3, -1, 5, -1, -1], [1, -1, 3, -1, -1], [2, -1, 4, -1, -1])], value=np.arange(5.0), gain=np.zeros(5))
    held, predicted, walked = np.arange(500) % 5 == 0, W._State.predicted, []
    ends = [1 if a <= 3 else 3 if b <= 5 else 4 for a, b in x]
    assert tree.landed(x).tolist() == ends

    class Rows:
        def mapInArrow(self, work, schema):
            self.work = work
            return self

        def groupBy(self, *by):
            return self

        agg = groupBy

        def toPandas(self):
            return pa.Table.from_batches(self.work([W._batch(x, pa.array(y), np.zeros(500), pa.array(u), pa.array(held))])).to_pandas()

    monkeypatch.setattr(W._State, "predicted", lambda self, before, bins: walked.append(len(bins)) or predicted(self, before, bins))
    told = W._sums(Rows(), W._State(0.0, 0.5, [tree]), tree, [3], 2, 8, W.Growth(), 0, False)
    rest = [(y[i] - 0.5 * 3, *x[i]) for i in range(500) if ends[i] == 3 and not held[i]]
    assert walked == [len(rest)]
    for f in range(2):
        own = told[told["feature"] == f].set_index("bin")
        assert own["n"].sum() == len(rest) and set(told["node"]) == {3}
        for b in range(8):
            here = [r[0] for r in rest if r[1 + f] == b]
            assert (own["s"].get(b, 0.0), own["n"].get(b, 0)) == (pytest.approx(sum(here)), len(here))
