"""Vector search and models: brute force, closed forms and invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattmill.operators import encoding as N
from wattmill.operators import metrics as M
from wattmill.operators import models as L
from wattmill.operators import vectors as V
from wattmill.session import stage


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(8, 16))
    points = np.vstack([base[i % 8] + 0.2 * rng.normal(size=16) for i in range(400)])
    points[10] = points[5]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    queries = spark.createDataFrame([(i, [float(x) for x in b]) for i, b in enumerate(base)], "query_id long, embedding array<double>")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = np.round(unit(base) @ unit(points.astype(np.float32).astype(np.float64)).T, V.SCORE_DIGITS)
    best = {q: sorted(range(400), key=lambda v: (-sims[q, v], v))[:7] for q in range(8)}
    return vectors, queries, best


def _lists(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


def test_exact_and_tiled_top_k(cloud):
    vectors, queries, best = cloud
    assert _lists(V.cosine_top_k(vectors, queries, 7)) == best
    assert _lists(V.tiled_top_k(vectors, queries, 7, 8, tile=64)) == best


def test_large_query_sets_are_tiled(cloud, monkeypatch):
    vectors, queries, best = cloud
    monkeypatch.setattr(V, "QUERY_BYTES", 10)
    assert _lists(V.cosine_top_k(vectors, queries, 7)) == best


def test_no_queries_no_hits(cloud):
    vectors, queries, _ = cloud
    assert V.cosine_top_k(vectors, queries.limit(0)).count() == 0


def test_bucketed_recall(cloud):
    vectors, queries, best = cloud
    found = _lists(V.bucketed_top_k(vectors, queries, 7, width=1.0))
    hit = sum(len(set(found.get(q, [])) & set(best[q])) for q in best)
    assert hit / (7 * len(best)) > 0.9


def test_word_embedding(spark):
    df = spark.createDataFrame([("a b c",), ("c, b! A",), ("outra coisa",), ("",)], "text string")
    vecs = [np.array(r["text_vector"]) for r in V.embed_words(df).collect()]
    assert [len(v) for v in vecs] == [V.DIMENSION] * 4
    assert np.allclose(vecs[0], vecs[1]) and not np.allclose(vecs[0], vecs[2])
    assert np.linalg.norm(vecs[0]) == pytest.approx(1.0, rel=1e-6) and np.linalg.norm(vecs[3]) == 0


def test_user_encoder(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("abc",), ("",)], "text string")
    assert [r["text_vector"] for r in V.embed_with(df, load).collect()] == [[3.0, 1.0], [0.0, 1.0]]


@pytest.fixture(scope="module")
def training(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(400, 4))
    y = 1 + 2 * x[:, 0] - x[:, 1] + 0.5 * (x[:, 2] > 0.5) + 0.05 * rng.normal(size=400)
    rows = [(*map(float, r), float(t), "train" if i < 300 else "val" if i < 350 else "test") for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, log_target double, split string")
    return df, x[:300], y[:300]


NAMES = ["a", "b", "c", "d"]


def test_ridge_closed_form(training):
    df, x, y = training
    model = L.fit(L.assemble(df.where("split = 'train'"), NAMES), L.RIDGE)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + np.eye(4), xc.T @ yc)
    assert model.coefficients.toArray() == pytest.approx(want, abs=1e-6)


def test_lasso_optimality(training):
    df, x, y = training
    alpha = L.LASSO.values["alpha"]
    model = L.fit(L.assemble(df.where("split = 'train'"), NAMES), L.LASSO)
    w = model.coefficients.toArray()
    slope = (x - x.mean(0)).T @ (y - y.mean() - (x - x.mean(0)) @ w) / len(y)
    for wj, sj in zip(w, slope):
        assert sj == pytest.approx(alpha * np.sign(wj), abs=1e-4) if abs(wj) > 1e-6 else abs(sj) <= alpha + 1e-4


def _jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        done = work()
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()
    return done, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_lasso_reads_its_rows_as_often_as_least_squares(spark, training):
    df, _, _ = training
    train = L.assemble(df.where("split = 'train'"), NAMES)
    _, plain = _jobs(spark, "least-squares", lambda: L.fit(train, L.LINEAR))
    _, sparse = _jobs(spark, "lasso", lambda: L.fit(train, L.LASSO))
    assert sparse <= plain


def test_scaling_and_encoding_leave_no_scan_in_the_plan_of_a_row(spark, training):
    df, _, _ = training
    scaled = N.scale(df, N.fit_scaler(df, NAMES), NAMES)
    assert "subquery" not in scaled._jdf.queryExecution().toString().lower()
    rows = df.withColumns({"city": F.lit("x"), "fold": F.lit(0)})
    assert "subquery" not in N.fold_encode(rows, ["city"])._jdf.queryExecution().toString().lower()
    told = scaled.agg(F.avg("a"), F.stddev_pop("a")).first()
    assert told[0] == pytest.approx(0, abs=1e-9) and told[1] == pytest.approx(1)


def test_fits_write_their_rows_twice_and_narrow(spark, monkeypatch):
    from wattmill.plans.catalog import features, learning, models

    written = []

    def kept(df, label):
        written.append((label, df.columns))
        return stage(df, label)

    for module in (features, learning, models):
        monkeypatch.setattr(module, "stage", kept, raising=False)
    rows = models.training_rows(spark, "/root/testdata/sf0.001")
    assert [label for label, _ in written] == ["usage-rows", "training-rows"]
    assert "type_of_connection" not in written[0][1]
    told = rows.where("split = 'train'").agg(*[F.avg(c) for c in models.FEATURES]).first()
    assert list(told) == pytest.approx([0] * len(models.FEATURES), abs=1e-9)


def test_experiment_writes_model_rows_once(spark, monkeypatch):
    from wattmill.plans import experiment
    from wattmill.plans.views import usage

    written = {}
    monkeypatch.setattr(experiment, "stage", lambda df, label: written.setdefault(label, stage(df, label)))
    rows, names = experiment.model_rows(usage(spark, "/root/testdata/sf0.001"))
    assert list(written) == ["target-rows", "split-rows", "model-rows"]
    assert written["model-rows"].columns == ["row_id", "split", "log_target", *names] == rows.columns
    assert "type_of_connection" not in written["split-rows"].columns
    told = rows.where("split = 'train'").agg(*[F.avg(c) for c in names]).first()
    assert list(told) == pytest.approx([0] * len(names), abs=1e-6)


def test_trees_beat_the_baseline_and_repeat(training):
    df, _, _ = training
    ready = L.assemble(df, NAMES)
    train, test = ready.where("split = 'train'"), ready.where("split = 'test'")
    settings = L.TRAINING_GBT.but(trees=30, depth=3, rate=0.2)

    def score():
        held = L.predict(L.fit(train, settings), test).withColumn("y", F.col("log_target"))
        return M.original_space(held, []).first()["mae"]

    base = test.withColumn("p", M.median_baseline(train)).withColumn("y", F.col("log_target"))
    assert score() < M.original_space(base, []).first()["mae"]
    assert score() == pytest.approx(score(), rel=1e-9)


def test_metrics_by_hand(spark):
    y, p = np.log1p([1.0, 2.0, 4.0]), np.log1p([2.0, 2.0, 1.0])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    got = M.original_space(df, []).first()
    assert got["mae"] == pytest.approx(4 / 3) and got["medae"] == pytest.approx(1.0)
    assert got["rmse"] == pytest.approx(np.sqrt(10 / 3)) and got["wmape"] == pytest.approx(400 / 7)
    assert got["mape"] == pytest.approx((1 + 0 + 0.75) / 3 * 100)
    assert got["r2"] == pytest.approx(1 - 10 / np.sum((np.array([1, 2, 4]) - 7 / 3) ** 2))


def test_blend_refinement_never_worse(spark):
    rng = np.random.default_rng(4)
    y = rng.uniform(1, 3, 500)
    rows = [(float(t), *(float(t + e) for e in rng.normal(0, s, 3))) for t, s in zip(y, [[0.1, 0.3, 0.2]] * 500)]
    df = spark.createDataFrame(rows, "y double, a double, b double, c double")
    coarse, w0 = M.best_blend(df, ["a", "b", "c"])
    fine, w1 = M.best_blend(df, ["a", "b", "c"], refine=1)
    assert w1 <= w0 + 1e-12 and sum(fine) == pytest.approx(1.0) and len(M.weight_grid(3)) == 231


def test_blend_descent_reaches_the_grid(spark):
    rng = np.random.default_rng(9)
    y = rng.uniform(1, 3, 600)
    names = ["a", "b", "c", "d", "e", "f"]
    rows = [(float(t), *(float(t + e) for e in rng.normal([0, 0.2, -0.3, 0, 0.1, 0], [0.3, 0.2, 0.2, 0.6, 0.3, 0.4]))) for t in y]
    df = spark.createDataFrame(rows, "y double, " + ", ".join(f"{n} double" for n in names)).repartition(3)
    grid = M.best_blend(df, names[:3])[1]
    weights, error = M.descend_blend(df, names[:3])
    assert error <= grid + 1e-9 and sum(weights) == pytest.approx(1.0) and min(weights) >= 0
    logs, truth = np.array(rows)[:, 1:], np.expm1(y)
    score = lambda w: np.abs(truth - np.expm1(np.clip(logs[:, : len(w)] @ w, 0, None))).sum() / truth.sum() * 100
    assert error == pytest.approx(score(np.array(weights)))
    six, low = M.descend_blend(df, names)
    assert low <= error + 1e-9 and low == pytest.approx(score(np.array(six)))
    assert low <= min(score(w) for w in np.random.default_rng(1).dirichlet(np.ones(6), 3000))
    assert M.descend_blend(df, ["a"])[0] == [1.0]
    nothing = M.descend_blend(df.limit(0), names[:2])
    assert nothing[0] == [0.5, 0.5] and np.isnan(nothing[1])


def test_encoding_unseen_and_out_of_fold(spark):
    rows = [("x", 1.0, "train", 0), ("x", 3.0, "train", 1), ("y", 5.0, "train", 0), ("z", 9.0, "test", 0), (None, 9.0, "test", 1), ("x", 9.0, "test", 1)]
    df = spark.createDataFrame(rows, "city string, log_target double, split string, fold int")
    plain = {(r["city"], r["log_target"]): r["city_te"] for r in N.target_encode(df, ["city"]).collect()}
    assert plain[("x", 9.0)] == 2.0 and plain[("z", 9.0)] == 3.0 and plain[(None, 9.0)] == 3.0
    folded = {(r["city"], r["log_target"]): r["city_te"] for r in N.fold_encode(df, ["city"]).collect()}
    assert folded[("x", 1.0)] == 3.0 and folded[("x", 3.0)] == 1.0 and folded[("y", 5.0)] == 3.0 and folded[("x", 9.0)] == 2.0


def test_compare_keeps_copies(spark):
    from wattmill.plans import experiment

    plain = [(f"r{i % 40}", "train" if i % 4 else ("val" if i % 8 else "test"), float(np.log1p(10 + i % 40)), float(i % 40)) for i in range(40)]
    rows = spark.createDataFrame([r for r in plain for _ in range(3)], "row_id string, split string, log_target double, x double")
    found = {r["model"]: r for r in experiment.compare(rows, ["x"], {"Ridge": L.RIDGE}).collect()}
    train = sorted(r[2] for r in plain if r[1] == "train")
    median = float(np.log1p(np.median(np.expm1(train))))
    errors = [abs(np.expm1(median) - np.expm1(r[2])) for r in plain if r[1] == "test"]
    assert found[experiment.BASELINE]["mae"] == pytest.approx(np.mean(errors), rel=1e-6)
    assert found["Ridge"]["mae"] < found[experiment.BASELINE]["mae"]
