"""Queries that fit models. SQL cannot express a fit, so most have no checking statement.

The tree counts below are lower than the presets to keep a check run short;
rows and columns are not reduced.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wattmill.operators import boosting as B
from wattmill.operators import encoding as N
from wattmill.operators import features as X
from wattmill.operators import leafwise as W
from wattmill.operators import metrics as M
from wattmill.operators import models as L
from wattmill.operators import splits as S
from wattmill.plans.catalog.features import TARGET_SQL, with_target
from wattmill.plans.catalog.learning import TEMPORAL_SQL, parted, temporal
from wattmill.plans.registry import query
from wattmill.plans.rounding import rounded
from wattmill.plans.views import KEY
from wattmill.session import stage

PLAIN = ["num_connections", "delivery_perc", "perc_of_active_connections", "smartmeter_perc", "year"]
FEATURES = [*PLAIN, "city_te", "purchase_area_te", "net_manager_te"]
_ERRS = ["mae", "medae", "rmse", "mape", "wmape", "r2"]


def training_rows(spark, sf):
    """Encoded and scaled rows. The encoded ones are written once, as every fit makes many passes; scaling is two numbers a column."""
    parts = parted(spark, sf, (*KEY, *N.ENCODED, *PLAIN, "annual_consume"))
    coded = N.fold_encode(S.with_fold(parts, KEY)).select(*KEY, "split", "log_target", *FEATURES)
    rows = stage(coded, "training-rows")
    return N.scale(rows, N.fit_scaler(rows.where(F.col("split") == "train"), FEATURES), FEATURES)


def errors(held):
    """Errors of predictions, written once: four scans follow."""
    return M.original_space(stage(held.select(F.col("log_target").alias("y"), "p"), "predictions"), []).select(*_ERRS)


def scored(spark, sf, settings, validation=False, library=False):
    rows = L.assemble(training_rows(spark, sf), FEATURES)
    if validation:
        fitted = L.fit(
            rows.where(F.col("split") != "test").withColumn("is_val", F.col("split") == "val"), settings, validation="is_val",
            library=library,
        )
    else:
        fitted = L.fit(rows.where(F.col("split") == "train"), settings, library=library)
    return fitted, errors(L.predict(fitted, rows.where(F.col("split") == "test")))


@query("fit_gbt")
def fit_gbt(spark, sf):
    return scored(spark, sf, L.TRAINING_GBT)[1]


@query("fit_gbt_early_stop")
def fit_gbt_early_stop(spark, sf):
    """The preset as it is: 1,200 trees at most, rate 0.02, depth 7, a patience of 60 trees."""
    rows = L.assemble(training_rows(spark, sf), FEATURES)
    done = B.fit_patient(rows.where(F.col("split") == "train"), rows.where(F.col("split") == "val"), L.EARLY_STOP_GBT)
    return errors(L.predict(done.model, rows.where(F.col("split") == "test")))


@query(
    "early_stop_patience",
    f"""WITH {TEMPORAL_SQL} SELECT count(*) AS n_val, TRUE AS same_count, TRUE AS same_error, TRUE AS cut_there, TRUE AS within_patience
FROM parts WHERE split = 'val'""",
)
def early_stop_patience(spark, sf):
    """The preset with a patience of 15 trees for 60: the chosen number of trees and its error against sums over single trees."""
    rows = L.assemble(training_rows(spark, sf), FEATURES)
    train, held = (rows.where(F.col("split") == part) for part in ("train", "val"))
    done = B.fit_patient(train, held, L.EARLY_STOP_GBT, patience=15)
    errors = [r["error"] for r in B.errors_by_prefix(done.whole, held).orderBy("trees").collect()]
    best = B.stopping_point(errors, 15)[0]
    served = L.predict(done.model, held)
    error = F.sqrt(F.avg(F.pow(F.col("log_target") - F.col("p"), 2)))
    return served.agg(
        F.count("p").alias("n_val"),
        F.lit(done.best == best).alias("same_count"),
        (F.abs(error - F.lit(errors[best - 1])) < 1e-9).alias("same_error"),
        F.lit(len(done.model.trees) == best).alias("cut_there"),
        F.lit(min(errors[best : best + 15], default=1e9) >= errors[best - 1]).alias("within_patience"),
    )


@query("fit_gbt_second")
def fit_gbt_second(spark, sf):
    return scored(spark, sf, L.SECOND_GBT.but(trees=20, rate=0.1), validation=True, library=True)[1]


_BINS = 32
_LONG_SQL = " UNION ALL ".join(f"SELECT {i} AS f, '{c}' AS feature, CAST({c} AS DOUBLE) AS x, g FROM r" for i, c in enumerate(PLAIN))


@query(
    "leafwise_first_split",
    f"""WITH {TEMPORAL_SQL}, r AS (SELECT *, log_target - avg(log_target) OVER () AS g FROM parts WHERE split = 'train'),
long AS ({_LONG_SQL}),
cuts AS (SELECT DISTINCT f, unnest(quantile_cont(x, [{", ".join(f"{j / _BINS!r}" for j in range(1, _BINS))}])) AS cut FROM long GROUP BY f),
sums AS (SELECT f, feature, cut, count(*) AS n, sum(g) AS s, count(*) FILTER (WHERE x <= cut) AS nl, sum(g) FILTER (WHERE x <= cut) AS sl
  FROM long JOIN cuts USING (f) GROUP BY f, feature, cut),
gains AS (SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM sums WHERE nl >= 20 AND n - nl >= 20)
SELECT feature, round(cut + 1e-8, 4) AS cut, nl AS n_left, n - nl AS n_right, round(gain + 1e-8, 4) AS gain
FROM gains ORDER BY gains.gain DESC, f, gains.cut LIMIT 1""",
)
def leafwise_first_split(spark, sf):
    """The first split of the leaf-wise trees over all training rows, against every cut of every feature tried one by one."""
    train = temporal(spark, sf).where(F.col("split") == "train")
    model = W.fit_leafwise(train, PLAIN, "log_target", W.Growth(trees=1, leaves=2, min_leaf=20, bins=_BINS))
    tree = model.trees[0]
    feature = PLAIN[int(tree.feature[0])]
    cut = float(model.cuts[int(tree.feature[0])][int(tree.bin[0])])
    low = F.col(feature).cast("double") <= F.lit(cut)
    sides = train.agg(F.count_if(low).alias("n_left"), F.count_if(~low).alias("n_right"))
    found = sides.select(F.lit(feature).alias("feature"), F.lit(cut).alias("cut"), "n_left", "n_right", F.lit(float(tree.gain[0])).alias("gain"))
    return rounded(found, ["cut", "gain"], 4)


@query(
    "leafwise_against_levels",
    f"""WITH {TEMPORAL_SQL} SELECT count(*) AS n_val, TRUE AS same_error, TRUE AS leaves_kept, TRUE AS within_2_pct
FROM parts WHERE split = 'val'""",
)
def leafwise_against_levels(spark, sf):
    """Leaf-wise and level-wise boosting with as many trees (12) at the same rate: the reported validation error against that of the
    served predictions, no tree above its leaves, and an error at most 2 % above the level-wise one."""
    rows = temporal(spark, sf)
    train, held = (rows.where(F.col("split") == part) for part in ("train", "val"))
    growth = W.Growth(trees=12, rate=0.2, leaves=31, depth=L.SECOND_GBT.values["depth"], min_leaf=20, rows=0.8, columns=0.8)
    model = W.fit_leafwise(train, PLAIN, "log_target", growth, validation=held)
    levels = L.fit(L.assemble(train, PLAIN), L.TRAINING_GBT.but(trees=12, rate=0.2))
    rest = L.predict(levels, L.assemble(held, PLAIN)).agg(F.sqrt(F.avg(F.pow(F.col("log_target") - F.col("p"), 2)))).first()[0]
    error = F.sqrt(F.avg(F.pow(F.col("log_target") - F.col("p"), 2)))
    return W.predict(model, held).agg(
        F.count("p").alias("n_val"),
        (F.abs(error - F.lit(model.errors[len(model.trees) - 1])) < 1e-9).alias("same_error"),
        F.lit(all((t.feature >= 0).sum() <= 30 for t in model.trees)).alias("leaves_kept"),
        (error <= F.lit(1.02 * rest)).alias("within_2_pct"),
    )


@query("fit_forest")
def fit_forest(spark, sf):
    rows = training_rows(spark, sf)
    model = L.fit(L.assemble(rows.where(F.col("split") == "train"), FEATURES), L.FOREST)
    return errors(L.predict(model, L.assemble(rows.where(F.col("split") == "test"), FEATURES)))


@query("fit_linear")
def fit_linear(spark, sf):
    return scored(spark, sf, L.LINEAR)[1]


@query("fit_ridge")
def fit_ridge(spark, sf):
    return scored(spark, sf, L.RIDGE)[1]


@query("fit_lasso")
def fit_lasso(spark, sf):
    return scored(spark, sf, L.LASSO)[1]


def _linear_is_optimal(model, train, alpha: float, algorithm: str):
    """Whether the residuals of the training rows meet the optimality condition of the fit.

    Least squares: orthogonal to every feature. Ridge: their product with a feature is alpha times its weight. Lasso: their mean
    product with a feature is alpha towards its weight, and at most alpha where the weight is zero.
    """
    rest = F.col("log_target") - F.col("p")
    sums = train.agg(F.count(F.lit(1)), *[F.sum(rest * F.col(f)) for f in FEATURES], *[F.sum(F.col(f) * F.col(f)) for f in FEATURES]).first()
    n, products, squares = sums[0], sums[1 : 1 + len(FEATURES)], sums[1 + len(FEATURES) :]
    for product, square, weight in zip(products, squares, model.coefficients.toArray(), strict=True):
        slack = 1e-4 * max(1.0, (square * n) ** 0.5)
        if algorithm == "lasso":
            good = abs(product / n) <= alpha * 1.02 + 1e-6 if weight == 0 else abs(product / n - alpha * (1 if weight > 0 else -1)) <= 0.02 * alpha + 1e-6
        else:
            good = abs(product - (alpha * weight if algorithm == "ridge" else 0.0)) <= slack
        if not good:
            return False
    return True


@query(
    "fit_facts",
    f"""WITH {TEMPORAL_SQL} SELECT model, (SELECT count(*) FROM parts WHERE split = 'test') AS n_test, TRUE AS beats_mean, TRUE AS sound
FROM (VALUES ('linear'), ('ridge'), ('lasso'), ('forest'), ('gbt')) m(model)""",
)
def fit_facts(spark, sf):
    """What holds for every right fit over all eight features: a prediction per test row, training error below the mean's, optimality
    of the linear ones and importances that sum to one."""
    rows = L.assemble(training_rows(spark, sf), FEATURES)
    train, out = rows.where(F.col("split") == "train"), []
    for name, settings in [
        ("linear", L.LINEAR), ("ridge", L.RIDGE), ("lasso", L.LASSO), ("forest", L.FOREST.but(trees=20)), ("gbt", L.TRAINING_GBT.but(trees=20))
    ]:
        model = L.fit(train, settings)
        seen = L.predict(model, train)
        error, spread = seen.agg(F.avg(F.pow(F.col("log_target") - F.col("p"), 2)), F.var_pop("log_target")).first()
        if name in ("linear", "ridge", "lasso"):
            sound = _linear_is_optimal(model, seen, settings.values.get("alpha", 0.0), name)
        else:
            sound = abs(float(model.featureImportances.toArray().sum()) - 1) < 1e-9
        held = L.predict(model, rows.where(F.col("split") == "test"))
        out.append(held.where(F.col("p").isNotNull()).agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_test"), F.lit(error < spread).alias("beats_mean"), F.lit(sound).alias("sound")))
    found = out[0]
    for part in out[1:]:
        found = found.unionByName(part)
    return found


@query("lasso_zeroed")
def lasso_zeroed(spark, sf):
    model, _ = scored(spark, sf, L.LASSO)
    return L.zeroed(L.importances(model, FEATURES, spark))


@query("feature_importance")
def feature_importance(spark, sf):
    model, _ = scored(spark, sf, L.TRAINING_GBT.but(trees=5), library=True)
    return L.top_features(L.importances(model, FEATURES, spark), 15)


@query(
    "linear_one_feature",
    f"""WITH {TEMPORAL_SQL}, f AS (SELECT regr_slope(log_target, num_connections) AS b, regr_intercept(log_target, num_connections) AS a
   FROM parts WHERE split = 'train')
SELECT order_key, line, part_key, supp_key, round(a + b * num_connections + 1e-8, 4) AS p FROM parts, f WHERE split = 'test'""",
)
def linear_one_feature(spark, sf):
    """Least squares with one feature, which SQL can state: checks fit and prediction together."""
    rows = L.assemble(temporal(spark, sf).select(*KEY, "split", "log_target", "num_connections"), ["num_connections"])
    model = L.fit(rows.where(F.col("split") == "train"), L.LINEAR)
    return rounded(L.predict(model, rows.where(F.col("split") == "test")).select(*KEY, "p"), ["p"], 4)


@query(
    "ridge_one_feature",
    f"""WITH {TEMPORAL_SQL}, m AS (SELECT avg(num_connections) AS mx, avg(log_target) AS my FROM parts WHERE split = 'train'),
f AS (SELECT sum((num_connections - mx) * (log_target - my)) / (sum((num_connections - mx) * (num_connections - mx)) + 1.0) AS b,
   any_value(mx) AS mx, any_value(my) AS my FROM parts, m WHERE split = 'train')
SELECT order_key, line, part_key, supp_key, round(my + b * (num_connections - mx) + 1e-8, 4) AS p FROM parts, f WHERE split = 'test'""",
)
def ridge_one_feature(spark, sf):
    """Ridge with one feature against its closed form."""
    rows = L.assemble(temporal(spark, sf).select(*KEY, "split", "log_target", "num_connections"), ["num_connections"])
    model = L.fit(rows.where(F.col("split") == "train"), L.RIDGE)
    return rounded(L.predict(model, rows.where(F.col("split") == "test")).select(*KEY, "p"), ["p"], 4)


@query(
    "run_record",
    f"""WITH {TEMPORAL_SQL}, c AS (SELECT split, CAST(count(*) AS VARCHAR) AS n FROM parts GROUP BY split)
SELECT 'linear' AS algorithm, '5' AS n_features, max(n) FILTER (WHERE split = 'train') AS n_train,
  max(n) FILTER (WHERE split = 'val') AS n_val, max(n) FILTER (WHERE split = 'test') AS n_test, CAST(9 AS INTEGER) AS n_metrics FROM c""",
)
def run_record(spark, sf):
    _, record = L.run_record(temporal(spark, sf), L.LINEAR, PLAIN, "run-1")
    p = F.col("params")
    return record.select(
        p["algorithm"].alias("algorithm"), p["n_features"].alias("n_features"), p["n_train"].alias("n_train"),
        p["n_val"].alias("n_val"), p["n_test"].alias("n_test"), F.size("metrics").alias("n_metrics"),
    )


@query("experiment")
def experiment(spark, sf):
    """The exploration run end to end over all usage rows: lags, temporal split, encoders, models, blend, ranking."""
    from wattmill.plans import experiment as E
    from wattmill.plans.views import usage

    rows, names = E.model_rows(usage(spark, sf))
    chosen = {"Ridge": L.RIDGE, "Lasso": L.LASSO, "GBT": L.EARLY_STOP_GBT}
    ranked = E.compare(rows, names, chosen, ["Ridge", "Lasso", "GBT"])
    return rounded(ranked, _ERRS, 4).select("model", *_ERRS, "rank")
