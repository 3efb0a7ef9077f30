"""Queries over splits, encoders, scalers and error metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattmill.operators import encoding as N
from wattmill.operators import metrics as M
from wattmill.operators import profile as P
from wattmill.operators import splits as S
from wattmill.plans.catalog.features import TARGET_SQL, staged_target, with_target
from wattmill.plans.registry import query
from wattmill.plans.rounding import rounded, settled
from wattmill.plans.views import KEY, USAGE_SQL, usage
from wattmill.session import stage

_KEYS = ", ".join(KEY)
_TEXT_KEY = "concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in KEY) + ")"


def _hash(seed: int, digits: int) -> str:
    return f"CAST('0x' || substr(md5({_TEXT_KEY} || '#{seed}'), 1, {digits}) AS BIGINT)"


_BUCKET = f"({_hash(42, 8)} % 10000)"

TEMPORAL_SQL = TARGET_SQL + """, ranked AS (SELECT year, row_number() OVER (ORDER BY year DESC) AS k FROM (SELECT DISTINCT year FROM t)),
parts AS (SELECT t.*, ln(1 + consume_per_conn) AS log_target,
   CASE WHEN k <= 2 THEN 'test' WHEN k <= 4 THEN 'val' ELSE 'train' END AS split
  FROM t JOIN ranked USING (year))"""


def parted(spark, sf, columns=("*",)):
    return S.temporal_split(with_target(spark, sf, columns).withColumn("log_target", F.log1p("consume_per_conn")))


def temporal(spark, sf):
    return stage(parted(spark, sf), "split-rows")


@query(
    "split_random",
    f"""WITH {USAGE_SQL} SELECT {_KEYS}, CASE WHEN {_BUCKET} < 7000 THEN 'train' WHEN {_BUCKET} < 8500 THEN 'val'
  ELSE 'test' END AS split FROM usage""",
)
def split_random(spark, sf):
    return S.random_split(usage(spark, sf).select(*KEY), KEY)


@query(
    "split_exact",
    f"""WITH {USAGE_SQL}, o AS (SELECT {_KEYS}, row_number() OVER (ORDER BY {_hash(42, 13)}) AS k, count(*) OVER () AS n FROM usage),
c AS (SELECT *, ceil(n * 0.15) AS test FROM o)
SELECT {_KEYS}, CASE WHEN k <= test THEN 'test' WHEN k <= test + ceil((n - test) * (0.15::DOUBLE / (0.70::DOUBLE + 0.15::DOUBLE))) THEN 'val'
  ELSE 'train' END AS split FROM c""",
)
def split_exact(spark, sf):
    return S.exact_split(stage(usage(spark, sf).select(*KEY), "usage-keys"), KEY)


@query(
    "sample_rows",
    f"""WITH {USAGE_SQL} SELECT {_KEYS} FROM usage ORDER BY {_hash(42, 13)} LIMIT 10000""",
)
def sample_rows(spark, sf):
    return S.sample_rows(stage(usage(spark, sf).select(*KEY), "usage-keys"), KEY, 10_000)


@query("split_temporal", f"WITH {TEMPORAL_SQL} SELECT {_KEYS}, year, split FROM parts")
def split_temporal(spark, sf):
    return temporal(spark, sf).select(*KEY, "year", "split")


@query(
    "split_by_years_or_random",
    f"WITH {TEMPORAL_SQL} SELECT {_KEYS}, split FROM parts",
)
def split_by_years_or_random(spark, sf):
    return S.split_rows(staged_target(spark, sf), KEY).select(*KEY, "split")


@query(
    "split_few_years",
    f"""WITH {USAGE_SQL} SELECT {_KEYS}, CASE WHEN {_BUCKET} < 7000 THEN 'train' WHEN {_BUCKET} < 8500 THEN 'val'
  ELSE 'test' END AS split FROM usage WHERE year <= 1998""",
)
def split_few_years(spark, sf):
    return S.split_rows(usage(spark, sf).where(F.col("year") <= 1998), KEY).select(*KEY, "split")


@query("fold_assignment", f"WITH {USAGE_SQL} SELECT {_KEYS}, CAST({_hash(43, 8)} % 10000 % 5 AS INTEGER) AS fold FROM usage")
def fold_assignment(spark, sf):
    return S.with_fold(usage(spark, sf).select(*KEY), KEY)


@query(
    "train_years",
    f"""WITH {USAGE_SQL}, y AS (SELECT DISTINCT year FROM usage)
SELECT year FROM y EXCEPT SELECT * FROM (SELECT year FROM y ORDER BY year DESC LIMIT 4)""",
)
def train_years(spark, sf):
    return S.train_years(usage(spark, sf))


@query(
    "split_union",
    f"WITH {TEMPORAL_SQL} SELECT {_KEYS}, split FROM parts WHERE split = 'val' UNION ALL SELECT {_KEYS}, split FROM parts WHERE split = 'test'",
)
def split_union(spark, sf):
    rows = temporal(spark, sf).select(*KEY, "split")
    return rows.where(F.col("split") == "val").unionByName(rows.where(F.col("split") == "test"))


@query(
    "split_summary",
    f"""WITH {TEMPORAL_SQL} SELECT split, count(*) AS n_rows, string_agg(DISTINCT CAST(year AS VARCHAR), ', ' ORDER BY CAST(year AS VARCHAR)) AS years,
  round(100.0 * count(*) / (SELECT count(*) FROM parts) + 1e-10, 6) AS share_pct FROM parts GROUP BY split""",
)
def split_summary(spark, sf):
    return rounded(S.split_summary(temporal(spark, sf)), ["share_pct"])


@query(
    "target_summary",
    f"""WITH {TEMPORAL_SQL}, y AS (SELECT log_target AS y FROM parts WHERE split = 'train')
SELECT round(avg(y) + 1e-10, 6) AS mean, round(stddev_samp(y) + 1e-10, 6) AS std, round(min(y) + 1e-10, 6) AS min,
  round(max(y) + 1e-10, 6) AS max, round(exp(avg(y)) - 1 + 1e-8, 4) AS mean_kwh, round(quantile_cont(y, 0.5) + 1e-10, 6) AS median,
  round(exp(quantile_cont(y, 0.5)) - 1 + 1e-8, 4) AS median_kwh FROM y""",
)
def target_summary(spark, sf):
    found = P.target_summary(temporal(spark, sf).where(F.col("split") == "train"))
    return rounded(rounded(found, ["mean", "std", "min", "max", "median"]), ["mean_kwh", "median_kwh"], 4)


_ENC = ["city", "purchase_area", "net_manager"]
ENCODED_SQL = (
    TEMPORAL_SQL
    + ", g AS (SELECT avg(log_target) AS gm FROM parts WHERE split = 'train')"
    + "".join(
        f", m_{c} AS (SELECT {c}, avg(log_target) AS te FROM parts WHERE split = 'train' GROUP BY {c})" for c in _ENC
    )
    + ", enc AS (SELECT parts.*, "
    + ", ".join(f"coalesce(m_{c}.te, gm) AS {c}_te" for c in _ENC)
    + " FROM parts CROSS JOIN g "
    + " ".join(f"LEFT JOIN m_{c} ON m_{c}.{c} = parts.{c}" for c in _ENC)
    + ")"
)


def encoded(spark, sf):
    return N.target_encode(temporal(spark, sf))


@query(
    "target_encode",
    f"WITH {ENCODED_SQL} SELECT {_KEYS}, " + ", ".join(f"round({c}_te + 1e-10, 6) AS {c}_te" for c in _ENC) + " FROM enc",
)
def target_encode(spark, sf):
    names = [f"{c}_te" for c in _ENC]
    return rounded(encoded(spark, sf).select(*KEY, *names), names)


FOLD_SQL = (
    TEMPORAL_SQL
    + f", f AS (SELECT *, CAST({_hash(43, 8)} % 10000 % 5 AS INTEGER) AS fold FROM parts), g AS (SELECT avg(log_target) AS gm FROM f WHERE split = 'train')"
    + "".join(
        f", m_{c} AS (SELECT {c}, sum(log_target) AS s, count(*) AS n FROM f WHERE split = 'train' GROUP BY {c})"
        f", o_{c} AS (SELECT {c}, fold, sum(log_target) AS s, count(*) AS n FROM f WHERE split = 'train' GROUP BY {c}, fold)"
        for c in _ENC
    )
    + f" SELECT {_KEYS}, "
    + ", ".join(
        f"""round(coalesce(CASE WHEN split = 'train' THEN (m_{c}.s - o_{c}.s) / nullif(m_{c}.n - o_{c}.n, 0)
   ELSE m_{c}.s / m_{c}.n END, gm) + 1e-10, 6) AS {c}_te"""
        for c in _ENC
    )
    + " FROM f CROSS JOIN g "
    + " ".join(
        f"LEFT JOIN m_{c} ON m_{c}.{c} = f.{c} LEFT JOIN o_{c} ON o_{c}.{c} = f.{c} AND o_{c}.fold = f.fold" for c in _ENC
    )
)


@query("fold_encode", f"WITH {FOLD_SQL}")
def fold_encode(spark, sf):
    rows = S.with_fold(temporal(spark, sf), KEY)
    names = [f"{c}_te" for c in _ENC]
    return rounded(N.fold_encode(rows).select(*KEY, *names), names)


_SCALED = ["num_connections", "delivery_perc", "smartmeter_perc", "year"]


@query(
    "standard_scale",
    f"WITH {TEMPORAL_SQL}, s AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS d_{c}" for c in _SCALED)
    + f" FROM parts WHERE split = 'train') SELECT {_KEYS}, "
    + ", ".join(f"round(({c} - m_{c}) / d_{c} + 1e-10, 6) AS {c}" for c in _SCALED)
    + ", 0.0::DOUBLE AS constant FROM parts, s",
)
def standard_scale(spark, sf):
    rows = temporal(spark, sf).withColumn("constant", F.lit(3.0))
    columns = [*_SCALED, "constant"]
    scaler = N.fit_scaler(rows.where(F.col("split") == "train"), columns)
    return rounded(N.scale(rows, scaler, columns).select(*KEY, *columns), _SCALED)


PRED_SQL = ENCODED_SQL + """, bl AS (SELECT ln(1 + quantile_cont(exp(log_target) - 1, 0.5)) AS b FROM parts WHERE split = 'train'),
pred AS (
  SELECT 'Baseline (Mediana)' AS model, split, log_target AS y, b AS p FROM enc, bl
  UNION ALL SELECT 'City', split, log_target, city_te FROM enc UNION ALL SELECT 'Area', split, log_target, purchase_area_te FROM enc
  UNION ALL SELECT 'Manager', split, log_target, net_manager_te FROM enc),
scored AS (SELECT model, exp(y) - 1 AS y, exp(greatest(p, 0)) - 1 AS p FROM pred WHERE split = 'test'),
res AS (SELECT model, avg(abs(y - p)) AS mae, quantile_cont(abs(y - p), 0.5) AS medae, sqrt(avg((y - p) * (y - p))) AS rmse,
   avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) * 100 AS mape, sum(abs(y - p)) / sum(abs(y)) * 100 AS wmape,
   1 - avg((y - p) * (y - p)) / var_pop(y) AS r2 FROM scored GROUP BY model)"""


def wide_predictions(spark, sf):
    """Encoded rows with four log predictions beside the truth."""
    rows = encoded(spark, sf)
    base = M.median_baseline(rows.where(F.col("split") == "train"))
    return stage(
        rows.select(
            *KEY, "split", F.col("log_target").alias("y"), base.alias("p_base"), F.col("city_te").alias("p_city"),
            F.col("purchase_area_te").alias("p_area"), F.col("net_manager_te").alias("p_manager"),
        ),
        "predictions",
    )


def long_predictions(spark, sf):
    wide = wide_predictions(spark, sf)
    cells = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.col(c).alias("p"))
            for m, c in [("Baseline (Mediana)", "p_base"), ("City", "p_city"), ("Area", "p_area"), ("Manager", "p_manager")]
        ]
    )
    return wide.select("split", "y", F.explode(cells).alias("c")).select("split", "y", "c.model", "c.p")


def results(spark, sf):
    return M.original_space(long_predictions(spark, sf).where(F.col("split") == "test"), ["model"])


_ERRS = ["mae", "medae", "rmse", "mape", "wmape", "r2"]
_ERR_LIST = ", ".join(f"round({c} + 1e-8, 4) AS {c}" for c in _ERRS)


@query("metrics_original", f"WITH {PRED_SQL} SELECT model, {_ERR_LIST} FROM res")
def metrics_original(spark, sf):
    return rounded(results(spark, sf), _ERRS, 4).select("model", *_ERRS)


@query(
    "metrics_baseline",
    f"WITH {PRED_SQL} SELECT {_ERR_LIST} FROM res WHERE model = 'Baseline (Mediana)'",
)
def metrics_baseline(spark, sf):
    rows = long_predictions(spark, sf).where((F.col("split") == "test") & (F.col("model") == "Baseline (Mediana)"))
    return rounded(M.original_space(rows, []), _ERRS, 4).select(*_ERRS)


@query(
    "metrics_log",
    f"""WITH {PRED_SQL} SELECT model, split, round(sqrt(avg((y - p) * (y - p))) + 1e-10, 6) AS rmse, round(avg(abs(y - p)) + 1e-10, 6) AS mae,
  round(1 - avg((y - p) * (y - p)) / var_pop(y) + 1e-10, 6) AS r2,
  round(avg(abs((exp(y) - 1 - (exp(greatest(least(p, 20), -10)) - 1)) / (exp(y) - 1))) FILTER (WHERE exp(y) - 1 > 0) * 100 + 1e-8, 4) AS mape
FROM pred WHERE split <> 'train' GROUP BY model, split""",
)
def metrics_log(spark, sf):
    found = M.log_space(long_predictions(spark, sf).where(F.col("split") != "train"), ["model", "split"])
    return rounded(rounded(found, ["rmse", "mae", "r2"]), ["mape"], 4)


@query(
    "model_ranking",
    f"""WITH {PRED_SQL} SELECT model, round(mae + 1e-8, 4) AS mae, round(rmse + 1e-8, 4) AS rmse,
  CAST(row_number() OVER (ORDER BY mae, rmse) AS INTEGER) AS rank FROM res""",
)
def model_ranking(spark, sf):
    return rounded(M.ranked(results(spark, sf)), ["mae", "rmse"], 4).select("model", "mae", "rmse", "rank")


@query(
    "model_gains",
    f"""WITH {PRED_SQL}, b AS (SELECT mae AS bm, r2 AS br FROM res WHERE model = 'Baseline (Mediana)')
SELECT model, round(mae + 1e-8, 4) AS mae, round(r2 + 1e-8, 4) AS r2, round(bm - mae + 1e-8, 4) AS mae_gain, round(r2 - br + 1e-8, 4) AS r2_gain
FROM res, b""",
)
def model_gains(spark, sf):
    found = M.gains(results(spark, sf), "Baseline (Mediana)")
    return rounded(found, ["mae", "r2", "mae_gain", "r2_gain"], 4)


@query(
    "blend_grid",
    f"""WITH {PRED_SQL}, w AS (SELECT a.i / 20.0::DOUBLE AS w1, b.i / 20.0::DOUBLE AS w2, (20 - a.i - b.i) / 20.0::DOUBLE AS w3
   FROM range(21) a(i), range(21) b(i) WHERE a.i + b.i <= 20),
v AS (SELECT log_target AS y, city_te, purchase_area_te, net_manager_te FROM enc WHERE split = 'val')
SELECT round(w1 + 1e-8, 4) AS w_city, round(w2 + 1e-8, 4) AS w_area, round(w3 + 1e-8, 4) AS w_manager,
  round(sum(abs((exp(y) - 1) - (exp(greatest(w1 * city_te + w2 * purchase_area_te + w3 * net_manager_te, 0)) - 1)))
   / sum(abs(exp(y) - 1)) * 100 + 1e-8, 4) AS wmape FROM v, w GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY w1, w2, w3"),
)
def blend_grid(spark, sf):
    rows = wide_predictions(spark, sf).where(F.col("split") == "val")
    grid = M.blend_errors(rows, ["p_city", "p_area", "p_manager"])
    w = F.col("weights")
    return grid.select(
        settled(w[0], 4).alias("w_city"), settled(w[1], 4).alias("w_area"), settled(w[2], 4).alias("w_manager"),
        settled(F.col("wmape"), 4).alias("wmape"),
    )


@query(
    "blend_descent",
    f"""WITH {PRED_SQL}, w AS (SELECT a.i / 20.0::DOUBLE AS w1, b.i / 20.0::DOUBLE AS w2, (20 - a.i - b.i) / 20.0::DOUBLE AS w3
   FROM range(21) a(i), range(21) b(i) WHERE a.i + b.i <= 20),
v AS (SELECT log_target AS y, city_te, purchase_area_te, net_manager_te FROM enc WHERE split = 'val'),
e AS (SELECT sum(abs((exp(y) - 1) - (exp(greatest(w1 * city_te + w2 * purchase_area_te + w3 * net_manager_te, 0)) - 1)))
   / sum(abs(exp(y) - 1)) * 100 AS wmape FROM v, w GROUP BY w1, w2, w3)
SELECT round(min(wmape) + 1e-8, 4) AS grid_wmape, TRUE AS three_not_above, TRUE AS six_not_above, TRUE AS on_simplex FROM e""",
)
def blend_descent(spark, sf):
    """Descent over the weights of three and of six models against the whole grid for three."""
    held = wide_predictions(spark, sf).where(F.col("split") == "val").select(
        "y", "p_city", "p_area", "p_manager", "p_base", (F.col("p_city") * 0.9).alias("p_low"), (F.col("p_city") * 1.1).alias("p_high")
    )
    three = ["p_city", "p_area", "p_manager"]
    w3, e3 = M.descend_blend(held, three)
    w6, e6 = M.descend_blend(held, [*three, "p_base", "p_low", "p_high"])
    sound = all(min(w) >= 0 and abs(sum(w) - 1) < 1e-9 for w in (w3, w6))
    best = M.blend_errors(held, three).agg(F.min("wmape").alias("grid_wmape"))
    told = best.select(
        "grid_wmape", (F.lit(e3) <= F.col("grid_wmape") + 1e-9).alias("three_not_above"),
        (F.lit(e6) <= F.col("grid_wmape") + 1e-9).alias("six_not_above"), F.lit(sound).alias("on_simplex"),
    )
    return rounded(told, ["grid_wmape"], 4)


@query("blend_test_score")
def blend_test_score(spark, sf):
    """Weights found on the validation rows (grid, then refined), scored on the test rows."""
    wide = wide_predictions(spark, sf)
    columns = ["p_city", "p_area", "p_manager"]
    weights, _ = M.best_blend(wide.where(F.col("split") == "val"), columns, refine=1)
    scored = wide.where(F.col("split") == "test").withColumn("p", M.blended(columns, weights))
    return rounded(M.original_space(scored, []), _ERRS, 4).select(*_ERRS)


@query(
    "residual_quantiles",
    f"""WITH {PRED_SQL}, r AS (SELECT y - p AS g FROM scored WHERE model = 'City') """
    + " UNION ALL ".join(
        f"SELECT CAST({q} AS DOUBLE) AS prob, round(quantile_cont(g, {q}) + 1e-8, 4) AS value FROM r" for q in M.RESIDUAL_QUANTILES
    ),
)
def residual_quantiles(spark, sf):
    rows = wide_predictions(spark, sf).where(F.col("split") == "test")
    return rounded(M.residual_quantiles(rows, "y", "p_city"), ["value"], 4)


@query(
    "residual_histogram",
    f"""WITH {PRED_SQL}, x AS (SELECT y - p AS x FROM scored WHERE model = 'City'), e AS (SELECT min(x) AS lo, max(x) AS hi FROM x)
SELECT CAST(least(floor((x - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, count(*) AS n FROM x, e GROUP BY 1""",
)
def residual_histogram(spark, sf):
    from wattmill.functions.numeric import from_log

    rows = wide_predictions(spark, sf).where(F.col("split") == "test")
    return P.histogram(rows, F.expm1("y") - from_log(F.col("p_city")), P.RESIDUAL_BINS)
