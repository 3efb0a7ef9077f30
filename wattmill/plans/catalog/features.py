"""Queries over features, lags and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattmill.functions.numeric import from_log, CLIP_TRAIN
from wattmill.operators import cleaning as C
from wattmill.operators import features as X
from wattmill.operators import profile as P
from wattmill.plans.catalog.cleaning import ALL, SILVER_SQL
from wattmill.plans.registry import query
from wattmill.plans.rounding import rounded, settled
from wattmill.plans.views import DIRTY_SQL, KEY, USAGE_SQL, usage, usage_dirty
from wattmill.session import stage

#: One row per consumption line with the exploration target, as SQL and as a frame.
TARGET_SQL = USAGE_SQL + """, t0 AS (SELECT *, annual_consume / num_connections AS consume_per_conn FROM usage),
t AS (SELECT * FROM t0 WHERE consume_per_conn BETWEEN 0 AND (SELECT quantile_cont(consume_per_conn, 0.995) FROM t0))"""

LAG_SQL = TARGET_SQL + """, cy AS (SELECT city, year, avg(consume_per_conn) AS m FROM t GROUP BY city, year),
nat AS (SELECT year, avg(consume_per_conn) AS national_year_mean FROM t GROUP BY year),
roll AS (SELECT city, year, avg(m) OVER (PARTITION BY city ORDER BY year ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS r FROM cy),
lagged AS (SELECT t.*, a.m AS city_lag1_mean, b.m AS city_lag2_mean, roll.r AS city_rolling_mean3,
   nat.national_year_mean, a.m - nat.national_year_mean AS city_vs_national
  FROM t LEFT JOIN cy a ON a.city = t.city AND a.year = t.year - 1
         LEFT JOIN cy b ON b.city = t.city AND b.year = t.year - 2
         LEFT JOIN roll ON roll.city = t.city AND roll.year = t.year
         LEFT JOIN nat ON nat.year = t.year)"""




def with_target(spark, sf, columns=("*",)):
    """Usage rows (or what is wanted of them) written once, then cut at the quantile of the target."""
    return X.exploration_target(stage(usage(spark, sf).select(*columns), "usage-rows"))


def staged_target(spark, sf):
    """The same, written once because several scans follow."""
    return stage(with_target(spark, sf), "target-rows")


@query(
    "usage_city_year",
    f"""WITH {SILVER_SQL}, cy AS (SELECT city, year, avg(consume_per_conn) AS m, count(*) AS n FROM silver GROUP BY city, year)
SELECT cy.city, cy.year, round(cy.m + 1e-8, 4) AS mean_kwh, cy.n AS n_rows, round(p.m + 1e-8, 4) AS last_year_mean_kwh
FROM cy LEFT JOIN cy p ON p.city = cy.city AND p.year = cy.year - 1""",
)
def usage_city_year(spark, sf):
    """Mean consumption per connection by city and year after cleaning, last year's beside it."""
    from pyspark.sql import Window as W

    valid = stage(C.apply_rules(usage_dirty(spark, sf).select(*ALL)), "valid-rows")
    silver = X.silver_features(C.below_quantile(valid, "annual_consume"))
    means = X.group_means(silver, ["city", "year"])
    before = W.partitionBy("city").orderBy("year").rangeBetween(-1, -1)
    return means.select(
        "city",
        "year",
        settled(F.col("mean"), 4).alias("mean_kwh"),
        "n_rows",
        settled(F.avg("mean").over(before), 4).alias("last_year_mean_kwh"),
    )


@query(
    "silver_features",
    f"""WITH {SILVER_SQL} SELECT order_key, line, part_key, supp_key, amperage, round(consume_per_conn + 1e-10, 6) AS consume_per_conn,
  total_capacity, round(hightarif_perc + 1e-10, 6) AS hightarif_perc, round(log_target + 1e-10, 6) AS log_target FROM silver""",
)
def silver_features(spark, sf):
    valid = stage(C.apply_rules(usage_dirty(spark, sf).select(*ALL)), "valid-rows")
    silver = X.silver_features(C.below_quantile(valid, "annual_consume"))
    return rounded(
        silver.select(*KEY, "amperage", "consume_per_conn", "total_capacity", "hightarif_perc", "log_target"),
        ["consume_per_conn", "hightarif_perc", "log_target"],
    )


@query(
    "amperage",
    f"""WITH {DIRTY_SQL} SELECT type_of_connection,
  try_cast(nullif(regexp_extract(trim(type_of_connection), '^([0-9]+)x([0-9]+)', 1), '') AS DOUBLE)
   * try_cast(nullif(regexp_extract(trim(type_of_connection), '^([0-9]+)x([0-9]+)', 2), '') AS DOUBLE) AS amperage,
  count(*) AS n FROM dirty GROUP BY 1, 2""",
)
def amperage(spark, sf):
    from wattmill.functions.numeric import amperage as amps

    rows = usage_dirty(spark, sf)
    return (
        rows.groupBy("type_of_connection")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("type_of_connection", amps(F.col("type_of_connection")).alias("amperage"), "n")
    )


@query(
    "trend_features",
    f"""WITH {TARGET_SQL}, e AS (SELECT min(year) AS lo, max(year) AS hi FROM t),
a AS (SELECT t.*, ln(1 + num_connections) AS log_num_connections,
    num_connections * perc_of_active_connections / 100.0 AS active_connections,
    num_connections * smartmeter_perc / 100.0 AS smartmeter_connections,
    (year - lo)::DOUBLE / nullif(hi - lo, 0) AS year_trend, line * type_conn_perc * num_connections AS total_capacity
   FROM t, e)
SELECT order_key, line, part_key, supp_key, round(log_num_connections + 1e-10, 6) AS log_num_connections,
  round(active_connections + 1e-10, 6) AS active_connections, round(smartmeter_connections + 1e-10, 6) AS smartmeter_connections,
  round(year_trend + 1e-10, 6) AS year_trend, round(smartmeter_perc * year_trend + 1e-10, 6) AS smart_x_trend,
  round(total_capacity * year_trend + 1e-10, 6) AS capacity_x_trend FROM a""",
)
def trend_features(spark, sf):
    rows = X.trend_features(X.base_features(with_target(spark, sf)))
    names = [
        "log_num_connections", "active_connections", "smartmeter_connections", "year_trend", "smart_x_trend",
        "capacity_x_trend",
    ]
    return rounded(rows.select(*KEY, *names), names)


@query(
    "group_mean_city",
    f"WITH {TARGET_SQL} SELECT city, round(avg(consume_per_conn) + 1e-8, 4) AS mean, count(*) AS n_rows FROM t GROUP BY city",
)
def group_mean_city(spark, sf):
    return rounded(X.group_means(with_target(spark, sf), ["city"]), ["mean"], 4)


@query(
    "group_mean_city_year",
    f"""WITH {TARGET_SQL} SELECT city, year, round(avg(consume_per_conn) + 1e-8, 4) AS mean, count(*) AS n_rows
  FROM t GROUP BY city, year""",
)
def group_mean_city_year(spark, sf):
    return rounded(X.group_means(with_target(spark, sf), ["city", "year"]), ["mean"], 4)


@query(
    "group_mean_year",
    f"WITH {TARGET_SQL} SELECT year, round(avg(consume_per_conn) + 1e-8, 4) AS mean, count(*) AS n_rows FROM t GROUP BY year",
)
def group_mean_year(spark, sf):
    return rounded(X.group_means(with_target(spark, sf), ["year"]), ["mean"], 4)


_LAGS = ["city_lag1_mean", "city_lag2_mean", "city_rolling_mean3", "national_year_mean", "city_vs_national"]
_LAG_LIST = ", ".join(f"round({c} + 1e-8, 4) AS {c}" for c in _LAGS)


@query("lag_columns", f"WITH {LAG_SQL} SELECT order_key, line, part_key, supp_key, {_LAG_LIST} FROM lagged")
def lag_columns(spark, sf):
    return rounded(X.lag_features(staged_target(spark, sf), fill=False).select(*KEY, *_LAGS), _LAGS, 4)


@query(
    "lag_filled",
    f"""WITH {LAG_SQL}, m AS (SELECT quantile_cont(consume_per_conn, 0.5) AS med FROM t)
SELECT order_key, line, part_key, supp_key, round(coalesce(city_lag1_mean, med) + 1e-8, 4) AS city_lag1_mean,
  round(coalesce(city_lag2_mean, med) + 1e-8, 4) AS city_lag2_mean, round(coalesce(city_rolling_mean3, med) + 1e-8, 4) AS city_rolling_mean3,
  round(coalesce(city_vs_national, 0) + 1e-8, 4) AS city_vs_national FROM lagged, m""",
)
def lag_filled(spark, sf):
    names = [*X.LAG_COLUMNS, "city_vs_national"]
    return rounded(X.lag_features(staged_target(spark, sf)).select(*KEY, *names), names, 4)


@query(
    "lag_filled_train_fit",
    f"""WITH {LAG_SQL}, m AS (SELECT quantile_cont(consume_per_conn, 0.5) AS med FROM t WHERE year <= 1999)
SELECT order_key, line, part_key, supp_key, round(coalesce(city_lag1_mean, med) + 1e-8, 4) AS city_lag1_mean,
  round(coalesce(city_lag2_mean, med) + 1e-8, 4) AS city_lag2_mean, round(coalesce(city_rolling_mean3, med) + 1e-8, 4) AS city_rolling_mean3,
  round(coalesce(city_vs_national, 0) + 1e-8, 4) AS city_vs_national FROM lagged, m""",
)
def lag_filled_train_fit(spark, sf):
    names = [*X.LAG_COLUMNS, "city_vs_national"]
    rows = staged_target(spark, sf)
    return rounded(X.lag_features(rows, fit=rows.where(F.col("year") <= 1999)).select(*KEY, *names), names, 4)


@query(
    "inverse_transform",
    f"""WITH {TARGET_SQL}, p AS (SELECT order_key, line, part_key, supp_key, ln(1 + consume_per_conn) - 7.0 AS p FROM t)
SELECT order_key, line, part_key, supp_key, round(exp(greatest(p, 0.0)) - 1 + 1e-8, 4) AS from_zero,
  round(exp(greatest(least(p, 20.0), -10.0)) - 1 + 1e-8, 4) AS both_sides FROM p""",
)
def inverse_transform(spark, sf):
    rows = with_target(spark, sf).withColumn("p", F.log1p("consume_per_conn") - 7.0)
    return rows.select(
        *KEY,
        settled(from_log(F.col("p")), 4).alias("from_zero"),
        settled(from_log(F.col("p"), CLIP_TRAIN), 4).alias("both_sides"),
    )


_CARD = ["net_manager", "purchase_area", "city", "type_of_connection"]


@query(
    "cardinality",
    "WITH " + DIRTY_SQL + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS item, CAST(count(DISTINCT {c}) AS DOUBLE) AS value FROM dirty" for c in _CARD
    ),
)
def cardinality(spark, sf):
    return P.cardinality(usage_dirty(spark, sf), _CARD)


@query(
    "multi_year_cities",
    f"""WITH {USAGE_SQL}, c AS (SELECT city, count(DISTINCT year) AS n FROM usage GROUP BY city)
SELECT count(*) AS cities, count(*) FILTER (WHERE n > 1) AS multi_year_cities,
  CAST(quantile_cont(n, 0.5) AS DOUBLE) AS median_years, CAST(quantile_cont(n, 0.95) AS DOUBLE) AS p95_years FROM c""",
)
def multi_year_cities(spark, sf):
    return P.multi_year_cities(usage(spark, sf))


@query(
    "median_by_manager",
    f"""WITH {TARGET_SQL} SELECT net_manager, round(quantile_cont(consume_per_conn, 0.5) + 1e-10, 6) AS median
  FROM t GROUP BY net_manager""",
)
def median_by_manager(spark, sf):
    return rounded(P.median_by(staged_target(spark, sf), "net_manager", "consume_per_conn"), ["median"])


@query(
    "median_by_city",
    f"""WITH {TARGET_SQL} SELECT city, round(quantile_cont(consume_per_conn, 0.5) + 1e-10, 6) AS median FROM t GROUP BY city""",
)
def median_by_city(spark, sf):
    return rounded(P.median_by(staged_target(spark, sf), "city", "consume_per_conn"), ["median"])


@query("rows_per_year", f"WITH {USAGE_SQL} SELECT year, count(*) AS n FROM usage GROUP BY year")
def rows_per_year(spark, sf):
    return P.rows_per_year(usage(spark, sf))


_MISS = ["purchase_area", "num_connections", "delivery_perc", "type_of_connection", "annual_consume", "year"]


@query(
    "missing_share",
    "WITH " + DIRTY_SQL + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS item, round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*) + 1e-10, 6) AS value FROM dirty"
        for c in _MISS
    ),
)
def missing_share(spark, sf):
    return rounded(P.missing_share(usage_dirty(spark, sf), _MISS), ["value"])


def _describe_sql(column: str, percentiles) -> str:
    plain = [
        f"SELECT '{column}' AS item, '{m}' AS metric, round(CAST({f} AS DOUBLE) + 1e-8, 4) AS value FROM t"
        for m, f in [
            ("count", f"count({column})"), ("mean", f"avg({column})"), ("std", f"stddev_samp({column})"),
            ("min", f"min({column})"), ("max", f"max({column})"),
        ]
    ]
    ranked = [
        f"SELECT '{column}', '{p * 100:g}%', round(quantile_cont({column}, {p}) + 1e-8, 4) FROM t" for p in percentiles
    ]
    return " UNION ALL ".join(plain + ranked)


@query(
    "describe_summary",
    f"""WITH {TARGET_SQL} {_describe_sql('annual_consume', P.SUMMARY_PERCENTILES)}
  UNION ALL {_describe_sql('consume_per_conn', P.SUMMARY_PERCENTILES)}""",
)
def describe_summary(spark, sf):
    rows = staged_target(spark, sf)
    wanted = {c: F.col(c) for c in ["annual_consume", "consume_per_conn"]}
    return rounded(P.describe(rows, wanted, P.SUMMARY_PERCENTILES), ["value"], 4)


@query("describe_audit", f"WITH {TARGET_SQL} {_describe_sql('annual_consume', P.AUDIT_PERCENTILES)}")
def describe_audit(spark, sf):
    rows = staged_target(spark, sf)
    return rounded(P.describe(rows, {"annual_consume": F.col("annual_consume")}, P.AUDIT_PERCENTILES), ["value"], 4)


_PROFILED = ["annual_consume", "consume_per_conn", "num_connections"]


@query(
    "column_profile",
    f"WITH {TARGET_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS item, '{m}' AS metric, round(CAST({f} AS DOUBLE) + 1e-8, 4) AS value FROM t"
        for c in _PROFILED
        for m, f in [
            ("mean", f"avg({c})"), ("std", f"stddev_samp({c})"), ("min", f"min({c})"),
            ("median", f"quantile_cont({c}, 0.5)"), ("max", f"max({c})"),
        ]
    ),
)
def column_profile(spark, sf):
    return rounded(P.column_profile(staged_target(spark, sf), _PROFILED), ["value"], 4)


@query(
    "coverage",
    f"WITH {USAGE_SQL} SELECT min(year) AS first_year, max(year) AS last_year, max(year) - min(year) + 1 AS span FROM usage",
)
def coverage(spark, sf):
    return P.coverage(usage(spark, sf))


_CORR = ["num_connections", "delivery_perc", "annual_consume", "smartmeter_perc", "year"]


@query(
    "correlations",
    f"WITH {DIRTY_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}) + 1e-10, 6) AS value FROM dirty"
        for i, a in enumerate(_CORR)
        for b in _CORR[i:]
    ),
)
def correlations(spark, sf):
    return rounded(P.correlations(usage_dirty(spark, sf), _CORR), ["value"])


@query(
    "histogram_target",
    f"""WITH {TARGET_SQL}, x AS (SELECT ln(1 + consume_per_conn) AS x FROM t), e AS (SELECT min(x) AS lo, max(x) AS hi FROM x)
SELECT CAST(least(floor((x - lo) / (hi - lo) * 60), 59) AS INTEGER) AS bin, count(*) AS n FROM x, e GROUP BY 1""",
)
def histogram_target(spark, sf):
    return P.histogram(with_target(spark, sf), F.log1p("consume_per_conn"), P.TARGET_BINS)


@query(
    "repeated_share",
    f"""WITH {DIRTY_SQL}, g AS (SELECT count(*) AS n FROM dirty
   GROUP BY net_manager, city, year, num_connections, annual_consume)
SELECT round((sum(n) - count(*)) / sum(n) + 1e-10, 6) AS share FROM g""",
)
def repeated_share(spark, sf):
    keys = ["net_manager", "city", "year", "num_connections", "annual_consume"]
    return rounded(P.repeated_share(usage_dirty(spark, sf), keys), ["share"])


@query(
    "column_agreement",
    f"""WITH {USAGE_SQL}, g AS (SELECT CASE WHEN line = 1 THEN NULL WHEN line = 2 THEN annual_consume
   ELSE annual_consume / num_connections END AS given, annual_consume / num_connections AS again FROM usage)
SELECT round(avg(CASE WHEN given IS NOT NULL THEN 1.0 ELSE 0.0 END) + 1e-10, 6) AS filled_share,
  round(avg(CASE WHEN given IS NULL THEN NULL WHEN abs(given - again) < 1e-3 THEN 1.0 ELSE 0.0 END) + 1e-10, 6) AS match_share FROM g""",
)
def column_agreement(spark, sf):
    again = F.col("annual_consume") / F.col("num_connections")
    given = F.when(F.col("line") == 1, F.lit(None)).when(F.col("line") == 2, F.col("annual_consume")).otherwise(again)
    return rounded(P.agreement(usage(spark, sf), given, again), ["filled_share", "match_share"])
