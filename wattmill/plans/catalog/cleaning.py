"""Queries over the cleaning rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattmill.functions.numeric import clamp, to_number
from wattmill.operators import cleaning as C
from wattmill.operators.quantiles import quantiles
from wattmill.plans.registry import query
from wattmill.plans.rounding import settled
from wattmill.plans.views import DIRTY_SQL, PLAIN, USAGE_SQL, table, usage, usage_dirty
from wattmill.session import stage

ROWS = PLAIN
#: Columns by which a dirty row is told from its copies (all of them, key included).
ALL = ["order_key", "line", "part_key", "supp_key", *PLAIN]

PASS_SQL = """annual_consume > 0 AND num_connections > 0
  AND coalesce(delivery_perc BETWEEN 0 AND 100, TRUE) AND coalesce(perc_of_active_connections BETWEEN 0 AND 100, TRUE)
  AND coalesce(type_conn_perc BETWEEN 0 AND 100, TRUE)
  AND coalesce(annual_consume_lowtarif_perc BETWEEN 0 AND 100, TRUE)
  AND coalesce(smartmeter_perc BETWEEN 0 AND 100, TRUE)"""

SILVER_SQL = DIRTY_SQL + f""", uniq AS (SELECT DISTINCT * FROM dirty),
valid AS (SELECT * FROM uniq WHERE {PASS_SQL}),
cleaned AS (SELECT * FROM valid WHERE annual_consume <= (SELECT quantile_cont(annual_consume, 0.995) FROM valid)),
target AS (SELECT *, annual_consume / nullif(num_connections, 0) AS consume_per_conn FROM cleaned
           WHERE annual_consume / nullif(num_connections, 0) > 0),
kept AS (SELECT * FROM target WHERE consume_per_conn <= (SELECT quantile_cont(consume_per_conn, 0.995) FROM target)),
parsed AS (SELECT *,
   try_cast(nullif(regexp_extract(trim(type_of_connection), '^([0-9]+)x([0-9]+)', 1), '') AS DOUBLE)
     * try_cast(nullif(regexp_extract(trim(type_of_connection), '^([0-9]+)x([0-9]+)', 2), '') AS DOUBLE) AS amperage
   FROM kept),
silver AS (SELECT *, amperage * num_connections AS total_capacity, 100.0 - annual_consume_lowtarif_perc AS hightarif_perc,
                  ln(1 + consume_per_conn) AS log_target FROM parsed)"""


@query(
    "coerce_numbers",
    """SELECT l_orderkey AS order_key, l_linenumber AS line, l_partkey AS part_key,
  CASE WHEN l_linenumber IN (2, 3) THEN NULL ELSE l_quantity END AS num_connections FROM lineitem""",
)
def coerce_numbers(spark, sf):
    text = (
        F.when(F.col("l_linenumber") == 2, F.lit("n/a"))
        .when(F.col("l_linenumber") == 3, F.lit("NaN"))
        .when(F.col("l_linenumber") == 4, F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")))
        .otherwise(F.col("l_quantity").cast("string"))
    )
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_key"),
        to_number(text).alias("num_connections"),
    )


@query("drop_copies", f"WITH {DIRTY_SQL} SELECT DISTINCT {', '.join(ALL)} FROM dirty")
def drop_copies(spark, sf):
    return C.drop_copies(usage_dirty(spark, sf).select(*ALL))


@query("valid_target", f"WITH {DIRTY_SQL} SELECT {', '.join(ALL)} FROM dirty WHERE annual_consume > 0")
def valid_target(spark, sf):
    return usage_dirty(spark, sf).select(*ALL).where(C.valid_target())


@query("valid_count", f"WITH {DIRTY_SQL} SELECT {', '.join(ALL)} FROM dirty WHERE num_connections > 0")
def valid_count(spark, sf):
    return usage_dirty(spark, sf).select(*ALL).where(C.valid_count())


@query(
    "percents_in_range",
    f"""WITH {DIRTY_SQL} SELECT {', '.join(ALL)} FROM dirty
  WHERE (delivery_perc IS NULL OR delivery_perc BETWEEN 0 AND 100)
    AND (perc_of_active_connections IS NULL OR perc_of_active_connections BETWEEN 0 AND 100)
    AND (type_conn_perc IS NULL OR type_conn_perc BETWEEN 0 AND 100)
    AND (annual_consume_lowtarif_perc IS NULL OR annual_consume_lowtarif_perc BETWEEN 0 AND 100)
    AND (smartmeter_perc IS NULL OR smartmeter_perc BETWEEN 0 AND 100)""",
)
def percents_in_range(spark, sf):
    return usage_dirty(spark, sf).select(*ALL).where(C.percents_in_range(C.PERCENTS))


@query(
    "outlier_rule",
    f"""WITH {USAGE_SQL} SELECT {', '.join(ALL)} FROM usage
  WHERE annual_consume <= (SELECT quantile_cont(annual_consume, 0.995) FROM usage)""",
)
def outlier_rule(spark, sf):
    return C.below_quantile(stage(usage(spark, sf).select(*ALL), "usage-rows"), "annual_consume")


@query(
    "outlier_rule_derived",
    f"""WITH {USAGE_SQL}, t AS (SELECT {', '.join(ALL)}, annual_consume / num_connections AS consume_per_conn FROM usage)
  SELECT * REPLACE (round(consume_per_conn + 1e-10, 6) AS consume_per_conn) FROM t
  WHERE consume_per_conn BETWEEN 0 AND (SELECT quantile_cont(consume_per_conn, 0.995) FROM t)""",
)
def outlier_rule_derived(spark, sf):
    from wattmill.operators.features import exploration_target

    return exploration_target(stage(usage(spark, sf).select(*ALL), "usage-rows")).withColumn(
        "consume_per_conn", settled(F.col("consume_per_conn"))
    )


@query(
    "outlier_rule_train_fit",
    f"""WITH {USAGE_SQL} SELECT {', '.join(ALL)} FROM usage
  WHERE annual_consume <= (SELECT quantile_cont(annual_consume, 0.995) FROM usage WHERE year <= 1999)""",
)
def outlier_rule_train_fit(spark, sf):
    rows = stage(usage(spark, sf).select(*ALL), "usage-rows")
    return C.below_quantile(rows, "annual_consume", fit=rows.where(F.col("year") <= 1999))


@query(
    "clean_layered",
    f"WITH {SILVER_SQL} SELECT {', '.join(ALL)} FROM cleaned",
)
def clean_layered(spark, sf):
    return C.clean(usage_dirty(spark, sf).select(*ALL))


@query(
    "clean_exploration",
    f"""WITH {DIRTY_SQL}, v AS (SELECT * FROM dirty WHERE annual_consume > 0)
  SELECT {', '.join(ALL)} FROM v WHERE annual_consume <= (SELECT quantile_cont(annual_consume, 0.995) FROM v)""",
)
def clean_exploration(spark, sf):
    return C.clean(usage_dirty(spark, sf).select(*ALL), C.EXPLORATION)


_REMOVED = [
    ("removed_invalid_consume", "coalesce(annual_consume > 0, FALSE)"),
    ("removed_invalid_connections", "coalesce(num_connections > 0, FALSE)"),
    *[(f"removed_{c}_out_of_range", f"coalesce({c} BETWEEN 0 AND 100, TRUE)") for c in C.PERCENTS],
]
_CASCADE = ", ".join(
    f"count(*) FILTER (WHERE {' AND '.join([f'({p})' for _, p in _REMOVED[:i]] + [f'NOT ({rule})'])}) AS {name}"
    for i, (name, rule) in enumerate(_REMOVED)
)
CASCADE_SQL = f"""WITH {SILVER_SQL}
SELECT (SELECT count(*) FROM dirty) AS initial_rows,
  (SELECT count(*) FROM dirty) - (SELECT count(*) FROM uniq) AS removed_duplicates,
  u.*,
  (SELECT count(*) FROM valid) - (SELECT count(*) FROM cleaned) AS removed_outliers_annual_consume,
  (SELECT round(quantile_cont(annual_consume, 0.995), 2) FROM valid) AS outlier_threshold_annual_consume_kwh,
  (SELECT count(*) FROM cleaned) AS rows_after_cleaning,
  (SELECT count(*) FROM target) - (SELECT count(*) FROM kept) AS removed_outliers_consume_per_conn,
  (SELECT round(quantile_cont(consume_per_conn, 0.995), 2) FROM target) AS outlier_threshold_consume_per_conn,
  (SELECT count(*) FROM kept) AS final_rows
FROM (SELECT {_CASCADE} FROM uniq) u"""


@query("cascade_counts", CASCADE_SQL)
def cascade_counts(spark, sf):
    return C.cascade_counts(usage_dirty(spark, sf).select(*ALL), ALL)


@query(
    "drop_missing",
    f"""WITH {DIRTY_SQL} SELECT {', '.join(ALL)} FROM dirty
  WHERE num_connections IS NOT NULL AND delivery_perc IS NOT NULL AND annual_consume IS NOT NULL""",
)
def drop_missing(spark, sf):
    return C.drop_missing(usage_dirty(spark, sf).select(*ALL), ["num_connections", "delivery_perc", "annual_consume"])


@query(
    "missing_counts",
    f"""WITH {DIRTY_SQL}, c AS (
  SELECT 'purchase_area' AS item, count(*) FILTER (WHERE purchase_area IS NULL) AS missing, count(*) AS total FROM dirty
  UNION ALL SELECT 'num_connections', count(*) FILTER (WHERE num_connections IS NULL), count(*) FROM dirty
  UNION ALL SELECT 'delivery_perc', count(*) FILTER (WHERE delivery_perc IS NULL), count(*) FROM dirty
  UNION ALL SELECT 'type_of_connection', count(*) FILTER (WHERE type_of_connection IS NULL), count(*) FROM dirty
  UNION ALL SELECT 'city', count(*) FILTER (WHERE city IS NULL), count(*) FROM dirty)
SELECT * FROM c WHERE missing > 0""",
)
def missing_counts(spark, sf):
    return C.missing_counts(
        usage_dirty(spark, sf),
        ["purchase_area", "num_connections", "delivery_perc", "type_of_connection", "city"],
    )


@query(
    "feature_selection",
    f"""WITH {USAGE_SQL}, s AS (SELECT
   count(DISTINCT num_connections) > 1 AS a, count(DISTINCT delivery_perc) > 1 AS b, count(DISTINCT year) > 1 AS c,
   FALSE AS d FROM usage)
SELECT 'num_connections' AS item, a AS varies FROM s UNION ALL SELECT 'delivery_perc', b FROM s
UNION ALL SELECT 'year', c FROM s UNION ALL SELECT 'constant', d FROM s""",
)
def feature_selection(spark, sf):
    rows = usage(spark, sf).withColumn("constant", F.lit(1.0))
    return C.spread_of(rows, ["num_connections", "delivery_perc", "year", "constant"])


@query(
    "projection",
    f"""WITH {USAGE_SQL} SELECT order_key, line, part_key, city AS place, annual_consume AS kwh, year FROM usage""",
)
def projection(spark, sf):
    rows = usage(spark, sf).withColumnRenamed("city", "place").withColumnRenamed("annual_consume", "kwh")
    return rows.select("order_key", "line", "part_key", "place", "kwh", "year")


@query(
    "year_membership",
    f"""WITH {USAGE_SQL}, last2 AS (SELECT DISTINCT year FROM usage ORDER BY year DESC LIMIT 2)
  SELECT {', '.join(ALL)} FROM usage WHERE year IN (SELECT year FROM last2)""",
)
def year_membership(spark, sf):
    from wattmill.operators.splits import year_list

    rows = usage(spark, sf).select(*ALL)
    return rows.where(F.array_contains(F.slice(year_list(rows), 1, 2), F.col("year")))


@query(
    "conform_schema",
    f"""WITH {USAGE_SQL} SELECT order_key, line, part_key, city, CAST(num_connections AS DOUBLE) AS num_connections,
  CAST(NULL AS VARCHAR) AS zipcode_from, CAST(year AS SMALLINT) AS year FROM usage""",
)
def conform_schema(spark, sf):
    from pyspark.sql import types as T

    wanted = T.StructType(
        [
            T.StructField("order_key", T.LongType()),
            T.StructField("line", T.IntegerType()),
            T.StructField("part_key", T.LongType()),
            T.StructField("city", T.StringType()),
            T.StructField("num_connections", T.DoubleType()),
            T.StructField("zipcode_from", T.StringType()),
            T.StructField("year", T.ShortType()),
        ]
    )
    return C.conform(usage(spark, sf), wanted)


@query(
    "clamp_round_cut",
    """SELECT l_orderkey AS order_key, l_linenumber AS line, l_partkey AS part_key,
  greatest(0.0, least(1.0, l_quantity / 30 - 0.2)) AS unit, round(l_extendedprice / 7, 3) AS price3,
  left(l_returnflag || l_linestatus || 'abcdef', 5) AS label FROM lineitem""",
)
def clamp_round_cut(spark, sf):
    line = table(spark, sf, "lineitem")
    return line.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_key"),
        clamp(F.col("l_quantity") / 30 - 0.2, 0.0, 1.0).alias("unit"),
        F.round(F.col("l_extendedprice") / 7, 3).alias("price3"),
        F.left(F.concat("l_returnflag", "l_linestatus", F.lit("abcdef")), F.lit(5)).alias("label"),
    )


@query(
    "exact_quantiles",
    f"""WITH {USAGE_SQL} SELECT round(quantile_cont(annual_consume, 0.005) + 1e-10, 6) AS p005,
   round(quantile_cont(annual_consume, 0.5) + 1e-10, 6) AS p50,
   round(quantile_cont(annual_consume, 0.995) + 1e-10, 6) AS p995,
   quantile_cont(num_connections, 0.95) AS conn95 FROM usage""",
)
def exact_quantiles(spark, sf):
    use = F.col("annual_consume")
    found = quantiles(
        stage(usage(spark, sf).select("annual_consume", "num_connections"), "usage-rows"),
        {"p005": (use, 0.005), "p50": (use, 0.5), "p995": (use, 0.995), "conn95": (F.col("num_connections"), 0.95)},
    )
    return found.select(
        *[settled(F.col(c)).alias(c) for c in ["p005", "p50", "p995"]], "conn95"
    )
