"""Views over the supplied tables that give every operator its natural input.

``usage`` reads the order star schema as yearly consumption rows; ``usage_dirty``
adds the nulls, bad values and exact copies that cleaning has to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.session import spread

KEY = ["order_key", "line", "part_key", "supp_key"]
PLAIN = [
    "net_manager", "purchase_area", "city", "num_connections", "delivery_perc",
    "perc_of_active_connections", "type_of_connection", "type_conn_perc", "annual_consume",
    "annual_consume_lowtarif_perc", "smartmeter_perc", "year",
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` on all cores, for work that costs more per row than reading it."""
    return spread(table(spark, sf, "documents"))


def usage(spark: SparkSession, sf: str) -> DataFrame:
    """Clean consumption rows with the key of the line they come from."""
    line = spread(
        table(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
        )
    )
    order = table(spark, sf, "orders")
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    part = table(spark, sf, "part")
    wide = (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    return wide.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_key"),
        F.col("l_suppkey").alias("supp_key"),
        F.col("c_mktsegment").alias("net_manager"),
        F.col("n_name").alias("purchase_area"),
        F.col("o_custkey").cast("string").alias("city"),
        F.col("l_quantity").alias("num_connections"),
        (100 * (1 - F.col("l_discount"))).alias("delivery_perc"),
        (100 * (1 - F.col("l_tax"))).alias("perc_of_active_connections"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("x"), F.col("p_size").cast("string")).alias(
            "type_of_connection"
        ),
        F.col("p_size").cast("double").alias("type_conn_perc"),
        F.col("l_extendedprice").alias("annual_consume"),
        (F.col("l_discount") * 1000).alias("annual_consume_lowtarif_perc"),
        (F.col("l_tax") * 1000).alias("smartmeter_perc"),
        F.year("o_orderdate").alias("year"),
    )


USAGE_SQL = """usage AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line, l_partkey AS part_key, l_suppkey AS supp_key,
         c_mktsegment AS net_manager, n_name AS purchase_area, CAST(o_custkey AS VARCHAR) AS city,
         l_quantity AS num_connections, 100 * (1 - l_discount) AS delivery_perc,
         100 * (1 - l_tax) AS perc_of_active_connections,
         concat(CAST(l_linenumber AS VARCHAR), 'x', CAST(p_size AS VARCHAR)) AS type_of_connection,
         CAST(p_size AS DOUBLE) AS type_conn_perc, l_extendedprice AS annual_consume,
         l_discount * 1000 AS annual_consume_lowtarif_perc, l_tax * 1000 AS smartmeter_perc,
         CAST(year(o_orderdate) AS INTEGER) AS year
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""


def usage_dirty(spark: SparkSession, sf: str) -> DataFrame:
    """``usage`` with missing, impossible and repeated rows."""
    base = usage(spark, sf)
    line, tax, disc = F.col("line"), F.col("smartmeter_perc"), F.col("annual_consume_lowtarif_perc")
    bad = base.select(
        *KEY,
        "net_manager",
        F.when(F.col("purchase_area") != "NATION_3", F.col("purchase_area")).alias("purchase_area"),
        "city",
        F.when((line == 3) & (tax > 75), F.lit(None))
        .when((line == 4) & (tax > 75), F.lit(0.0))
        .otherwise(F.col("num_connections"))
        .alias("num_connections"),
        F.when((line == 5) & (disc > 95), F.lit(110.0))
        .when((line == 6) & (disc > 95), F.lit(None))
        .otherwise(F.col("delivery_perc"))
        .alias("delivery_perc"),
        "perc_of_active_connections",
        F.when((line == 7) & (F.col("type_conn_perc") > 45), F.lit("onbekend"))
        .when((line == 7) & (F.col("type_conn_perc") < 5), F.lit(None))
        .otherwise(F.concat(F.lit(" "), F.col("type_of_connection"), F.lit(" A")))
        .alias("type_of_connection"),
        "type_conn_perc",
        F.when((line == 1) & (tax > 75), F.lit(None))
        .when((line == 2) & (tax > 75), -F.col("annual_consume"))
        .otherwise(F.col("annual_consume"))
        .alias("annual_consume"),
        "annual_consume_lowtarif_perc",
        F.when((line == 1) & (disc > 95), F.lit(-1.0)).otherwise(tax).alias("smartmeter_perc"),
        "year",
    )
    twice = (F.col("net_manager") == "BUILDING") & (F.col("line") == 2)
    copies = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return bad.select("*", F.explode(copies).alias("copy")).drop("copy")


DIRTY_SQL = USAGE_SQL + """, bad AS (
  SELECT order_key, line, part_key, supp_key, net_manager,
         CASE WHEN purchase_area <> 'NATION_3' THEN purchase_area END AS purchase_area, city,
         CASE WHEN line = 3 AND smartmeter_perc > 75 THEN NULL WHEN line = 4 AND smartmeter_perc > 75 THEN 0.0
              ELSE num_connections END AS num_connections,
         CASE WHEN line = 5 AND annual_consume_lowtarif_perc > 95 THEN 110.0
              WHEN line = 6 AND annual_consume_lowtarif_perc > 95 THEN NULL ELSE delivery_perc END AS delivery_perc,
         perc_of_active_connections,
         CASE WHEN line = 7 AND type_conn_perc > 45 THEN 'onbekend' WHEN line = 7 AND type_conn_perc < 5 THEN NULL
              ELSE ' ' || type_of_connection || ' A' END AS type_of_connection,
         type_conn_perc,
         CASE WHEN line = 1 AND smartmeter_perc > 75 THEN NULL WHEN line = 2 AND smartmeter_perc > 75
              THEN -annual_consume ELSE annual_consume END AS annual_consume,
         annual_consume_lowtarif_perc,
         CASE WHEN line = 1 AND annual_consume_lowtarif_perc > 95 THEN -1.0 ELSE smartmeter_perc END AS smartmeter_perc,
         year
  FROM usage),
dirty AS (SELECT * FROM bad UNION ALL SELECT * FROM bad WHERE net_manager = 'BUILDING' AND line = 2)"""
