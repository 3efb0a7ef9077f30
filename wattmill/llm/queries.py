"""Named queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.llm import chat, pii, topk, urls
from wattmill.llm.common import table
from wattmill.plans.registry import query

URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: What both turns of conversation -1 say: the template's own control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def _is_kind(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


@query("op1_pii")
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("spans", lambda s: ~s["added"])
    written = F.transform(F.col("base"), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    everything = F.transform(F.col("spans"), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return found.withColumn("base", base).select(
        "doc_id",
        *[F.size(F.filter("base", _is_kind(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(F.array_join(written, ","), 256).alias("base_sha256"),
        F.array_join(everything, ",").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


@query("op2_chat_windows")
def op2_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat.read_back(chat.windows(turns.unionByName(planted)))


def _url_sql() -> str:
    rest = "CASE WHEN url LIKE '%://%' THEN substr(url, position('://' IN url) + 3) ELSE '' END"
    lowered = "translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    fits = []
    for rule, verdict in sorted(URL_RULES, key=lambda r: -len(r[0])):
        host, _, path = rule.partition("/")
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')", rule, verdict))
    case = lambda i, last: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[i]}'" for f in fits) + f" {last} END"
    return f"""
        SELECT page_id, host, path, {case(1, '')} AS rule, {case(2, "ELSE 'allow'")} AS verdict
        FROM (SELECT page_id, {lowered} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
              FROM (SELECT page_id, coalesce({rest}, '') AS rest FROM pages))
    """


@query("op8_url_cascade", _url_sql())
def op8_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages").select("page_id", "url"), URL_RULES).drop("url")


TOP_K_SQL = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    ), scored AS (
        SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.c::DOUBLE[], v.c::DOUBLE[])::BIGINT AS score
        FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) q JOIN v ON q.vec_id <> v.vec_id AND len(q.c) = len(v.c)
    )
    SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
    FROM scored QUALIFY rank <= 5
"""


@query("op10_pivot_top_k", TOP_K_SQL)
def op10_pivot_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.exact_top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, 5)
