"""Chat-shaped views: message logs from ``events``, chat tables from ``conversations``, hits from order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.functions import text as T
from wattmill.plans.text_views import _WS_SQL, PROJECT, runs_wide
from wattmill.plans.views import table


def message_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a message log per user with tool rows, internal prompts and token usage."""
    kind, value, props = F.col("event_type"), F.col("value"), F.col("props")
    asked = (
        F.when(value > 40, F.concat(F.lit(T.RETRY_PREFIX + " com query "), props))
        .when(kind == "signup", F.concat(F.lit("Qual o rmse? "), props))
        .otherwise(F.concat(F.lit("Bom dia "), props))
    )
    said = F.when(value > 30, F.concat(F.lit("<think>"), props, F.lit("</think>"))).otherwise(
        F.concat(F.lit("Resposta "), props, F.lit(" [gold_governance] ."))
    )
    in_t, out_t = F.floor(value * 10).cast("long"), F.floor(value).cast("long")
    usage = F.when(
        kind.isin("view", "error") & (value <= 25),
        F.struct(
            in_t.alias("input_tokens"), out_t.alias("output_tokens"),
            F.when(value < 5, F.lit(0)).otherwise(in_t + out_t).cast("long").alias("total_tokens"),
        ),
    )
    return table(spark, sf, "events").select(
        F.col("user_id").alias("conv"), F.col("event_id").alias("pos"),
        F.when(kind.isin("signup", "click"), "user").when(kind == "purchase", "tool").otherwise("assistant").alias("role"),
        F.when(kind.isin("signup", "click"), asked).when(kind == "view", said).when(kind == "purchase", props).otherwise("").alias("content"),
        (kind == "error").alias("has_tool_calls"), (value < 20).alias("has_hits"), usage.alias("usage"),
    )


LOG_SQL = f"""log AS (SELECT user_id AS conv, event_id AS pos,
   CASE WHEN event_type IN ('signup', 'click') THEN 'user' WHEN event_type = 'purchase' THEN 'tool' ELSE 'assistant' END AS role,
   CASE WHEN event_type IN ('signup', 'click') THEN CASE WHEN value > 40 THEN '{T.RETRY_PREFIX} com query ' || props
          WHEN event_type = 'signup' THEN 'Qual o rmse? ' || props ELSE 'Bom dia ' || props END
        WHEN event_type = 'view' THEN CASE WHEN value > 30 THEN '<think>' || props || '</think>' ELSE 'Resposta ' || props || ' [gold_governance] .' END
        WHEN event_type = 'purchase' THEN props ELSE '' END AS content,
   event_type = 'error' AS has_tool_calls, value < 20 AS has_hits,
   event_type IN ('view', 'error') AND value <= 25 AS has_usage, CAST(floor(value * 10) AS BIGINT) AS u_in, CAST(floor(value) AS BIGINT) AS u_out,
   CASE WHEN value < 5 THEN 0 ELSE CAST(floor(value * 10) AS BIGINT) + CAST(floor(value) AS BIGINT) END AS u_total FROM events),
flagged AS (SELECT *, role = 'user' AND (starts_with(content, '{T.RETRY_PREFIX}') OR starts_with(content, '{T.FORCED_PREFIX}')) AS internal FROM log),
starts AS (SELECT conv, max(pos) FILTER (WHERE role = 'user' AND NOT internal) AS start FROM flagged GROUP BY conv),
turn AS (SELECT flagged.* FROM flagged JOIN starts USING (conv) WHERE start IS NULL OR (pos >= start AND NOT internal))"""


def chat_messages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("message_id"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("chat_id"), "role", F.col("text").alias("content"), "turn",
    )


def _session(conv):
    return F.concat(F.lit("s"), F.floor(conv / 4).cast("string"))


def chats(spark: SparkSession, sf: str) -> DataFrame:
    """A chat for every conversation that has a system message."""
    rows = table(spark, sf, "conversations").where(F.col("role") == "system")
    return rows.groupBy("conv_id").agg(F.max("turn").alias("updated_at")).select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("chat_id"), _session(F.col("conv_id")).alias("session_id"),
        F.when(F.floor(F.col("conv_id") / 2) * 2 == F.col("conv_id"), "New chat").otherwise("Titulo fixo").alias("title"), "updated_at",
    )


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """One response per assistant turn that follows a user turn."""
    talk = table(spark, sf, "conversations")
    asked = talk.where(F.col("role") == "user").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("user_message"))
    said = talk.where(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("answer"))
    with_chat = talk.where(F.col("role") == "system").select("conv_id").distinct().withColumn("has_chat", F.lit(True))
    pairs = said.join(asked, ["conv_id", "turn"]).join(with_chat, "conv_id", "left")
    words = lambda c: F.size(F.split(c, " ")).cast("long")
    return pairs.select(
        F.concat(F.lit("r"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("response_id"),
        _session(F.col("conv_id")).alias("session_id"),
        F.when(F.col("has_chat"), F.concat(F.lit("c"), F.col("conv_id").cast("string"))).alias("chat_id"),
        "user_message", "answer", words("user_message").alias("input_tokens"),
        F.when(F.col("turn") != 3, words("answer")).alias("output_tokens"),
        (words("user_message") + words("answer")).alias("total_tokens"), F.col("turn").alias("created_at"), "conv_id", "turn",
    )


def sessions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").groupBy(_session(F.col("conv_id")).alias("session_id")).agg(
        F.sum(F.size(F.split("text", " "))).cast("long").alias("input_tokens"), F.lit(None).cast("long").alias("output_tokens"),
        F.count(F.lit(1)).alias("total_tokens"), F.count(F.lit(1)).alias("message_count"),
    )


CHAT_SQL = """talk AS (SELECT *, 's' || CAST(conv_id // 4 AS VARCHAR) AS session_id FROM conversations),
chats AS (SELECT 'c' || conv_id AS chat_id, any_value(session_id) AS session_id,
   CASE WHEN conv_id % 2 = 0 THEN 'New chat' ELSE 'Titulo fixo' END AS title, max(turn) AS updated_at
  FROM talk WHERE role = 'system' GROUP BY conv_id),
responses AS (SELECT 'r' || a.conv_id || '-' || a.turn AS response_id, a.session_id,
   CASE WHEN a.conv_id IN (SELECT conv_id FROM talk WHERE role = 'system') THEN 'c' || a.conv_id END AS chat_id,
   u.text AS user_message, a.text AS answer, len(string_split(u.text, ' ')) AS input_tokens,
   CASE WHEN a.turn <> 3 THEN len(string_split(a.text, ' ')) END AS output_tokens,
   len(string_split(u.text, ' ')) + len(string_split(a.text, ' ')) AS total_tokens, a.turn AS created_at, a.conv_id, a.turn
  FROM talk a JOIN talk u ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' AND u.role = 'user'),
sessions AS (SELECT session_id, CAST(sum(len(string_split(text, ' '))) AS BIGINT) AS input_tokens, CAST(NULL AS BIGINT) AS output_tokens,
   count(*) AS total_tokens, count(*) AS message_count FROM talk GROUP BY session_id),
legacy AS (SELECT * FROM sessions s WHERE EXISTS (SELECT 1 FROM responses r WHERE r.session_id = s.session_id)
   AND NOT EXISTS (SELECT 1 FROM chats c WHERE c.session_id = s.session_id))"""


def line_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as the stored hits of a response (the order)."""
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("response_id"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
        F.when(F.col("l_linenumber") != 4, F.col("l_discount") * 8).alias("distance"),
        F.concat_ws(" ", "l_returnflag", "l_linestatus", F.col("l_partkey").cast("string")).alias("text"),
        F.concat(F.lit("src"), F.col("l_linenumber").cast("string")).alias("source"),
    )


LINE_HIT_SQL = """hits AS (SELECT 'o' || l_orderkey AS response_id, l_linenumber AS line, l_partkey AS part, l_suppkey AS supp,
   CASE WHEN l_linenumber <> 4 THEN l_discount * 8 END AS distance, l_returnflag || ' ' || l_linestatus || ' ' || l_partkey AS text,
   'src' || l_linenumber AS source FROM lineitem)"""


def run_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Run texts as search hits of a response (the customer), with preparation lines among them."""
    wide = runs_wide(spark, sf)
    metric = lambda n: F.col(f"`metrics.{n}`")
    four = lambda c: c.cast("decimal(18,4)").cast("string")
    text = F.concat_ws(
        "\n",
        F.lit(f"Resumo {PROJECT}"),
        F.concat(F.lit("- RMSE  na validação: "), four(metric("val_rmse"))),
        F.concat(F.lit("MAE: "), four(metric("mae"))),
        F.concat(F.lit("Valores r2 no teste : "), four(metric("r2"))),
        F.lit("- Limpeza de duplicatas"),
        F.when(F.col("status") == "FINISHED", "Target Encoding aplicado"),
        F.when(F.col("status") == "FAILED", "|--- outlier"),
        F.when(F.col("status") == "RUNNING", "Limpeza de duplicatas"),
        F.concat(F.lit("Registros finais: "), F.col("response_key").cast("string")),
    )
    return wide.select(
        F.col("response_key").alias("response"), F.concat_ws(" ", "start_time", "run_id").alias("hit_no"), text.alias("text")
    )


_D4 = "CAST(CAST({} AS DECIMAL(18,4)) AS VARCHAR)"
RUN_HIT_SQL = f"""rh AS (SELECT o_custkey AS response, strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00 ' || md5('run' || o_orderkey) AS hit_no,
  concat_ws(chr(10), 'Resumo {PROJECT}',
   CASE WHEN o_orderpriority = '1-URGENT' THEN '- RMSE  na validação: ' || {_D4.format('o_totalprice / 907')} END,
   CASE WHEN o_orderstatus <> 'O' THEN 'MAE: ' || {_D4.format('o_totalprice / 3001')} END,
   CASE WHEN o_orderstatus = 'F' THEN 'Valores r2 no teste : ' || {_D4.format('o_custkey / 10007')} END,
   '- Limpeza de duplicatas', CASE o_orderstatus WHEN 'F' THEN 'Target Encoding aplicado' WHEN 'P' THEN '|--- outlier' ELSE 'Limpeza de duplicatas' END,
   'Registros finais: ' || o_custkey) AS text FROM orders)"""


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """One question per customer; every kind occurs."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        key.alias("response"),
        F.when(segment == "BUILDING", "Qual foi o desempenho?").when(segment == "MACHINERY", "Como foi a limpeza?")
        .when(segment == "FURNITURE", "Quem treinou?").otherwise("Bom dia").alias("question"),
    )


QUESTION_SQL = """qs AS (SELECT c_custkey AS response, CASE c_mktsegment WHEN 'BUILDING' THEN 'Qual foi o desempenho?'
   WHEN 'MACHINERY' THEN 'Como foi a limpeza?' WHEN 'FURNITURE' THEN 'Quem treinou?' ELSE 'Bom dia' END AS question, c_mktsegment AS seg FROM customer)"""

_PAT = [
    r"(?im)^[-•]?[{ws}]*((?:RMSE|MAE|R²|MAPE|R2)[^:]{{0,80}}):[{ws}]*([\p{{Nd}}.]+)".format(ws=T.WS),
    r"(?i)((?:RMSE|MAE|R²|MAPE|R2)[^:\n]{{0,80}}):[{ws}]*([\p{{Nd}}.]+)".format(ws=T.WS),
]


def _mention(turn: int) -> str:
    entry = f"regexp_replace(trim(a, {_WS_SQL}), '[{T.WS}]+', ' ', 'g') || ': ' || b"
    return f"""SELECT response, hit_no, {turn} AS turn, place - 1 AS place, {entry} AS entry FROM (
   SELECT response, hit_no, unnest(regexp_extract_all(text, '{_PAT[turn]}', 1)) AS a, unnest(regexp_extract_all(text, '{_PAT[turn]}', 2)) AS b,
     unnest(range(1, len(regexp_extract_all(text, '{_PAT[turn]}', 1)) + 1)) AS place FROM rh)"""


MENTION_SQL = RUN_HIT_SQL + f""", mentions AS ({_mention(0)} UNION ALL {_mention(1)}),
firsts AS (SELECT * FROM mentions WHERE NOT contains(lower(entry), 'duração') AND NOT contains(lower(entry), 'train_duration')
  QUALIFY row_number() OVER (PARTITION BY response, lower(entry) ORDER BY hit_no, turn, place) = 1)"""
LINE_CTES = f"""lined AS (SELECT response, hit_no, k - 1 AS place, trim(ls[k], {_WS_SQL}) AS line FROM (
   SELECT *, unnest(range(1, len(ls) + 1)) AS k FROM (SELECT *, string_split(text, chr(10)) AS ls FROM rh))),
cleaned AS (SELECT *, trim(ltrim(line, '-• '), {_WS_SQL}) AS snippet, regexp_matches(line, '\\A[-•]') AS bullet FROM lined
  WHERE line <> '' AND NOT starts_with(line, '|---') AND regexp_matches(lower(line),
    'limpeza|target encoding|standardscaler|normalização|pré-processamento|duplicat|outlier|removid')),
snips AS (SELECT response, hit_no, place, snippet FROM cleaned
  QUALIFY bullet OR row_number() OVER (PARTITION BY response, snippet ORDER BY hit_no, place) = 1)"""
LINE_SQL = RUN_HIT_SQL + ", " + LINE_CTES
