"""Text-shaped views over the supplied tables: markdown documents, runs, raw model answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.functions import text as T
from wattmill.plans.views import table, texts
from wattmill.session import spread

PROJECT = "consumo"
EXPERIMENT = "treino"

# --- SQL counterparts of the text helpers -----------------------------------------------------
_WS_SQL = " || ".join(f"chr({ord(c)})" for c in T.WHITESPACE)


def sql_strip(expr: str) -> str:
    return f"trim({expr}, {_WS_SQL})"


def sql_drop_ids(expr: str) -> str:
    hexed = f"(^|[^{T.WORD}])[a-fA-F0-9]{{32}}($|[^{T.WORD}])"
    text = f"regexp_replace({expr}, '(?i){T.RUN_ID_LINE}', '', 'g')"
    return f"regexp_replace(regexp_replace({text}, '{hexed}', '\\1\\2', 'g'), '{hexed}', '\\1\\2', 'g')"


def sql_redact(expr: str) -> str:
    return sql_strip(f"regexp_replace({sql_drop_ids(expr)}, '[{T.WS}]{{2,}}', ' ', 'g')")


def sql_strip_artifacts(expr: str) -> str:
    text = f"regexp_replace({expr}, '(?s){T.CHANNEL_THOUGHT}', '', 'g')"
    for tag in T.THINKING_TAGS:
        text = f"regexp_replace({text}, '(?s)<{tag}>.*?</{tag}>', '', 'g')"
        text = f"regexp_replace({text}, '(?s)<{tag}>.*', '', 'g')"
    text = f"regexp_replace({text}, '(?s){T.TOOL_CALL}', '', 'g')"
    return sql_strip(f"regexp_replace({text}, '(?s){T.PIPED_TOOL_CALL}', '', 'g')")


def sql_sanitize(expr: str) -> str:
    text = f"regexp_replace({sql_strip_artifacts(expr)}, '(?i){T.SOURCE_TAG}', '', 'g')"
    text = f"regexp_replace({sql_drop_ids(text)}, '[{T.WS}]{{2,}}', ' ', 'g')"
    return sql_strip(f"regexp_replace({text}, '[{T.WS}]+([.,;])', '\\1', 'g')")


def sql_unify_lines(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '{T.LINE_BREAK}', chr(10), 'g'), '\\n\\z', '')"


def sql_cut_at_word(expr: str, limit: int = T.MAX_TEXT) -> str:
    bare = sql_strip(expr)
    return f"""(SELECT CASE WHEN length(b) <= {limit} THEN b ELSE {sql_strip(
        f"left(b, CASE WHEN strpos(reverse(left(b, {limit})), ' ') = 0 THEN {limit} ELSE {limit} - strpos(reverse(left(b, {limit})), ' ') END)"
    )} END FROM (SELECT {bare} AS b))"""


# --- markdown documents -----------------------------------------------------------------------
#: Lines that begin with one of these letters get the heading before them.
HEADINGS = {
    "E": "## Limpeza de dados",
    "T": "### Feature Engineering silver",
    "D": "## Divisão dos Dados",
    "L": "## 3. Pré-processamento Pós-Split",
}


def markdown_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as markdown: title, timestamp heading, then its whole text under headings."""
    body = F.col("text")
    for letter, heading in HEADINGS.items():
        body = F.regexp_replace(body, f"\n({letter})", f"\n{heading}\n$1")
    return texts(spark, sf).select(
        "doc_id",
        F.when(F.col("lang") == "en", "mlflow_metadata").when(F.col("lang") == "fr", "silver_governance")
        .otherwise("gold_governance").alias("source"),
        F.concat(
            F.lit("# Documento "), F.col("source"), F.lit(" "), F.col("lang"),
            F.lit("\r\n## Processado em: 2024-05-01T10:"), F.col("doc_id").cast("string"), F.lit("\n\n---\n\n"), body,
        ).alias("text"),
    )


_BODY = "text"
for _letter, _heading in HEADINGS.items():
    _BODY = f"regexp_replace({_BODY}, '\\n({_letter})', chr(10) || '{_heading}' || chr(10) || '\\1', 'g')"
MARKDOWN_SQL = f"""md AS (
  SELECT doc_id, CASE lang WHEN 'en' THEN 'mlflow_metadata' WHEN 'fr' THEN 'silver_governance' ELSE 'gold_governance' END AS source,
    '# Documento ' || source || ' ' || lang || chr(13) || chr(10) || '## Processado em: 2024-05-01T10:' || doc_id || chr(10) || chr(10)
      || '---' || chr(10) || chr(10) || {_BODY} AS text
  FROM documents)"""
SECTION_SQL = MARKDOWN_SQL + f""", cut AS (
  SELECT doc_id, source, string_split(regexp_replace({sql_unify_lines('text')}, '\\n(#{{2,3}}[{T.WS_IN_LINE}])', chr(1) || '\\1', 'g'), chr(1)) AS parts
  FROM md),
sec AS (SELECT doc_id, source, CAST(k - 1 AS INTEGER) AS section_no, parts[k] AS section
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS k FROM cut))"""
PIECE_SQL = f"""pieces AS (
  SELECT id, -1 AS piece_no, CAST(NULL AS VARCHAR) AS piece, body AS rest, length(body) <= {T.MAX_CHUNK} AS short FROM src
  UNION ALL
  SELECT id, piece_no + 1,
    CASE WHEN length(rest) <= {T.MAX_CHUNK} THEN rest ELSE {sql_strip('left(rest, cut_at)')} END,
    CASE WHEN length(rest) <= {T.MAX_CHUNK} THEN '' ELSE {sql_strip('substr(rest, cut_at + 1)')} END, FALSE
  FROM (SELECT *, CASE WHEN strpos(reverse(left(rest, {T.MAX_CHUNK})), ' ') = 0 THEN {T.MAX_CHUNK}
          ELSE {T.MAX_CHUNK} - strpos(reverse(left(rest, {T.MAX_CHUNK})), ' ') END AS cut_at FROM pieces)
  WHERE rest <> '' OR (short AND piece_no = -1))"""


# --- runs -------------------------------------------------------------------------------------
#: Runs in one split: each becomes up to nine texts.
RUNS_PER_TASK = 25_000


def runs_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a wide run table with dotted metric and parameter columns and gaps."""
    price, status, rank = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderpriority")
    return spread(table(spark, sf, "orders"), RUNS_PER_TASK).select(
        F.md5(F.concat(F.lit("run"), F.col("o_orderkey").cast("string"))).alias("run_id"),
        F.col("o_custkey").alias("response_key"),
        F.when(status == "F", "FINISHED").when(status == "O", "RUNNING").otherwise("FAILED").alias("status"),
        F.concat(F.substring(F.col("o_orderdate").cast("string"), 1, 10), F.lit(" 00:00:00")).alias("start_time"),
        (price / 1009).alias("metrics.rmse"),
        F.when(status != "O", price / 3001).alias("metrics.mae"),
        F.when(rank == "1-URGENT", price / 907).alias("metrics.val_rmse"),
        F.when(rank == "2-HIGH", price / 1103).alias("metrics.test_rmse"),
        F.when(status == "F", F.col("o_custkey") / 10007).alias("metrics.r2"),
        (price / 7001).alias("metrics.train_duration_sec"),
        F.when(status == "P", price / 11003).alias("metrics.aux_loss"),
        F.when(rank != "5-LOW", F.concat(F.lit("Alg-"), F.substring(rank, 1, 1))).alias("params.algorithm"),
        F.col("o_custkey").cast("string").alias("params.n_estimators"),
        F.when(status == "F", F.lit("12")).alias("params.n_features"),
    )


_METRICS = {
    "aux_loss": "CASE WHEN o_orderstatus = 'P' THEN o_totalprice / 11003 END",
    "mae": "CASE WHEN o_orderstatus <> 'O' THEN o_totalprice / 3001 END",
    "r2": "CASE WHEN o_orderstatus = 'F' THEN o_custkey / 10007 END",
    "rmse": "o_totalprice / 1009",
    "test_rmse": "CASE WHEN o_orderpriority = '2-HIGH' THEN o_totalprice / 1103 END",
    "train_duration_sec": "o_totalprice / 7001",
    "val_rmse": "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 907 END",
}
RUNS_SQL = """runs AS (SELECT md5('run' || o_orderkey) AS run_id, o_custkey AS response_key,
   CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
   strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' AS start_time,
   """ + ", ".join(f"round({e}, 4) AS m_{k}" for k, e in _METRICS.items()) + """,
   CASE WHEN o_orderpriority <> '5-LOW' THEN 'Alg-' || left(o_orderpriority, 1) END AS p_algorithm,
   CAST(o_custkey AS VARCHAR) AS p_n_estimators, CASE WHEN o_orderstatus = 'F' THEN '12' END AS p_n_features FROM orders)"""


# --- raw model answers ------------------------------------------------------------------------
def raw_answers(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns dressed up as raw model output: thinking tags, tool calls, source tags, ids."""
    turn, text = F.col("turn"), F.col("text")
    ident = F.md5(F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string")))
    raw = (
        F.when(turn == 0, F.concat(F.lit("<think>plano\n um</think>\n"), text, F.lit(" [silver_governance]  .")))
        .when(turn == 1, F.concat(text, F.lit(" Run ID MLflow: "), ident, F.lit(". RMSE: 0.34 ; "), ident, F.lit("  fim ,"), F.lit(" x"), ident))
        .when(turn == 2, F.concat(F.lit("<|channel>thought\nprimeiro\n\n"), text, F.lit("<tool_call>{}</tool_call>"), text, F.lit("<redacted_thinking>corte")))
        .when(turn == 3, F.concat(text, F.lit("<|tool_call>call<tool_call|> <redacted_thinking> b </redacted_thinking><think>sem fim")))
        .when(turn == 4, F.lit(" Search "))
        .when(turn == 5, F.concat(text, F.lit(". " + T.EMPTY_PHRASE + ". Mais.")))
        .when(turn == 6, F.concat(F.lit("<think>"), text, F.lit("</think>")))
        .otherwise(F.concat(F.lit("Qual o RMSE? "), text))
    )
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", raw.alias("raw"))


ANSWERS_SQL = f"""answers AS (SELECT conv_id, turn, role, CASE
   WHEN turn = 0 THEN '<think>plano' || chr(10) || ' um</think>' || chr(10) || text || ' [silver_governance]  .'
   WHEN turn = 1 THEN text || ' Run ID MLflow: ' || h || '. RMSE: 0.34 ; ' || h || '  fim , x' || h
   WHEN turn = 2 THEN '<|channel>thought' || chr(10) || 'primeiro' || chr(10) || chr(10) || text || '<tool_call>{{}}</tool_call>' || text || '<redacted_thinking>corte'
   WHEN turn = 3 THEN text || '<|tool_call>call<tool_call|> <redacted_thinking> b </redacted_thinking><think>sem fim'
   WHEN turn = 4 THEN ' Search ' WHEN turn = 5 THEN text || '. {T.EMPTY_PHRASE}. Mais.'
   WHEN turn = 6 THEN '<think>' || text || '</think>' ELSE 'Qual o RMSE? ' || text END AS raw
  FROM (SELECT *, md5(conv_id || '-' || turn) AS h FROM conversations))"""
