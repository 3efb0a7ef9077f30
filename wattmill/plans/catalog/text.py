"""Queries over documents, runs and raw answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattmill.functions import text as T
from wattmill.functions.binding import computed
from wattmill.operators import chunking as K
from wattmill.operators import runs as R
from wattmill.plans.registry import query
from wattmill.plans.text_views import (
    ANSWERS_SQL, EXPERIMENT, MARKDOWN_SQL, PIECE_SQL, PROJECT, RUNS_SQL, SECTION_SQL, markdown_docs, raw_answers,
    runs_wide, sql_cut_at_word, sql_drop_ids, sql_redact, sql_sanitize, sql_strip, sql_strip_artifacts, sql_unify_lines,
)
from wattmill.plans.views import table, texts

_TITLE = sql_strip(f"regexp_extract({sql_unify_lines('section')}, '(?m)^#{{2,3}}[{T.WS_IN_LINE}]([^\\n]*)', 1)")


@query("markdown_sections", f"WITH {SECTION_SQL} SELECT doc_id, section_no, section, {_TITLE} AS title FROM sec")
def markdown_sections(spark, sf):
    return K.sections(markdown_docs(spark, sf), ["doc_id"]).withColumn("title", T.section_title(F.col("section")))


@query(
    "document_heads",
    f"""WITH {MARKDOWN_SQL} SELECT doc_id, {sql_strip(f"regexp_extract({sql_unify_lines('text')}, '(?m)^# ([^\\n]*)', 1)")} AS title,
  {sql_strip(f"regexp_extract({sql_unify_lines('text')}, '(?m)^## Processado em:([^\\n]*)', 1)")} AS processed_at FROM md""",
)
def document_heads(spark, sf):
    return markdown_docs(spark, sf).select(
        "doc_id", T.document_title(F.col("text")).alias("title"), T.processed_at(F.col("text")).alias("processed_at")
    )


@query(
    "bounded_pieces",
    f"""WITH RECURSIVE src AS (SELECT doc_id AS id, text AS body FROM documents), {PIECE_SQL}
SELECT id AS doc_id, CAST(piece_no AS INTEGER) AS piece_no, piece FROM pieces WHERE piece_no >= 0""",
)
def bounded_pieces(spark, sf):
    return K.pieces(texts(spark, sf), ["doc_id"])


_KEYWORD = "CASE " + " ".join(
    f"WHEN contains(lower(title), '{key}') THEN '{sentence}'" for key, sentence in K.SECTION_SENTENCES.items()
) + f" WHEN source = 'mlflow_metadata' THEN '{K.RUN_SENTENCE.format(project=PROJECT)}' END"
_LOW = f"""(length({sql_strip('text')}) < 80 OR contains(text, '[Aguardando treinamento')
   OR regexp_matches({sql_strip('text')}, '\\A#+ [^\\n]+\\z')
   OR (regexp_matches({sql_strip('text')}, '(?i)processado em:[{T.WS}]*\\p{{Nd}}{{4}}')
       AND length(trim(regexp_replace({sql_strip('text')}, '(?i).*processado em:[^\\n-]*', '', 'g'), ' -')) < 50))"""
CHUNK_SQL = f"""RECURSIVE {SECTION_SQL}, titled AS (SELECT doc_id, source, section_no, section, {_TITLE} AS title FROM sec),
src AS (SELECT doc_id * 1000000 + section_no AS id, section AS body FROM titled), {PIECE_SQL},
rich AS (SELECT doc_id, source, section_no, CAST(piece_no AS INTEGER) AS piece_no,
    {sql_cut_at_word(f"concat_ws(chr(10), {_KEYWORD}, CASE WHEN length(title) > 0 THEN title || '.' END, {sql_strip('piece')})")} AS text
  FROM pieces JOIN titled ON id = doc_id * 1000000 + section_no WHERE piece_no >= 0)"""


@query("markdown_chunks", f"WITH {CHUNK_SQL} SELECT doc_id, source, section_no, piece_no, text FROM rich WHERE NOT {_LOW}")
def markdown_chunks(spark, sf):
    return K.markdown_chunks(markdown_docs(spark, sf), ["doc_id"], PROJECT)


@query(
    "low_value_flags",
    f"WITH {CHUNK_SQL} SELECT {_LOW} AS low_value, count(*) AS n FROM rich GROUP BY 1",
)
def low_value_flags(spark, sf):
    split = K.sections(markdown_docs(spark, sf), ["doc_id", "source"]).withColumn("title", T.section_title(F.col("section")))
    parts = K.pieces(split, ["doc_id", "source", "title"], "section")
    text = K.enrich(F.col("piece"), F.col("source"), F.col("title"), PROJECT)
    rich = computed(parts, ["doc_id"], text=text)
    return rich.groupBy(T.is_low_value(F.col("text")).alias("low_value")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "cut_at_word",
    f"SELECT doc_id, {sql_cut_at_word('text')} AS short FROM documents",
)
def cut_at_word(spark, sf):
    return texts(spark, sf).select("doc_id", T.cut_at_word(F.col("text")).alias("short"))


@query(
    "line_chunks",
    f"""WITH RECURSIVE src AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ls FROM documents),
fold AS (
  SELECT doc_id, 0 AS i, CAST([] AS VARCHAR[]) AS open, CAST(NULL AS VARCHAR) AS chunk FROM src
  UNION ALL
  SELECT doc_id, i + 1,
    CASE WHEN full_up THEN list_append((
        SELECT open[j + 1:] FROM range(0, len(open) + 1) r(j)
        WHERE (CASE WHEN j = len(open) THEN 0 ELSE length(array_to_string(open[j + 1:], chr(10))) END) <= 20
          AND (j = len(open) OR length(array_to_string(open[j + 1:], chr(10))) + length(line) + 1 <= 500)
        ORDER BY j LIMIT 1), line) ELSE list_append(open, line) END,
    CASE WHEN full_up THEN {sql_strip("array_to_string(open, chr(10))")} END
  FROM (SELECT fold.doc_id, i, open, ls[i + 1] AS line,
          len(open) > 0 AND length(array_to_string(open, chr(10))) + length(ls[i + 1]) + 1 > 500 AS full_up
        FROM fold JOIN src ON fold.doc_id = src.doc_id WHERE i < len(ls)))
SELECT doc_id, chunk FROM fold WHERE chunk <> ''
UNION ALL SELECT f.doc_id, {sql_strip("array_to_string(open, chr(10))")} FROM fold f JOIN src s ON f.doc_id = s.doc_id
WHERE i = len(ls) AND {sql_strip("array_to_string(open, chr(10))")} <> ''""",
)
def line_chunks(spark, sf):
    return texts(spark, sf).select("doc_id", F.explode(K.line_chunks(F.col("text"))).alias("chunk"))


# --- runs -----------------------------------------------------------------------------------------
_M = ["aux_loss", "mae", "r2", "rmse", "test_rmse", "train_duration_sec", "val_rmse"]


def runs(spark, sf):
    wide = runs_wide(spark, sf)
    return R.from_wide(wide)


@query(
    "run_history",
    f"""WITH {RUNS_SQL} SELECT run_id, status, start_time, concat_ws(';', """
    + ", ".join(f"CASE WHEN m_{k} IS NOT NULL THEN '{k}=' || m_{k} END" for k in _M)
    + """) AS metrics, concat_ws(';', 'algorithm=' || p_algorithm, 'n_estimators=' || p_n_estimators, 'n_features=' || p_n_features) AS params
FROM runs ORDER BY start_time DESC, run_id LIMIT 20""",
)
def run_history(spark, sf):
    def listed(entries, text):
        pairs = F.transform(F.array_sort(F.map_entries(entries)), lambda e: F.concat(e["key"], F.lit("="), text(e["value"])))
        return F.array_join(pairs, ";")

    return R.newest(runs(spark, sf)).select(
        "run_id", "status", "start_time", listed("metrics", R.shown).alias("metrics"),
        listed("params", lambda v: v).alias("params"),
    )


@query(
    "best_run",
    f"""WITH {RUNS_SQL} SELECT run_id, coalesce(m_val_rmse, m_test_rmse, m_rmse) AS rmse_value FROM runs
ORDER BY rmse_value ASC NULLS LAST, start_time DESC, run_id LIMIT 1""",
)
def best_run(spark, sf):
    return R.best_run(runs(spark, sf)).select("run_id", "rmse_value")


_JSON = (
    "'{' || concat_ws(', ', "
    + ", ".join(f"""CASE WHEN m_{k} IS NOT NULL THEN '"metric_{k}": ' || m_{k} END""" for k in _M)
    + """, CASE WHEN p_algorithm IS NOT NULL THEN '"param_algorithm": "' || p_algorithm || '"' END, '"param_n_estimators": "' || p_n_estimators || '"',
   CASE WHEN p_n_features IS NOT NULL THEN '"param_n_features": "' || p_n_features || '"' END,
   '"run_id": "' || run_id || '"', '"status": "' || status || '"') || '}'"""
)


@query("content_hash", f"WITH {RUNS_SQL} SELECT run_id, sha256({_JSON}) AS content_hash FROM runs")
def content_hash(spark, sf):
    return runs(spark, sf).select(
        "run_id", R.content_hash(F.col("run_id"), F.col("status"), F.col("metrics"), F.col("params")).alias("content_hash")
    )


@query(
    "runs_fingerprint",
    f"""WITH {RUNS_SQL}, n AS (SELECT md5({_JSON} || chr(31) || start_time) AS d FROM runs)
SELECT sha256(count(*) || ':' || coalesce(sum(('0x' || substr(d, 1, 15))::BIGINT), 0) || ':' || coalesce(sum(('0x' || substr(d, 17, 15))::BIGINT), 0)) AS fingerprint
FROM n""",
)
def runs_fingerprint(spark, sf):
    return R.fingerprint(runs(spark, sf))


_LABEL = {k: R.METRIC_LABELS.get(k, k) for k in _M}
_SHOWN = ["val_rmse", "rmse", "mae", "r2", "test_rmse", "aux_loss"]
_HEAD = R.HEADER.format(project=PROJECT)
_BEST = f"""best AS (SELECT run_id AS best_id FROM runs WHERE coalesce(m_val_rmse, m_test_rmse, m_rmse) IS NOT NULL
  ORDER BY coalesce(m_val_rmse, m_test_rmse, m_rmse), start_time DESC, run_id LIMIT 1),
r AS (SELECT runs.*, run_id = best_id AS is_best, coalesce(p_algorithm, 'XGBoost') AS alg FROM runs, best)"""
_SUMMARY = (
    f"concat_ws(chr(10), '{_HEAD}', CASE WHEN is_best THEN '{R.BEST_NOTE}' ELSE '' END || 'Modelos treinados e métricas utilizadas no pipeline {PROJECT}.', "
    "'Modelo treinado: ' || alg || '.', 'Métricas de avaliação do treinamento:', "
    + ", ".join(f"CASE WHEN m_{k} IS NOT NULL THEN '- {_LABEL[k]}: ' || m_{k} END" for k in _SHOWN)
    + ", 'Quais modelos foram treinados e quais métricas foram utilizadas? Resumo de métricas RMSE, MAE, R², MAPE.')"
)
CHUNKS_SQL = (
    f"""{RUNS_SQL}, {_BEST}, parts AS (
  SELECT run_id, 'overview' AS section, '{_HEAD}' || chr(10) || CASE WHEN is_best THEN '{R.BEST_NOTE_OVERVIEW}' ELSE '' END
    || 'Este é um run de treinamento do modelo de machine learning no experimento ''{EXPERIMENT}''.' || chr(10) || 'Run ID MLflow: ' || run_id
    || '. Status: ' || status || '. Data de início: ' || start_time || '.' || chr(10) || 'Algoritmo utilizado: ' || alg
    || '. Treinamento do modelo, experimento MLflow, modelo treinado, run de machine learning.' AS text FROM r
  UNION ALL SELECT run_id, 'metrics_summary', {_SUMMARY} FROM r """
    + " ".join(
        f"""UNION ALL SELECT run_id, 'metric_{k}', '{_HEAD}' || chr(10) || CASE WHEN is_best THEN '{R.BEST_NOTE}' ELSE '' END
    || 'Desempenho do modelo treinado — Run ID: ' || run_id || '.' || chr(10) || 'Modelo: ' || alg || '. Métrica de avaliação do treinamento.' || chr(10)
    || '{_LABEL[k]}: ' || m_{k} || '.' || chr(10) || 'Qual foi o desempenho do modelo? Métrica {k}, {_LABEL[k]}.' FROM r WHERE m_{k} IS NOT NULL"""
        for k in _SHOWN
    )
    + f""" UNION ALL SELECT run_id, 'params', '{_HEAD}' || chr(10) || 'Configuração e hiperparâmetros do treinamento — Run ID: ' || run_id || '.' || chr(10)
    || 'O modelo ' || alg || ' foi configurado com os seguintes parâmetros de treinamento'
    || CASE WHEN p_n_features IS NOT NULL THEN ' O modelo utilizou ' || p_n_features || ' features (variáveis de entrada).' ELSE '' END || ':' || chr(10)
    || 'Hiperparâmetros, configuração do modelo, parâmetros de treinamento:' || chr(10)
    || concat_ws(chr(10), '- algorithm: ' || p_algorithm, '- n_estimators: ' || p_n_estimators, '- n_features: ' || p_n_features) FROM r)"""
)


@query("run_chunks", f"WITH {CHUNKS_SQL} SELECT 'mlflow:' || run_id || ':' || section AS id, section, text, 'mlflow_metadata' AS source FROM parts")
def run_chunks(spark, sf):
    return R.run_chunks(R.with_best(runs(spark, sf)), PROJECT, EXPERIMENT).select("id", "section", "text", "source")


def _bare(expr: str) -> str:
    return f"regexp_replace({expr}, '[{T.WS}]', '', 'g')"


def _same_words(rows, by, order):
    """Digest and length of all pieces of a text put together without white space, and whether each piece keeps to its width."""
    listed = F.array_sort(F.collect_list(F.struct(*order, "body")))
    told = rows.groupBy(*by).agg(F.array_join(F.transform(listed, lambda p: p["body"]), "").alias("all"), F.bool_and(F.length("text") <= T.MAX_TEXT).alias("bounded"))
    bare = F.regexp_replace("all", f"[{T.WS}]", "")
    return told.select(*by, F.md5(bare).alias("digest"), F.length(bare).cast("long").alias("chars"), "bounded")


@query(
    "whole_chunks",
    f"WITH {MARKDOWN_SQL} SELECT doc_id, md5({_bare('text')}) AS digest, length({_bare('text')}) AS chars, TRUE AS bounded FROM md WHERE text IS NOT NULL",
)
def whole_chunks(spark, sf):
    """Every document's words before and after chunking, in order and none missing."""
    return _same_words(K.whole_chunks(markdown_docs(spark, sf), ["doc_id"], PROJECT), ["doc_id"], ["section_no", "piece_no"])


_REST = f"substr(text, {len(_HEAD) + 2})"


@query(
    "whole_run_chunks",
    f"WITH {CHUNKS_SQL} SELECT run_id, section, md5({_bare(_REST)}) AS digest, length({_bare(_REST)}) AS chars, TRUE AS bounded FROM parts",
)
def whole_run_chunks(spark, sf):
    """The same for the texts of every run. Runs meet by id before they become texts, so no text is shuffled."""
    wide = runs_wide(spark, sf)
    history = R.from_wide(wide.repartition(wide.rdd.getNumPartitions(), "run_id"))
    return _same_words(R.whole_run_chunks(R.with_best(history), PROJECT, EXPERIMENT), ["run_id", "section"], ["piece_no"])


@query("metrics_summary", f"WITH {RUNS_SQL}, {_BEST} SELECT run_id, {_SUMMARY} AS text FROM r")
def metrics_summary(spark, sf):
    return R.with_best(runs(spark, sf)).select(
        "run_id", R.metrics_summary(F.col("metrics"), F.col("params"), F.col("is_best"), PROJECT).alias("text")
    )


@query(
    "best_run_text",
    f"""WITH {RUNS_SQL}, b AS (SELECT * FROM runs ORDER BY coalesce(m_val_rmse, m_test_rmse, m_rmse) ASC NULLS LAST, start_time DESC, run_id LIMIT 1)
SELECT concat_ws(chr(10), 'Melhor run de treinamento (ID: ' || run_id || '):', '  Status: ' || status, '  Data: ' || start_time,
  '  Métricas:', """
    + ", ".join(f"CASE WHEN m_{k} IS NOT NULL THEN '    {k}: ' || m_{k} END" for k in _M)
    + """, '  Parâmetros:', '    algorithm: ' || p_algorithm, '    n_estimators: ' || p_n_estimators, '    n_features: ' || p_n_features) AS text FROM b""",
)
def best_run_text(spark, sf):
    return R.best_run_text(runs(spark, sf))


@query(
    "redact",
    f"WITH {CHUNKS_SQL} SELECT 'mlflow:' || run_id || ':' || section AS id, {sql_redact('text')} AS text FROM parts",
)
def redact(spark, sf):
    return R.run_chunks(R.with_best(runs(spark, sf)), PROJECT, EXPERIMENT).select("id", T.redact(F.col("text")).alias("text"))


# --- raw answers ------------------------------------------------------------------------------------
@query("sanitize", f"WITH {ANSWERS_SQL} SELECT conv_id, turn, {sql_sanitize('raw')} AS answer FROM answers")
def sanitize(spark, sf):
    return raw_answers(spark, sf).select("conv_id", "turn", T.sanitize(F.col("raw")).alias("answer"))


@query("strip_artifacts", f"WITH {ANSWERS_SQL} SELECT conv_id, turn, {sql_strip_artifacts('raw')} AS answer FROM answers")
def strip_artifacts(spark, sf):
    return raw_answers(spark, sf).select("conv_id", "turn", T.strip_artifacts(F.col("raw")).alias("answer"))


_BLOCKS = " || ".join(
    f"list_filter(list_transform(regexp_extract_all(raw, '(?s){p}', 1), lambda x: {sql_strip('x')}), lambda x: x <> '')"
    for p in [T.CHANNEL_THOUGHT, *[f"<{t}>(.*?)</{t}>" for t in T.THINKING_TAGS]]
)


@query(
    "thinking",
    f"WITH {ANSWERS_SQL} SELECT conv_id, turn, coalesce(array_to_string({_BLOCKS}, chr(10)), '') AS thinking FROM answers",
)
def thinking(spark, sf):
    return raw_answers(spark, sf).select("conv_id", "turn", F.array_join(T.thinking_blocks(F.col("raw")), "\n").alias("thinking"))


@query(
    "question_classes",
    f"""WITH q AS (SELECT doc_id AS id, 'doc' AS kind, text FROM documents UNION ALL
   SELECT turn + 100 * conv_id, 'chat', 'Qual o ' || CASE turn WHEN 0 THEN 'RMSE' WHEN 2 THEN 'PRÉ-PROCESSAMENTO' WHEN 4 THEN 'tempo' ELSE 'Métrica' END || ' ' || text FROM conversations)
SELECT id, kind, regexp_matches(text, '(?i){T.NEEDS_SEARCH}') AS needs_search, regexp_matches(text, '(?i){T.ASKS_METRICS}') AS asks_metrics,
  regexp_matches(text, '(?i){T.ASKS_PREPARATION}') AS asks_preparation FROM q""",
)
def question_classes(spark, sf):
    docs = texts(spark, sf).select(F.col("doc_id").alias("id"), F.lit("doc").alias("kind"), "text")
    turn = F.col("turn")
    word = F.when(turn == 0, "RMSE").when(turn == 2, "PRÉ-PROCESSAMENTO").when(turn == 4, "tempo").otherwise("Métrica")
    chat = table(spark, sf, "conversations").select(
        (turn + 100 * F.col("conv_id")).alias("id"), F.lit("chat").alias("kind"),
        F.concat(F.lit("Qual o "), word, F.lit(" "), F.col("text")).alias("text"),
    )
    text = F.col("text")
    return docs.unionByName(chat).select(
        "id", "kind", T.needs_search(text).alias("needs_search"), T.asks_metrics(text).alias("asks_metrics"),
        T.asks_preparation(text).alias("asks_preparation"),
    )


@query(
    "bogus_answers",
    f"""WITH {ANSWERS_SQL}, c AS (SELECT conv_id, turn, lower({sql_strip_artifacts('raw')}) AS a FROM answers)
SELECT conv_id, turn, a = '' OR a = 'search' OR contains(a, '<think>') OR contains(a, '<redacted_thinking>')
  OR (contains(a, 'chame a ferramenta') AND contains(a, 'search')) OR contains(a, 'minha primeira ação') OR contains(a, 'query será') AS bogus FROM c""",
)
def bogus_answers(spark, sf):
    return raw_answers(spark, sf).select("conv_id", "turn", T.is_bogus(F.col("raw")).alias("bogus"))


@query(
    "refine_answer",
    f"""WITH {ANSWERS_SQL}, h AS (SELECT *, rtrim({sql_strip(f"string_split(raw, '{T.EMPTY_PHRASE}')[1]")}, '.') AS head FROM answers),
k AS (SELECT conv_id, turn, CASE WHEN contains(raw, '{T.EMPTY_PHRASE}') AND length(head) > 40 THEN head || '.' ELSE raw END AS t FROM h)
SELECT conv_id, turn, {sql_sanitize('t')} AS answer FROM k""",
)
def refine_answer(spark, sf):
    return raw_answers(spark, sf).select("conv_id", "turn", T.refine_answer(F.col("raw")).alias("answer"))


@query(
    "replace_placeholder",
    f"""WITH {MARKDOWN_SQL}, d AS (SELECT doc_id, text || chr(10) || '## 7. Modelo (preenchido após treinamento)' || chr(10) || '[Aguardando treinamento MLflow]' AS t FROM md)
SELECT doc_id, replace(t, '## 7. Modelo (preenchido após treinamento)' || chr(10) || '[Aguardando treinamento MLflow]', '## 7. Modelo' || chr(10) || 'Algoritmo: gbt') AS text FROM d""",
)
def replace_placeholder(spark, sf):
    from wattmill.operators.reports import MODEL_PLACEHOLDER, fill_placeholder

    docs = markdown_docs(spark, sf).select("doc_id", F.concat("text", F.lit("\n" + MODEL_PLACEHOLDER)).alias("text"))
    return docs.select("doc_id", fill_placeholder(F.col("text"), F.lit("Algoritmo: gbt")).alias("text"))
