"""Queries over chat logs, hits and extractive answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattmill.functions import text as T
from wattmill.operators import answers as A
from wattmill.operators import chatlog as L
from wattmill.operators import coded_search as Q
from wattmill.operators import retrieval as RT
from wattmill.operators import vectors as V
from wattmill.plans import chat_views as C
from wattmill.plans.registry import query
from wattmill.plans.rounding import rounded, settled
from wattmill.plans.text_views import sql_redact, sql_sanitize, sql_strip, sql_strip_artifacts
from wattmill.plans.views import table, texts
from wattmill.session import spread


# --- the current turn -------------------------------------------------------------------------------
@query("current_turn", f"WITH {C.LOG_SQL} SELECT conv, pos, role, content FROM turn")
def current_turn(spark, sf):
    return L.current_turn(C.message_log(spark, sf), "conv", "pos").select("conv", "pos", "role", "content")


@query(
    "turn_tokens",
    f"""WITH {C.LOG_SQL}, s AS (SELECT conv, CAST(sum(u_in) AS BIGINT) AS i, CAST(sum(u_out) AS BIGINT) AS o, CAST(sum(u_total) AS BIGINT) AS t
   FROM turn WHERE role = 'assistant' AND has_usage GROUP BY conv)
SELECT conv, i AS input_tokens, o AS output_tokens, CASE WHEN t = 0 THEN i + o ELSE t END AS total_tokens FROM s""",
)
def turn_tokens(spark, sf):
    return L.turn_tokens(L.current_turn(C.message_log(spark, sf), "conv", "pos"), "conv")


@query(
    "final_answers",
    f"""WITH {C.LOG_SQL}, a AS (SELECT conv, pos, {sql_strip_artifacts('content')} AS t FROM turn WHERE role = 'assistant'),
b AS (SELECT conv, coalesce(max_by(t, pos) FILTER (WHERE t <> ''), '') AS t FROM a GROUP BY conv)
SELECT conv, {sql_sanitize('t')} AS answer FROM b""",
)
def final_answers(spark, sf):
    return L.final_answers(L.current_turn(C.message_log(spark, sf), "conv", "pos"), "conv", "pos")


@query(
    "search_retry",
    f"""WITH {C.LOG_SQL} SELECT conv, coalesce(regexp_matches(min_by(content, pos) FILTER (WHERE role = 'user'), '(?i){T.NEEDS_SEARCH}')
  AND NOT (bool_or(role = 'tool' OR (role = 'assistant' AND has_tool_calls)) AND bool_or(role = 'tool' AND has_hits)), FALSE) AS retry FROM turn GROUP BY conv""",
)
def search_retry(spark, sf):
    return L.search_retry(L.current_turn(C.message_log(spark, sf), "conv", "pos"), "conv", "pos")


@query(
    "compact_history",
    f"""WITH {C.LOG_SQL}, c AS (SELECT conv, pos, role, CASE WHEN role = 'assistant' THEN {sql_sanitize('content')} ELSE content END AS content
   FROM flagged WHERE (role = 'user' AND NOT internal) OR role = 'assistant')
SELECT * FROM c WHERE role = 'user' OR content <> ''""",
)
def compact_history(spark, sf):
    return L.compact_history(C.message_log(spark, sf)).select("conv", "pos", "role", "content")


@query(
    "message_counts",
    f"WITH {C.LOG_SQL} SELECT conv, count(*) AS messages, count(*) FILTER (WHERE role = 'user') AS user_messages FROM log GROUP BY conv",
)
def message_counts(spark, sf):
    return L.message_counts(C.message_log(spark, sf), "conv")


# --- chat tables ------------------------------------------------------------------------------------
@query(
    "register_rows",
    """SELECT conv_id || ':' || turn AS message_id, 'c' || conv_id AS chat_id, role, text AS content, CAST(NULL AS TIMESTAMP) AS created_at
FROM conversations""",
)
def register_rows(spark, sf):
    return L.register(C.chat_messages(spark, sf), L.MESSAGES).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("legacy_sessions", f"WITH {C.CHAT_SQL} SELECT session_id FROM legacy")
def legacy_sessions(spark, sf):
    return L.legacy_sessions(C.sessions(spark, sf), C.responses(spark, sf), C.chats(spark, sf)).select("session_id")


_NEW_CHAT = "'chat-' || md5(session_id)"


@query(
    "backfill_chats",
    f"""WITH {C.CHAT_SQL} SELECT {_NEW_CHAT} AS chat_id, session_id, 'Imported chat' AS title, input_tokens,
  coalesce(output_tokens, 0) AS output_tokens, total_tokens, message_count FROM legacy""",
)
def backfill_chats(spark, sf):
    return L.backfill(C.sessions(spark, sf), C.responses(spark, sf), C.chats(spark, sf))[0]


@query(
    "backfill_responses",
    f"""WITH {C.CHAT_SQL} SELECT r.response_id, coalesce(r.chat_id, CASE WHEN l.session_id IS NOT NULL THEN 'chat-' || md5(r.session_id) END) AS chat_id
FROM responses r LEFT JOIN legacy l USING (session_id)""",
)
def backfill_responses(spark, sf):
    return L.backfill(C.sessions(spark, sf), C.responses(spark, sf), C.chats(spark, sf))[1].select("response_id", "chat_id")


@query(
    "backfill_messages",
    f"""WITH {C.CHAT_SQL}, m AS (SELECT response_id, {_NEW_CHAT} AS chat_id, user_message, answer FROM responses JOIN legacy USING (session_id))
SELECT response_id || ':0' AS message_id, chat_id, 'user' AS role, user_message AS content FROM m
UNION ALL SELECT response_id || ':1', chat_id, 'assistant', answer FROM m""",
)
def backfill_messages(spark, sf):
    return L.backfill(C.sessions(spark, sf), C.responses(spark, sf), C.chats(spark, sf))[2].drop("created_at")


@query(
    "insert_if_absent",
    f"WITH {C.CHAT_SQL} SELECT DISTINCT 'c' || conv_id AS chat_id FROM talk WHERE 'c' || conv_id NOT IN (SELECT chat_id FROM chats)",
)
def insert_if_absent(spark, sf):
    return L.absent_only(C.chat_messages(spark, sf).select("chat_id"), C.chats(spark, sf), "chat_id")


@query(
    "resolve_chats",
    f"""WITH {C.CHAT_SQL}, req AS (SELECT response_id AS request_id, session_id,
   CASE turn WHEN 1 THEN 'c' || conv_id WHEN 3 THEN 'c' || (conv_id + 3) END AS chat_id FROM responses),
o AS (SELECT req.*, c.session_id AS owner, req.chat_id IS NOT NULL AND (c.session_id IS NULL OR c.session_id = req.session_id) AS keep
  FROM req LEFT JOIN chats c ON c.chat_id = req.chat_id)
SELECT request_id, session_id, CASE WHEN keep THEN chat_id ELSE 'chat-' || md5(session_id || '/' || request_id) END AS chat_id,
  NOT (keep AND owner IS NOT NULL) AS "create" FROM o""",
)
def resolve_chats(spark, sf):
    conv, turn = F.col("conv_id"), F.col("turn")
    asked = F.when(turn == 1, F.concat(F.lit("c"), conv.cast("string"))).when(
        turn == 3, F.concat(F.lit("c"), (conv + 3).cast("string"))
    )
    requests = C.responses(spark, sf).select(F.col("response_id").alias("request_id"), "session_id", asked.alias("chat_id"))
    return L.resolve_chats(requests, C.chats(spark, sf))


@query(
    "ownership",
    f"WITH {C.CHAT_SQL} SELECT response_id, chat_id, session_id FROM responses WHERE (chat_id, session_id) IN (SELECT (chat_id, session_id) FROM chats)",
)
def ownership(spark, sf):
    owners = C.chats(spark, sf).select("chat_id", "session_id")
    return C.responses(spark, sf).join(owners, ["chat_id", "session_id"], "left_semi").select("response_id", "chat_id", "session_id")


@query(
    "auto_titles",
    f"""WITH {C.CHAT_SQL}, f AS (SELECT 'c' || conv_id AS chat_id, min_by(text, turn) AS t FROM talk WHERE role = 'user' GROUP BY conv_id)
SELECT c.chat_id, CASE WHEN lower(title) IN ('new chat', 'novo chat') THEN coalesce(nullif(left({sql_strip('t')}, 50), ''), title) ELSE title END AS title
FROM chats c LEFT JOIN f USING (chat_id)""",
)
def auto_titles(spark, sf):
    return L.auto_titles(C.chats(spark, sf), C.chat_messages(spark, sf), "chat_id", "turn").select("chat_id", "title")


_EVENTS_SQL = """ev AS (SELECT 'c' || conv_id AS chat_id, turn AS event_at, CASE role WHEN 'system' THEN 'New chat' WHEN 'user' THEN text END AS title FROM conversations),
titles AS (SELECT chat_id, coalesce(max_by(left(title, 255), event_at) FILTER (WHERE title IS NOT NULL), 'New chat') AS title, max(event_at) AS updated_at FROM ev GROUP BY chat_id)"""


def _titles(spark, sf):
    title = F.when(F.col("role") == "system", "New chat").when(F.col("role") == "user", F.col("content"))
    return L.chat_titles(C.chat_messages(spark, sf).select("chat_id", F.col("turn").alias("event_at"), title.alias("title")))


@query("chat_titles", f"WITH {_EVENTS_SQL} SELECT * FROM titles")
def chat_titles(spark, sf):
    return _titles(spark, sf)


_TOKENS_SQL = """SELECT {key} AS chat_id, CAST(sum(coalesce(input_tokens, 0)) AS BIGINT) AS input_tokens,
  CAST(sum(coalesce(output_tokens, 0)) AS BIGINT) AS output_tokens, CAST(sum(coalesce(total_tokens, 0)) AS BIGINT) AS total_tokens, count(*) AS {n}
  FROM responses GROUP BY ALL"""


@query("chat_tokens", f"WITH {C.CHAT_SQL} " + _TOKENS_SQL.format(key="'c' || conv_id", n="message_count"))
def chat_tokens(spark, sf):
    return L.chat_tokens(C.responses(spark, sf).withColumn("chat_id", F.concat(F.lit("c"), F.col("conv_id").cast("string"))))


@query(
    "chat_summary",
    f"""WITH {C.CHAT_SQL}, {_EVENTS_SQL}, tk AS ({_TOKENS_SQL.format(key="'c' || conv_id", n="responses")}),
mc AS (SELECT 'c' || conv_id AS chat_id, count(*) AS messages, count(*) FILTER (WHERE role = 'user') AS user_messages FROM talk GROUP BY conv_id)
SELECT chat_id, title, updated_at, coalesce(input_tokens, 0) AS input_tokens, coalesce(output_tokens, 0) AS output_tokens,
  coalesce(total_tokens, 0) AS total_tokens, coalesce(responses, 0) AS responses, coalesce(messages, 0) AS messages, coalesce(user_messages, 0) AS user_messages
FROM titles LEFT JOIN tk USING (chat_id) LEFT JOIN mc USING (chat_id)""",
)
def chat_summary(spark, sf):
    named = C.responses(spark, sf).withColumn("chat_id", F.concat(F.lit("c"), F.col("conv_id").cast("string")))
    return L.chat_summary(_titles(spark, sf), named, C.chat_messages(spark, sf))


@query(
    "chat_facts",
    f"""WITH {C.CHAT_SQL} SELECT response_id, conv_id, turn,
  CAST(sum(coalesce(input_tokens, 0)) OVER w AS BIGINT) AS chat_input_tokens, CAST(sum(coalesce(output_tokens, 0)) OVER w AS BIGINT) AS chat_output_tokens,
  CAST(sum(coalesce(total_tokens, 0)) OVER w AS BIGINT) AS chat_total_tokens, CAST(count(*) OVER w AS BIGINT) AS message_count
FROM responses WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
)
def chat_facts(spark, sf):
    return L.chat_facts(C.responses(spark, sf), "conv_id", "turn").select(
        "response_id", "conv_id", "turn", "chat_input_tokens", "chat_output_tokens", "chat_total_tokens", "message_count"
    )


@query(
    "response_facts",
    f"""WITH {C.CHAT_SQL}, h AS (SELECT 'r' || (l_orderkey // 8) || '-' || (l_orderkey % 8) AS response_id, avg(l_discount * 8) AS d, count(*) AS n FROM lineitem GROUP BY 1)
SELECT r.response_id, input_tokens, output_tokens, total_tokens, CAST(sum(total_tokens) OVER w AS BIGINT) AS chat_total_tokens,
  CAST(count(*) OVER w AS BIGINT) AS message_count, round(CASE WHEN d IS NULL THEN 0.0 ELSE greatest(0.0, least(1.0, 1 - d)) END + 1e-10, 6) AS confidence,
  coalesce(n, 0) AS hit_count FROM responses r LEFT JOIN h USING (response_id) WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""",
)
def response_facts(spark, sf):
    key = F.col("l_orderkey")
    hits = table(spark, sf, "lineitem").select(
        F.concat(F.lit("r"), F.floor(key / 8).cast("string"), F.lit("-"), (key % 8).cast("string")).alias("response_id"),
        (F.col("l_discount") * 8).alias("distance"),
    )
    facts = L.fact_rows(C.responses(spark, sf), hits, "conv_id", "turn").withColumn("confidence", settled(F.col("confidence")))
    return facts.select(
        "response_id", "input_tokens", "output_tokens", "total_tokens", "chat_total_tokens", "message_count", "confidence", "hit_count"
    )


@query(
    "running_event_value",
    """SELECT event_id, user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS cents FROM events""",
)
def running_event_value(spark, sf):
    """The running total of token-like amounts over a log with many blocks per chat."""
    from wattmill.operators.running import running_totals

    rows = table(spark, sf, "events").select("event_id", "user_id", F.round(F.col("value") * 100).cast("long").alias("amount"))
    totals = running_totals(rows, ["user_id"], F.floor(F.col("event_id") / L.RUNNING_BLOCK), ["event_id"], {"cents": "amount"})
    return totals.select("event_id", "user_id", "cents")


@query(
    "newest_chats",
    f"WITH {C.CHAT_SQL} SELECT chat_id, title, updated_at FROM chats WHERE session_id = 's3' ORDER BY updated_at DESC, chat_id",
)
def newest_chats(spark, sf):
    return L.newest_chats(C.chats(spark, sf), "s3").select("chat_id", "title", "updated_at")


@query(
    "oldest_messages",
    "SELECT conv_id || ':' || turn AS message_id, role, text AS content FROM conversations WHERE conv_id = 7 ORDER BY turn, message_id LIMIT 4",
)
def oldest_messages(spark, sf):
    return L.oldest_messages(C.chat_messages(spark, sf), "c7", ["turn", "message_id"], 4).select("message_id", "role", "content")


# --- hits -------------------------------------------------------------------------------------------
@query(
    "confidence",
    f"""WITH {C.LINE_HIT_SQL}, d AS (SELECT response_id, avg(coalesce(distance, 0)) AS d, count(*) AS n FROM hits GROUP BY 1)
SELECT 'o' || o_orderkey AS response_id, round(CASE WHEN d IS NULL THEN 0.0 ELSE greatest(0.0, least(1.0, 1 - d)) END + 1e-10, 6) AS confidence, coalesce(n, 0) AS hit_count
FROM orders LEFT JOIN d ON response_id = 'o' || o_orderkey""",
)
def confidence(spark, sf):
    orders = table(spark, sf, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("response_id"))
    found = L.confidences(orders, C.line_hits(spark, sf))
    return found.select("response_id", settled(F.col("confidence")).alias("confidence"), "hit_count")


@query(
    "response_with_hits",
    f"""WITH {C.LINE_HIT_SQL}, l AS (SELECT response_id, string_agg(source || '/' || text, ';' ORDER BY line, part, supp) AS hits FROM hits GROUP BY 1)
SELECT 'o' || o_orderkey AS response_id, o_orderstatus AS status, hits FROM orders LEFT JOIN l ON response_id = 'o' || o_orderkey""",
)
def response_with_hits(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("response_id"), F.col("o_orderstatus").alias("status")
    )
    found = L.responses_with_hits(orders, C.line_hits(spark, sf), ["line", "part", "supp"], ["source", "text"])
    shown = F.array_join(F.transform("hits", lambda h: F.concat_ws("/", h["source"], h["text"])), ";")
    return found.select("response_id", "status", shown.alias("hits"))


@query(
    "context",
    f"""WITH {C.LINE_HIT_SQL}, b AS (SELECT * FROM hits WHERE text <> '' QUALIFY row_number() OVER (PARTITION BY response_id ORDER BY line, part, supp) <= 12)
SELECT response_id, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY line, part, supp) AS context FROM b GROUP BY 1""",
)
def context(spark, sf):
    return A.context(C.line_hits(spark, sf), "response_id", V.POOL_K, ["line", "part", "supp"])


@query(
    "tool_hits",
    f"""SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, 0.25::DOUBLE AS distance, {sql_redact('text')} AS text, source, 'governance' AS collection FROM documents
WHERE length(text) > 0 UNION ALL
SELECT doc_id, 'x', 0.0, 'segundo', NULL, 'governance' FROM documents WHERE lang = 'en'""",
)
def tool_hits(spark, sf):
    """Tool output as one object, a list, or nested lists, by language, parsed back to hits."""
    hit = F.struct(
        F.col("doc_id").alias("id"), F.lit(0.25).alias("distance"), F.struct(F.col("text").alias("text"), F.col("source").alias("source")).alias("entity")
    )
    flat = F.struct(F.col("doc_id").cast("string").alias("id"), F.lit(0.25).alias("distance"), F.col("text").alias("text"), F.col("source").alias("source"))
    extra = '{"id": "x", "text": "segundo"}, {"id": "y", "entity": {"text": ""}}'
    content = (
        F.when(F.col("lang") == "en", F.concat(F.lit("[["), F.to_json(hit), F.lit(", " + extra + "]]")))
        .when(F.col("lang") == "fr", F.to_json(hit))
        .otherwise(F.concat(F.lit(" ["), F.to_json(flat), F.lit("]")))
    )
    docs = texts(spark, sf).select("doc_id", content.alias("content"))
    return docs.select("doc_id", F.explode(V.flat_hits(V.parse_hits(F.col("content")))).alias("h")).select("doc_id", "h.*")


@query("metric_mentions", f"WITH {C.MENTION_SQL} SELECT response, hit_no, entry FROM firsts")
def metric_mentions(spark, sf):
    return A.metric_mentions(C.run_hits(spark, sf), "response").select("response", "hit_no", "entry")


@query(
    "top_metric_mentions",
    f"""WITH {C.MENTION_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY response ORDER BY hit_no, turn, place) AS rank FROM firsts)
SELECT response, entry, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 4""",
)
def top_metric_mentions(spark, sf):
    found = A.metric_mentions(C.run_hits(spark, sf), "response")
    return A.top_per_response(found, "response", ["hit_no", "turn", "place"], A.TOP_METRICS).select("response", "entry", "rank")


@query(
    "keyword_lines",
    f"""WITH {C.LINE_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY response ORDER BY hit_no, place) AS rank FROM snips)
SELECT response, snippet, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 6""",
)
def keyword_lines(spark, sf):
    found = A.keyword_lines(C.run_hits(spark, sf), "response")
    return A.top_per_response(found, "response", ["hit_no", "place"], A.TOP_LINES).select("response", "snippet", "rank")


@query(
    "fallback_answers",
    f"""WITH {C.MENTION_SQL}, {C.LINE_CTES}, {C.QUESTION_SQL},
ml AS (SELECT response, string_agg(entry, '; ' ORDER BY hit_no, turn, place) AS m FROM (
   SELECT * FROM firsts QUALIFY row_number() OVER (PARTITION BY response ORDER BY hit_no, turn, place) <= 4) GROUP BY 1),
sl AS (SELECT response, left(string_agg(snippet, ' ' ORDER BY hit_no, place), 400) AS s FROM (
   SELECT * FROM snips QUALIFY row_number() OVER (PARTITION BY response ORDER BY hit_no, place) <= 4) GROUP BY 1),
ev AS (SELECT response, arg_min(v, (hit_no, place)) AS e FROM (SELECT *, rtrim({sql_strip("substr(line, strpos(line, ':') + 1)")}, '.') AS v FROM lined
   WHERE contains(lower(line), 'rmse') OR contains(lower(line), 'erro quadrático')) WHERE v <> '' GROUP BY 1),
cl AS (SELECT response, left(array_to_string((list(line ORDER BY place))[1:5], ' '), 400) AS c FROM lined
   WHERE (response, hit_no) IN (SELECT (response, min(hit_no)) FROM rh GROUP BY response) AND line <> '' AND NOT starts_with(line, '|---') GROUP BY 1),
an AS (SELECT qs.response, coalesce(
   CASE WHEN regexp_matches(question, '(?i){T.ASKS_METRICS}') THEN 'O modelo treinado foi XGBoost. Métricas: ' || m || '.' END,
   CASE WHEN regexp_matches(question, '(?i){T.ASKS_PREPARATION}') THEN s END,
   'O modelo treinado é XGBoost e o RMSE na validação foi ' || e || '.', c, '{T.EMPTY_ANSWER}') AS answer
  FROM qs LEFT JOIN ml USING (response) LEFT JOIN sl USING (response) LEFT JOIN ev USING (response) LEFT JOIN cl USING (response))
SELECT * FROM an""",
)
def fallback_answers(spark, sf):
    return A.fallback_answers(C.questions(spark, sf), C.run_hits(spark, sf), "response")


# --- vectors ----------------------------------------------------------------------------------------
_TOPK_SQL = """u AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings),
c AS (SELECT label, i, avg(x) AS m FROM u GROUP BY ALL), q AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY i) AS qv FROM c GROUP BY label),
s AS (SELECT query_id, vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], qv), 9) AS sim FROM embeddings, q),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rank FROM s)"""


def _queries(vectors):
    return V.centroids(vectors, "label", 64)


@query(
    "cosine_top_k",
    f"WITH {_TOPK_SQL} SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(sim + 1e-8, 4) AS similarity, round(1 - sim + 1e-8, 4) AS distance, label FROM k WHERE rank <= 5",
)
def cosine_top_k(spark, sf):
    vectors = table(spark, sf, "embeddings")
    found = V.with_fields(V.cosine_top_k(vectors, _queries(vectors)), vectors, ["label"])
    sim = F.col("similarity")
    return found.select("query_id", "vec_id", "rank", settled(sim, 4).alias("similarity"), settled(1 - sim, 4).alias("distance"), "label")


@query(
    "cosine_top_k_tiled",
    f"WITH {_TOPK_SQL} SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(sim + 1e-8, 4) AS similarity FROM k WHERE rank <= 12",
)
def cosine_top_k_tiled(spark, sf):
    """The way for query sets beyond the broadcast bound, with tiles small enough that several exist."""
    vectors = table(spark, sf, "embeddings")
    found = V.tiled_top_k(vectors, _queries(vectors), V.POOL_K, 10, tile=128)
    return found.select("query_id", "vec_id", "rank", settled(F.col("similarity"), 4).alias("similarity"))


@query("bucketed_top_k")
def bucketed_top_k(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return V.bucketed_top_k(vectors, _queries(vectors))


def _coded(vectors):
    """A coded index and a short list below 5 % of the vectors."""
    short = max(V.TOP_K, (vectors.count() - 1) // 20)
    return Q.search(Q.build(vectors, 64), vectors, _queries(vectors), short=short)


@query(
    "coded_top_k",
    f"WITH {_TOPK_SQL} SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank, round(sim + 1e-8, 4) AS similarity FROM k WHERE rank <= 5",
)
def coded_top_k(spark, sf):
    """Hits of the approximate search; at a recall of one they are the exact ones."""
    found = _coded(table(spark, sf, "embeddings"))
    return found.select("query_id", "vec_id", "rank", settled(F.col("similarity"), 4).alias("similarity"))


@query(
    "coded_recall",
    f"WITH {_TOPK_SQL} SELECT query_id, TRUE AS recall_reached, TRUE AS share_below FROM k WHERE rank <= 5 GROUP BY query_id",
)
def coded_recall(spark, sf):
    """Recall at five of the approximate search against the exact one, and the share of full vectors that it reads, per query."""
    vectors = table(spark, sf, "embeddings")
    total = vectors.count()
    exact = V.cosine_top_k(vectors, _queries(vectors)).select("query_id", "vec_id", F.lit(1).alias("wanted"))
    found = _coded(vectors).select("query_id", "vec_id", "read")
    hits = exact.join(found, ["query_id", "vec_id"], "left").groupBy("query_id").agg(F.count("read").alias("hit"), F.sum("wanted").alias("wanted"), F.max("read").alias("read"))
    return hits.select("query_id", (F.col("hit") >= 0.9 * F.col("wanted")).alias("recall_reached"), (F.col("read") < 0.05 * total).alias("share_below"))


@query("embed_words")
def embed_words(spark, sf):
    return V.embed_words(texts(spark, sf)).select("doc_id", F.size("text_vector").alias("dim"))


@query(
    "split_rejects",
    """SELECT doc_id, length(text) <= 1024 AS accepted FROM documents""",
)
def split_rejects(spark, sf):
    rows = V.embed_words(texts(spark, sf))
    good, bad = V.split_rejects(rows)
    return good.select("doc_id", F.lit(True).alias("accepted")).unionByName(bad.select("doc_id", F.lit(False).alias("accepted")))


# --- questions to hits, context and answers -------------------------------------------------------------
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_counts(df):
    """An encoder that SQL can repeat: how often each letter occurs."""
    count = lambda c: (F.length("text") - F.length(F.replace("text", F.lit(c)))).cast("double")
    return df.withColumn("text_vector", F.array(*[count(c) for c in _LETTERS]))


def _searched(spark, sf):
    docs = spread(texts(spark, sf)).select(F.col("doc_id").cast("string").alias("id"), "text", "source", F.col("doc_id"))
    asked = docs.where("doc_id % 20 = 0").select(F.col("id").alias("question_id"), "text")
    return asked, RT.search(letter_counts(docs), asked, V.TOP_K, letter_counts, len(_LETTERS))


def _letters_sql(text: str) -> str:
    return "[" + ", ".join(f"CAST(length({text}) - length(replace({text}, '{c}', '')) AS DOUBLE)" for c in _LETTERS) + "]"


SEARCH_SQL = f"""v AS (SELECT doc_id, text, source, {_letters_sql('text')} AS v FROM documents WHERE text IS NOT NULL),
q AS (SELECT CAST(doc_id AS VARCHAR) AS question_id, {_letters_sql('text')} AS q FROM documents WHERE doc_id % 20 = 0 AND text IS NOT NULL),
s AS (SELECT question_id, CAST(doc_id AS VARCHAR) AS id, text, source, round(list_cosine_similarity(q, v), 9) AS similarity FROM q, v
  WHERE list_sum(q) > 0 AND list_sum(v) > 0),
hits AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY similarity DESC, id) AS rank FROM s QUALIFY rank <= 5)"""


@query(
    "text_search",
    f"""WITH {SEARCH_SQL} SELECT question_id, CAST(rank AS INTEGER) AS rank, id, round(1 - similarity + 1e-8, 4) AS distance,
  {sql_redact('text')} AS text, source FROM hits WHERE length(text) > 0""",
)
def text_search(spark, sf):
    """Every twentieth document as a question against all documents, with an encoder that SQL can repeat."""
    return rounded(_searched(spark, sf)[1], ["distance"], 4)


@query(
    "question_context",
    f"""WITH {SEARCH_SQL} SELECT question_id, count(id) AS hits,
  md5(string_agg({sql_redact('text')}, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank)) AS context, TRUE AS answered
FROM q LEFT JOIN hits USING (question_id) GROUP BY question_id""",
)
def question_context(spark, sf):
    """The same questions through hits and context to an extract."""
    asked, hits = _searched(spark, sf)
    told = RT.answered(asked, hits, V.TOP_K)
    return told.select("question_id", "hits", F.md5("context").alias("context"), (F.length("answer") > 0).alias("answered"))
