"""Chat-log tables: turns, tokens, titles, backfill, response facts.

The log is append-only. What the application updates in place is folded from
events here, so a late or repeated run gives the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as S

from wattmill.functions import text as T
from wattmill.functions.numeric import unit_interval
from wattmill.operators.cleaning import conform
from wattmill.operators.lookup import lookup
from wattmill.operators.running import running_totals

# Table columns and default titles.
_TOKENS = [(c, S.LongType()) for c in ("input_tokens", "output_tokens", "total_tokens")]


def _schema(*fields: tuple[str, S.DataType]) -> S.StructType:
    return S.StructType([S.StructField(n, t) for n, t in fields])


TEXT, STAMP = S.StringType(), S.TimestampType()
SESSIONS = _schema(("session_id", TEXT), *_TOKENS, ("message_count", S.IntegerType()), ("created_at", STAMP), ("updated_at", STAMP))
CHATS = _schema(
    ("chat_id", TEXT), ("session_id", TEXT), ("title", TEXT), *_TOKENS, ("message_count", S.IntegerType()),
    ("created_at", STAMP), ("updated_at", STAMP),
)
MESSAGES = _schema(("message_id", TEXT), ("chat_id", TEXT), ("role", TEXT), ("content", TEXT), ("created_at", STAMP))
RESPONSES = _schema(
    ("response_id", TEXT), ("session_id", TEXT), ("chat_id", TEXT), ("model", TEXT), ("user_message", TEXT), ("answer", TEXT),
    *_TOKENS, ("response_time_seconds", S.DoubleType()), ("confidence_score", S.DoubleType()), ("created_at", STAMP),
)
HITS = _schema(
    ("id", S.LongType()), ("response_id", TEXT), ("milvus_id", TEXT), ("collection", TEXT), ("source", TEXT),
    ("distance", S.DoubleType()), ("text_preview", TEXT),
)
DEFAULT_TITLE = "New chat"
IMPORTED_TITLE = "Imported chat"
RUNNING_BLOCK = 1_000


def register(rows: DataFrame, schema: S.StructType) -> DataFrame:
    """New rows in the shape of a chat table, texts cut to their column width."""
    out = conform(rows, schema)
    widths = {"title": T.TITLE_CHARS, "text_preview": T.PREVIEW_CHARS}
    return out.withColumns({c: F.left(c, F.lit(w)) for c, w in widths.items() if c in out.columns})


def absent_only(new: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """New rows whose key is not stored yet, one per key."""
    return new.dropDuplicates([key]).join(known.select(key), key, "left_anti")


def owned_by(rows: DataFrame, chat_id: str, session_id: str) -> DataFrame:
    """A chat's rows, empty unless the session owns the chat."""
    return rows.where((F.col("chat_id") == chat_id) & (F.col("session_id") == session_id))


def resolve_chats(requests: DataFrame, chats: DataFrame) -> DataFrame:
    """Chat id per request ``(request_id, session_id, chat_id)`` and whether to create it.

    A requested id stays when free or owned by the session; an id owned by
    another session, or none at all, gives a new id derived from the request.
    """
    owners = chats.select("chat_id", F.col("session_id").alias("owner"))
    fresh = F.concat(F.lit("chat-"), F.md5(F.concat_ws("/", "session_id", "request_id")))
    seen = lookup(requests, owners, ["chat_id"])
    keep = F.col("chat_id").isNotNull() & (F.col("owner").isNull() | (F.col("owner") == F.col("session_id")))
    return seen.select(
        "request_id", "session_id", F.when(keep, F.col("chat_id")).otherwise(fresh).alias("chat_id"),
        (~(keep & F.col("owner").isNotNull())).alias("create"),
    )


def legacy_sessions(sessions: DataFrame, responses: DataFrame, chats: DataFrame) -> DataFrame:
    """Sessions that have responses but no chat."""
    answered, known = responses.select("session_id").distinct(), chats.select("session_id").distinct()
    return sessions.join(answered, "session_id", "left_semi").join(known, "session_id", "left_anti").distinct()


def backfill(sessions: DataFrame, responses: DataFrame, chats: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New chats for legacy sessions, all responses with their chat filled in, and the messages behind them.

    Ids are derived from the rows, so repeating the backfill changes nothing.
    """
    legacy = legacy_sessions(sessions, responses, chats)
    made = legacy.select(
        F.concat(F.lit("chat-"), F.md5("session_id")).alias("chat_id"), "session_id", F.lit(IMPORTED_TITLE).alias("title"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("input_tokens", "output_tokens", "total_tokens", "message_count")],
    )
    new_ids = made.select("session_id", F.col("chat_id").alias("_new"))
    joined = lookup(responses, new_ids, ["session_id"])
    filled = joined.withColumn("chat_id", F.coalesce("chat_id", "_new"))
    moved = filled.where(F.col("_new").isNotNull() & (F.col("chat_id") == F.col("_new")))
    said = F.array(
        F.struct(F.lit(0).alias("part"), F.lit("user").alias("role"), F.col("user_message").alias("content")),
        F.struct(F.lit(1).alias("part"), F.lit("assistant").alias("role"), F.col("answer").alias("content")),
    )
    messages = moved.select("response_id", "chat_id", "created_at", F.explode(said).alias("m")).select(
        F.concat_ws(":", "response_id", "m.part").alias("message_id"), "chat_id", "m.role", "m.content", "created_at"
    )
    return made, filled.drop("_new"), messages


# --- the current turn -------------------------------------------------------------------------------
def current_turn(messages: DataFrame, conv: str, pos: str, role: str = "role", content: str = "content") -> DataFrame:
    """Messages from the last real user message on, prompts of the application itself left out.

    The start is an aggregate per conversation that is looked up, not a window
    over it, so a huge conversation never sits in one task.
    """
    asked = (F.col(role) == "user") & ~T.is_internal(F.col(content))
    starts = messages.groupBy(conv).agg(
        F.max(F.when(asked, F.col(pos))).alias("_start"), F.count(F.lit(1)).alias("_rows")
    )
    marked = lookup(messages, starts, [conv], weight="_rows")
    internal = (F.col(role) == "user") & T.is_internal(F.col(content))
    inside = F.col("_start").isNull() | ((F.col(pos) >= F.col("_start")) & ~internal)
    return marked.where(inside).select(*messages.columns)


def final_answers(turn: DataFrame, conv: str, pos: str) -> DataFrame:
    """Last non-empty assistant text of each conversation's turn, artifacts stripped and sanitised."""
    said = turn.where(F.col("role") == "assistant").select(conv, pos, T.strip_artifacts(F.col("content")).alias("_a"))
    last = said.groupBy(conv).agg(F.max_by("_a", F.when(F.length("_a") > 0, F.col(pos))).alias("_a"))
    return last.select(conv, T.sanitize(F.coalesce("_a", F.lit(""))).alias("answer"))


def turn_tokens(turn: DataFrame, conv: str) -> DataFrame:
    """Token sums of the assistant messages that carry usage; a zero total is input plus output."""
    used = turn.where((F.col("role") == "assistant") & F.col("usage").isNotNull())
    parts = {c: F.sum(F.coalesce(F.col("usage")[c], F.lit(0))) for c in ("input_tokens", "output_tokens", "total_tokens")}
    sums = used.groupBy(conv).agg(*[e.cast("long").alias(c) for c, e in parts.items()])
    whole = F.when(F.col("total_tokens") == 0, F.col("input_tokens") + F.col("output_tokens")).otherwise(F.col("total_tokens"))
    return sums.withColumn("total_tokens", whole)


def search_retry(turn: DataFrame, conv: str, pos: str) -> DataFrame:
    """Per conversation: whether the question needs a search that did not happen or found nothing."""
    facts = turn.groupBy(conv).agg(
        F.min_by("content", F.when(F.col("role") == "user", F.col(pos))).alias("question"),
        F.max(((F.col("role") == "tool") | ((F.col("role") == "assistant") & F.col("has_tool_calls"))).cast("int")).alias("used"),
        F.max(((F.col("role") == "tool") & F.col("has_hits")).cast("int")).alias("found"),
    )
    answered = (F.col("used") == 1) & (F.col("found") == 1)
    return facts.select(conv, F.coalesce(T.needs_search(F.col("question")) & ~answered, F.lit(False)).alias("retry"))


def compact_history(messages: DataFrame) -> DataFrame:
    """User and assistant texts only: no tool rows, internal prompts or empty answers."""
    user = (F.col("role") == "user") & ~T.is_internal(F.col("content"))
    shown = messages.where(user | (F.col("role") == "assistant"))
    cleaned = F.when(F.col("role") == "assistant", T.sanitize(F.col("content"))).otherwise(F.col("content"))
    return shown.withColumn("content", cleaned).where((F.col("role") == "user") | (F.length("content") > 0))


def message_counts(messages: DataFrame, conv: str) -> DataFrame:
    return messages.groupBy(conv).agg(
        F.count(F.lit(1)).alias("messages"), F.count_if(F.col("role") == "user").alias("user_messages")
    )


# --- responses --------------------------------------------------------------------------------------
def confidences(responses: DataFrame, hits: DataFrame, key: str = "response_id") -> DataFrame:
    """``(key, confidence, hit_count)``: one minus the mean hit distance within 0 to 1; 0 without hits."""
    means = hits.groupBy(key).agg(
        F.avg(F.coalesce("distance", F.lit(0.0))).alias("_d"), F.count(F.lit(1)).alias("hit_count")
    )
    joined = responses.select(key).join(means, key, "left")
    return joined.select(
        key, F.coalesce(unit_interval(1.0 - F.col("_d")), F.lit(0.0)).alias("confidence"),
        F.coalesce("hit_count", F.lit(0)).alias("hit_count"),
    )


def responses_with_hits(
    responses: DataFrame, hits: DataFrame, order: Sequence[str], fields: Sequence[str], most: int | None = None
) -> DataFrame:
    """Each response with its hits as a list in stored order, the first ``most`` of them if given.

    A response stores at most the hits of one search, so its list is short; pass ``most`` where that is not sure: each task then
    drops what lies beyond before rows are shuffled.
    """
    if most is not None:
        place = F.row_number().over(W.partitionBy("response_id").orderBy(*order))
        hits = hits.withColumn("_place", place).where(F.col("_place") <= most).drop("_place")
    ordered = F.sort_array(F.collect_list(F.struct(*order, *[F.col(f).alias(f"_f_{f}") for f in fields])))
    lists = hits.groupBy("response_id").agg(
        F.transform(ordered, lambda h: F.struct(*[h[f"_f_{f}"].alias(f) for f in fields])).alias("hits")
    )
    return responses.join(lists, "response_id", "left")


def chat_tokens(responses: DataFrame, chat: str = "chat_id") -> DataFrame:
    """Token totals and message count per chat from its responses."""
    return responses.groupBy(chat).agg(
        *[F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in ("input_tokens", "output_tokens", "total_tokens")],
        F.count(F.lit(1)).alias("message_count"),
    )


def chat_facts(responses: DataFrame, chat: str, pos: str) -> DataFrame:
    """Responses with the chat's running token totals and user-message count up to each of them."""
    plain = responses.withColumns(
        {f"_{c}": F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("input_tokens", "output_tokens", "total_tokens")}
    ).withColumn("_one", F.lit(1).cast("long"))
    sums = {
        "chat_input_tokens": "_input_tokens", "chat_output_tokens": "_output_tokens", "chat_total_tokens": "_total_tokens",
        "message_count": "_one",
    }
    block = F.floor(F.col(pos) / RUNNING_BLOCK)
    totals = running_totals(plain, [chat], block, [F.col(pos)], sums)
    return totals.select(*responses.columns, *sums)


def fact_rows(responses: DataFrame, hits: DataFrame, chat: str, pos: str) -> DataFrame:
    """One fact per response: its tokens, the chat's totals so far, user messages so far, confidence and hit count."""
    totals = chat_facts(responses, chat, pos)
    return totals.join(confidences(responses, hits), "response_id", "left")


def chat_titles(events: DataFrame) -> DataFrame:
    """Latest title and time per chat from ``(chat_id, event_at, title)``; a null title only touches."""
    return events.groupBy("chat_id").agg(
        F.coalesce(F.max_by(F.left("title", F.lit(T.TITLE_CHARS)), F.when(F.col("title").isNotNull(), F.col("event_at"))), F.lit(DEFAULT_TITLE)).alias("title"),
        F.max("event_at").alias("updated_at"),
    )


def auto_title(current: Column, first_message: Column) -> Column:
    """A default title gives way to the first 50 characters of the first user message."""
    now = T.strip(F.coalesce(current, F.lit("")))
    cut = F.nullif(F.left(T.strip(first_message), F.lit(T.AUTO_TITLE_CHARS)), F.lit(""))
    return F.when(F.lower(now).isin(*T.DEFAULT_TITLES), F.coalesce(cut, now)).otherwise(current)


def auto_titles(chats: DataFrame, messages: DataFrame, chat: str, pos: str) -> DataFrame:
    first = messages.where(F.col("role") == "user").groupBy(chat).agg(F.min_by("content", pos).alias("_first"))
    joined = chats.join(first, chat, "left")
    return joined.withColumn("title", auto_title(F.col("title"), F.col("_first"))).drop("_first")


def chat_summary(titles: DataFrame, responses: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per chat: title, last change, token totals, message counts."""
    tokens = chat_tokens(responses).withColumnRenamed("message_count", "responses")
    joined = titles.join(tokens, "chat_id", "left").join(message_counts(messages, "chat_id"), "chat_id", "left")
    zero = ["input_tokens", "output_tokens", "total_tokens", "responses", "messages", "user_messages"]
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero})


def newest_chats(chats: DataFrame, session_id: str) -> DataFrame:
    return chats.where(F.col("session_id") == session_id).orderBy(F.desc("updated_at"), "chat_id")


def oldest_messages(messages: DataFrame, chat_id: str, order: Sequence[str], most: int | None = None) -> DataFrame:
    rows = messages.where(F.col("chat_id") == chat_id).orderBy(*order)
    return rows.limit(most) if most is not None else rows
