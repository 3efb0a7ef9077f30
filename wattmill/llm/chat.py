"""Chat formatting in budgeted windows.

A conversation becomes one or more windows of text. Prefix sums of turn tokens
choose spans of whole turns that fit the budget; every window repeats the
system turn and a limited number of tokens of the turns just before its span.
Repeated turns are context only: the loss mask covers each assistant text once, in the
window that owns the turn.

Turns are marked ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside
roles and texts are escaped reversibly: ``<``, any backslashes, ``|`` gets one more
backslash.

Long conversations are cut into blocks of prefix-summed tokens, each planned on
its own with the tail of the block before it, so one conversation that holds a
third of all rows is spread over many tasks. Only the digest of a whole
conversation (:func:`read_back`) streams its windows through one task: a hash over an
ordered text cannot be computed in parts.

Null texts and roles are empty. Null turns come first, ties are ordered by role
and text, repeated rows are turns of their own. A null conversation id is a
conversation like any other. A turn larger than the budget gets a window of its own.
Other columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.operators.running import running_totals

START, END = "<|im_start|>", "<|im_end|>"
#: Budget of a window, of the turns it repeats, and the tokens that marking a turn costs.
BUDGET, HISTORY, TURN_COST = 2048, 256, 4
#: Tokens of a block and turns of a block of prefix sums.
BLOCK, SUM_BLOCK = 32 * BUDGET, 1024

WINDOWS = "conv_id long, block long, window int, n_context int, text string, loss array<struct<start:int,end:int>>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def mark(role: str, text: str) -> tuple[str, int, int]:
    """A marked turn and where its text starts and ends in it."""
    head = f"{START}{escape(role.replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n'))}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse(window: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted window."""
    turns = []
    for piece in window.split(START)[1:]:
        role, _, rest = piece.partition("\n")
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))
        turns.append((role, unescape(rest[: rest.rindex(END)])))
    return turns


def token_estimate(text: Column) -> Column:
    """Tokens of a turn: a quarter of its bytes, rounded up, and the cost of its marks."""
    return (F.ceil(F.octet_length(text) / 4) + TURN_COST).cast("long")


def plan_spans(tokens: np.ndarray, first: int, system: int, owned: bool, budget: int, history: int) -> list[tuple[int, int, int]]:
    """Spans ``(context_start, start, end)`` over turns ``first..`` by prefix sums; earlier turns are context only.

    ``system`` tokens are repeated in every window but the first when that ``owned`` the system turn.
    """
    ends = np.concatenate([[0], np.cumsum(tokens)])
    spans, at = [], first
    while at < len(tokens):
        room = budget - (0 if owned and at == 0 else system)
        spare = min(history, max(0, room - int(tokens[at])))
        back = int(np.searchsorted(ends, ends[at] - spare, side="left"))
        left = room - int(ends[at] - ends[back])
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + left, side="right")) - 1)
        spans.append((back, at, stop))
        at = stop
    return spans


def _format(key: tuple, turns: list[tuple[int, str, str, int]], budget: int, history: int) -> Iterator[dict]:
    """``turns``: kind (0 system repeated, 1 context from the block before, 2 own), role, text, tokens."""
    system = turns[0] if turns[0][0] == 0 else None
    rows = turns[1:] if system else turns
    first = next((i for i, t in enumerate(rows) if t[0] == 2), len(rows))
    own_system = system is None and first == 0 and key[1] == 0 and rows[0][1] == "system"
    held = rows[0] if own_system else system
    tokens = np.array([t[3] for t in rows], dtype=np.int64)
    for window, (back, start, end) in enumerate(plan_spans(tokens, first, held[3] if held else 0, own_system, budget, history)):
        repeat_system = held is not None and not (own_system and start == 0)
        if own_system and start > 0:
            back = max(back, 1)
        chosen = ([held] if repeat_system else []) + rows[back:end]
        context = start - back + repeat_system
        parts, loss, at = [], [], 0
        for i, (_, role, text, _) in enumerate(chosen):
            marked, a, b = mark(role, text)
            if i >= context and role == "assistant":
                loss.append({"start": at + a, "end": at + b})
            parts.append(marked)
            at += len(marked)
        yield {"conv_id": key[0], "block": key[1], "window": window, "n_context": context, "text": "".join(parts), "loss": loss}


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Formatted windows of ``conv_id, turn, role, text`` rows, with the loss mask as spans of code points."""
    history = min(history, budget // 2)
    block_tokens = BLOCK if budget <= BUDGET else 32 * budget
    clean = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    clean = clean.withColumn("tokens", token_estimate(F.col("text"))).withColumn("one", F.lit(1).cast("long"))
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    sums = running_totals(
        clean, ["conv_id"], F.floor(F.col("turn") / SUM_BLOCK), order, {"upto": "tokens", "pos": "one"}
    )
    before = F.col("upto") - F.col("tokens")
    own = sums.withColumn("block", F.floor(before / block_tokens)).withColumn("kind", F.lit(2))
    is_system = (F.col("pos") == 1) & (F.col("role") == "system")
    tail = own.where((before >= (F.col("block") + 1) * block_tokens - history) & ~is_system)
    tail = tail.withColumn("block", F.col("block") + 1).withColumn("kind", F.lit(1))
    later = own.where(F.col("block") > 0).select(F.col("conv_id").alias("c"), F.col("block").alias("b")).distinct()
    system = own.where(is_system).join(later, F.col("conv_id").eqNullSafe(F.col("c")), "inner")
    system = system.withColumn("block", F.col("b")).withColumn("kind", F.lit(0)).drop("c", "b")
    rows = own.unionByName(tail).unionByName(system).select("conv_id", "block", "kind", "pos", "role", "text", "tokens")
    dealt = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "kind", "pos")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("conv_id", pa.int64()), ("block", pa.int64()), ("window", pa.int32()), ("n_context", pa.int32()), ("text", pa.string()),
             ("loss", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
        )
        key, held, out, size = None, [], [], 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "block", "kind", "role", "text", "tokens")]
            for conv, block, *turn in zip(*columns, strict=True):
                if held and (conv, block) != key:
                    if any(t[0] == 2 for t in held):
                        made = list(_format(key, held, budget, history))
                        out += made
                        size += sum(len(m["text"]) for m in made)
                    held = []
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, size = [], 0
                key = (conv, block)
                held.append(tuple(turn))
        if held and any(t[0] == 2 for t in held):
            out += _format(key, held, budget, history)
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return dealt.mapInArrow(build, WINDOWS)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation with digests of the turns and of the text under the loss mask, parsed from the windows."""
    dealt = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        now, started, out = None, False, []

        def fresh(conv: int | None) -> list:
            return [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]

        def closed(state: list) -> dict:
            return dict(zip(names, [x.hexdigest() if hasattr(x, "hexdigest") else x for x in state], strict=True))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "n_context", "text", "loss")]
            for conv, context, text, loss in zip(*columns, strict=True):
                if not started or conv != now[0]:
                    if started:
                        out.append(closed(now))
                    now, started = fresh(conv), True
                for role, content in parse(text)[context:]:
                    now[1] += 1
                    now[2].update(f"{role}\n{content}\n".encode())
                for span in loss:
                    said = unescape(text[span["start"] : span["end"]])
                    now[3] += len(said)
                    now[4].update(said.encode())
                now[5] += len(text)
                now[6] += 1
            if len(out) > 5000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if started:
            out.append(closed(now))
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    return dealt.mapInArrow(digest, DIGESTS)
