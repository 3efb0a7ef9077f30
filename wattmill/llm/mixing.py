"""Interleaving sources to target weights by Pfair scheduling, in DataFrame and SQL functions only.

Rows of a source are cut into blocks. Block ``j`` of a source of weight ``w`` is
released at slot ``floor((j - 1) / w)`` and due at ``ceil(j / w)``; every slot goes to the released block with the
earliest deadline. At every slot each source has had its weight's share of all slots to within less than
one block.

The driver walks the schedule once with exact whole-number windows and keeps the state at every :data:`CHUNK`-th
slot only; a fold in SQL per chunk finds the slots of its blocks again, in many tasks, and rows meet them by source and
block. Weights are taken to at least 2**-30 of their sum (2**-40 up to two million blocks), which moves no source by a block.
When a source runs out a new phase begins: the other weights are scaled up and the windows start anew. No row is
dropped or repeated, no slot stays empty.

Rows of a source are numbered through blocks of a hash order (:func:`running_totals`), so a source
that holds a third of all rows is numbered by many tasks. A null source is a source of its own; sources without a target
weight share ``other`` equally. Empty tables stay empty. Columns named ``slot`` or ``place`` are replaced.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.operators.lookup import BROADCAST_BYTES
from wattmill.operators.running import running_totals

#: Slots of one fold, and rows of a block.
CHUNK, BLOCK_ROWS = 1000, 16
#: Bytes of one block's slot where all of them are held.
SLOT_BYTES = 64
#: Rows that one numbering block should hold.
NUMBERING = 4096


def shares(weights: Sequence[float], slots: int) -> list[int]:
    """Whole shares of ``slots`` by largest remainder, at least one each."""
    slots = max(slots, len(weights))
    total = sum(weights)
    exact = [w / total * slots for w in weights]
    given = [max(1, math.floor(x)) for x in exact]
    order = sorted(range(len(weights)), key=lambda i: (given[i] - exact[i], i))
    while sum(given) < slots:
        for i in order[: slots - sum(given)]:
            given[i] += 1
    while sum(given) > slots:
        i = max(range(len(given)), key=lambda i: (given[i] - exact[i] if given[i] > 1 else -math.inf, -i))
        given[i] -= 1
    return given


def whole(weights: Sequence[float], blocks: int) -> list[int]:
    """Weights as whole numbers, as fine as windows of ``blocks`` blocks can be kept in 64 bits."""
    scale = 2 ** min(40, 61 - blocks.bit_length())
    total = sum(weights)
    return [max(1, round(w / total * scale)) for w in weights]


#: One stretch of the schedule: its first slot and that in its phase, slots, and per source still there the index, weight, blocks
#: used before the phase and blocks done in it.
CHUNK_TYPE = "start long, t0 long, slots int, idx array<int>, w array<long>, used array<long>, done array<long>"


def chunks(blocks: Sequence[int], weights: Sequence[float], cycle: int | None = None) -> Iterator[tuple]:
    """Rows of :data:`CHUNK_TYPE` over all ``blocks``; with ``cycle`` the weights are whole shares of so many slots."""
    left, start = {i: n for i, n in enumerate(blocks) if n > 0}, 0
    gone = [0] * len(blocks)
    while left:
        idx = sorted(left)
        some = [weights[i] for i in idx]
        w = shares(some, cycle) if cycle else whole(some, sum(blocks))
        total, used, done = sum(w), [gone[i] for i in idx], [0] * len(idx)
        end = [left[i] for i in idx]
        waiting: list[tuple[int, int]] = []
        ready = [(-(-total // x), -x, s) for s, x in enumerate(w)]
        heapq.heapify(ready)
        t, t0, before, over = 0, 0, list(done), False
        while not over:
            while waiting and waiting[0][0] <= t:
                s = heapq.heappop(waiting)[1]
                heapq.heappush(ready, (-(-(done[s] + 1) * total // w[s]), -w[s], s))
            s = heapq.heappop(ready)[2]
            done[s] += 1
            heapq.heappush(waiting, (done[s] * total // w[s], s))
            t += 1
            over = done[s] == end[s]
            if over or t - t0 == CHUNK:
                yield start + t0, t0, t - t0, idx, w, used, before
                t0, before = t, list(done)
        start += t
        for s, i in enumerate(idx):
            gone[i] += done[s]
            left[i] -= done[s]
            if not left[i]:
                del left[i]


def edf(stretches: DataFrame) -> DataFrame:
    """``source`` (index), ``block`` (from 0) and ``slot`` of every block of the chunks, earliest deadline first."""
    due = "((acc.done[s] + 1) * total + w[s] - 1) div w[s]"
    pick = f"""
        array_min(transform(
            filter(sequence(0, size(w) - 1), s -> (acc.done[s] * total) div w[s] <= t0 + t),
            s -> struct({due} as due, -w[s] as heavy, s as s)
        )).s
    """
    fold = f"""
        aggregate(
            sequence(0, slots - 1),
            struct(done, cast(array() as array<struct<s:int,j:bigint>>) as chosen),
            (acc, t) -> transform(array({pick}), p -> struct(
                transform(acc.done, (x, i) -> if(i = p, x + 1L, x)) as done,
                concat(acc.chosen, array(struct(p as s, acc.done[p] as j))) as chosen))[0],
            acc -> acc.chosen
        )
    """
    summed = stretches.selectExpr("*", "aggregate(w, 0L, (a, x) -> a + x) as total")
    chosen = summed.selectExpr("start", "idx", "used", f"posexplode({fold}) as (at, p)")
    return chosen.selectExpr("idx[p.s] as source", "used[p.s] + p.j as block", "start + at as slot")


def edf_cycle(spark: SparkSession, part: Sequence[int]) -> DataFrame:
    """``source`` (index), ``nth`` (from 0) and ``at``: the slot of each block of one cycle of whole shares."""
    none = [0] * len(part)
    one = spark.createDataFrame([(0, 0, sum(part), list(range(len(part))), list(part), none, none)], CHUNK_TYPE)
    return edf(one).selectExpr("source", "slot as at", "block as nth")


def tempered(counts: Mapping[str | None, int], exponent: float = 0.5) -> dict[str | None, float]:
    """Target weights that grow as a power of a source's rows: large sources give way to small ones."""
    return {s: float(n) ** exponent for s, n in counts.items() if n}


def mix(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    *,
    other: float = 0.05,
    source: str = "source",
    key: str = "doc_id",
    block_rows: int = BLOCK_ROWS,
    cycle: int | None = None,
) -> DataFrame:
    """``docs`` with ``slot`` of the row's block and its ``place`` in it; their order is the mixture.

    Without ``weights`` the targets are :func:`tempered` row counts. ``cycle`` rounds them to whole shares of so many slots.
    """
    spark = docs.sparkSession
    rows = docs.drop("slot", "place")
    counts = {r[0]: r[1] for r in rows.groupBy(source).count().collect()}
    if not counts:
        return rows.withColumn("slot", F.lit(None).cast("long")).withColumn("place", F.lit(None).cast("int"))
    target = dict(weights) if weights is not None else tempered(counts)
    unnamed = [s for s in counts if target.get(s, 0) <= 0]
    total = sum(w for s, w in target.items() if s in counts and w > 0) or 1.0
    target |= {s: other * total / len(unnamed) for s in unnamed}
    names = sorted(counts, key=lambda s: (s is None, s or ""))
    plan = list(chunks([-(-counts[s] // block_rows) for s in names], [target[s] for s in names], cycle))

    bits = max(0, math.ceil(math.log2(max(1, sum(counts.values()) / NUMBERING))))
    hashed = rows.withColumn("_mix_hash", F.xxhash64(key)).withColumn("_mix_one", F.lit(1).cast("long"))
    block = F.shiftright(F.col("_mix_hash"), 64 - bits) if bits else F.lit(0).cast("long")
    numbered = running_totals(hashed, [source], block, ["_mix_hash", F.col(key).asc_nulls_first()], {"_mix_row": "_mix_one"})
    numbered = numbered.withColumn("_mix_k", F.floor((F.col("_mix_row") - 1) / block_rows))

    slots_of = edf(spark.createDataFrame(plan, CHUNK_TYPE)).selectExpr("source as _mix_s", "block as _mix_k", "slot as _mix_slot")
    told = spark.createDataFrame(list(enumerate(names)), "_mix_s int, _mix_name string")
    found = numbered.join(F.broadcast(told), F.col(source).cast("string").eqNullSafe(F.col("_mix_name")), "left")
    # one row per block: sent to the rows while it fits, so that texts are not dealt out once more
    few = sum(-(-counts[s] // block_rows) for s in names) * SLOT_BYTES <= BROADCAST_BYTES
    found = found.join(F.broadcast(slots_of) if few else slots_of, ["_mix_s", "_mix_k"], "left")
    return found.select(
        *rows.columns, F.col("_mix_slot").alias("slot"), ((F.col("_mix_row") - 1) % block_rows).cast("int").alias("place")
    )
