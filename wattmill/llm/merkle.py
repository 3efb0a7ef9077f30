"""Merkle manifest of a table: one root, and for every row the siblings that lead from its digest to the root.

A tree level is one aggregate: conditional aggregates spread the children of each parent into one column per slot, the columns
concatenated give the parent's digest, and the same columns without a child's own slot are that child's siblings. Rows are ranked
within their branch by :func:`wattmill.llm.common.ranked`, so a branch that holds all rows is dealt out like any other, and a parent
never has more than ``fanout`` children. Levels go up from the leaves (each a ``fanout``-th of the one below, written to
the shared folder), then paths go down: each level's parents bring their own path and hand it to the children that their slot
columns hold, so the largest join has one row per parent of leaves.

Branches have trees of different height; their tops (subroots) are the leaves of one more tree in the order of the
branch value, null first, whose top is the root. A single node stays itself.

Defined results: null values are digested as ``-``; rows with equal keys and different content are ordered by their leaf digest, equal
rows follow each other and get different places; a null key comes first; an empty table gives an empty result; columns that
the manifest does not read are ignored, whatever their names; texts of any length are digested by the engine's ``sha2``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.llm.common import ranked
from wattmill.session import pin, stage

FANOUT = 8
PATH = "array<struct<left:string,right:string>>"


def framed(value: Column) -> Column:
    """A value as digests take it in: ``-`` for null, else UTF-8 bytes counted, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    """Lower-case hex of the SHA-256 of the joined parts."""
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings, level by level."""
    return F.aggregate(path, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings in order."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _grown(nodes: DataFrame, fanout: int, label: str) -> list[DataFrame]:
    """The levels above ``nodes`` (``branch, idx, n, item`` with the digest ``item.h``), lowest first."""
    levels: list[DataFrame] = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        slot = F.col("idx") % fanout
        up = nodes.where("n > 1").groupBy(
            "branch", F.expr(f"idx div {fanout}").alias("idx"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n")
        )
        up = up.agg(*[F.max(F.when(slot == k, F.col("item"))).alias(f"s{k}") for k in range(fanout)])
        up = stage(up.withColumn("h", F.sha2(F.concat_ws("", *[f"s{k}.h" for k in range(fanout)]), 256)), label)
        levels.append(up)
        nodes = up.select("branch", "idx", "n", F.struct("h").alias("item"))
        most = -(-most // fanout)
    return levels


def _tops(nodes: DataFrame, levels: Sequence[DataFrame]) -> DataFrame:
    """``branch, height, h`` of the node that remains of each branch."""
    found = nodes.where("n = 1").select("branch", F.lit(0).alias("height"), F.col("item.h").alias("h"))
    for height, level in enumerate(levels, 1):
        found = found.unionByName(level.where("n = 1").select("branch", F.lit(height).alias("height"), "h"))
    return found


def _descended(nodes: DataFrame, levels: Sequence[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """``item, top, path`` of every node, from ``tops`` (``branch, height, top, path``)."""
    at = lambda height: tops.where(F.col("height") == height).select("branch", F.lit(0).cast("long").alias("idx"), "top", "path")
    above: DataFrame | None = None
    for height in range(len(levels), 0, -1):
        here = at(height) if above is None else above.select("branch", "idx", "top", "path").unionByName(at(height))
        digests = [F.col(f"s{k}.h") for k in range(fanout)]
        children = [
            F.struct(
                F.lit(k).alias("slot"),
                F.col(f"s{k}").alias("item"),
                F.concat_ws("", *digests[:k]).alias("left"),
                F.concat_ws("", *digests[k + 1 :]).alias("right"),
            )
            for k in range(fanout)
        ]
        met = here.join(levels[height - 1].drop("n", "h"), ["branch", "idx"])
        met = met.select("branch", "idx", "top", "path", F.explode(F.array(*children)).alias("c")).where("c.item is not null")
        step = F.array(F.struct(F.col("c.left").alias("left"), F.col("c.right").alias("right")))
        above = met.select(
            "branch", (F.col("idx") * fanout + F.col("c.slot")).alias("idx"), F.col("c.item").alias("item"), "top", F.concat(step, "path").alias("path")
        )
    alone = nodes.where("n = 1").join(at(0).drop("idx"), "branch").select("item", "top", "path")
    return alone if above is None else above.select("item", "top", "path").unionByName(alone)


def manifest(
    rows: DataFrame, leaf: Column, *, branch: Column, order: Sequence[Column], carried: dict[str, Column] | None = None, fanout: int = FANOUT
) -> DataFrame:
    """``carried`` columns with ``leaf``, ``subroot``, ``root`` and ``path``: siblings left and right of the own node, level by level.

    ``order`` ranks the rows of a branch; what it leaves open the leaf digest decides.
    """
    kept = carried or {}
    keys = [f"_by{i}" for i in range(len(order))]
    items = rows.select(
        framed(branch).alias("branch"),
        *[c.alias(k) for c, k in zip(order, keys, strict=True)],
        leaf.alias("_leaf"),
        F.struct(leaf.alias("h"), *[c.alias(n) for n, c in kept.items()]).alias("item"),
    )
    leaves = ranked(items, "branch", [*keys, "_leaf"], "leaves").select("branch", "idx", "n", "item")
    levels = _grown(leaves, fanout, "level")
    tops = _tops(leaves, levels)

    named = F.when(F.col("branch") != "-", F.expr("substring(branch, instr(branch, ':') + 1)"))
    subroots = tops.select(F.lit("-").alias("all"), named.alias("name"), F.struct("h", F.col("branch").alias("of"), "height").alias("item"))
    upper = ranked(subroots, "all", ["name"], "subroots").select(F.col("all").alias("branch"), "idx", "n", "item")
    upper_levels = _grown(upper, fanout, "upper")
    root = pin(_tops(upper, upper_levels).select("branch", "height", F.col("h").alias("top"), F.array().cast(PATH).alias("path")))
    found = _descended(upper, upper_levels, root, fanout)
    below = found.select(
        F.col("item.of").alias("branch"), F.col("item.height").alias("height"), F.struct(F.col("item.h").alias("subroot"), F.col("top").alias("root")).alias("top"), "path"
    )
    told = _descended(leaves, levels, pin(below), fanout)
    return told.select(*[F.col(f"item.{n}").alias(n) for n in kept], F.col("item.h").alias("leaf"), "top.subroot", "top.root", "path")
