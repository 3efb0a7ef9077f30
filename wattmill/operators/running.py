"""Running totals whose largest task is a block, not a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[str | Column],
    sums: dict[str, str],
) -> DataFrame:
    """Add ``sums`` (new column -> summed column) as inclusive running totals per ``keys``.

    ``block`` is a non-decreasing function of ``order``. Rows are summed per
    block first, the short list of block totals is accumulated, and each row
    then only needs the rows of its own block. Both joins and windows use the
    same ``keys + block`` partitioning, so rows are shuffled once.
    """
    cut = df.withColumn("_block", block)
    part = [*keys, "_block"]
    blocks = cut.groupBy(*part).agg(*[F.sum(src).alias(f"_t_{out}") for out, src in sums.items()])
    before = W.partitionBy(*keys).orderBy(F.col("_block").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_block").alias("_k__block"),
        *[F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_o_{out}") for out in sums],
    )
    match = F.lit(True)
    for p in part:
        match = match & F.col(p).eqNullSafe(F.col(f"_k_{p}"))
    inside = W.partitionBy(*part).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = cut.join(offsets, match, "left")
    return joined.select(
        *df.columns,
        *[(F.sum(src).over(inside) + F.col(f"_o_{out}")).alias(out) for out, src in sums.items()],
    )
