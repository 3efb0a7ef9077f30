"""Key lookups that stay shuffle-free when they can and skew-free when they cannot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattmill.session import pin

#: A lookup table is broadcast only when its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
#: A key is hot when it holds at least this share of all rows, so there are at
#: most ``1 / HOT_SHARE`` hot keys whatever the data looks like.
HOT_SHARE = 0.001
SALTS = 1024


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of a *pinned* table: fixed-width columns plus string lengths."""
    fixed = 0
    variable = [F.lit(0)]
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            variable.append(F.coalesce(F.octet_length(field.name), F.lit(0)))
            fixed += 16
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            variable.append(F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)))
            fixed += 16
        else:
            fixed += 8
    width = variable[0]
    for extra in variable[1:]:
        width = width + extra
    rows, text = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return int(rows) * (fixed + 32) + int(text)


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    *,
    weight: str | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left-join ``dim`` (at most one row per key) to ``fact``.

    ``dim`` is pinned first: it is usually an aggregate over the very rows it
    is joined to and must not be computed twice. Its measured size then picks
    the join. Small: broadcast, the fact side is not shuffled at all. Large:
    the hot keys (``weight`` says how many rows a key has; counted from
    ``fact`` when not given) are looked up by broadcast, only the remaining
    keys meet in a shuffle join, and rows that need no match there are spread
    by a salt, so no key can fill a single task.
    """
    dim = pin(dim)
    if measured_bytes(dim) <= max_bytes:
        payload = dim.drop(weight) if weight else dim
        return fact.join(F.broadcast(payload), list(on), "left")
    return skewed_lookup(fact, dim, on, weight=weight)


def skewed_lookup(fact: DataFrame, dim: DataFrame, on: Sequence[str], *, weight: str | None = None) -> DataFrame:
    """The branch of :func:`lookup` for lookup tables too large to broadcast."""
    on = list(on)
    values = [c for c in dim.columns if c not in on and c != weight]
    if weight is None:
        weights = pin(fact.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")))
        weight, hot_source = "_rows", dim.join(weights, on, "inner")
        total = weights.agg(F.sum("_rows")).first()[0]
    else:
        hot_source = dim
        total = dim.agg(F.sum(weight)).first()[0]
    hot = (
        hot_source.where(F.col(weight) >= F.lit(float(total or 0) * HOT_SHARE))
        .select(*on, F.struct(*values).alias("_hot"))
    )
    cold = dim.select(*on, F.lit(0).alias("_salt"), F.struct(*values).alias("_cold"))
    no_key = F.lit(False)
    for key in on:
        no_key = no_key | F.col(key).isNull()
    spread = F.pmod(F.xxhash64(*fact.columns), F.lit(SALTS)).cast("int") + F.lit(1)
    tagged = fact.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull() | no_key, spread).otherwise(F.lit(0))
    )
    joined = tagged.join(cold, [*on, "_salt"], "left")
    found = [F.coalesce(F.col("_hot")[v], F.col("_cold")[v]).alias(v) for v in values]
    return joined.select(*fact.columns, *found)
