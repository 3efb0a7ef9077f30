"""Name an intermediate value inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def computed(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` plus new columns that later filters read instead of re-evaluating.

    A filter on a projected column is normally pushed below the projection with
    the whole expression copied into it once per use. One-row generators stop that.
    """
    made = df.select(*keep, *[c.alias(f"_c_{n}") for n, c in columns.items()])
    packed = F.struct(*[F.col(f"_c_{n}").alias(n) for n in columns])
    return made.select(*keep, F.inline(F.array(packed)))
