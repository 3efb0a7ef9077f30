"""Rounding that decides decimal ties alike in every engine.

A quotient such as ``x / 32`` often ends exactly half way between two rounded
values, and engines disagree there. A shift far below the last kept digit, the
same one in the checking SQL, moves such values off the tie.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(value: Column, digits: int = 6) -> Column:
    return F.round(value + F.lit(10.0 ** -(digits + 4)), digits)


def rounded(df: DataFrame, columns: Iterable[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: settled(F.col(c), digits) for c in columns})
