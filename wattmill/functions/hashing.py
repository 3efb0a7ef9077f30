"""Stable row hashes: the same in every run, partitioning and engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(columns: Sequence[str]) -> Column:
    """Text key of a row; null and empty text stay apart."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])


def hash_number(key: Column, seed: int, digits: int = 8) -> Column:
    """The first ``digits`` hex digits of an MD5 over key and seed as a long (13 digits fit a double)."""
    hexed = F.substring(F.md5(F.concat_ws("#", key, F.lit(str(seed)))), 1, digits)
    return F.conv(hexed, 16, 10).cast("long")
