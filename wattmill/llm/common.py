"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattmill.operators.lookup import lookup
from wattmill.session import stage

#: ASCII white space that separates words, as a character class of Java and Python.
SPACES = r"\x20\x09-\x0D"
#: The same characters as a plain list.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the supplied tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(value: Column) -> Column:
    """A-Z lower-cased, every other character left alone."""
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(rows: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """``rows`` with ``idx``, the place (from 0) in ``order`` within ``group`` (never null), and ``n``, the group's rows.

    Rows are dealt by ranges of (group, order) and written sorted; a row's place is its row number in its file plus what earlier
    files hold of the group. So no group meets in one task, only the list of files does. Equal rows are told apart by where the scan
    found them, and each range is written once, so a lost executor cannot change a place.
    """
    keys = [F.col(group), *[F.col(c).asc_nulls_first() for c in order], F.col("_tie")]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return placed(stage(dealt, label), group, [group, *order, "_tie"]).drop("_tie")


def placed(written: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``written``, just staged, with ``idx`` and ``n``: files in the order of their first rows, rows as they stand."""
    rows = written.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    heads = rows.where("_row = 0").select(F.col("_file").alias("_head"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    runs = rows.groupBy(group, "_file").agg(F.min("_row").alias("_from"), F.count(F.lit(1)).alias("_held"))
    runs = runs.join(heads, F.col("_file") == F.col("_head"))
    files = W.partitionBy(group).orderBy(*[F.col(f"_o{i}").asc_nulls_first() for i in range(len(order))])
    before = F.coalesce(F.sum("_held").over(files.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select(group, "_file", (before - F.col("_from")).alias("_shift"), F.sum("_held").over(W.partitionBy(group)).alias("n"))
    found = lookup(rows, starts, [group, "_file"])
    return found.select(*written.columns, (F.col("_row") + F.col("_shift")).alias("idx"), "n")
