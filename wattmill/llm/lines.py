"""Line de-duplication: exploded normalised lines, hashed, counted by document, dropped, put together again by position.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased. A key of ``min_chars`` code points or more that
more than ``max_docs`` documents hold loses all its lines except in the document with the smallest id. Only hashes travel: each
line becomes two 64-bit hashes and its position, one aggregate combines them on the map side to the smallest and largest id of each
hash, and the hashes of several documents are looked up again by the lines (``operators.lookup``: broadcast below a measured bound,
else hot keys by broadcast and the rest salted). What comes back to a document is the list of positions it loses, so a document's
own lines are the largest group there is.

Defined results: null text is empty and an empty text is one empty line. Rows with the same id are one document: a line in both is
in one document. All rows with a null id are one document that comes after every other. Ties cannot occur (ids decide), repeated
rows get the same answer each. An empty table gives an empty result. Columns named ``kept_text``, ``n_lines`` or ``n_dropped`` are
replaced, all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.functions.binding import let
from wattmill.llm.common import WHITE, ascii_lower
from wattmill.operators.lookup import lookup

MADE = ("kept_text", "n_lines", "n_dropped")


def line_key(line: Column) -> Column:
    """What makes two lines the same."""
    return F.trim(ascii_lower(line), F.lit(WHITE))


def _hashes(*values: Column) -> list[Column]:
    """128 bits in two columns."""
    return [F.xxhash64(F.lit(seed), *values) for seed in (1, 2)]


def _row_hashes(id_col: str, text: Column) -> list[Column]:
    return _hashes(F.col(id_col).isNull(), F.col(id_col), text)


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``_r1, _r2`` of the row, ``_id``, ``_pos`` and ``_h1, _h2`` of every line whose key is long enough."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    r1, r2 = _row_hashes(id_col, text)
    rows = docs.select(r1.alias("_r1"), r2.alias("_r2"), F.col(id_col).alias("_id"), F.posexplode(F.split(text, "\n")).alias("_pos", "_line"))
    keyed = rows.where(F.length("_line") >= min_chars).withColumn("_key", line_key(F.col("_line")))
    h1, h2 = _hashes(F.col("_key"))
    return keyed.where(F.length("_key") >= min_chars).select("_r1", "_r2", "_id", "_pos", h1.alias("_h1"), h2.alias("_h2"))


def shared_keys(lines: DataFrame, max_docs: int = 1) -> DataFrame:
    """Hashes that more than ``max_docs`` documents hold: ``_first`` id that keeps them, ``_n`` lines."""
    ids = lines.groupBy("_h1", "_h2").agg(
        F.min("_id").alias("_first"), F.max("_id").alias("_last"), F.max(F.col("_id").isNull()).alias("_none"), F.count(F.lit(1)).alias("_n")
    )
    several = ids.where((F.col("_first") != F.col("_last")) | (F.col("_none") & F.col("_first").isNotNull()))
    found = several.select("_h1", "_h2", "_first", "_n")
    if max_docs <= 1:
        return found
    told = lookup(lines.select("_h1", "_h2", "_id"), found.withColumn("_many", F.lit(True)), ["_h1", "_h2"], weight="_n")
    pairs = told.where("_many").groupBy("_h1", "_h2", "_id").agg(F.count(F.lit(1)).alias("_n"), F.first("_first").alias("_first"))
    counted = pairs.groupBy("_h1", "_h2").agg(F.first("_first").alias("_first"), F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_docs"))
    return counted.where(F.col("_docs") > max_docs).drop("_docs")


def dedup_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, max_docs: int = 1
) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` before dropping and ``n_dropped``."""
    lines = hashed_lines(docs, id_col, text_col, min_chars)
    shared = shared_keys(lines, max_docs).withColumn("_shared", F.lit(True))
    told = lookup(lines, shared, ["_h1", "_h2"], weight="_n")
    lost = told.where(F.col("_shared") & ~F.col("_id").eqNullSafe(F.col("_first")))
    lost = lost.groupBy("_r1", "_r2").agg(F.collect_set("_pos").alias("_lost"))

    text = F.coalesce(F.col(text_col), F.lit(""))
    r1, r2 = _row_hashes(id_col, text)
    kept = [c for c in docs.columns if c not in MADE]
    found = lookup(docs.select(*kept, r1.alias("_r1"), r2.alias("_r2")), lost, ["_r1", "_r2"])
    all_lines = F.split(text, "\n")

    def put_together(cut: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), F.col("_lost"))
        return F.array_join(F.transform(stay, lambda i: cut[i]), "\n")

    return found.select(
        *kept,
        F.when(F.col("_lost").isNull(), text).otherwise(let(all_lines, put_together)).alias("kept_text"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce(F.size("_lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )
