"""The corpus pipeline: quality rules, near-copies, personal data, mixing, tokens.

Each stage takes what the one before kept, written as Parquet and read again. The first four return the columns of ``documents``;
the last returns the token ids of each document that is left with its ``position`` in the mixture: the mixing stage sorts files and
rows, and the position is counted from the name and row number that the scan of those files reports.
"""

from __future__ import annotations

import re
from itertools import accumulate

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.llm import bpe, mixing, neardup, pii, quality
from wattmill.llm.common import table
from wattmill.plans.registry import query
from wattmill.session import stage

VOCABULARY = "byte_bpe_50k.tiktoken"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays."""
    return neardup.drop_copies(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; ``n_chars`` follows the text."""
    clean = pii.redact_pii(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def interleave(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture: files and rows are sorted by slot."""
    mixed = mixing.mix(docs)
    return mixed.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select(*docs.columns)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs``, read from files, with ``position``: from 0 in the order of part numbers and rows."""
    rows = docs.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = {r["_file"]: r["n"] for r in rows.groupBy("_file").agg((F.max("_row") + 1).alias("n")).collect()}
    names = sorted(sizes, key=lambda name: ([int(n) for n in re.findall(r"^part-(\d+)", name)], name))
    starts = zip(names, accumulate((sizes[n] for n in names), initial=0), strict=False)
    told = docs.sparkSession.createDataFrame(list(starts), "_file string, _start long")
    found = rows.join(F.broadcast(told), "_file")
    return found.select(*docs.columns, (F.col("_start") + F.col("_row")).alias("position"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and its position in the mixture; fails where the ids don't decode to the text."""
    coder = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    coded = numbered(docs).withColumn("ids", bpe.encode_ids(F.col("text"), *coder))
    coded = coded.withColumn("_bytes", bpe.decode_ids(F.col("ids"), *coder))
    same = F.col("_bytes") == F.coalesce("text", F.lit("")).cast("binary")
    ids = F.when(same, F.col("ids")).otherwise(F.raise_error(F.concat(F.lit("tokens differ from the text of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))))
    return coded.select("doc_id", "source", "lang", ids.alias("ids"), "position", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("quality rules", keep_good),
    ("near-copies", drop_copies),
    ("personal data", redact),
    ("mixing", interleave),
    ("tokens", tokenize),
]

#: Joint likelihoods, rewriting and schedules are not for SQL: the tests hold the result against plain Python.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
