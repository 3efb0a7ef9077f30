"""Named queries with a fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.llm import toxicity
from wattmill.llm.common import table
from wattmill.plans.registry import query


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels").select("doc_id", "toxic"))
    scored = toxicity.score_texts(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
