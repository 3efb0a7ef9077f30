"""Named queries over whole texts: quality rules, near-copies, mixing, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.llm import bpe, licences, mixing, neardup, quality
from wattmill.llm.common import table, text_or_empty
from wattmill.plans.registry import query

VOCABULARY = "byte_bpe_50k.tiktoken"

QUALITY_SQL = r"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    cut AS (
        SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
            list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM docs
    ), windows AS (
        SELECT doc_id, p, array_to_string(words[p : p + 4], ' ') AS w
        FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM cut)
    ), twice AS (
        SELECT doc_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
    ), covered AS (
        SELECT doc_id, count(DISTINCT p + o) AS n FROM twice, (SELECT unnest(range(0, 5)) AS o) GROUP BY doc_id
    ), counted AS (
        SELECT c.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
            length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_capitals,
            len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
        FROM cut c LEFT JOIN covered USING (doc_id)
    )
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
        n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
        n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 5 * word_chars
            OR 100 * n_capitals > 50 * word_chars OR 100 * n_dup_lines > 30 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
    FROM counted
"""


@query("op3_quality", QUALITY_SQL)
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    order = quality.ordered(quality.RULES, quality.estimate(docs))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    measured = quality.measure(docs, counts=counts)
    base = F.col("n_words") < 10
    base = base | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    # what the result does not show is counted only where the rules come to it
    verdict = quality.cascade(order, text_or_empty(), counts).isNull()
    return measured.select("doc_id", *counts, base.alias("base_failed"), F.when(base, False).otherwise(verdict).alias("kept"))


@query("op4_near_copies")
def op4_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_copies(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query("op6_bpe")
def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_digests(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN).drop("text")


@query("op9_mixing")
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents").select("doc_id", "source"))


def _licence_sql() -> str:
    notices = ", ".join(f"({i}, '{name}', '{notice}')" for i, (name, notice) in enumerate(licences.TEMPLATES))
    lowered = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    cut = lambda x: f"list_filter(string_split_regex({lowered.format(x)}, '{licences.TERMS}'), lambda t: t <> '')"
    return f"""
    WITH docs AS (
        SELECT doc_id, coalesce(text, '') AS text, concat_ws('/', source, lang, (doc_id // 50)::VARCHAR) AS dir FROM documents
    ), templates(no, licence, notice) AS (VALUES {notices}),
    template_terms AS (SELECT no, term, count(*) AS n FROM (SELECT no, unnest({cut('notice')}) AS term FROM templates) GROUP BY ALL),
    held AS (SELECT doc_id, unnest(list_distinct({cut('text')})) AS term FROM docs),
    weights AS (
        SELECT term, ln((1 + (SELECT count(*) FROM docs)) / (1 + count(doc_id))) + 1 AS idf
        FROM (SELECT DISTINCT term FROM template_terms) LEFT JOIN held USING (term) GROUP BY term
    ), lines AS (
        SELECT * FROM (SELECT doc_id, dir, len({cut('text')}) AS words, unnest(string_split(text, chr(10))) AS line FROM docs)
        WHERE regexp_matches({lowered.format('line')}, '{licences.ANCHORS}')
    ), line_terms AS (
        SELECT line, term, count(*) * coalesce(idf, ln(1 + (SELECT count(*) FROM docs)) + 1) AS w
        FROM (SELECT line, unnest({cut('line')}) AS term FROM (SELECT DISTINCT line FROM lines)) LEFT JOIN weights USING (term) GROUP BY line, term, idf
    ), vectors AS (SELECT no, term, n * idf AS v FROM template_terms JOIN weights USING (term)),
    cosines AS (
        SELECT line, no, sum(w * v) / sqrt(any_value(l.square) * any_value(t.square)) AS score
        FROM line_terms JOIN vectors USING (term)
        JOIN (SELECT line, sum(w * w) AS square FROM line_terms GROUP BY line) l USING (line)
        JOIN (SELECT no, sum(v * v) AS square FROM vectors GROUP BY no) t USING (no) GROUP BY line, no
    ), best AS (
        SELECT line, licence, score FROM cosines JOIN templates USING (no)
        WHERE score >= {licences.THRESHOLD} QUALIFY row_number() OVER (PARTITION BY line ORDER BY round(score, 9) DESC, no) = 1
    ), matched AS (
        SELECT DISTINCT doc_id, dir, words, line, licence, score, len({cut('line')}) AS in_line FROM lines JOIN best USING (line)
    ), own AS (
        SELECT doc_id, dir, arg_max(licence, (round(score, 9), licence)) AS licence, max(score) AS score, 2 * sum(in_line) >= max(words) AS file
        FROM matched GROUP BY doc_id, dir
    ), held_by AS (
        SELECT dir, arg_max(licence, (round(score, 9), -doc_id)) AS licence FROM own WHERE file GROUP BY dir
    )
    SELECT d.doc_id, coalesce(o.licence, h.licence) AS licence,
        CASE WHEN o.licence IS NOT NULL THEN 'own' WHEN h.licence IS NOT NULL THEN 'inherited' END AS origin,
        CASE WHEN o.licence IS NULL THEN h.dir END AS directory
    FROM docs d LEFT JOIN own o USING (doc_id)
    LEFT JOIN LATERAL (
        SELECT dir, licence FROM held_by h WHERE h.dir = d.dir OR h.dir = '' OR starts_with(d.dir, h.dir || '/') ORDER BY length(h.dir) DESC LIMIT 1
    ) h ON TRUE
    """


@query("op7_licences", _licence_sql())
def op7_licences(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    fifty = F.floor(F.col("doc_id") / 50).cast("string")
    path = F.concat_ws("/", "source", "lang", fifty, F.col("doc_id").cast("string"))
    return licences.scan(docs, path).withColumnRenamed("id", "doc_id")
