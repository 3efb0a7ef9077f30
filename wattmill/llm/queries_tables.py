"""Named queries over whole tables: line de-duplication, Merkle manifest, whitened embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.llm import lines, merkle, whitening
from wattmill.llm.common import ascii_lower, table
from wattmill.plans.registry import query

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINES_SQL = f"""
    WITH cut AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents
    ), keyed AS (
        SELECT doc_id, pos, line, trim({LOWERED.format('line')}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM cut
    ), shared AS (
        SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
    )
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (first <> doc_id)::BIGINT AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
    FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id
"""


@query("op12_line_dedup", LINES_SQL)
def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"), min_chars=10, max_docs=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


#: CRC-32 of a short ASCII text, bit by bit: DuckDB has no such function.
CRC_SQL = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({}::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda sum, byte: list_reduce(
        list_prepend(xor(sum, byte), range(8)), lambda c, bit: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)))"""


def _merkle_sql() -> str:
    framed = lambda x: f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(framed(text if c == "text" else c) for c in LEAF_COLUMNS) + ")"
    return f"""
    WITH RECURSIVE hashed AS MATERIALIZED (
        SELECT doc_id, lang, {leaf('text')} AS leaf, {leaf(LOWERED.format('text'))} AS lowered FROM documents
    ), leaves AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM hashed
    ), nodes(branch, level, idx, n, h) AS (
        SELECT coalesce('=' || lang, ''), 0, idx, n, leaf FROM leaves
        UNION ALL
        SELECT branch, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1
        GROUP BY branch, level, idx // 8, (n + 7) // 8
    ), subroots AS MATERIALIZED (
        SELECT branch, level, h, row_number() OVER (ORDER BY branch) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1
    ), upper(level, idx, n, h) AS (
        SELECT 0, idx, n, h FROM subroots
        UNION ALL
        SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM upper WHERE n > 1 GROUP BY level, idx // 8, (n + 7) // 8
    ), families AS MATERIALIZED (
        SELECT branch, level, idx // 8 AS parent, list(h ORDER BY idx) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
        UNION ALL
        SELECT NULL, level, idx // 8, list(h ORDER BY idx) FROM upper WHERE n > 1 GROUP BY ALL
    ), starts AS (
        SELECT l.*, CASE WHEN {CRC_SQL.format('doc_id')} % 3 = 0 THEN lowered ELSE leaf END AS shown, s.h AS subroot, s.branch, s.level AS height, s.idx AS place
        FROM leaves l JOIN subroots s ON s.branch = coalesce('=' || lang, '')
    ), walk(doc_id, leaf, subroot, branch, height, place, level, spot, proof, folded) AS (
        SELECT doc_id, leaf, subroot, CASE WHEN height > 0 THEN branch END, height, place, 0, CASE WHEN height > 0 THEN idx ELSE place END, '', shown FROM starts
        UNION ALL
        SELECT doc_id, leaf, subroot, CASE WHEN w.level + 1 < height THEN w.branch END, height, place, w.level + 1,
            CASE WHEN w.level + 1 = height THEN place ELSE spot // 8 END,
            proof || array_to_string(hs[: (spot % 8)], '') || array_to_string(hs[(spot % 8) + 2 :], ''),
            sha256(array_to_string(hs[: (spot % 8)], '') || folded || array_to_string(hs[(spot % 8) + 2 :], ''))
        FROM walk w JOIN families f
            ON f.branch IS NOT DISTINCT FROM w.branch AND f.parent = spot // 8 AND f.level = CASE WHEN w.branch IS NULL THEN w.level - height ELSE w.level END
    )
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM (SELECT * FROM walk QUALIFY level = max(level) OVER (PARTITION BY doc_id, leaf)), (SELECT h AS root FROM upper WHERE n = 1)
    """


def _leaf(text: str) -> merkle.Column:
    values = [ascii_lower(F.col("text")) if c == "text" and text == "lowered" else F.col(c) for c in LEAF_COLUMNS]
    return merkle.digest(*map(merkle.framed, values))


@query("op13_merkle_manifest", _merkle_sql())
def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(*LEAF_COLUMNS)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, _leaf("lowered"))
    made = merkle.manifest(
        docs, _leaf("text"), branch=F.col("lang"), order=[F.col("doc_id")], carried={"doc_id": F.col("doc_id"), "tampered": tampered}
    )
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("path"))
    shown = made.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors, 16).withColumnRenamed("id", "vec_id")
