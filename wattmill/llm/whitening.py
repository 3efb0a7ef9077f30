"""Whitened embeddings by MLlib block matrices.

Entries become longs (``floor(64 * c) + 1000000``), so counts and sums are exact. The fit list is each distinct vector once, its rows
numbered from 0, centred as ``(n * x - S) / n`` and dealt into blocks of a :class:`BlockMatrix`; transposed times itself gives the
scatter matrix, the only thing that comes to the driver (dimension squared, whatever the rows). ``eigh`` there gives the whitening
matrix, and one more block multiplication projects every row. The identity error comes from the projected fit list, multiplied
with its own transpose in the same way.

The product of a tall matrix with itself has a single result block; left alone, MLlib would send all rows to one task for it. The
middle dimension is therefore split into as many parts as there are blocks, and only dimension-squared partial sums
meet. Blocks hold :data:`BLOCK_BYTES`; a product takes :data:`SLAB_BLOCKS` blocks at a time, because MLlib lists the blocks of a
product on the driver, and the scatter matrices of the slabs add up.

Defined results: rows whose vector is null or holds null or non-finite entries are dropped; so are rows whose vector has not the
commonest length (of equally common ones the longer). Repeated vectors count once in the fit and are each returned; null and repeated
ids pass through. Directions in which the fit list does not vary have no component (equal vectors or a single row give none).
Of two equal eigenvalues the order of ``eigh`` decides. An empty table gives an empty result. Columns other than id and vector are
ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.llm.common import placed
from wattmill.llm.topk import usable
from wattmill.session import stage

BLOCK_BYTES = 8 * 1024 * 1024
SLAB_BLOCKS = 16_384
SCALE, SHIFT = 64.0, 1_000_000
RESULT = "id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Fit:
    """What the distinct vectors give: their number, sums per dimension, eigenvalues falling, unit vectors as columns, trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    distinct: DataFrame

    @property
    def whitening(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def whole_entries(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))


def _numbered(rows: DataFrame, label: str) -> DataFrame:
    """``rows``, written, with ``idx`` from 0 without gaps."""
    written = stage(rows.withColumn("_all", F.lit("-")), label)
    first = [c for c in rows.columns if not c.startswith("x")]
    return placed(written, "_all", ["_all", *first] if first else ["_all"]).drop("_all")


def _exceeding(x: Column, fit_n: int, sums: list[int]) -> Column:
    """``n * x - S`` by dimension, exact."""
    total = F.array(*[F.lit(s).cast("long") for s in sums])
    return F.zip_with(x, total, lambda a, s: a * F.lit(fit_n).cast("long") - s)


def _matrix(rows: DataFrame, x: Column, n: int, sums: list[int], per_block: int, first: int = 0, count: int = 0) -> BlockMatrix:
    """Centred rows, numbered by ``idx - first``, as blocks of all columns."""
    centred = F.transform(_exceeding(x, n, sums), lambda v: v / F.lit(float(n)))
    some = rows.select((F.col("idx") - first).alias("index"), array_to_vector(centred).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(some, "vector"), count, len(sums)).toBlockMatrix(per_block, len(sums))


def _squared(matrix: BlockMatrix, blocks: int) -> np.ndarray:
    """The matrix' transpose times the matrix, the long middle dimension split by block."""
    turned = matrix.transpose()
    product = turned._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, blocks)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _slabs(count: int, per_block: int) -> list[tuple[int, int]]:
    """Ranges of rows (start, rows) that a product takes at a time."""
    size = per_block * SLAB_BLOCKS
    return [(start, min(size, count - start)) for start in range(0, count, size)]


def _per_block(dimension: int) -> int:
    return max(1, BLOCK_BYTES // (8 * dimension))


def fit(vectors: DataFrame, components: int | None = None) -> Fit | None:
    """The fit over the distinct arrays ``x`` (longs, all of one length); None where nothing varies."""
    distinct = _numbered(vectors.select("x").distinct(), "distinct")
    totals = distinct.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
    found = sorted(tuple(r) for r in totals.collect())
    if not found:
        return None
    sums, n, size = [s for _, s, _ in found], found[0][2], len(found)
    scatter, per_block = np.zeros((size, size)), _per_block(size)
    for start, count in _slabs(n, per_block):
        rows = distinct.where((F.col("idx") >= start) & (F.col("idx") < start + count))
        scatter += _squared(_matrix(rows, F.col("x"), n, sums, per_block, start, count), -(-count // per_block))
    values, directions = np.linalg.eigh(scatter / n)
    values, directions = values[::-1], directions[:, ::-1]
    varies = int((values > values[0] * size * np.finfo(float).eps * 16).sum()) if values[0] > 0 else 0
    kept = min(varies, components or varies)
    if not kept:
        return None
    return Fit(n, sums, values[:kept], directions[:, :kept], float(np.trace(scatter) / n), distinct)


def _projected(rows: DataFrame, model: Fit, start: int, count: int) -> BlockMatrix:
    size, kept = model.vectors.shape
    matrix = _matrix(rows.where((F.col("idx") >= start) & (F.col("idx") < start + count)), F.col("x"), model.n, model.sums, _per_block(size), start, count)
    whole = Matrices.dense(size, kept, model.whitening.flatten(order="F"))
    by = BlockMatrix(rows.sparkSession.sparkContext.parallelize([((0, 0), whole)], 1), size, kept)
    return matrix.multiply(by)


def identity_error(model: Fit) -> float:
    """Largest entry of the covariance of the whitened fit list minus the identity."""
    size, kept = model.vectors.shape
    total, per_block = np.zeros((kept, kept)), _per_block(size)
    for start, count in _slabs(model.n, per_block):
        total += _squared(_projected(model.distinct, model, start, count), -(-count // per_block))
    return float(np.abs(total / model.n - np.eye(kept)).max())


def project(rows: DataFrame, model: Fit) -> DataFrame:
    """Numbered ``rows`` (``idx``, ``x``) as ``idx, whitened``: an array with one entry per component."""
    count = (rows.agg(F.max("idx")).first()[0] or 0) + 1
    parts = []
    for start, some in _slabs(count, _per_block(len(model.sums))):
        matrix = _projected(rows, model, start, some).toIndexedRowMatrix()
        told = callMLlibFunc("getIndexedRows", matrix._java_matrix_wrapper._java_model)
        told = MLUtils.convertVectorColumnsToML(told.toDF("index", "vector"), "vector")
        parts.append(told.select((F.col("index") + start).alias("idx"), vector_to_array("vector").alias("whitened")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def whiten(embeddings: DataFrame, components: int | None = None, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, component`` (from 1), ``n, deviation, whitened, explained, identity_error`` for every usable row and component."""
    spark = embeddings.sparkSession
    clean = embeddings.where(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    common = clean.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    nothing = spark.createDataFrame([], RESULT)
    if common is None:
        return nothing
    rows = _numbered(clean.where(F.size("v") == common["length"]).select("id", whole_entries(F.col("v")).alias("x")), "whole")
    model = fit(rows, components)
    if model is None:
        return nothing
    squares = F.transform(_exceeding(F.col("x"), model.n, model.sums), lambda d: d * d)
    told = rows.select("idx", "id", F.aggregate(squares, F.lit(0).cast("long"), lambda a, d: a + d).alias("deviation"))
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    found = told.join(project(rows, model), "idx").select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return found.select(
        "id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(identity_error(model)).alias("identity_error"),
    )
