"""Approximate cosine search: inverted lists with product-quantised codes, exact re-ranking of a short list.

The index is fitted on a bounded sample (:data:`SAMPLE_ROWS` rows with the smallest hashes): coarse centres by Spark's k-means, and for
each slice of the residual vector a codebook of up to 256 entries. Every row of the table is then coded in one pass: the number of its
nearest centre and one byte per slice. A search scans the codes of the probed lists only, a table lookup per byte instead of a product
per component, keeps a short list per query in each task, merges these, and reads the full vectors of the short list alone.

Probing fewer lists pays where vectors form clusters; by default all lists are scanned, because codes are small and isotropic
vectors have their neighbours in every list. Null, ragged, zero or non-finite vectors are not coded and never found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattmill.operators.lookup import BROADCAST_BYTES, measured_bytes
from wattmill.operators.vectors import QUERY_BYTES, SCORE_DIGITS, TOP_K
from wattmill.session import pin, stage

#: Rows that centres and codebooks are fitted on, entries of a codebook, rounds of its refinement, components of a slice.
SAMPLE_ROWS, ENTRIES, ROUNDS, SLICE = 20_000, 256, 12, 2
_SHORT = "query_id long, vec_id long, near double"


@dataclass(frozen=True)
class CodedIndex:
    """``codes`` (``vec_id, list, code``, written), centres, and one codebook per slice: ``(slices, entries, components)``."""

    codes: DataFrame
    centres: np.ndarray
    books: np.ndarray
    dim: int


def unit_vector(vector: Column, dim: int) -> Column:
    """The vector at length one; null where it has another size, no length, or a component that is no finite number."""
    plain = vector.cast("array<double>")
    bad = F.exists(plain, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    length = F.sqrt(F.aggregate(plain, F.lit(0.0), lambda a, x: a + x * x))
    made = F.transform(plain, lambda x: x / length)
    return F.when((F.size(vector) == dim) & ~bad & (length > 0), made)


def _codebook(points: np.ndarray, seed: int) -> np.ndarray:
    """Entries of one slice by Lloyd's rounds over the sample; equal entries fill up what the points cannot."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    book = distinct[rng.permutation(len(distinct))[:ENTRIES]]
    for _ in range(ROUNDS if len(distinct) > ENTRIES else 0):
        nearest = _nearest(points, book)
        held = np.bincount(nearest, minlength=len(book))
        for axis in range(points.shape[1]):
            sums = np.bincount(nearest, weights=points[:, axis], minlength=len(book))
            book[:, axis] = np.where(held > 0, sums / np.maximum(held, 1), book[:, axis])
    return np.concatenate([book, np.repeat(book[:1], ENTRIES - len(book), axis=0)])


def _nearest(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(axis=1) - 2.0 * points @ book.T).argmin(axis=1)


def _sliced(matrix: np.ndarray, books: np.ndarray) -> np.ndarray:
    """``(slices, rows, components)``, the last slice filled up with zeros."""
    slices, _, width = books.shape
    padded = np.zeros((len(matrix), slices * width))
    padded[:, : matrix.shape[1]] = matrix
    return padded.reshape(len(matrix), slices, width).transpose(1, 0, 2)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def build(vectors: DataFrame, dim: int, lists: int = 16, seed: int = 42) -> CodedIndex | None:
    """Fit on the sample, code every row of ``vectors`` (``vec_id, embedding``); None without a usable vector."""
    usable = vectors.select(F.col("vec_id").cast("long"), unit_vector(F.col("embedding"), dim).alias("unit")).where("unit is not null")
    sample = pin(usable.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(SAMPLE_ROWS))
    points = np.array([r["unit"] for r in sample.select("unit").collect()], dtype=np.float64)
    if not len(points):
        return None
    apart = min(lists, len(np.unique(points, axis=0)))
    coarse = KMeans(k=apart, seed=seed, maxIter=10, initMode="random") if apart > 1 else None
    spread = sample.select("unit").distinct().orderBy(F.xxhash64("unit")).select(array_to_vector("unit").alias("features"))
    centres = np.array(coarse.fit(spread).clusterCenters()) if coarse else points[:1]
    slices = -(-dim // SLICE)
    rest = _sliced(points - centres[_nearest(points, centres)], np.zeros((slices, 1, SLICE)))
    books = np.stack([_codebook(rest[i], seed + i) for i in range(slices)])
    sent = vectors.sparkSession.sparkContext.broadcast((centres, books))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres_, books_ = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column("unit"))
            near = _nearest(matrix, centres_)
            parts = _sliced(matrix - centres_[near], books_)
            codes = np.stack([_nearest(p, b) for p, b in zip(parts, books_, strict=True)], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(near.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())], names=["vec_id", "list", "code"]
            )

    made = usable.mapInArrow(code, "vec_id long, list int, code binary")
    return CodedIndex(stage(made.sortWithinPartitions("list"), "codes"), centres, books, dim)


def _short_lists(index: CodedIndex, ids: np.ndarray, queries: np.ndarray, probes: int, short: int) -> DataFrame:
    """``query_id, vec_id, near``: per task the ``short`` best rows of each query by codes, ties by smaller id."""
    toward = queries @ index.centres.T
    probed = np.zeros_like(toward, dtype=bool)
    np.put_along_axis(probed, np.argsort(-toward, axis=1, kind="stable")[:, :probes], True, axis=1)
    tables = np.einsum("sqw,sew->sqe", _sliced(queries, index.books), index.books)
    sent = index.codes.sparkSession.sparkContext.broadcast((ids, toward, probed, tables))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_, toward_, probed_, tables_ = sent.value
        best = [(np.zeros(0), np.zeros(0, dtype=np.int64))] * len(ids_)
        for batch in batches:
            if not batch.num_rows:
                continue
            vec, place = batch.column("vec_id").to_numpy(), batch.column("list").to_numpy()
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8).reshape(len(vec), -1)
            for number in np.unique(place):
                asking = np.flatnonzero(probed_[:, number])
                rows = np.flatnonzero(place == number)
                if not len(asking):
                    continue
                scores = np.repeat(toward_[asking, number][:, None], len(rows), axis=1)
                for s in range(codes.shape[1]):
                    scores += tables_[s][asking][:, codes[rows, s]]
                for q, found in zip(asking.tolist(), scores, strict=True):
                    near, who = np.concatenate([best[q][0], found]), np.concatenate([best[q][1], vec[rows]])
                    top = np.lexsort((who, -near))[:short]
                    best[q] = near[top], who[top]
        sizes = [len(b[1]) for b in best]
        if sum(sizes):
            flat = [np.repeat(ids_, sizes), np.concatenate([b[1] for b in best]), np.concatenate([b[0] for b in best])]
            yield pa.RecordBatch.from_arrays([pa.array(f) for f in flat], names=["query_id", "vec_id", "near"])

    lists = np.flatnonzero(probed.any(axis=0)).tolist()
    codes = index.codes if len(lists) == len(index.centres) else index.codes.where(F.col("list").isin(lists))
    return codes.mapInArrow(scan, _SHORT)


def _tiles(queries: DataFrame, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and unit vectors of the queries, so many at a time as :data:`QUERY_BYTES` allows with their lookup tables."""
    asked = pin(queries.select(F.col("query_id").cast("long"), unit_vector(F.col("embedding"), dim).alias("unit")).where("unit is not null"))
    each = 8 * ENTRIES * -(-dim // SLICE)
    tiles = max(1, -(-asked.count() * each // QUERY_BYTES))
    for tile in range(tiles):
        rows = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(tiles)) == tile).orderBy("query_id").collect()
        if rows:
            yield np.array([r["query_id"] for r in rows], dtype=np.int64), np.array([r["unit"] for r in rows], dtype=np.float64)


def search(
    index: CodedIndex | None, vectors: DataFrame, queries: DataFrame, k: int = TOP_K, *, short: int | None = None, probes: int | None = None
) -> DataFrame:
    """``query_id, vec_id, similarity, rank, read``: ``k`` hits per query, and how many full vectors were read for it.

    ``short`` rows per query (at least ``k``, by default ten times ``k``) are ranked by full vectors. No index gives no hits.
    """
    spark = vectors.sparkSession
    nothing = spark.createDataFrame([], "query_id long, vec_id long, similarity double, rank int, read long")
    if index is None:
        return nothing
    keep = max(k, short or 10 * k)
    found: DataFrame | None = None
    for ids, matrix in _tiles(queries, index.dim):
        part = _short_lists(index, ids, matrix, probes or len(index.centres), keep)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return nothing
    order = W.partitionBy("query_id").orderBy(F.desc("near"), "vec_id")
    chosen = stage(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep).select("query_id", "vec_id"), "short-list")

    wanted = F.broadcast(chosen) if measured_bytes(chosen) <= BROADCAST_BYTES else chosen
    full = vectors.select(F.col("vec_id").cast("long"), unit_vector(F.col("embedding"), index.dim).alias("unit"))
    asked = queries.select(F.col("query_id").cast("long"), unit_vector(F.col("embedding"), index.dim).alias("ask"))
    met = full.join(wanted, "vec_id").where("unit is not null").join(asked, "query_id")
    product = F.aggregate(F.zip_with("unit", "ask", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = met.select("query_id", "vec_id", F.round(product, SCORE_DIGITS).alias("similarity"))
    best = W.partitionBy("query_id").orderBy(F.desc("similarity"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(best)).withColumn("read", F.count(F.lit(1)).over(W.partitionBy("query_id")))
    return ranked.where(F.col("rank") <= k)
