"""Exact top-k by inner product with a table of pivot distances.

Every vector keeps its distances to a fixed set of pivots. For a query the
triangle inequality turns them into a lower bound on its distance to a vector,
``max |d(q, p) - d(x, p)|`` over the pivots, and so into an upper bound on the
inner product, ``(|q|^2 + |x|^2 - d^2) / 2``. Candidates are scored in the order
of that bound and the search stops when the next bound is below the k-th best
score, so the result is exact.

The table is computed once per vector and written. Its rows belong to the group of their nearest pivot; a group keeps the
smallest and largest distance to every pivot, so one bound can exclude it for a whole query. Groups are cut into cells of about
:data:`CELL` numbers, queries into tiles of about :data:`TILE` rows. Only tiles travel: first to one cell of their own group, which
gives every query a score that its k-th best cannot fall below, then to all cells of the groups that this score leaves open.
A tile and a cell hand on ``k`` rows per query.

Components become ``floor(256 * x)`` (as double). Vectors that are null, empty or hold a
null or non-finite component take no part; only vectors of one length are
compared. Repeated rows and equal vectors are ordinary candidates; ties go to the smaller id, a
query never meets rows of its own id. Query rows that repeat are asked once. Null ids take no part. Scores beyond a long are held at its ends.
Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattmill.session import stage

PIVOTS = 32
#: Rows of one query tile, and of its slices whose bounds are held at once.
TILE, SLICE = 512, 16
#: Numbers (components and distances) of one cell: 16 MB as doubles.
CELL = 1 << 21
#: Candidates scored at first between two looks at the next bound; the number doubles while none ends the search.
STEP = 64
#: Slack for the rounding of square roots, relative to the squared lengths.
SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(256.0 * flat.reshape(len(column), -1).astype(np.float64))


def usable(vector: Column) -> Column:
    """Present, not empty and every component a finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products; beyond 53 bits by whole numbers."""
    top = max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0))
    if top * top * max(1, queries.shape[1]) < 2.0**53:
        return (queries @ vectors.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in queries], dtype=object).reshape(queries.shape) @ (
        np.array([[int(x) for x in row] for row in vectors], dtype=object).reshape(vectors.shape).T
    )
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances to the pivots from plain differences, one pivot at a time: no cancellation."""
    out = np.empty((len(rows), len(pivots)))
    for i, pivot in enumerate(pivots):
        diff = rows - pivot
        out[:, i] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


class Cell:
    """Vectors of one group with their part of the pivot table."""

    def __init__(self, batches: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(batches).combine_chunks()
        self.ids = rows["id"].to_numpy()
        self.vectors = _matrix(rows["vector"].combine_chunks())
        self.table = rows["distances"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1).T.copy()
        self.square = np.einsum("ij,ij->i", self.vectors, self.vectors)

    def bounds(self, distances: np.ndarray, square: np.ndarray) -> np.ndarray:
        """No inner product of the queries and the rows is above these."""
        nearest = np.zeros((len(distances), len(self.ids)))
        for p, known in enumerate(self.table):
            np.maximum(nearest, np.abs(distances[:, p, None] - known[None, :]), out=nearest)
        whole = square[:, None] + self.square[None, :]
        return (whole - nearest * nearest) / 2 + SLACK * whole + 1

    def best(self, query: int, vector: np.ndarray, bounds: np.ndarray, k: int, floor: int | None) -> tuple[list[tuple[int, int]], int]:
        """The ``k`` best (score, id) from ``floor`` on, and how many rows were scored."""
        best: list[tuple[int, int]] = []
        open_ = np.flatnonzero(self.ids != query if floor is None else (self.ids != query) & (bounds >= floor))
        order = open_[np.argsort(-bounds[open_], kind="stable")]
        at, step = 0, STEP
        while at < len(order) and (floor is None or bounds[order[at]] >= floor):
            some = order[at : at + step]
            found = _scores(vector[None, :], self.vectors[some])[0]
            near = range(len(some)) if floor is None else np.flatnonzero(found >= floor)
            best = sorted(best + [(int(found[j]), int(self.ids[some[j]])) for j in near], key=lambda x: (-x[0], x[1]))[:k]
            if len(best) == k:
                floor = best[-1][0] if floor is None else max(floor, best[-1][0])
            at, step = at + len(some), 2 * step
        return best, min(at, len(order))


def choose_pivots(vectors: DataFrame, count: int) -> np.ndarray:
    """``count`` different rows with the smallest hashes of their content: a bounded sample, spread over the data."""
    hashed = vectors.select("vector", F.xxhash64("vector").alias("h"))
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(count).collect()]
    rows = hashed.where(F.col("h").isin(least)).groupBy("h").agg(F.min("vector").alias("vector")).orderBy("h").collect()
    return np.floor(256.0 * np.array([r["vector"] for r in rows], dtype=np.float64))


def exact_top_k(
    embeddings: DataFrame, is_query: Column, k: int = 5, *, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best partners of every row where ``is_query`` holds."""
    spark = embeddings.sparkSession
    clean = embeddings.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    clean = clean.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("asks"))
    parts = []
    for (size,) in sorted(tuple(r) for r in clean.select(F.size("vector").alias("n")).distinct().collect()):
        parts.append(_one_length(clean.where(F.size("vector") == size), k, pivots))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _one_length(vectors: DataFrame, k: int, pivots: int) -> DataFrame:
    first, rest = search_rounds(vectors, k, pivots)
    return first.unionByName(rest).selectExpr("inline(found)")


def pivot_table(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with ``distances`` to the pivots, the nearest one as ``grp``, and their squared length."""
    sent = vectors.sparkSession.sparkContext.broadcast(pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = _matrix(batch.column("vector"))
            table, square = _distances(rows, sent.value), np.einsum("ij,ij->i", rows, rows)
            ends = pa.array(np.arange(len(batch) + 1, dtype=np.int32) * table.shape[1])
            nearest = pa.array(table.argmin(axis=1).astype(np.int32))
            arrays = [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(table.ravel())), nearest, pa.array(square)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "distances", "grp", "square"])

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.mapInArrow(measure, f"id long, vector {kind}, asks boolean, distances array<double>, grp int, square double")


def search_rounds(vectors: DataFrame, k: int, pivots: int) -> tuple[DataFrame, DataFrame]:
    """Rows of ``found`` (an array of query, partner and score) and ``scored`` pairs: each tile in one cell of its group, then elsewhere."""
    spark = vectors.sparkSession
    known = choose_pivots(vectors, pivots)
    table = stage(pivot_table(vectors, known), "pivot-table")
    # one row per group: its rows, its queries, the longest vector, and the range of distances to every pivot
    some = range(len(known))
    ranges = [f(F.col("distances")[i]).alias(f"{n}{i}") for n, f in (("lo", F.min), ("hi", F.max)) for i in some]
    sizes = [F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q"), F.max("square").alias("longest")]
    groups = table.groupBy("grp").agg(*sizes, *ranges).collect()
    held = {r["grp"]: r for r in groups}
    size = table.select(F.size("vector")).first()[0]
    cells = {g: -(-r["n"] * (size + len(known)) // CELL) for g, r in held.items()}
    tiles = {g: max(1, -(-r["q"] // TILE)) for g, r in held.items()}
    names = sorted(held)
    low, high = (np.array([[held[g][f"{n}{i}"] for i in some] for g in names]) for n in ("lo", "hi"))
    sent = spark.sparkContext.broadcast((known, k, names, low, high, np.array([held[g]["longest"] for g in names])))

    of = lambda counts: F.element_at(F.create_map(*[F.lit(x) for g in names for x in (g, counts[g])]), F.col("grp"))
    place = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    dealt = table.select("grp", F.pmod(place, of(cells)).cast("int").alias("cell"), F.lit(0).alias("side"), "id", "vector", "distances")
    queries = table.where("asks").select("grp", "id", "vector").distinct()
    tile = F.pmod(F.xxhash64("id", "vector"), of(tiles)).cast("int")
    asked = queries.groupBy("grp", tile.alias("tile")).agg(F.collect_list(F.struct("id", "vector")).alias("asked"))
    asked = asked.select("grp", "asked", F.expr("cast(null as array<bigint>)").alias("floors"))
    grain = max(spark.sparkContext.defaultParallelism, sum(cells.values()))

    first = stage(_meet(dealt.where("cell = 0"), asked.withColumn("cell", F.lit(0)), grain, sent), "first-cells")
    # the cells that remain to be seen of the groups that remain open
    left = F.filter(F.sequence(F.lit(0), of(cells) - 1), lambda c: (F.col("grp") != F.col("home")) | (c > 0))
    onward = first.select(F.col("grp").alias("home"), "asked", "floors", F.explode("visit").alias("grp"))
    onward = onward.select("grp", "asked", "floors", F.explode(left.cast("array<int>")).alias("cell"))
    return first.select("found", "scored"), _meet(dealt, onward, grain, sent).select("found", "scored")


def _meet(dealt: DataFrame, tiles: DataFrame, grain: int, sent: Broadcast) -> DataFrame:
    """Every tile against the cell it was sent to: found rows, the floors they give, and the groups these leave open."""
    kinds = {f.name: f.dataType.simpleString() for f in [*dealt.schema, *tiles.schema]}
    null = lambda names: [F.expr(f"cast(null as {kinds[c]})").alias(c) for c in names]
    rows = dealt.select("*", *null(["asked", "floors"]))
    both = rows.unionByName(tiles.select("grp", "cell", F.lit(1).alias("side"), *null(["id", "vector", "distances"]), "asked", "floors"))
    both = both.repartition(grain, "grp", "cell").sortWithinPartitions("grp", "cell", "side")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, cell = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in ("grp", "cell", "side")])
            cuts = [0, *(np.flatnonzero((np.diff(marks) != 0).any(axis=0)) + 1), len(batch)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if at != (marks[0, a], marks[1, a]):
                    at, parts, cell = (marks[0, a], marks[1, a]), [], None
                if marks[2, a] == 0:
                    parts.append(batch.slice(a, b - a).select(["id", "vector", "distances"]))
                    continue
                cell = cell or (Cell(parts) if parts else None)
                parts = []
                for i in range(a, b):
                    yield _answer(batch.slice(i, 1), cell, sent.value)

    asks = kinds["asked"]
    found = "array<struct<query_id:bigint,vec_id:bigint,score:bigint>>"
    return both.mapInArrow(search, f"grp int, asked {asks}, floors array<bigint>, visit array<int>, found {found}, scored bigint")


def _answer(row: pa.RecordBatch, cell: Cell | None, about: tuple) -> pa.RecordBatch:
    known, k, names, low, high, longest = about
    asked = row.column("asked").flatten()
    ids, vectors = asked.field("id").to_numpy(), _matrix(asked.field("vector"))
    floors = row.column("floors")[0].as_py() or [None] * len(ids)
    found: list[tuple[int, int, int]] = []
    visit, scored = np.zeros(len(names), dtype=bool), 0
    for at in range(0, len(ids), SLICE):
        part = vectors[at : at + SLICE]
        distances, square = _distances(part, known), np.einsum("ij,ij->i", part, part)
        bounds = cell.bounds(distances, square) if cell else None
        for i in range(len(part)):
            best, seen = cell.best(ids[at + i], part[i], bounds[i], k, floors[at + i]) if cell else ([], 0)
            scored += seen
            found += [(int(ids[at + i]), v, s) for s, v in best]
            if len(best) == k:
                floors[at + i] = best[-1][0]
            gap = np.maximum(0, np.maximum(low - distances[i], distances[i] - high)).max(axis=1, initial=0)
            whole = square[i] + longest
            above = (whole - gap * gap) / 2 + SLACK * whole + 1
            visit |= above >= floors[at + i] if floors[at + i] is not None else True
    told = [{"query_id": q, "vec_id": v, "score": s} for q, v, s in found]
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("query_id", "vec_id", "score")]))
    open_ = [g for g, seen in zip(names, visit, strict=True) if seen]
    arrays = [
        row.column("grp"), row.column("asked"), pa.array([floors], pa.list_(pa.int64())), pa.array([open_], pa.list_(pa.int32())),
        pa.array([told], kind), pa.array([scored], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["grp", "asked", "floors", "visit", "found", "scored"])
