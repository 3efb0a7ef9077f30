"""Boosted regression trees that grow level by level, over rows that are packed once; the result is Spark ML's own model.

The rules are those of ``GBTRegressor``: at most 32 intervals per feature, the first tree fits the label and counts in full, every later
one fits twice the rest and counts by the rate, each tree sees a share of the rows and each node a share of the features, a split
needs ``min_leaf`` rows on both sides and a gain. Cuts are the middles between values of a feature with few of them, else quantiles of all rows, off by 1/2,000 of
the ranks at most.

Rows are written once as blocks of bytes (one byte per feature, the rest as a double, a hash), so a pass hands whole blocks to numpy.
One job serves a level: tasks add residuals up per (node, feature, interval) for the smaller half of every split, the other half is
the difference. The job of the first level also brings the rests up to date. What comes back is bounded by nodes x features x
intervals. Packed tables up to ``LOCAL_BYTES`` are grown on the driver by the same functions, as a job would cost more than its work.
Rows that are equal in features and label share their lot when a tree draws its rows.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.session import discard, scratch_path, scratch_root

BINS = 32
#: Points that stand for the values of a feature in a task: a quantile is off by one rank in half as many at most.
POINTS = 4096
#: Rows of a block, blocks of a file.
BLOCK, BLOCKS_PER_FILE = 65_536, 32
#: Packed tables up to this many bytes (a row has one per feature and twelve) are grown on the driver.
LOCAL_BYTES = 64 * 1024 * 1024
#: Trees after which the rests are written to the shared folder.
KEPT = 10
#: Gains up to this share of the tree's first one are rounding.
NO_GAIN = 1e-12
_PACKED = "held boolean, n int, bins binary, rest binary, lot binary"
_NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
    "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)

Block = tuple[bool, np.ndarray, np.ndarray, np.ndarray]  # held, bins (feature, row), rest, lot
Sums = tuple[np.ndarray, ...]


@dataclass
class Tree:
    """Nodes in the order they were made, the root first. ``feature`` is -1 at a leaf, which leads to itself; rows above ``bin`` go right."""

    feature: np.ndarray
    bin: np.ndarray
    child: np.ndarray  # left and right of node k at 2k and 2k + 1
    n: np.ndarray
    s: np.ndarray
    gain: np.ndarray
    depth: int
    q: np.ndarray | None = None

    def mean(self) -> np.ndarray:
        return np.divide(self.s, self.n, out=np.zeros_like(self.s), where=self.n > 0)

    def landed(self, bins: np.ndarray) -> np.ndarray:
        """The node each column of ``bins`` ends in."""
        count = bins.shape[1]
        node, at, cells = np.zeros(count, dtype=np.intp), np.arange(count), bins.reshape(-1)
        first, limit = np.maximum(self.feature, 0) * count, self.bin.astype(np.int16)
        for _ in range(self.depth):
            place = first.take(node)
            place += at
            node *= 2
            node += cells.take(place) > limit.take(node >> 1)
            node = self.child.take(node)
        return node


ROOT = Tree(np.array([-1]), np.array([0]), np.array([0, 0]), *[np.zeros(1)] * 3, depth=0)


@dataclass
class Grown:
    """Trees, mean squared errors on the held rows of their prefixes (empty without such rows), cuts per feature."""

    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    cuts: tuple[np.ndarray, ...] = ()


def drawn(lot: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree sees: the same rows whenever a task is repeated."""
    if share >= 1:
        return np.ones(len(lot), dtype=bool)
    key = (seed * 1_000_003 + tree * 0x9E3779B1 + 1) & 0xFFFFFFFF
    mixed = lot ^ np.uint32(key)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        mixed = (mixed ^ (mixed >> np.uint32(shift))) * np.uint32(factor)
    return (mixed ^ (mixed >> np.uint32(16))) < np.uint32(min(int(share * 2**32), 2**32 - 1))


# --- rows to blocks -------------------------------------------------------------------------------
def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)


def _points(values: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` values of equal weight that stand for all of them in the order of their ranks."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    if len(values) <= most:
        return values, weights
    reached = np.cumsum(weights)
    at = np.searchsorted(reached, (np.arange(most) + 0.5) * (reached[-1] / most))
    return values[np.minimum(at, len(values) - 1)], np.full(most, reached[-1] / most)


def feature_cuts(rows: DataFrame, width: int, bins: int = BINS) -> tuple[np.ndarray, ...]:
    """Ascending cuts per feature of ``x``: middles between its values where there are at most ``bins``, else quantiles of all rows
    from weighted points, merged per task and once more here."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.array([])] * width
        points = [(np.array([]), np.array([]))] * width
        waiting: list[np.ndarray] = []

        def merge() -> None:
            x = np.concatenate(waiting)
            waiting.clear()
            for f in range(width):
                known = np.sort(x[~np.isnan(x[:, f]), f])
                if len(seen[f]) <= bins:
                    seen[f] = np.unique(np.concatenate([seen[f], known]))[: bins + 1]
                fresh = _points(known, np.ones(len(known)), POINTS)
                both = [np.concatenate(pair) for pair in zip(points[f], fresh, strict=True)]
                points[f] = tuple(both) if len(both[0]) <= 64 * POINTS else _points(*both, 32 * POINTS)

        for batch in batches:
            waiting.append(_matrix(batch.column("x"), width))
            if sum(map(len, waiting)) >= 4 * BLOCK:
                merge()
        if waiting:
            merge()
        for f in range(width):
            v, w = _points(*points[f], POINTS)
            v, w = np.concatenate([seen[f], v]), np.concatenate([np.zeros(len(seen[f])), w])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), f, dtype=np.int32)), pa.array(v), pa.array(w)], ["f", "v", "w"])

    parts = rows.select("x").mapInArrow(told, "f int, v double, w double").toPandas()
    out = []
    for f in range(width):
        own = parts[parts["f"] == f]
        few = np.unique(own.loc[own["w"] == 0, "v"].to_numpy())
        v, w = _points(*(own.loc[own["w"] > 0, c].to_numpy() for c in ("v", "w")), len(own))
        if len(few) <= bins:
            out.append((few[1:] + few[:-1]) / 2)
        else:
            reached = np.cumsum(w)
            out.append(np.unique(v[np.searchsorted(reached, np.arange(1, bins) / bins * reached[-1] * (1 - 1e-12))]))
    return tuple(out)


def _pack(rows: DataFrame, cuts: Sequence[np.ndarray]) -> DataFrame:
    width = len(cuts)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bool, list] = {False: [], True: []}

        def block(held: bool) -> pa.RecordBatch:
            bins, rest, lot = (np.concatenate(p, axis=-1) for p in zip(*waiting[held], strict=True))
            waiting[held] = []
            cells = [np.ascontiguousarray(bins).tobytes(), rest.tobytes(), lot.tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([held]), pa.array([len(rest)], pa.int32()), *[pa.array([c], pa.binary()) for c in cells]], ["held", "n", "bins", "rest", "lot"]
            )

        for batch in batches:
            x, y = _matrix(batch.column("x"), width), batch.column("y").to_numpy(zero_copy_only=False)
            # a missing value sorts as the largest, as in the model's own tests
            bins = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]).astype(np.uint8)
            lot = batch.column("u").to_numpy().astype(np.uint64).astype(np.uint32)
            kept = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            for held in (False, True):
                some = kept == held
                if some.any():
                    waiting[held].append((bins[:, some], y[some], lot[some]))
                    if sum(len(p[1]) for p in waiting[held]) >= BLOCK:
                        yield block(held)
        for held in (False, True):
            if waiting[held]:
                yield block(held)

    return rows.mapInArrow(packed, _PACKED)


def _block(held: bool, n: int, bins: bytes, rest: bytes, lot: bytes) -> Block:
    return held, np.frombuffer(bins, np.uint8).reshape(-1, n), np.frombuffer(rest, np.float64), np.frombuffer(lot, np.uint32)


def _added(parts: Iterator[Sums]) -> list[Sums]:
    out: Sums | None = None
    for part in parts:
        out = part if out is None else tuple(a + b for a, b in zip(out, part, strict=True))
    return [] if out is None else [out]


class _Here:
    """Blocks on the driver."""

    def __init__(self, blocks: Sequence[Block]) -> None:
        self.blocks: list[tuple[Block, Sums]] = []
        for held in (False, True):
            if some := [b for b in blocks if b[0] == held]:
                bins, rest, lot = np.concatenate([b[1] for b in some], axis=1), *(np.concatenate([b[i] for b in some]) for i in (2, 3))
                for at in range(0, len(rest), BLOCK):
                    here = slice(at, at + BLOCK)
                    self.blocks.append(((held, np.ascontiguousarray(bins[:, here]), rest[here], lot[here]), ()))

    def total(self, work: Callable[[Block, Sums], Sums]) -> Sums:
        return _added(work(*b) for b in self.blocks)[0]

    def moved(self, work: Callable[[Block], tuple[Block, Sums]]) -> None:
        self.blocks = [work(b) for b, _ in self.blocks]

    def settled(self) -> None:
        pass

    close = settled


class _There:
    """Blocks on the executors; every few trees they are written to the shared folder, so that lineages stay short."""

    def __init__(self, table: DataFrame) -> None:
        self.spark, self.since, self.file, self.before = table.sparkSession, 0, None, None
        self.rdd = table.rdd.map(lambda r: (_block(*r), ())).persist(StorageLevel.MEMORY_AND_DISK)

    def total(self, work: Callable[[Block, Sums], Sums]) -> Sums:
        return _added(iter(self.rdd.mapPartitions(lambda blocks: _added(work(*b) for b in blocks)).collect()))[0]

    def moved(self, work: Callable[[Block], tuple[Block, Sums]]) -> None:
        self.before = self.rdd
        self.rdd = self.before.map(lambda b: work(b[0])).persist(StorageLevel.MEMORY_AND_DISK)
        self.since += 1
        if self.since % KEPT == 0:
            self.rdd.checkpoint()

    def settled(self) -> None:
        """Forget the blocks before the last move, once a job has made the new ones."""
        self.before.unpersist()
        if self.since % KEPT == 0:
            if self.file:
                discard(self.spark, self.file)
            self.file = self.rdd.getCheckpointFile()

    def close(self) -> None:
        self.rdd.unpersist()
        if self.file:
            discard(self.spark, self.file)


# --- growth ---------------------------------------------------------------------------------------
def _histograms(block: Block, tree: Tree, place: np.ndarray, slots: int, bins: int, seed: int, number: int, share: float) -> Sums:
    """Counts and sums by (slot, feature, interval) of the rows that the tree sees, ``place`` telling a node's slot or -1."""
    held, cells, rest, lot = block
    n, s = np.zeros((slots, len(cells), bins)), np.zeros((slots, len(cells), bins))
    if held:
        return n, s
    slot = place.take(tree.landed(cells))
    seen = np.flatnonzero((slot >= 0) & drawn(lot, seed, number, share))
    base, rest = slot[seen] * bins, rest[seen]
    for f in range(len(cells)):
        cell = base + cells[f].take(seen)
        n[:, f] = np.bincount(cell, minlength=slots * bins).reshape(slots, bins)
        s[:, f] = np.bincount(cell, weights=rest, minlength=slots * bins).reshape(slots, bins)
    return n, s


def _moved(block: Block, tree: Tree, values: np.ndarray, seed: int, number: int, share: float) -> tuple[Block, Sums]:
    """The block with the rests after ``tree``, and the sum of squares before it at every node of the rows that the tree sees."""
    held, cells, rest, lot = block
    node, size = tree.landed(cells), len(tree.n)
    seen = np.zeros(len(rest), dtype=bool) if held else drawn(lot, seed, number, share)
    squares = np.bincount(node[seen], weights=rest[seen] ** 2, minlength=size)
    return (held, cells, rest - values.take(node), lot), (squares,)


def _first(block: Block, before: Sums, bins: int, seed: int, number: int, share: float) -> Sums:
    """The histograms of a tree's root, the held rows' squares and what the move left."""
    missed = np.array([(block[2] ** 2).sum() if block[0] else 0.0])
    return (*_histograms(block, ROOT, np.zeros(1, dtype=np.intp), 1, bins, seed, number, share), missed, *before)


def best_splits(n: np.ndarray, s: np.ndarray, min_leaf: int, columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The best split of every node from counts and sums by (node, feature, interval): gain (-inf without one), feature, interval and
    count and sum on the left. ``columns`` tells by (node, feature) what may be split. Ties go to the first feature and interval."""
    left_n, left_s = np.cumsum(n, axis=2)[:, :, :-1], np.cumsum(s, axis=2)[:, :, :-1]
    all_n, all_s = n.sum(axis=2, keepdims=True), s.sum(axis=2, keepdims=True)
    right_n, right_s = all_n - left_n, all_s - left_s
    good = (left_n >= max(min_leaf, 1)) & (right_n >= max(min_leaf, 1)) & columns[:, :, None]
    gain = np.full(left_n.shape, -np.inf)
    np.copyto(gain, left_s**2 / np.maximum(left_n, 1) + right_s**2 / np.maximum(right_n, 1) - all_s**2 / np.maximum(all_n, 1), where=good)
    flat = gain.reshape(len(n), -1)
    at = np.argmax(flat, axis=1) if flat.shape[1] else np.zeros(len(n), dtype=int)
    rows, cuts = np.arange(len(n)), max(left_n.shape[2], 1)
    if not flat.shape[1]:
        return (np.full(len(n), -np.inf), *[np.zeros(len(n), dtype=int)] * 2, *[np.zeros(len(n))] * 2)
    return flat[rows, at], at // cuts, at % cuts, left_n.reshape(flat.shape)[rows, at], left_s.reshape(flat.shape)[rows, at]


def _columns(seed: int, number: int, nodes: Sequence[int], width: int, share: float) -> np.ndarray:
    out = np.ones((len(nodes), width), dtype=bool)
    wanted = max(1, math.ceil(share * width))
    if wanted < width:
        out[:] = False
        for k, node in enumerate(nodes):
            out[k, np.random.default_rng((seed, number, node)).choice(width, wanted, replace=False)] = True
    return out


def _grown_tree(table: _Here | _There, root: Sums, width: int, bins: int, s: dict, number: int) -> Tree:
    seed, share, columns = s["seed"], s["rows"], 1.0 if s["columns"] == "all" else float(s["columns"])
    feature, cut, child, count, total, gain = [-1], [0], [0, 0], [0.0], [0.0], [0.0]

    def tree(depth: int) -> Tree:
        return Tree(np.array(feature), np.array(cut), np.array(child), np.array(count), np.array(total), np.array(gain), depth)

    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    open_, pairs, depth, floor = [0], [(0, None, None)], 0, 0.0
    count[0], total[0] = root[0][0, 0].sum(), root[1][0, 0].sum()
    while open_ and depth < s["depth"]:
        if depth == 0:
            n, sums = root
        else:
            asked = [small for small, _, _ in pairs]
            place = np.full(len(feature), -1)
            place[asked] = np.arange(len(asked))
            now, slots = tree(depth), len(asked)
            n, sums = table.total(lambda b, _: _histograms(b, now, place, slots, bins, seed, number, share))
        above, known = known, {}
        for k, (small, large, parent) in enumerate(pairs):
            known[small] = (n[k], sums[k])
            if large is not None:
                known[large] = (above[parent][0] - n[k], above[parent][1] - sums[k])
        nodes = [k for k in open_ if k in known]
        found = best_splits(*(np.stack([known[k][i] for k in nodes]) for i in (0, 1)), s["min_leaf"], _columns(seed, number, nodes, width, columns))
        if depth == 0:
            floor = max(0.0, NO_GAIN * found[0][0])
        open_, pairs = [], []
        for k, best, f, b, left_n, left_s in zip(nodes, *found, strict=True):
            if not best > floor:
                continue
            low, high = len(feature), len(feature) + 1
            feature[k], cut[k], gain[k], child[2 * k], child[2 * k + 1] = int(f), int(b), float(best), low, high
            feature += [-1, -1]
            cut += [0, 0]
            child += [low, low, high, high]
            gain += [0.0, 0.0]
            count += [float(left_n), count[k] - float(left_n)]
            total += [float(left_s), total[k] - float(left_s)]
            halves = sorted((low, high), key=lambda x: (count[x], x))
            if count[halves[1]] >= 2 * s["min_leaf"]:
                pairs.append((halves[0], halves[1], k))
                open_ += [x for x in (low, high) if count[x] >= 2 * s["min_leaf"]]
        depth += 1
    return tree(depth)


def grow(
    train: DataFrame, held: DataFrame | None, settings: dict, label: str, stop: Callable[[list[float]], bool] | None = None, strict: bool = False
) -> Grown:
    """Trees over all rows of ``train`` (with ``features``) until their number is reached or ``stop`` says so from the errors on ``held``.

    As in the library, a missing or infinite feature of a training row is an error; ``strict`` asks the same of held rows.
    """
    spark = train.sparkSession
    parts = [(train, False)] if held is None else [(train, False), (held, True)]

    def features(finite: bool) -> Column:
        x = vector_to_array("features")
        odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        return F.when(odd, F.raise_error(F.lit("features must be finite numbers"))).otherwise(x) if finite else x

    slim = [df.select(features(strict or not mark).alias("x"), F.col(label).cast("double").alias("y"), F.lit(mark).alias("held")) for df, mark in parts]
    first = slim[0].select(F.size("x").alias("d")).first()
    if first is None:
        raise ValueError("no row to fit")
    width = first["d"]
    rows = slim[0] if len(slim) == 1 else slim[0].unionByName(slim[1])
    y = F.col("y")
    checked = F.when(y.isNull() | F.isnan(y) | (F.abs(y) == float("inf")), F.raise_error(F.lit(f"{label} must be a finite number"))).otherwise(y)
    rows = rows.select("x", checked.alias("y"), F.xxhash64("x", "y").alias("u"), "held")
    cuts = feature_cuts(slim[0], width)
    path = scratch_path(spark, "packed")
    _pack(rows, cuts).write.option("maxRecordsPerFile", BLOCKS_PER_FILE).parquet(path)
    packed = spark.read.schema(_PACKED).parquet(path)
    sizes = {r["held"]: r["n"] for r in packed.groupBy("held").agg(F.sum("n").alias("n")).collect()}
    scratch_root(spark)
    table = _Here([_block(*r) for r in packed.collect()]) if sum(sizes.values()) * (width + 12) <= LOCAL_BYTES else _There(packed)
    bins, out = max((len(c) for c in cuts), default=0) + 1, Grown(cuts=cuts)
    seed, share = settings["seed"], settings["rows"]
    try:
        told = table.total(lambda b, before: _first(b, before, bins, seed, 0, share))
        for number in range(settings["trees"]):
            tree = _grown_tree(table, told[:2], width, bins, settings, number)
            values = tree.mean() * (1.0 if number == 0 else 2 * settings["rate"])
            table.moved(lambda b: _moved(b, tree, values, seed, number, share))  # noqa: B023
            told = table.total(lambda b, before: _first(b, before, bins, seed, number + 1, share))  # noqa: B023
            table.settled()
            tree.q = told[3]
            out.trees.append(tree)
            if held is not None and sizes.get(True):
                out.errors.append(float(told[2][0]) / sizes[True])
                if stop and stop(out.errors):
                    break
    finally:
        table.close()
        discard(spark, path)
    return out


def within_tolerance(errors: Sequence[float], tolerance: float) -> bool:
    """Whether the last error gained less than the tolerance on the best before it, the library's rule."""
    return len(errors) > 1 and min(errors[:-1]) - errors[-1] < tolerance * max(errors[-1], 0.01)


# --- the model ------------------------------------------------------------------------------------
def _preorder(tree: Tree, cuts: Sequence[np.ndarray], factor: float) -> list[tuple]:
    """The nodes of a tree as the library stores them: numbered depth first, with the sums of what the tree was fitted to."""
    q = tree.q.copy()
    for k in range(len(q) - 1, -1, -1):
        if tree.feature[k] >= 0:
            q[k] = q[tree.child[2 * k]] + q[tree.child[2 * k + 1]]
    out: list[tuple] = []

    def put(k: int) -> int:
        at, n = len(out), float(tree.n[k])
        mean = factor * float(tree.s[k]) / n if n else 0.0
        stats = [n, factor * float(tree.s[k]), factor**2 * float(q[k])]
        impurity = max(0.0, stats[2] / n - mean**2) if n else 0.0
        out.append(())
        if tree.feature[k] < 0:
            out[at] = (at, mean, impurity, stats, int(n), -1.0, -1, -1, (-1, [], -1))
        else:
            low, high = put(int(tree.child[2 * k])), put(int(tree.child[2 * k + 1]))
            cut = (int(tree.feature[k]), [float(cuts[tree.feature[k]][tree.bin[k]])], -1)
            out[at] = (at, mean, impurity, stats, int(n), factor**2 * float(tree.gain[k]) / n, low, high, cut)
        return at

    put(0)
    return out


def as_model(spark: SparkSession, grown: Grown, estimator: GBTRegressor, trees: int | None = None) -> GBTRegressionModel:
    """The first ``trees`` trees as Spark ML's model, with the parameters of ``estimator``; written in its format and loaded."""
    some, rate = grown.trees[:trees], estimator.getStepSize()
    told = [(t, *node) for t, tree in enumerate(some) for node in _preorder(tree, grown.cuts, 1.0 if t == 0 else 2.0)]
    path = scratch_path(spark, "model")
    about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    plain = {p.name: v for p, v in estimator._paramMap.items()}
    usual = {p.name: v for p, v in estimator._defaultParamMap.items()}
    of_trees = ("featuresCol", "labelCol", "maxDepth", "minInstancesPerNode", "seed")
    one = {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", **about, "defaultParamMap": {"impurity": "variance"}}
    whole = {
        "class": "org.apache.spark.ml.regression.GBTRegressionModel", **about, "uid": estimator.uid, "paramMap": plain, "defaultParamMap": usual,
        "numFeatures": len(grown.cuts), "numTrees": len(some),
    }
    single = [
        json.dumps({**one, "uid": f"dtr_{estimator.uid}_{t}", "paramMap": {k: plain[k] for k in of_trees if k in plain}}) for t in range(len(some))
    ]
    try:
        spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        weights = [(t, text, 1.0 if t == 0 else rate) for t, text in enumerate(single)]
        spark.createDataFrame(weights, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame([(t, node) for t, *node in told], _NODE).write.parquet(f"{path}/data")
        return GBTRegressionModel.load(path)
    finally:
        discard(spark, path)
