"""Boosted regression trees that grow best leaf first, from histograms that Spark adds up.

Features are replaced once by the number of the interval they fall into (cuts are exact quantiles of the training rows), and the rows
are written with label, prediction so far and a hash. One job then serves all open leaves: every task adds residuals up per (leaf,
feature, interval), the sums are shuffled and merged, and what comes back is bounded by leaves x features x intervals, whatever the
rows. The leaf with the largest gain is split until the tree has its leaves.

Strict best-first growth needs the gains of a leaf's halves before the next leaf is chosen, which would be a job per split. Instead a
job looks at the halves of every leaf that the growth known so far would choose, and the growth is played again: the tree is the
same, the number of jobs is about its depth.

Missing values (null, NaN) count as smaller than every cut. Rows without a label take no part. Without any row the model has no tree
and predicts 0. Rows that occur twice count twice. Extra columns are carried by :func:`predict` and ignored otherwise.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmill.operators.boosting import stopping_point
from wattmill.operators.quantiles import quantiles
from wattmill.session import discard, scratch_path

#: Trees after which the rows are written again with their new prediction: every pass over the rows walks all trees since then.
REBASE = 3
#: Gains up to this share of the tree's variation are rounding.
NO_GAIN = 1e-12
_SUMS = "node int, feature int, bin int, n double, s double"
_NODES = "tree int, node int, feature int, bin int, left int, right int, value double, gain double"


@dataclass(frozen=True)
class Growth:
    """Settings; ``rows`` and ``columns`` are the shares each tree sees, ``bins`` intervals per feature at most."""

    trees: int = 100
    rate: float = 0.1
    leaves: int = 31
    depth: int | None = None
    min_leaf: int = 20
    rows: float = 1.0
    columns: float = 1.0
    bins: int = 64
    seed: int = 42


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays, the root first; ``feature`` is -1 at a leaf, rows up to interval ``bin`` go ``left``."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def landed(self, bins: np.ndarray) -> np.ndarray:
        """The node each row of ``bins`` ends in: one step per level for all rows at once, a leaf leading to itself."""
        own = np.arange(len(self.feature))
        inner = self.feature >= 0
        tested = np.where(inner, self.feature, 0)
        halves = np.column_stack([np.where(inner, self.right, own), np.where(inner, self.left, own)]).reshape(-1)
        cells, first = np.ascontiguousarray(bins).reshape(-1), np.arange(len(bins)) * bins.shape[1]
        node, reached = np.zeros(len(bins), dtype=np.int64), np.zeros(1, dtype=np.int64)
        while inner[reached].any():
            low = cells[first + tested[node]] <= self.bin[node]
            node = halves[2 * node + low]
            reached = np.unique(halves[np.concatenate([2 * reached, 2 * reached + 1])])
        return node


@dataclass(frozen=True)
class Leafwise:
    """A fitted ensemble; ``errors`` are the validation errors (root mean square) of its prefixes as far as it was grown."""

    features: tuple[str, ...]
    cuts: tuple[np.ndarray, ...]
    base: float
    rate: float
    trees: tuple[Tree, ...]
    errors: tuple[float, ...] = ()

    def cut(self, trees: int) -> Leafwise:
        return replace(self, trees=self.trees[:trees])

    def importances(self, spark: SparkSession) -> DataFrame:
        """``feature, importance``: shares of the summed gains."""
        total = np.zeros(len(self.features))
        for tree in self.trees:
            np.add.at(total, tree.feature[tree.feature >= 0], tree.gain[tree.feature >= 0])
        shares = total / total.sum() if total.sum() else total
        return spark.createDataFrame(list(zip(self.features, shares.tolist(), strict=True)), "feature string, importance double")

    def nodes(self, spark: SparkSession) -> DataFrame:
        """All nodes as a table, one row each."""
        rows = [
            (t, k, *(int(a[k]) for a in (tree.feature, tree.bin, tree.left, tree.right)), float(tree.value[k]), float(tree.gain[k]))
            for t, tree in enumerate(self.trees)
            for k in range(len(tree.feature))
        ]
        return spark.createDataFrame(rows, _NODES)


@dataclass
class _Open:
    """A node while its tree grows: its sums, its best split once known, its halves once made."""

    n: float
    s: float
    depth: int
    split: tuple[float, int, int, float, float] | None = None  # gain, feature, bin, and count and sum on the left
    halves: tuple[int, int] | None = None


@dataclass
class _State:
    """What tasks need beside the written rows."""

    base: float
    rate: float
    trees: list[Tree] = field(default_factory=list)

    def predicted(self, before: np.ndarray, bins: np.ndarray) -> np.ndarray:
        out = before.copy()
        for tree in self.trees:
            out += self.rate * tree.value[tree.landed(bins)]
        return out


def _interval(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.where(np.isnan(values), 0, np.searchsorted(cuts, values, side="left")).astype(np.int16)


def quantile_cuts(rows: DataFrame, features: Sequence[str], bins: int) -> tuple[np.ndarray, ...]:
    """Ascending distinct cuts per feature: its quantiles at ``1/bins, 2/bins, ...``."""
    exprs = {f: F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features}
    wanted = {f"{i}_{j}": (exprs[f], j / bins) for i, f in enumerate(features) for j in range(1, bins)}
    found = quantiles(rows, wanted).first()
    return tuple(
        np.unique([v for v in (found[f"{i}_{j}"] for j in range(1, bins)) if v is not None]).astype(float) for i in range(len(features))
    )


def _written(rows: DataFrame, label: str, features: Sequence[str], cuts: Sequence[np.ndarray], base: float) -> str:
    """Write ``bins, y, f, u, held``; returns the path."""
    slim = rows.select(
        F.array(*[F.col(c).cast("double") for c in features]).alias("x"), F.col(label).cast("double").alias("y"),
        F.xxhash64(*features, label).alias("u"), F.col("_held").alias("held"),
    )

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), len(cuts), np.float64)
            bins = np.column_stack([_interval(x[:, i], c) for i, c in enumerate(cuts)])
            yield _batch(bins, batch.column("y"), np.full(len(x), base), batch.column("u"), batch.column("held"))

    path = scratch_path(rows.sparkSession, "leafwise")
    slim.mapInArrow(coded, "bins array<smallint>, y double, f double, u long, held boolean").write.parquet(path)
    return path


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return values.reshape(-1, width)


def _batch(bins: np.ndarray, y: pa.Array, f: np.ndarray, u: pa.Array, held: pa.Array) -> pa.RecordBatch:
    ends = pa.array(np.arange(0, bins.size + 1, bins.shape[1], dtype=np.int32))
    lists = pa.ListArray.from_arrays(ends, pa.array(bins.reshape(-1), pa.int16()))
    return pa.RecordBatch.from_arrays([lists, y, pa.array(f), u, held], ["bins", "y", "f", "u", "held"])


def _drawn(u: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree sees: the same rows whenever a task is repeated. Equal rows share their lot."""
    mixed = u.astype(np.uint64) ^ np.uint64((seed * 1_000_003 + tree * 2 + 1) & (2**64 - 1))
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return (mixed >> np.uint64(11)).astype(np.float64) / 2.0**53 < share


def _sums(rows: DataFrame, state: _State, tree: Tree, asked: Sequence[int], width: int, bins: int, growth: Growth, number: int, errors: bool):
    """``node, feature, bin, n, s`` of the asked nodes; node -1 holds count and squared error of the validation rows if wanted."""
    place = np.full(len(tree.feature), -1)
    place[list(asked)] = np.arange(len(asked))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(asked) * width * bins
        n, s, missed = np.zeros(size), np.zeros(size), np.zeros(2)
        for batch in batches:
            every = _matrix(batch.column("bins"), width, np.int16)
            y, before = batch.column("y").to_numpy(), batch.column("f").to_numpy()
            held = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            if errors:
                missed += [held.sum(), ((y[held] - state.predicted(before[held], every[held])) ** 2).sum()]
            # only rows of the asked nodes are predicted
            seen = np.flatnonzero(~held & _drawn(batch.column("u").to_numpy(), growth.seed, number, growth.rows))
            at = place[tree.landed(every[seen])]
            seen, at = seen[at >= 0], at[at >= 0]
            rest, x = y[seen] - state.predicted(before[seen], every[seen]), every[seen].astype(np.int64)
            for f in range(width):
                cell = (at * width + f) * bins + x[:, f]
                n += np.bincount(cell, minlength=size)
                s += np.bincount(cell, weights=rest, minlength=size)
        full = np.flatnonzero(n)
        node, f, b = np.asarray(asked, dtype=np.int64)[full // (width * bins)], full // bins % width, full % bins
        if errors:
            node, f, b = np.append(node, -1), np.append(f, 0), np.append(b, 0)
            n, s = np.append(n[full], missed[0]), np.append(s[full], missed[1])
        else:
            n, s = n[full], s[full]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a.astype(np.int32)) for a in (node, f, b)] + [pa.array(n), pa.array(s)], ["node", "feature", "bin", "n", "s"]
        )

    partial = rows.mapInArrow(added, _SUMS)
    return partial.groupBy("node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toPandas()


def best_split(n: np.ndarray, s: np.ndarray, min_leaf: int, columns: Sequence[int]) -> tuple[float, int, int, float, float] | None:
    """The split of one leaf with the largest drop of the squared error, from counts and sums by (feature, bin).

    Ties go to the first feature, then to the lowest interval.
    """
    best = None
    for f in sorted(columns):
        left_n, left_s = np.cumsum(n[f])[:-1], np.cumsum(s[f])[:-1]
        all_n, all_s = n[f].sum(), s[f].sum()
        right_n, right_s = all_n - left_n, all_s - left_s
        good = (left_n >= max(min_leaf, 1)) & (right_n >= max(min_leaf, 1))
        if not good.any():
            continue
        gain = np.full(len(left_n), -np.inf)
        gain[good] = left_s[good] ** 2 / left_n[good] + right_s[good] ** 2 / right_n[good] - all_s**2 / all_n
        top = int(np.argmax(gain))
        if best is None or gain[top] > best[0]:
            best = (float(gain[top]), f, top, float(left_n[top]), float(left_s[top]))
    return best


def _played(nodes: Sequence[_Open], leaves: int, floor: float) -> tuple[list[int], list[int]]:
    """Nodes that best-first growth splits as far as gains are known, and those of them whose halves are still unknown."""
    ready: list[tuple[float, int]] = []

    def offer(at: int) -> None:
        if nodes[at].split and nodes[at].split[0] > floor:
            heapq.heappush(ready, (-nodes[at].split[0], at))

    offer(0)
    chosen, unknown = [], []
    while ready and len(chosen) < leaves - 1:
        at = heapq.heappop(ready)[1]
        chosen.append(at)
        if nodes[at].halves is None:
            unknown.append(at)
        else:
            for half in nodes[at].halves:
                offer(half)
    return chosen, unknown


def _tree(nodes: Sequence[_Open], inner: Sequence[int]) -> Tree:
    """``inner`` nodes as tests, everything else as leaves."""
    size, open_ = len(nodes), set(inner)
    ints = {name: np.full(size, -1) for name in ("feature", "bin", "left", "right")}
    gain = np.zeros(size)
    for at in open_:
        gain[at], ints["feature"][at], ints["bin"][at] = nodes[at].split[:3]
        ints["left"][at], ints["right"][at] = nodes[at].halves
    value = np.array([x.s / x.n if x.n else 0.0 for x in nodes])
    return Tree(**ints, value=value, gain=gain)


def _halved(nodes: list[_Open], at: int) -> None:
    _, _, _, n, s = nodes[at].split
    nodes[at].halves = (len(nodes), len(nodes) + 1)
    nodes += [_Open(n, s, nodes[at].depth + 1), _Open(nodes[at].n - n, nodes[at].s - s, nodes[at].depth + 1)]


def _grown(rows: DataFrame, state: _State, width: int, bins: int, growth: Growth, number: int, errors: bool) -> tuple[Tree | None, float | None]:
    """The next tree (none without rows or gain), and the validation error before it."""
    draw = np.random.default_rng((growth.seed, number))
    columns = sorted(draw.choice(width, max(1, round(growth.columns * width)), replace=False).tolist())
    nodes, error = [_Open(0.0, 0.0, 0)], None
    asked, floor = [0], 0.0
    while True:
        if asked:
            known = _tree(nodes, [k for k, x in enumerate(nodes) if x.halves])
            told = _sums(rows, state, known, asked, width, bins, growth, number, errors and error is None)
            if errors and error is None:
                held = told[told["node"] == -1]
                error = float(np.sqrt(held["s"].sum() / held["n"].sum())) if held["n"].sum() else None
            for at in asked:
                own = told[told["node"] == at]
                n, s = np.zeros((width, bins)), np.zeros((width, bins))
                n[own["feature"], own["bin"]], s[own["feature"], own["bin"]] = own["n"], own["s"]
                if at == 0:
                    nodes[0].n, nodes[0].s = n[0].sum(), s[0].sum()
                nodes[at].split = best_split(n, s, growth.min_leaf, columns)
            if nodes[0].split:
                floor = max(floor, NO_GAIN * nodes[0].split[0])
        chosen, unknown = _played(nodes, growth.leaves, floor)
        if not unknown:
            return (_tree(nodes, chosen) if chosen else None), error
        for at in unknown:
            _halved(nodes, at)
        # the halves of the last leaf that fits are never chosen
        last = chosen[-1] if len(chosen) == growth.leaves - 1 and unknown == chosen[-1:] else None
        asked = [
            half for at in unknown if at != last for half in nodes[at].halves
            if nodes[half].n >= 2 * growth.min_leaf and (growth.depth is None or nodes[half].depth < growth.depth)
        ]


def fit_leafwise(
    train: DataFrame, features: Sequence[str], label: str, growth: Growth = Growth(), validation: DataFrame | None = None,
    patience: int | None = None, cuts: Sequence[np.ndarray] | None = None,
) -> Leafwise:
    """Fit on all rows of ``train``; with ``validation`` boosting ends after ``patience`` trees without a better error, and the model
    is cut at its best prefix."""
    spark = train.sparkSession
    names = list(dict.fromkeys([*features, label]))
    labelled = train.where(F.col(label).isNotNull()).select(*names)
    base = float(labelled.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0)
    cuts = tuple(cuts) if cuts is not None else quantile_cuts(labelled, features, growth.bins)
    rows = labelled.withColumn("_held", F.lit(False))
    if validation is not None:
        rows = rows.unionByName(validation.where(F.col(label).isNotNull()).select(*names).withColumn("_held", F.lit(True)))
    path = _written(rows, label, features, cuts, base)
    width, bins = len(features), max((len(c) for c in cuts), default=0) + 1
    state, trees, errors = _State(base, growth.rate), [], []
    try:
        while True:
            held = spark.read.parquet(path)
            if len(trees) == growth.trees:
                tree, error = None, _last_error(held, state, width) if validation is not None else None
            else:
                tree, error = _grown(held, state, width, bins, growth, len(trees), validation is not None)
            if error is not None and trees:
                errors.append(error)
                if patience and stopping_point(errors, patience)[1]:
                    break
            if tree is None:
                break
            trees.append(tree)
            state.trees.append(tree)
            if len(state.trees) == REBASE:
                path = _rebased(held, path, state, width)
    finally:
        discard(spark, path)
    found = Leafwise(tuple(features), cuts, base, growth.rate, tuple(trees), tuple(errors))
    return found.cut(stopping_point(errors, patience or len(errors))[0]) if errors else found


def _last_error(rows: DataFrame, state: _State, width: int) -> float | None:
    root = Tree(*[np.array([-1])] * 4, value=np.zeros(1), gain=np.zeros(1))
    told = _sums(rows.where("held"), state, root, [], width, 1, Growth(), 0, True)
    n = told["n"].sum()
    return float(np.sqrt(told["s"].sum() / n)) if n else None


def _rebased(rows: DataFrame, path: str, state: _State, width: int) -> str:
    """Write the rows again with their prediction, remove the table before it and forget the trees that are in it now."""
    done = _State(state.base, state.rate, list(state.trees))

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("bins"), width, np.int16)
            now = done.predicted(batch.column("f").to_numpy(), x)
            yield _batch(x, batch.column("y"), now, batch.column("u"), batch.column("held"))

    spark = rows.sparkSession
    new = scratch_path(spark, "leafwise")
    rows.select("bins", "y", "f", "u", "held").mapInArrow(moved, rows.select("bins", "y", "f", "u", "held").schema).write.parquet(new)
    state.trees.clear()
    discard(spark, path)
    return new


def predict(model: Leafwise, df: DataFrame, into: str = "p") -> DataFrame:
    """``df`` with the prediction of ``model``."""
    cuts, state = model.cuts, _State(model.base, model.rate, list(model.trees))

    @F.pandas_udf("double")
    def told(rows: pd.DataFrame) -> pd.Series:
        values = rows.to_numpy(dtype=float)
        bins = np.column_stack([_interval(values[:, i], c) for i, c in enumerate(cuts)])
        return pd.Series(state.predicted(np.full(len(values), state.base), bins))

    return df.withColumn(into, told(F.struct(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(model.features)])))


def from_nodes(nodes: DataFrame, like: Leafwise) -> Leafwise:
    """The ensemble whose nodes :meth:`Leafwise.nodes` wrote, with features, cuts, base and rate of ``like``."""
    held = nodes.toPandas().sort_values(["tree", "node"])
    trees = [
        Tree(*[own[c].to_numpy() for c in ("feature", "bin", "left", "right", "value", "gain")]) for _, own in held.groupby("tree")
    ]
    return replace(like, trees=tuple(trees))
