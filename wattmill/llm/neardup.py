"""Near-copies: SetSketch registers, bands, joint estimates, exact confirmation, components.

A document's set holds the distinct hashes of its five-word shingles (fewer words: the whole sequence as
one). Documents with equal sets form a class and only its smallest document goes on.
Register ``i`` of a sketch is the minimum of a hash of all shingles, read as an exponential variable and kept as a truncated whole
number on a scale of powers of :data:`BASE`; so sketches of parts merge by a maximum and equal registers are the
likelier the more two sets overlap.

Bands of :data:`ROWS` registers are grouped by value. In each group every member is paired with the
smallest one only. Pairs are estimated from their registers and set sizes by maximum likelihood, implausible ones
go, the rest is confirmed on the full sets, and confirmed pairs are joined into components. Groups
whose members do not end in one component pair their members with central ones in the same way, and those
still open are then *settled*: members are dealt out in blocks, each pair of
blocks is one unit of work that compares members of different components -- estimates first, then full
sets -- and reports a spanning forest of its links, never all pairs. So no link that the bands see is lost, and a group of
``g`` near-copies costs ``g`` rows, not ``g * g``.

Two sets of similarity 0.75 share a band with probability above 0.99999. Null texts and texts without
words have an empty set and link with nothing. Ids are expected to be unique: rows that repeat an id get the component of
their own text. Rows without an id are not linked and kept. Very long texts are read whole, empty
tables stay empty, other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmill.operators.lookup import BROADCAST_BYTES
from wattmill.session import pin, stage

SHINGLE = 5
#: Similarity from which two sets are linked, in percent.
PERCENT = 75
REGISTERS, ROWS = 128, 4
BANDS = REGISTERS // ROWS
#: Base of the register scale, rate of the exponential variables, largest register.
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 2
#: Estimates below this are not confirmed: five standard errors of 128 registers under the threshold.
PLAUSIBLE = 0.56
#: Equal registers of a plausible pair: more than six standard errors under what a similarity of 0.75 gives.
LEAST_EQUAL = 64
#: Registers looked at first and the least number of equal ones, by the same measure.
HEAD, HEAD_EQUAL = 32, 9
#: Central members that a block of a group may have.
CENTRES = 8
#: Members of a block when a group has to be settled.
SETTLE = 256

_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(1, 2**32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_OFFSETS = _RNG.integers(0, 2**32, REGISTERS, dtype=np.uint32)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 2**64) for i in range(SHINGLE)], dtype=np.uint64)


class _Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; ``bytes`` lower-case and split by ASCII rules only."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), dtype=np.uint64, count=len(words))
    size = len(words) - SHINGLE + 1
    total = hashes[:size] * _POWERS[0]
    for i in range(1, SHINGLE):
        total = total + hashes[i : i + size] * _POWERS[i]
    return np.unique(_mix(total))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Truncated registers of a set that is not empty."""
    low = (shingles >> np.uint64(16)).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(low), 1024):
        hashed = low[at : at + 1024, None] * _FACTORS + _OFFSETS
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(0x85EBCA6B)
        np.minimum(least, hashed.min(axis=0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**32
    scale = np.floor(1.0 - np.log(-np.log1p(-uniform) / RATE) / np.log(BASE))
    # the scale is centred so that sets of one to 2^40 shingles fall inside the register range
    return np.clip(scale + 20_000, 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def _likelihood(above: np.ndarray, below: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, registers: int) -> tuple[Callable, np.ndarray, np.ndarray]:
    u = size_a / (size_a + size_b)
    v = 1.0 - u
    equal = registers - above - below

    def larger(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 1e-12) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray | float) -> np.ndarray:
        p, q = larger(u - v * j), larger(v - u * j)
        return above * np.log(p) + below * np.log(q) + equal * np.log(np.maximum(1.0 - p - q, 1e-12))

    return likelihood, u, v


def likely_at_least(above: np.ndarray, below: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, least: float, registers: int = REGISTERS) -> np.ndarray:
    """Whether the most likely similarity is ``least`` or more: the likelihood is concave, so it must not fall there."""
    likelihood, u, v = _likelihood(above, below, size_a, size_b, registers)
    return (likelihood(least + 1e-4) >= likelihood(least - 1e-4)) & (np.minimum(u / v, v / u) >= least)


def likely_similarity(above: np.ndarray, below: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Similarity of maximum likelihood, given how many registers of ``a`` lie above or below those of ``b`` and both set sizes.

    For a similarity ``j`` and shares ``u``, ``v`` of the sizes, a register of ``a`` is the larger with
    probability ``-log_b(1 - (u - v j) (b - 1) / b)``. The likelihood is concave in ``j``; thirds of the interval find its top.
    """
    likelihood, u, v = _likelihood(above, below, size_a, size_b, registers)
    low, high = np.zeros_like(u), np.minimum(u / v, v / u)
    for _ in range(40):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        better = likelihood(a) < likelihood(b)
        low, high = np.where(better, a, low), np.where(better, high, b)
    return (low + high) / 2


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the similarity; exact."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def describe(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, set size, a digest of the whole set and the registers of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for value in batch.column(1):
                found = shingle_set(value.as_py())
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                sketches.append(sketch(found).tobytes() if len(found) else None)
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_shingles", "set", "sketch"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, n_shingles long, set binary, sketch binary")


def _band_values(registers: np.ndarray) -> np.ndarray:
    """The hashes of all bands of each sketch."""
    parts = registers.reshape(len(registers) * BANDS, ROWS).astype(np.uint64)
    place = np.tile(np.arange(BANDS, dtype=np.uint64), len(registers))
    value = _mix(parts[:, 0] | parts[:, 1] << np.uint64(16) | parts[:, 2] << np.uint64(32) | parts[:, 3] << np.uint64(48))
    return _mix(value + place * np.uint64(0x9E3779B97F4A7C15)).view(np.int64).reshape(len(registers), BANDS)


def band_rows(classes: DataFrame) -> DataFrame:
    """``id, band``: one row per class and band; the band is a hash of its place and its registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            value = _band_values(_registers(batch.column("sketch"))).reshape(-1)
            ids = np.repeat(batch.column("id").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(value)], names=["id", "band"])

    return classes.select("id", "sketch").mapInArrow(run, "id long, band long")


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(len(column), REGISTERS)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of ``a, b`` pairs those that the registers make plausible."""
    part = classes.select("id", "n_shingles", "sketch")
    both = pairs.join(part.toDF("a", "size_a", "sketch_a"), "a").join(part.toDF("b", "size_b", "sketch_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = _registers(batch.column("sketch_a")), _registers(batch.column("sketch_b"))
            sizes = [batch.column(c).to_numpy().astype(np.float64) for c in ("size_a", "size_b")]
            close = likely_at_least((a > b).sum(axis=1), (a < b).sum(axis=1), *sizes, PLAUSIBLE)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(close)) for c in ("a", "b")], names=["a", "b"])

    return both.select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of ``a, b`` pairs those whose full sets reach the similarity.

    The text of ``a`` goes with each of its pairs; that of ``b``, which many pairs may share, goes once to each
    of the cells that its pairs are dealt to.
    """
    cell = F.pmod(F.xxhash64("a"), F.lit(64)).cast("int")
    members = pairs.join(texts.toDF("a", "text"), "a").select("b", cell.alias("cell"), F.lit(1).alias("side"), "a", "text")
    heads = pairs.select("b", cell.alias("cell")).distinct().join(texts.toDF("b", "text"), "b")
    heads = heads.select("b", "cell", F.lit(0).alias("side"), F.lit(None).cast("long").alias("a"), "text")
    dealt = members.unionByName(heads).repartition("b", "cell").sortWithinPartitions("b", "cell", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, whose = None, None
        for batch in batches:
            found: list[tuple[int, int]] = []
            sides, a, b = (batch.column(c).to_pylist() for c in ("side", "a", "b"))
            for i, text in enumerate(batch.column("text")):
                if sides[i] == 0:
                    head, whose = shingle_set(text.as_py()), b[i]
                elif whose == b[i] and linked(shingle_set(text.as_py()), head):
                    found.append((a[i], b[i]))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``id, component``: the smallest id reachable, for every id that occurs in ``links`` (columns ``a``, ``b``).

    Labels spread along links and are then shortened to their label's label, so the rounds grow with the logarithm of a chain.
    """
    spark = links.sparkSession
    both = pin(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = pin(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    if labels.isEmpty():
        return spark.createDataFrame([], "id long, component long")
    while True:
        seen = both.join(labels.toDF("b", "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        spread = labels.join(seen, "id").select("id", "component", F.least("component", "near").alias("least"))
        heads = spread.groupBy(F.col("component").alias("old")).agg(F.min("least").alias("head"))
        moved = spread.join(heads, F.col("component") == F.col("old"), "left")
        new = moved.select("id", F.least("least", "head").alias("component"), F.col("component").alias("before"))
        new = new.join(labels.toDF("l", "further"), F.col("component") == F.col("l"), "left")
        new = pin(new.select("id", F.coalesce("further", "component").alias("component"), "before"))
        changed = new.where(F.col("component") != F.col("before")).limit(1).count()
        labels = new.select("id", "component")
        if not changed:
            return labels


class _Forest:
    def __init__(self, labels: Sequence[int]):
        self.up = {x: x for x in labels}

    def root(self, x: int) -> int:
        """The smallest label joined with ``x``."""
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _equal(rows: np.ndarray, row: np.ndarray) -> np.ndarray:
    """How many registers of each of ``rows`` equal those of ``row``."""
    return (rows == row).view(np.uint8).sum(axis=1, dtype=np.uint8)


def _likely(registers: np.ndarray, sizes: np.ndarray, i: int, rest: np.ndarray) -> np.ndarray:
    """Those of ``rest`` that may be linked with ``i``: sizes first, then registers, then the likelihood."""
    rest = rest[np.minimum(sizes[rest], sizes[i]) * 100 >= PERCENT * np.maximum(sizes[rest], sizes[i])]
    rest = rest[_equal(registers[rest], registers[i]) >= LEAST_EQUAL]
    if not len(rest):
        return rest
    above, below = (registers[i] > registers[rest]).sum(axis=1), (registers[i] < registers[rest]).sum(axis=1)
    return rest[likely_at_least(above, below, np.full(len(rest), sizes[i]), sizes[rest], PLAUSIBLE)]


def _plausible_in(band: int, registers: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """For each member those of other components, of its size or larger, that may be linked with it.

    Members stand in order of size, so possible partners are a short stretch; a quarter of the registers is looked at first. Each
    pair is given in the first band it shares only.
    """
    order = np.argsort(sizes, kind="stable")
    ranked, place = sizes[order], labels[order]
    heads = np.ascontiguousarray(registers[order, :HEAD])
    ends = np.searchsorted(ranked, ranked * 100 / PERCENT + 1e-6, side="right")
    values = None
    for k in range(len(order) - 1):
        end = int(ends[k])
        if end <= k + 1:
            continue
        near = (_equal(heads[k + 1 : end], heads[k]) >= HEAD_EQUAL) & (place[k + 1 : end] != place[k])
        if not near.any():
            continue
        i = int(order[k])
        rest = _likely(registers, sizes, i, order[np.flatnonzero(near) + k + 1])
        if len(rest):
            values = _band_values(registers) if values is None else values
            shared = (values[i] == values[rest]).argmax(axis=1)
            rest = rest[values[i][shared] == band]
        if len(rest):
            yield i, rest.tolist()


_MEMBER = ["band", "x", "y", "id", "component", "n_shingles", "sketch"]


def _by_block(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[tuple[tuple, list[list]]]:
    """The rows of each (band, x, y) as columns; rows arrive sorted by them."""
    key, held = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
            if held and row[:3] != key:
                yield key, list(zip(*held, strict=True))
                held = []
            key = row[:3]
            held.append(row)
    if held:
        yield key, list(zip(*held, strict=True))


def _arrays(columns: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    registers = np.frombuffer(b"".join(columns[6]), dtype=np.uint16).reshape(len(columns[6]), REGISTERS)
    return registers, np.array(columns[5], dtype=np.float64), np.array(columns[4])


def _central_pairs(open_: DataFrame, described: DataFrame) -> DataFrame:
    """``a, b``: members of open groups with a central member of another component.

    A group of copies of one document hangs together through that document, whatever its id. In blocks of a group the member
    that agrees most with a few others is taken; members unlike it go on to the next, so each member meets few central ones.
    """
    blocks = F.ceil(F.col("size") / (4 * SETTLE)).cast("int")
    block = F.pmod(F.xxhash64("id", "band"), blocks).cast("int")
    rows = open_.select("band", block.alias("x"), F.lit(0).alias("y"), "id", "component")
    rows = rows.join(described.select("id", "n_shingles", "sketch"), "id").select(*_MEMBER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, columns in _by_block(batches, _MEMBER):
            registers, sizes, labels = _arrays(columns)
            heads = np.ascontiguousarray(registers[:, :HEAD])
            ids, found = columns[3], []
            left = np.arange(len(ids))
            for _ in range(CENTRES):
                if len(left) < 2 or len(set(labels[left].tolist())) < 2:
                    break
                some = left[:: max(1, len(left) // 32)]
                agree = np.zeros(len(left), dtype=np.int64)
                for k in some:
                    agree += _equal(heads[left], heads[k])
                centre = int(left[int(agree.argmax())])
                others = left[labels[left] != labels[centre]]
                found += [(ids[j], ids[centre]) for j in _likely(registers, sizes, centre, others).tolist()]
                left = left[_equal(registers[left], registers[centre]) < LEAST_EQUAL + 24]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return _dealt(rows).mapInArrow(run, "a long, b long").distinct()


def _dealt(rows: DataFrame) -> DataFrame:
    """Blocks dealt to a fixed number of tasks: few bytes, much work, so small tasks must not be merged."""
    tasks = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "band", "x", "y").sortWithinPartitions("band", "x", "y")


def _dealt_out(open_: DataFrame) -> DataFrame:
    """``band, x, y, id, component``: each member once per pair of blocks that holds its block and another component.

    Components of :data:`SETTLE` // 2 members or more have blocks of their own, smaller ones share blocks with their members
    together. Two blocks of one component are no pair, so members of the component that fills a group travel once per block of the
    others, not once per block of the group.
    """
    held = open_.groupBy("band", "component").agg(F.count(F.lit(1)).alias("held"))
    owner = F.when(F.col("held") >= SETTLE // 2, F.col("component"))
    areas = held.groupBy("band", owner.alias("of")).agg(F.sum("held").alias("held"))
    areas = areas.select("band", "of", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("held") / SETTLE) - 1)).alias("k"))
    layout = areas.groupBy("band").agg(F.sort_array(F.collect_list(F.struct("of", "k"))).alias("blocks"))
    layout = layout.select("band", F.transform("blocks", lambda b, i: F.struct(i.alias("at"), b["of"].alias("of"))).alias("blocks"))
    own = F.filter("blocks", lambda b: b["of"] == F.col("component"))
    mixed = F.filter("blocks", lambda b: b["of"].isNull())
    pick = lambda some, by: F.get(some, F.pmod(F.xxhash64(by, "band"), F.size(some)).cast("int"))["at"]
    placed = open_.join(layout, "band").select("*", own.alias("own"), mixed.alias("mixed"))
    placed = placed.select("band", "id", "component", "blocks", F.when(F.size("own") > 0, pick(F.col("own"), "id")).otherwise(pick(F.col("mixed"), "component")).alias("b"))
    met = placed.select("band", "id", "component", "b", F.explode("blocks").alias("o")).where(~F.col("o.of").eqNullSafe(F.col("component")))
    return met.select("band", F.least("b", "o.at").alias("x"), F.greatest("b", "o.at").alias("y"), "id", "component")


def _settle(open_: DataFrame, described: DataFrame, whole: DataFrame) -> DataFrame:
    """Links between members (``band, id, component``) of one group that lie in different components.

    A first pass over the registers alone leaves the members with a plausible partner; only their texts are fetched.
    """
    dealt = _dealt_out(open_)
    rows = dealt.join(described.select("id", "n_shingles", "sketch"), "id").select(*_MEMBER)
    schema = pa.schema(
        [("band", pa.int64()), ("x", pa.int32()), ("y", pa.int32()), ("id", pa.int64()), ("component", pa.int64()), ("n_shingles", pa.int64()), ("sketch", pa.binary())]
    )

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, columns in _by_block(batches, _MEMBER):
            if len(set(columns[4])) > 1:
                chosen: set[int] = set()
                for i, partners in _plausible_in(key[0], *_arrays(columns)):
                    chosen |= {i, *partners}
                at = sorted(chosen)
                yield pa.RecordBatch.from_arrays([pa.array([c[i] for i in at], f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    first = _dealt(rows).mapInArrow(promising, "band long, x int, y int, id long, component long, n_shingles long, sketch binary")
    first = stage(first, "promising")
    texts = _texts_of(whole, first.select("id").distinct())
    named = [*_MEMBER, "text"]
    second = _dealt(first.join(texts, "id").select(*named))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, columns in _by_block(batches, named):
            ids, labels, texts_ = columns[3], columns[4], columns[7]
            sets: dict[int, np.ndarray] = {}
            forest, found = _Forest(labels), []
            for i, partners in _plausible_in(key[0], *_arrays(columns)):
                for j in partners:
                    if forest.root(labels[i]) != forest.root(labels[j]):
                        for k in (i, j):
                            if k not in sets:
                                sets[k] = shingle_set(texts_[k])
                        if linked(sets[i], sets[j]):
                            forest.join(labels[i], labels[j])
                            found.append((ids[i], ids[j]))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return second.mapInArrow(links, "a long, b long")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, kept`` for every row of ``docs``; ``kept`` marks the smallest id of a component."""
    whole = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    described = stage(describe(docs, key, text), "sketches")
    full = described.where(F.col("set").isNotNull() & F.col("id").isNotNull())
    classes = stage(full.groupBy("set").agg(F.min("id").alias("head")), "classes")
    heads = classes.groupBy(F.col("head").alias("id")).agg(F.min("set").alias("set"))
    distinct = full.join(heads, ["id", "set"]).dropDuplicates(["id"]).select("id", "n_shingles", "sketch")
    distinct = stage(distinct, "class-sketches")

    bands = stage(band_rows(distinct), "bands")
    groups = bands.groupBy("band").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("size"))
    groups = groups.where(F.col("least") != F.col("most")).select("band", "least", "size")
    members = stage(bands.join(groups, "band"), "band-members")
    pairs = members.where(F.col("id") != F.col("least")).select(F.col("id").alias("a"), F.col("least").alias("b")).distinct()
    links = _linked_pairs(stage(_estimated(pairs, distinct), "plausible"), whole)
    labels = components(links)
    open_ = _open_groups(members, labels)
    if not open_.isEmpty():
        links = links.unionByName(_linked_pairs(stage(_central_pairs(open_, distinct), "central-pairs"), whole))
        labels = components(links)
        open_ = _open_groups(members, labels)
    if not open_.isEmpty():
        more = stage(_settle(open_, distinct, whole), "more-links")
        if not more.isEmpty():
            labels = components(links.unionByName(more))

    of_class = classes.join(labels.toDF("head", "component"), "head", "left")
    of_class = of_class.select("set", F.coalesce("component", "head").alias("component"))
    found = described.select("id", "n_shingles", "set").join(of_class, "set", "left")
    component = F.coalesce("component", "id")
    return found.select("id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def _linked_pairs(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return stage(_confirmed(pairs, stage(_texts_of(whole, wanted), "pair-texts")), "links")


def _open_groups(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``band, id, component, size`` of the groups whose members lie in several components."""
    placed = members.join(labels, "id", "left").select("band", "id", F.coalesce("component", "id").alias("component"), "size")
    mixed = placed.groupBy("band").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p <> q").select("band")
    return stage(placed.join(mixed, "band", "left_semi"), "open-groups")


def _texts_of(whole: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of the named documents. A list of ids below the bound goes to the texts; a longer one meets them by a shuffle."""
    wanted = stage(ids, "wanted")
    small = wanted.count() * 16 <= BROADCAST_BYTES
    return whole.join(F.broadcast(wanted) if small else wanted, "id", "left_semi").dropDuplicates(["id"])


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, all columns unchanged: the one with the smallest id."""
    kept = near_copies(docs, key, text).where("kept").select(F.col("id").alias("_kept")).distinct()
    return docs.join(kept, F.col(key).cast("long").eqNullSafe(F.col("_kept")), "left_semi")
