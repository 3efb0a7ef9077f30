"""Toxicity by compression distance between two kinds of zstandard dictionaries.

From labelled documents one dictionary is trained on toxic and one on ordinary text. A window (a word with its edges)
is compressed with the ordinary dictionary alone and with the toxic one added to it; the bytes that the toxic one saves are its distance. Windows are spelled with
:data:`SPREAD` fixed bytes per byte first, so a match always pays and a literal never does: lengths then count
the phrases a window is made of.

Dictionaries are trained in rounds: toxic documents contribute the windows that stand out so far, ordinary
documents those that were mistaken, and :data:`PAIRS` pairs on different parts of the sample are averaged; the round that
fits the documents kept out best is used. Labelled documents kept out of
the dictionaries calibrate thresholds: a logistic score over the largest distances of a
document and the numbers of windows above fixed distances, weighted to the share of toxic labels.

Only the fit is bounded: it reads at most :data:`TOXIC_ROWS` toxic and :data:`ORDINARY_ROWS` ordinary labelled
documents, those of the smallest hashed ids. Scoring reads every whole text of every row and keeps nothing between rows but a bounded
memory of windows. Labels with null are no labels; a document with several labels is toxic if one says so. Without
toxic or ordinary labels the score is the share of toxic labels (0 without labels). Null and empty texts have no window and are scored as such.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOXIC_ROWS, ORDINARY_ROWS = 1500, 4000
PAIRS, ROUNDS, SPREAD = 4, 5, 3
#: Bytes of the dictionaries and of the segments they are made of.
TOXIC_BYTES, ORDINARY_BYTES, SEGMENT = 8192, 65536, 20
#: Distances above which windows are counted; windows of ordinary text above the first one are trained on again.
STEPS = (4.0, 6.0, 8.0, 10.0)
#: Share of a toxic document's distinct windows that the next round is trained on.
STAND_OUT = 25
PREDICT_FROM = 0.3
REMEMBERED = 300_000

_SPELLED = np.random.default_rng(5).integers(0, 256, (256, SPREAD), dtype=np.uint8)
#: A-Z lower-cased; other ASCII than letters becomes a blank; bytes of other characters stay.
_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 or 65 <= c <= 90 else 32 for c in range(256)).lower()


def windows_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LETTERS).split()


def _spell(raw: bytes) -> bytes:
    return _SPELLED[np.frombuffer(raw, dtype=np.uint8)].tobytes()


def _trained(documents: Sequence[Sequence[bytes]], size: int, rng: random.Random) -> bytes:
    """Content of a dictionary for these documents; where they are too few to train on, their own text."""
    samples = [b" " + b" ".join(d) + b" " for d in documents if d]
    rng.shuffle(samples)
    try:
        return zstandard.train_dictionary(size, samples, k=SEGMENT, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:] or b" "


def _shared(documents: Sequence[list[bytes]]) -> list[list[bytes]]:
    """The windows that several of the documents hold; one document's own words teach nothing about others."""
    support = Counter(w for d in documents for w in set(d))
    least = max(2, len(documents) // 200)
    return [[w for w in d if support[w] >= least] for d in documents]


class Distances(dict):
    """Mean saving of the toxic dictionaries on a window, computed when first asked for."""

    def __init__(self, pairs: Sequence[tuple[bytes, bytes]]):
        super().__init__()
        self.tools = [(self._tool(ordinary + toxic), self._tool(ordinary)) for toxic, ordinary in pairs]

    @staticmethod
    def _tool(content: bytes) -> zstandard.ZstdCompressor:
        known = zstandard.ZstdCompressionDict(_spell(content), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=3)
        return zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False)

    def __missing__(self, window: bytes) -> float:
        spelled = _spell(b" " + window + b" ")
        value = sum(len(o.compress(spelled)) - len(t.compress(spelled)) for t, o in self.tools) / max(1, len(self.tools))
        if len(self) >= REMEMBERED:
            self.clear()
        if len(window) <= 64:
            self[window] = value
        return value


def features(distances: Distances, windows: Sequence[bytes]) -> np.ndarray:
    """The three largest distances, logarithms of how many windows pass each step, and of how many there are."""
    found = np.fromiter(map(distances.__getitem__, windows), dtype=np.float64, count=len(windows))
    top = np.zeros(3)
    best = np.sort(found[np.argpartition(-found, 2)[:3]] if len(found) > 3 else found)[::-1]
    top[: len(best)] = best
    return np.concatenate([top, [np.log1p((found >= s).sum()) for s in STEPS], [np.log1p(len(found))]])


@dataclass(frozen=True)
class Model:
    pairs: tuple[tuple[bytes, bytes], ...]
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # the intercept first

    def score(self, rows: np.ndarray) -> np.ndarray:
        scaled = np.clip((rows - self.mean) / self.spread, -20, 20)
        return 1.0 / (1.0 + np.exp(-(self.weights[0] + scaled @ self.weights[1:])))


def _logistic(rows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    design = np.column_stack([np.ones(len(rows)), (rows - mean) / spread])
    beta = np.zeros(design.shape[1])
    for _ in range(40):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (weight * (labels - p)) - beta
        beta = beta + np.linalg.solve(design.T @ (design * (weight * p * (1 - p))[:, None]) + np.eye(len(beta)), slope)
    return mean, spread, beta


def fit(toxic: Sequence[list[bytes]], ordinary: Sequence[list[bytes]], share: float) -> Model:
    """A model from the windows of labelled documents; ``share`` is the part of labels that are toxic."""
    constant = Model((), np.zeros(8), np.ones(8), np.array([np.log((share + 1e-9) / (1 - share + 1e-9)), *np.zeros(8)]))
    if len(toxic) < 4 or len(ordinary) < 4:
        return constant
    rng = random.Random(17)
    held_t, held_o = list(toxic[::4]), list(ordinary[::4])
    rest_t, rest_o = (_shared([d for i, d in enumerate(part) if i % 4]) for part in (toxic, ordinary))
    pairs = [(_trained(rest_t[i::PAIRS], TOXIC_BYTES, rng), _trained(rest_o[i::PAIRS], ORDINARY_BYTES, rng)) for i in range(PAIRS)]
    labels = np.array([1.0] * len(held_t) + [0.0] * len(held_o))
    weight = np.where(labels == 1, share / len(held_t), (1 - share) / len(held_o)) * len(labels)
    best, least, mistaken = constant, np.inf, []
    for turn in range(ROUNDS + 1):
        distances = Distances(pairs)
        rows = np.array([features(distances, d) for d in held_t + held_o])
        model = Model(tuple(pairs), *_logistic(rows, labels, weight))
        found = np.clip(model.score(rows), 1e-9, 1 - 1e-9)
        loss = -float((weight * (labels * np.log(found) + (1 - labels) * np.log(1 - found))).sum())
        if loss < least:
            best, least = model, loss
        if turn == ROUNDS:
            break
        loud = []
        for document in rest_t:
            distinct = sorted(set(document))
            rng.shuffle(distinct)  # equal distances must not favour the same words everywhere
            some = sorted(distinct, key=distances.__getitem__, reverse=True)[: max(4, len(distinct) // STAND_OUT)]
            loud.append([w for w in some if distances[w] > 0])
        mistaken += [w for d in rest_o if (w := [x for x in sorted(set(d)) if distances[x] >= STEPS[0]])]
        pairs = [
            (
                _trained([d for j, d in enumerate(loud) if j % PAIRS != i], TOXIC_BYTES, rng),
                _trained(mistaken * 2 + rest_o[(i + turn) % 5 :: 5], ORDINARY_BYTES, rng),
            )
            for i in range(PAIRS)
        ]
    return best


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on the bounded sample of labelled rows that are not held out."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("_id")).agg((F.max(label) > 0).alias("_toxic"))
    counts = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = known.where("_toxic").orderBy(*order).limit(TOXIC_ROWS).unionByName(known.where("not _toxic").orderBy(*order).limit(ORDINARY_ROWS))
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    found = rows.groupBy("_id", "_toxic").agg(F.min("_text").alias("_text")).orderBy(*order).collect()
    split: dict[bool, list[list[bytes]]] = {True: [], False: []}
    pool: dict[bytes, bytes] = {}  # one object per distinct window
    while found:
        row = found.pop()
        split[row["_toxic"]].append([pool.setdefault(w, w) for w in windows_of(row["_text"])])
    return fit(split[True], split[False], counts.get(True, 0) / total if total else 0.0)


def score_texts(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from :data:`PREDICT_FROM` on)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    memory: list[Distances] = []

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if not memory:
            memory.append(Distances(sent.value.pairs))
        rows = np.array([features(memory[0], windows_of(t.as_py())) for t in texts]).reshape(len(texts), 8)
        return pa.array(sent.value.score(rows), pa.float64())

    scored = docs.withColumn("score", score(F.col(text)))
    return scored.withColumn("predicted", (F.col("score") >= PREDICT_FROM).cast("int"))
