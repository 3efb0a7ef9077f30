"""URL rules judged by a cascade of Bloom filters.

A rule is a host and a path prefix, written together (``example.com/de/``). A
page's candidate keys are its host suffixes joined with the starts of its path,
of those lengths only that occur in a rule. The keys of all pages are the
complete key universe. Level 0 of a cascade is a Bloom filter of the listed
keys; level 1 holds the universe's keys that level 0 accepts wrongly; level 2
the listed keys that level 1 accepts; and so on until a level accepts nothing
wrong. Membership of every key of the universe is then exact and costs a few
hashes: no page is joined with anything or shuffled.

The filters are sized as ``listed * log2(universe / listed)`` bits, so what is
sent to the executors is bounded by the rule list the caller passes in, not by
the pages. Only distinct keys are shuffled, to be counted and to fill a level.

Null urls and urls without ``://`` have an empty host and path and match no rule;
empty tables give empty results; repeated pages are judged one by one. Columns of
the input named ``host``, ``path``, ``rule`` or ``verdict`` are replaced. A key on
both lists is blocked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmill.llm.common import ascii_lower
from wattmill.session import stage

Rule = tuple[str, str]

#: Verdict where no rule fits: nothing is blocked unless it is listed.
DEFAULT_VERDICT = "allow"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_key(rule: str) -> str:
    """A rule as a key: host lower-cased, path from the first slash on."""
    host, slash, path = rule.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host) + slash + path


def candidate_keys(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """All keys by which one of ``rules`` could fit: one per label count and path length of the rules."""
    shapes = sorted({(k.partition("/")[0].count(".") + 1, len(k) - len(k.partition("/")[0])) for k in rules})
    labels = F.split(host, r"\.", -1)
    keys = [
        F.when(
            (F.size(labels) >= n) & (F.length(path) >= size),
            F.concat(F.array_join(F.slice(labels, -n, n), "."), F.substring(path, 1, size)),
        )
        for n, size in shapes
    ]
    return F.array_distinct(F.array_compact(F.array(*keys))) if keys else F.array().cast("array<string>")


@dataclass(frozen=True)
class Bloom:
    """Bits of one level as 64-bit words; ``level`` seeds its hashes."""

    level: int
    bits: int
    hashes: int
    words: np.ndarray

    @staticmethod
    def shape(keys: int, rate: float) -> tuple[int, int]:
        bits = max(64, math.ceil(-max(keys, 1) * math.log(rate) / math.log(2) ** 2))
        return bits, max(1, round(bits / max(keys, 1) * math.log(2)) if rate < 0.5 else 1)


def positions(key: str, level: int, bits: int, hashes: int) -> list[int]:
    digest = xxhash.xxh3_128_intdigest(key.encode(), seed=level)
    first, step = digest >> 64, digest & 0xFFFFFFFFFFFFFFFF | 1
    return [(first + i * step) % bits for i in range(hashes)]


def accepts(bloom: Bloom, key: str) -> bool:
    return all(int(bloom.words[p >> 6]) >> (p & 63) & 1 for p in positions(key, bloom.level, bloom.bits, bloom.hashes))


def member(cascade: Sequence[Bloom], key: str) -> bool:
    """Whether the first level that refuses ``key`` is an odd one; exact for keys of the universe."""
    for bloom in cascade:
        if not accepts(bloom, key):
            return bloom.level % 2 == 1
    return len(cascade) % 2 == 1


def _fill(keys: Sequence[str], level: int, rate: float) -> Bloom:
    bits, hashes = Bloom.shape(len(keys), rate)
    words = np.zeros((bits + 63) // 64, dtype=np.uint64)
    for key in keys:
        for p in positions(key, level, bits, hashes):
            words[p >> 6] |= np.uint64(1 << (p & 63))
    return Bloom(level, bits, hashes, words)


def _fill_from(keys: DataFrame, level: int, count: int, rate: float) -> Bloom:
    """As :func:`_fill`, from a distributed column ``key``; tasks emit words, equal words are or-ed before they are read."""
    bits, hashes = Bloom.shape(count, rate)

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[int, int] = {}
        for batch in batches:
            for key in batch.column(0).to_pylist():
                for p in positions(key, level, bits, hashes):
                    words[p >> 6] = words.get(p >> 6, 0) | 1 << (p & 63)
        at = np.fromiter(words, dtype=np.int64, count=len(words))
        value = np.fromiter(words.values(), dtype=np.uint64, count=len(words)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(value)], names=["word", "bits"])

    filled = keys.mapInArrow(words_of, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    words = np.zeros((bits + 63) // 64, dtype=np.uint64)
    for row in filled.collect():
        words[row["word"]] = np.array(row["bits"], dtype=np.int64).view(np.uint64)
    return Bloom(level, bits, hashes, words)


def build_cascade(universe: DataFrame, listed: Sequence[str]) -> list[Bloom]:
    """Levels for ``listed`` against the distinct keys of ``universe`` (column ``key``)."""
    inside = sorted(set(listed))
    if not inside:
        return []
    others = universe.where(~F.col("key").isin(inside)) if len(inside) <= 1000 else universe
    total = max(1, others.count())
    keep = frozenset(inside) if len(inside) > 1000 else frozenset()
    cascade = [_fill(inside, 0, min(0.5, math.sqrt(0.5) * len(inside) / total))]
    while True:
        sent = others.sparkSession.sparkContext.broadcast(list(cascade))

        def wrong(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [k for k in batch.column(0).to_pylist() if k not in keep and all(accepts(b, k) for b in sent.value)]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["key"])

        passed = others.mapInArrow(wrong, "key string")
        count = passed.count()
        if not count:
            return cascade
        cascade.append(_fill_from(passed, len(cascade), count, 0.5))
        inside = [k for k in inside if accepts(cascade[-1], k)]
        if not inside:
            return cascade
        cascade.append(_fill(inside, len(cascade), 0.5))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, the longest fitting ``rule`` (else null) and its ``verdict``.

    ``rules`` are pairs of a key and ``block`` or ``allow``. Of equally long rules the one with the longer host wins.
    """
    spark = pages.sparkSession
    keyed = [(rule_key(r), verdict) for r, verdict in rules]
    rest = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = url_parts(F.col(url))
    split = pages.select(*rest, host.alias("host"), path.alias("path"))
    keys = candidate_keys(F.col("host"), F.col("path"), [k for k, _ in keyed])
    universe = stage(split.select(F.explode(keys).alias("key")).distinct(), "url-keys")
    cascades = spark.sparkContext.broadcast(
        [(v, build_cascade(universe, [k for k, x in keyed if x == v])) for v in ("block", "allow")]
    )

    @F.pandas_udf("struct<rule:string,verdict:string>")
    def decide(batch: pd.Series) -> pd.DataFrame:
        known: dict[str, str | None] = {}
        rows = []
        for candidates in batch:
            best: tuple[int, int, str, str] | None = None
            for key in candidates:
                if key not in known:
                    known[key] = next((v for v, levels in cascades.value if levels and member(levels, key)), None)
                if known[key]:
                    size = (len(key), len(key.partition("/")[0]), key, known[key])
                    best = max(best, size) if best else size
            rows.append((best[2], best[3]) if best else (None, DEFAULT_VERDICT))
        return pd.DataFrame(rows, columns=["rule", "verdict"])

    judged = split.withColumn("_found", decide(keys))
    return judged.select(*rest, "host", "path", F.col("_found.rule").alias("rule"), F.col("_found.verdict").alias("verdict"))
