"""Byte-level BPE by recursive queries, one in-process DuckDB per task.

A batch of texts is cut into words by the pattern of the vocabulary. Each distinct word starts as one token per byte;
a recursive query joins the pairs of neighbouring positions with the merge table, contracts in every word the leftmost pair of
the smallest rank, and goes on with the words that changed until none does. An ordered
aggregation over (word, position) rows joined with the vocabulary decodes the ids of each distinct word again; a
text is decoded as its words in order. :func:`decode_ids` decodes any column of ids the same way, at most :data:`SLICE` tokens
in one query, so neither the rows of an Arrow batch nor the length of a text decides what a query holds.

Batches are bounded by characters and words are kept between batches up to a bound, so a task holds a few hundred MB
whatever it reads. Words longer than :data:`LONG` bytes (runs of one character, base64) would need one round
per byte; they are contracted pair by pair with a heap instead, same rule, same result.

The pattern's look-ahead (white space that something follows gives its last character away) is expressed by cutting
the text before that character, because DuckDB's patterns have none.

Null texts are empty: no ids. Repeated rows are encoded one by one; other columns pass through; columns named as the results are
replaced. The vocabulary is read from a path that every machine has; it is a parameter.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of one batch, distinct words kept between batches, bytes of a word contracted in SQL, tokens decoded by one query.
BATCH_CHARS, KEPT_WORDS, LONG, SLICE = 4_000_000, 300_000, 64, 100_000
#: The same bounds where whole arrays of ids are held beside the words.
ARRAY_CHARS, ARRAY_WORDS = 1_000_000, 150_000
#: What DuckDB may hold in a process.
MEMORY = "400MB"

#: White space of Unicode, spelled out: the engines disagree on ``\\s``.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(rf"(?<=[{_SPACE}])(?=[{_SPACE}][^{_SPACE}])")
_TWO = re.compile(rf"[{_SPACE}][{_SPACE}][^{_SPACE}]")
_LOOKAHEAD = r"|\s+(?!\S)|\s+"

SPLIT = "SELECT part, regexp_extract_all(text, $1) AS words FROM parts ORDER BY part"

CONTRACT = """
WITH RECURSIVE states(word, round, ids) AS (
    SELECT word, 0, ids FROM fresh
    UNION ALL
    SELECT s.word, s.round + 1, s.ids[: (p.best & 127) - 1] || [(p.best >> 7)::INTEGER] || s.ids[(p.best & 127) + 2 :]
    FROM states s JOIN (
        SELECT word, min(m.rank * 128 + pos) AS best
        FROM (
            SELECT word, pos, ids[pos] * 65536::BIGINT + ids[pos + 1] AS pair
            FROM (SELECT word, ids, unnest(range(1, len(ids))) AS pos FROM states)
        ) AS pairs JOIN merges m USING (pair)
        GROUP BY word
    ) p ON p.word = s.word
)
SELECT word, arg_max(ids, round) AS ids FROM states GROUP BY word ORDER BY word
"""

DECODE = """
SELECT t.item, unhex(string_agg(v.hex, '' ORDER BY t.pos)) AS bytes
FROM tokens t JOIN vocabulary v ON v.id = t.id GROUP BY t.item ORDER BY t.item
"""


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def re2_pattern(pattern: str) -> str:
    """The pattern without its look-ahead and with white space spelled out, as DuckDB reads it."""
    space = re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", _SPACE)
    if not pattern.endswith(_LOOKAHEAD):
        raise ValueError("the pattern has to end with the white space rule " + _LOOKAHEAD[1:])
    return pattern.removesuffix(_LOOKAHEAD).replace(r"[^\s", f"[^{space}") + f"|[{space}]+"


class Codec:
    """Encoder and decoder of one process; ``spelled`` keeps each word's ids as text and its decoded bytes too."""

    def __init__(self, path: str, pattern: str, spelled: bool):
        self.spelled, self.most = spelled, KEPT_WORDS if spelled else ARRAY_WORDS
        self.ranks = vocabulary(path)
        self.pattern = re2_pattern(pattern)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self.bytes_id = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        pairs = [
            (self.ranks[t[:i]] << 16 | self.ranks[t[i:]], rank)
            for t, rank in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        pair, rank = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True))
        self._load("merges", pa.table({"pair": pair, "rank": rank}))
        ids = pa.array(self.ranks.values(), pa.int32())
        self._load("vocabulary", pa.table({"id": ids, "hex": pa.array([t.hex() for t in self.ranks])}))
        self.forget()

    def _load(self, name: str, rows: pa.Table) -> None:
        self.db.register("rows", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
        self.db.unregister("rows")

    def _ask(self, name: str, rows: pa.Table, query: str, params: list | None = None) -> pa.Table:
        """The answer to ``query`` with ``rows`` in view as ``name``."""
        self.db.register(name, rows)
        try:
            return self.db.sql(query, params=params).to_arrow_table()
        finally:
            self.db.unregister(name)

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids: list[np.ndarray] = []
        self.written: list[str] = []
        self.decoded: list[bytes] = []

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet and decode them again."""
        short, long_ = [], []
        for word in words:
            (short if len(raw := word.encode()) <= LONG else long_).append((word, raw))
        if short:
            flat = self.bytes_id[np.frombuffer(b"".join(raw for _, raw in short), dtype=np.uint8)]
            ends = np.cumsum([0] + [len(raw) for _, raw in short], dtype=np.int64).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            rows = pa.table({"word": pa.array(np.arange(len(short), dtype=np.int32)), "ids": ids})
            done = self._ask("fresh", rows, CONTRACT).column("ids").combine_chunks()
            ends, flat = done.offsets.to_numpy(), done.values.to_numpy()
            self._keep([w for w, _ in short], [flat[x:y] for x, y in zip(ends, ends[1:], strict=False)])
        self._keep([w for w, _ in long_], [self._contract(raw) for _, raw in long_])

    def _keep(self, words: list[str], ids: list[np.ndarray]) -> None:
        if self.spelled:
            raw, ends = self.decode(np.concatenate([self.bytes_id[:0], *ids]), np.array([len(x) for x in ids], dtype=np.int64))
            self.decoded += [raw[x:y] for x, y in zip(ends.tolist(), ends[1:].tolist(), strict=False)]
            self.written += [" ".join(map(str, some.tolist())) for some in ids]
        for word, some in zip(words, ids, strict=True):
            self.known[word] = len(self.ids)
            self.ids.append(some)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of lists of ids, given one after the other with their sizes: joined, with where each list's bytes start and end.

        One query sees at most :data:`SLICE` tokens; a longer list is decoded in several pieces.
        """
        item = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        out, held = [], np.zeros(len(sizes) + 1, dtype=np.int64)
        for a in range(0, len(ids), SLICE):
            some = slice(a, a + SLICE)
            pos = np.arange(a, min(a + SLICE, len(ids)), dtype=np.int64)
            found = self._ask("tokens", pa.table({"item": item[some], "pos": pos, "id": ids[some].astype(np.int32)}), DECODE)
            pieces = found.column("bytes").to_pylist()
            held[found.column("item").to_numpy() + 1] += [len(p) for p in pieces]
            out += pieces
        return b"".join(out), np.cumsum(held)

    def split(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct words, the number of each word in order, and where each text's words end."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            cut = _CUT.split(text) if _TWO.search(text) else [text]
            parts += cut
            owner += [i] * len(cut)
        rows = pa.table({"part": pa.array(np.arange(len(parts), dtype=np.int32)), "text": pa.array(parts, pa.string())})
        words = self._ask("parts", rows, SPLIT, [self.pattern]).column("words").combine_chunks()
        coded = words.flatten().dictionary_encode()
        sizes = np.diff(words.offsets.to_numpy())
        per_text = np.bincount(np.array(owner, dtype=np.int64), weights=sizes, minlength=len(texts)).astype(np.int64)
        return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.cumsum(per_text)

    def _contract(self, raw: bytes) -> np.ndarray:
        """The same contraction for one long word: a heap of (rank, position), neighbours as linked positions."""
        ranks, size = self.ranks, len(raw)
        after, before, end = list(range(1, size + 1)), list(range(-1, size - 1)), list(range(1, size + 1))
        alive = bytearray(b"\1") * size

        def rank(at: int) -> int | None:
            return ranks.get(raw[at : end[after[at]]]) if after[at] < size and end[after[at]] - at <= 256 else None

        heap = [(r, i) for i in range(size) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not alive[i] or rank(i) != r:
                continue
            j = after[i]
            alive[j], end[i], after[i] = 0, end[j], after[j]
            if after[i] < size:
                before[after[i]] = i
            for k in (i, before[i]):
                if k >= 0 and (new := rank(k)) is not None:
                    heapq.heappush(heap, (new, k))
        return np.array([ranks[raw[i : end[i]]] for i in range(size) if alive[i]], dtype=np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The numbers of the words of each text; ``ids``, ``written`` and ``decoded`` have what they stand for."""
        if len(self.known) > self.most:
            self.forget()
        words, at, ends = self.split(texts)
        if fresh := [w for w in words if w not in self.known]:
            self.learn(fresh)
        numbers = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))[at]
        return np.split(numbers, ends[:-1])


@lru_cache(maxsize=1)
def codec(path: str, pattern: str, spelled: bool = False) -> Codec:
    return Codec(path, pattern, spelled)


def _batches(texts: list[str], chars: int) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > chars:
            yield start, i
            start, size = i, 0
        size += len(text)
    yield start, len(texts)


def encode_ids(text: Column, path: str, pattern: str) -> Column:
    """The token ids of a text column as an array."""

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        return _ids(texts, path, pattern)

    return ids_of(text)


def _ids(texts: pa.Array, path: str, pattern: str) -> pa.Array:
    tool, values = codec(path, pattern), [t or "" for t in texts.to_pylist()]
    rows: list[np.ndarray] = [tool.bytes_id[:0]]
    sizes: list[int] = [0]
    for a, b in _batches(values, ARRAY_CHARS):
        for numbers in map(np.ndarray.tolist, tool.encode(values[a:b])):
            words = [tool.ids[n] for n in numbers]
            rows += words
            sizes.append(sum(map(len, words)))
        rows = [np.concatenate(rows)]
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(rows[0]))


def decode_ids(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that an array column of ids stands for; null where the array is null."""

    @F.arrow_udf("binary")
    def bytes_of(rows: pa.Array) -> pa.Array:
        return _bytes(rows, path, pattern)

    return bytes_of(ids)


def _bytes(rows: pa.Array, path: str, pattern: str) -> pa.Array:
    sizes = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    raw, ends = codec(path, pattern).decode(rows.flatten().to_numpy(), sizes)
    plain = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])
    return pc.if_else(rows.is_valid(), plain, pa.scalar(None, pa.binary())) if rows.null_count else plain


def encode_digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, ``ids_sha256`` (ids joined by blanks) and ``decoded_sha256`` of the text read back from them."""
    kind = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"

    @F.arrow_udf(kind)
    def digests(texts: pa.Array) -> pa.Array:
        tool, values = codec(path, pattern, True), [t or "" for t in texts.to_pylist()]
        counts, written, decoded = [], [], []
        for a, b in _batches(values, BATCH_CHARS):
            for numbers in map(np.ndarray.tolist, tool.encode(values[a:b])):
                ids = " ".join([tool.written[n] for n in numbers])
                counts.append(ids.count(" ") + bool(ids))
                written.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([tool.decoded[n] for n in numbers])).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(written, pa.string()), pa.array(decoded, pa.string())],
            names=["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    found = docs.withColumn("_bpe", digests(F.col(text)))
    new = ("n_tokens", "ids_sha256", "decoded_sha256")
    return found.select(*[c for c in docs.columns if c not in new], *[F.col(f"_bpe.{n}").alias(n) for n in new])
