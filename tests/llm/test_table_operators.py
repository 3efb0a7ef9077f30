"""Line de-duplication, Merkle manifest and whitening against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattmill.llm import lines, merkle, queries_tables, whitening
from wattmill.operators import lookup as lookup_module

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- lines


def plain_lines(docs, min_chars=10, max_docs=1):
    """``{(id, text): (lines, dropped, kept text)}``"""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(CAPITALS)
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    late = lambda i: (i is None, i or 0)
    first = {k: min(ids, key=late) for k, ids in holders.items() if len(ids) > max_docs}
    out = {}
    for i, text in docs:
        own = (text or "").split("\n")
        kept = [line for line in own if first.get(key(line), i) == i]
        out[i, text] = (len(own), len(own) - len(kept), "\n".join(kept))
    return out


def line_docs():
    rng = random.Random(5)
    pool = ["All rights reserved", "  all RIGHTS reserved\t", "short", "", "ÄÖ zwölf Zeichen lang", "äö zwölf zeichen lang", "🙂" * 10, "🙂" * 9, "\x1f ten chars xx"]
    docs = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.5 else f"line number {rng.randint(0, 400)}" for _ in range(rng.randint(0, 12)))) for i in range(60)]
    docs += [(3, docs[3][1]), (4, "All rights reserved\nother words here"), (None, "All rights reserved\nonly in nulls"), (None, "only in nulls\nx")]
    docs += [(100, None), (101, ""), (102, "\n\n"), (103, "word " * 200_000 + "\n" + "\n".join(f"line number {i}" for i in range(30_000)))]
    return docs


@pytest.mark.parametrize("max_docs", [1, 3])
@pytest.mark.parametrize("small", [True, False])
def test_lines_equal_plain_python(spark, max_docs, small, monkeypatch):
    if not small:  # hot keys and salted join instead of a broadcast
        monkeypatch.setattr(lookup_module, "measured_bytes", lambda df: 10**12)
    docs = line_docs()
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, kept_text string, _pos long").repartition(5)
    got = lines.dedup_lines(frame, max_docs=max_docs).collect()
    assert got[0].__fields__ == ["doc_id", "text", "_pos", "kept_text", "n_lines", "n_dropped"]
    want = plain_lines(docs, max_docs=max_docs)
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_lines"], r["n_dropped"], r["kept_text"]) == want[r["doc_id"], r["text"]]


def test_no_lines(spark):
    assert lines.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


# ---- manifest


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_manifest(docs, fanout=8):
    """Rows as the query returns them, sorted."""
    leaf = lambda d, text: sha("".join(framed(x) for x in (d[0], d[3], d[2], d[4], text)))

    def grow(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + fanout])) for i in range(0, len(levels[-1]), fanout)])
        return levels

    def path(levels, i):
        steps = []
        for level in levels[:-1]:
            a = i - i % fanout
            steps.append(("".join(level[a:i]), "".join(level[i + 1 : a + fanout])))
            i //= fanout
        return steps

    groups = defaultdict(list)
    for d in docs:
        groups[d[2]].append((d[0] is not None, d[0] or 0, leaf(d, d[1]), d))
    trees = {lang: grow([x[2] for x in sorted(rows, key=lambda x: x[:3])]) for lang, rows in groups.items()}
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    upper = grow([trees[n][-1][0] for n in names])
    out = []
    for at, name in enumerate(names):
        for i, (_, _, h, d) in enumerate(sorted(groups[name], key=lambda x: x[:3])):
            steps = path(trees[name], i) + path(upper, at)
            folded = leaf(d, d[1] and d[1].translate(CAPITALS)) if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 else h
            for left, right in steps:
                folded = sha(left + folded + right)
            root = upper[-1][0]
            out.append((d[0], h, trees[name][-1][0], root, sha("".join(a + b for a, b in steps)), folded, folded == root))
    return sorted(out, key=repr)


def manifest_docs():
    rng = random.Random(3)
    langs = ["en"] * 90 + [None, "", "é", "z"] * 3 + [f"l{i}" for i in range(8)]
    docs = [(i, rng.choice(["Some Text ", "lower only", "", "É"]) * rng.randint(0, 4), rng.choice(langs), rng.choice(["web", None]), i) for i in range(400)]
    docs += [(7, "Other", "en", "web", 1)] * 3 + [(7, "Other", "en", "web", 2), (None, "No Id", "en", None, None), (None, None, None, None, None)]
    return docs + [(9000, "Long " * 100_000, "single", "web", None)]


@pytest.mark.parametrize("some", [slice(None), slice(0, 1), slice(0, 9), slice(0, 0)])
def test_manifest_equals_plain_python(spark, tmp_path, some):
    docs = manifest_docs()[some]
    spark.createDataFrame(docs, DOCS).withColumn("leaf", F.lit(1)).withColumn("idx", F.lit(1)).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries_tables.op13_merkle_manifest(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == plain_manifest(docs)


def test_manifest_of_equal_rows_in_many_ranges(spark):
    """One branch, one key: places come from the scan, nothing is lost."""
    rows = spark.range(0, 3000, 1, 7).select(F.lit(1).cast("long").alias("k"), (F.col("id") % 2).alias("v"))
    made = merkle.manifest(rows, merkle.digest(merkle.framed(F.col("v"))), branch=F.lit(None), order=[F.col("k")], carried={"v": F.col("v")}, fanout=3)
    checked = made.select("v", "path", merkle.fold(F.col("leaf"), F.col("path")).alias("folded"), "root").collect()
    assert len(checked) == 3000 and all(r["folded"] == r["root"] for r in checked)
    assert {len(r["path"]) for r in checked} == {8}
    h = [sha(merkle_text(v)) for v in [0] * 1500 + [1] * 1500]
    h.sort()
    while len(h) > 1:
        h = [sha("".join(h[i : i + 3])) for i in range(0, len(h), 3)]
    assert {r["root"] for r in checked} == set(h)


def merkle_text(value):
    return framed(value)


# ---- whitening


def plain_whitening(vectors, kept):
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    values, directions = np.linalg.eigh(((n * fit - total) / n).T @ ((n * fit - total) / n) / n)
    order = np.argsort(-values)[:kept]
    white = ((n * x - total) / n) @ directions[:, order] / np.sqrt(values[order])
    return n, ((n * x - total) ** 2).sum(1), white, values[order] / values.sum()


@pytest.mark.parametrize("block_bytes", [8 * 1024 * 1024, 20 * 6 * 8])
def test_whitening_equals_numpy(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(whitening, "SLAB_BLOCKS", 4)
    rng = np.random.default_rng(2)
    good = (rng.normal(size=(250, 6)) @ np.diag([5, 3, 2, 1, 0.7, 0.3])).astype(np.float32).tolist()
    good += [good[0]] * 120  # one hot vector
    rows = [(i, v, "x") for i, v in enumerate(good)]
    rows += [(None, good[1], "x"), (5, good[5], "again")]
    bad = [None, [], [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] * 6, [float("inf")] * 6, [1.0, 2.0]]
    rows += [(900 + i, v, "x") for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string").repartition(3)
    got = whitening.whiten(frame, 4).collect()
    n, deviation, white, explained = plain_whitening([v for _, v, _ in rows[: len(good) + 2]], 4)
    assert len(got) == 4 * (len(good) + 2)
    by_id = defaultdict(list)
    for r in got:
        by_id[r["id"], r["component"]].append(r)
    signs = {}
    for at, (i, _, _) in enumerate(rows[: len(good) + 2]):
        for c in range(4):
            r = by_id[i, c + 1][0]
            assert r["n"] == n and r["deviation"] == deviation[at]
            assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
            assert abs(r["whitened"]) == pytest.approx(abs(white[at, c]), abs=1e-8)
            assert r["identity_error"] < 1e-9
            if abs(white[at, c]) > 1e-6:
                signs.setdefault(c, set()).add(r["whitened"] * white[at, c] > 0)
    assert all(len(s) == 1 for s in signs.values())
    assert len(by_id[5, 1]) == 2


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3])
def test_nothing_to_whiten(spark, vectors):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    assert whitening.whiten(frame).count() == 0


def test_constant_direction_has_no_component(spark):
    frame = spark.createDataFrame([(i, [float(i), 3.0, float(i % 2)]) for i in range(9)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in whitening.whiten(frame).collect()} == {1, 2}


def test_mixing_deals_texts_out_once(spark, monkeypatch):
    """Slots go to the rows where they fit; where they don't, rows and slots meet by block. Both give the same mixture."""
    from wattmill.llm import mixing

    docs = spark.createDataFrame([(i, f"text {i}", "abc"[i % 3 and 1 + i % 2]) for i in range(400)], "doc_id long, text string, source string")

    def told(df):
        return sorted((r["doc_id"], r["slot"], r["place"]) for r in df.collect())

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    sent = mixing.mix(docs)
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    dealt = mixing.mix(docs)
    assert plan(sent).count("strategy=broadcast") == plan(dealt).count("strategy=broadcast") + 1
    assert told(sent) == told(dealt)
