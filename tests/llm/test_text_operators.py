"""Personal data, quality rules, near-copies, tokens, licences, toxicity against plain versions and hand-made cases."""

import hashlib
import random
import time
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.llm import plain
from wattmill.llm import bpe, licences, neardup, pii, quality, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOC = "doc_id long, text string, source string"


def rows(spark, texts, schema=DOC):
    return spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], schema)


# ---- personal data

PIECES = ["a", "x.y", "@", ".", "1", "42", "4242 4242 4242 4242", "-", " ", "+1", "(555)", "0199", "é", "\n", "255.1.1.1", "b-c.org", "999", "%", "_"]


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25)))
        assert pii.detect(text) == plain.base_pii(text), text


def test_disguises_map_back_to_the_source():
    text = "Ünd john [at] mail (dot) example.com or jane at host dot org, jоhn@exаmple.com, +1 five five five 123 4567 8; 192 dot 168 dot 1 dot one."
    base, added = pii.spans_of(text)
    assert base == []
    assert [(pii.KINDS[k], text[a:b]) for a, k, b in added] == [
        ("email", "john [at] mail (dot) example.com"),
        ("email", "jane at host dot org"),
        ("email", "jоhn@exаmple.com"),
        ("phone", "+1 five five five 123 4567 8"),
        ("ip", "192 dot 168 dot 1 dot one"),
    ]
    assert pii.redact(text, added).startswith("Ünd <email> or <email>, <email>, <phone>; <ip>.")


def test_plain_text_gets_no_spans():
    for text in ("look at the dot on the i", "one two three", "at one dot in time", "tone at none", "Привет, мир", "é ü ß", "see example.com"):
        assert pii.spans_of(text) == ([], [])


def test_disguises_need_no_other_hint(spark):
    texts = {
        "Call plus 44 20 7946 0958 today.": "phone",
        "Host 192.168.zero.one is up.": "ip",
        "+1.five.five.five.one.two.three.four.five.six.seven": "phone",
    }
    for text, kind in texts.items():
        base, added = pii.spans_of(text)
        wide_base, wide = pii.spans_of(text + " [at]")
        assert [(pii.KINDS[k], a, b) for a, k, b in added] == [(pii.KINDS[k], a, b) for a, k, b in wide] and base == wide_base
        assert kind in [pii.KINDS[k] for _, k, _ in added], text
    clean = [r["text"] for r in pii.redact_pii(rows(spark, list(texts))).orderBy("doc_id").collect()]
    assert clean[:3] == ["Call <phone> today.", "Host <ip> is up.", "<phone>"]


@pytest.mark.parametrize(
    "text,kind,span",
    [
        ("ruf an: plus vier neun drei null eins zwei drei vier fünf sechs sieben heute", "phone", "plus vier neun drei null eins zwei drei vier fünf sechs sieben"),
        ("llame al más tres cuatro nueve uno dos tres cuatro cinco seis cero hoy", "phone", "más tres cuatro nueve uno dos tres cuatro cinco seis cero"),
        ("eins neun zwei punkt eins punkt null punkt zwei", "ip", "eins neun zwei punkt eins punkt null punkt zwei"),
        ("maria arroba example punkt de", "email", "maria arroba example punkt de"),
        ("jean arobase exemple point fr.", "email", "jean arobase exemple point fr"),
        ("an john(@)example.com!", "email", "john(@)example.com"),
        ("x john%40example.com y", "email", "john%40example.com"),
        ("john&#64;example&#46;org x", "email", "john&#64;example&#46;org"),
        ("an j o h n @ e x a m p l e . c o m and so on", "email", "j o h n @ e x a m p l e . c o m"),
        ("john at mail dot example dot museum", "email", "john at mail dot example dot museum"),
        ("write to john at example dot com now", "email", "john at example dot com"),
        ("ring %2b49 30 1234567890", "phone", "%2b49 30 1234567890"),
    ],
)
def test_disguises_of_four_languages_and_encodings(text, kind, span):
    base, added = pii.spans_of(text)
    assert base == [] and [(pii.KINDS[k], text[a:b]) for a, k, b in added] == [(kind, span)]


def test_words_beside_plain_identifiers_add_nothing():
    for text in (
        "looked at example dot com", "at this point in time we stood", "stared at a dot on the map", "a b c @ d", "un punto de vista", "a point de plus",
        "john@example.com point taken", "+1 (389) 555-4387 un homme", "+1 (389) 555-4387 one more", "50% 40 people & 46 more",
    ):
        assert pii.spans_of(text)[1] == [], text
    assert [b - a for a, _, b in pii.spans_of("+1 389 555 4387 one two three")[1]] == [29]


@pytest.mark.parametrize("piece", ["a ", " @ a", "uno dos ", "x at ", "a dot ", "a punkt ", "( ", "at a dot b", "&#", "%4"])
def test_repeated_pieces_take_linear_time(piece):
    start = time.perf_counter()
    pii.spans_of(piece * 100_000)
    assert time.perf_counter() - start < 20


def test_pii_edges(spark):
    long_run, long_local = "9" * 200_000, "a" * 200_000 + "@"
    frame = rows(spark, [None, "", long_run, long_local, "me@x.org", "me@x.org"], "doc_id long, text string, spans string")
    found = {r["doc_id"]: r["spans"] for r in pii.find_pii(frame).collect()}
    assert [len(found[i]) for i in range(6)] == [0, 0, 0, 0, 1, 1]
    clean = {r["doc_id"]: r["text"] for r in pii.redact_pii(frame).collect()}
    assert clean[0] is None and clean[4] == "<email>" and clean[2] == long_run
    assert pii.find_pii(frame.limit(0)).count() == 0


# ---- quality rules


def test_quality_counts_and_verdicts(spark):
    rng = random.Random(4)
    texts = [None, "", " \t\n", "a b c d e " * 4000, "x" * 300_000]
    for _ in range(150):
        pool = [rng.choice(["the", "Cat", "#", "é", "RED", "|", "on"]) for _ in range(rng.randint(2, 9))]
        texts.append(rng.choice(["", " ", "\n"]).join(["", ""]) + "".join(rng.choice(pool) + rng.choice([" ", "  ", "\n", "\t", "\n\n"]) for _ in range(rng.randint(0, 60))))
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_words long")
    for row in quality.measure(docs).collect():
        want = plain.quality_counts(texts[row["doc_id"]] or "")
        assert {k: row[k] for k in want} == want, texts[row["doc_id"]]
    kept = {r["doc_id"] for r in quality.keep_good(docs).collect()}
    assert kept == {i for i, t in enumerate(texts) if plain.good(t or "")}
    assert quality.keep_good(docs.limit(0)).columns == docs.columns
    assert quality.keep_good(docs.limit(0)).count() == 0


def test_order_is_rejection_per_cost_and_changes_no_verdict(spark):
    names = [r.name for r in quality.RULES]
    estimates = [quality.Estimate(n, 1.0 + i, 0.1 * i) for i, n in enumerate(names)]
    order = quality.ordered(quality.RULES, estimates)
    worth = [(e.share / e.seconds, e.name) for e in estimates]
    assert [r.name for r in order] == [n for _, n in sorted(worth, key=lambda x: -x[0])]
    docs = rows(spark, ["a " * 50, "good words stand here and nothing else is wrong with them at all", "# " * 30])
    verdicts = [
        [r["v"] is None for r in quality.measure(docs).orderBy("doc_id").select(quality.cascade(o).alias("v")).collect()]
        for o in (quality.RULES, tuple(reversed(quality.RULES)))
    ]
    assert verdicts[0] == verdicts[1] == [False, True, False]
    known = ("n_words", "word_chars", "n_repeat_words")
    lazy = quality.measure(docs, counts=known).orderBy("doc_id").select(quality.cascade(order, F.col("text"), known).isNull().alias("v"))
    assert [r["v"] for r in lazy.collect()] == [False, True, False]


def test_rule_costs_are_above_an_empty_job(spark):
    texts = ["a " * 50, None, "", "# " * 30, "AB CD " * 6] + ["good words stand here and nothing else is wrong with them at all"] * 15
    found = {e.name: e for e in quality.estimate(rows(spark, texts), rows=1000)}
    assert all(e.seconds >= quality.LEAST for e in found.values())
    assert found["few_words"].share == 0.1 and found["symbols"].share == 0.05
    assert all(e.seconds == 0 for e in quality.estimate(rows(spark, texts).limit(0)))


# ---- near-copies


def sentence(rng, n):
    return [f"w{rng.randint(0, 5000)}" for _ in range(n)]


def near_texts(seed):
    rng = random.Random(seed)
    texts = [None, "", "  \n ", "one two", "ONE two", "one two three four five", "ÀB c d e f", "àb c d e f"]
    for _ in range(6):
        base = sentence(rng, rng.randint(20, 200))
        texts.append(" ".join(base))
        for _ in range(8):  # a chain: each copy changes the one before it
            base = list(base)
            for _ in range(rng.randint(1, 1 + len(base) // 45)):
                base[rng.randrange(len(base))] = f"w{rng.randint(0, 5000)}"
            texts.append(" ".join(base))
            if rng.random() < 0.2:
                texts.append(" ".join(base).upper())
    shared = " ".join(sentence(rng, 60))
    texts += [" ".join(sentence(rng, 25)) + " " + shared for _ in range(30)]  # a passage that many share
    order = list(range(len(texts)))
    rng.shuffle(order)
    return [texts[i] for i in order]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_equal_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(neardup, "SETTLE", 4)
    texts = near_texts(seed)
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, id int")
    want = plain.components(list(enumerate(texts)))
    for row in neardup.near_copies(docs).collect():
        assert row["n_shingles"] == len(plain.shingles(texts[row["id"]]))
        assert row["component_id"] == want[row["id"]]
        assert row["kept"] == (want[row["id"]] == row["id"])
    kept = {r["doc_id"] for r in neardup.drop_copies(docs).collect()}
    assert kept == {i for i, c in want.items() if i == c}


def test_near_copies_edges(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (5, "a b c d e f")], "doc_id long, text string")
    found = sorted((r["id"] or 0, r["component_id"] or 0, r["kept"]) for r in neardup.near_copies(docs).collect())
    assert [f for f in found if f[0]] == [(1, 1, True), (1, 1, True), (5, 1, False)]
    assert neardup.near_copies(docs.limit(0)).count() == 0


def test_sketches_merge_and_estimate():
    import numpy as np

    rng = np.random.default_rng(1)
    pool = neardup._mix(rng.integers(0, 2**63, 3000).astype(np.uint64))
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2500])
    ka, kb = neardup.sketch(a), neardup.sketch(b)
    assert (neardup.merge(ka, kb) == neardup.sketch(np.unique(np.concatenate([a, b])))).all()
    sizes = np.array([2000.0])
    found = neardup.likely_similarity(np.array([(ka > kb).sum()]), np.array([(ka < kb).sum()]), sizes, sizes)
    assert abs(found[0] - 0.6) < 0.15
    for least in (0.1, 0.3, 0.5, 0.56, 0.7, 0.9):
        got = neardup.likely_at_least(np.array([(ka > kb).sum()]), np.array([(ka < kb).sum()]), sizes, sizes, least)
        assert got[0] == (found[0] >= least)
    assert neardup.linked(a, a) and not neardup.linked(a, b)


# ---- tokens


def test_tokens_equal_the_library_and_decode(spark):
    ranks = bpe.vocabulary(PATH)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(9)
    bits = ["a", "the", " ", "  ", "\n", "'s", "'ll", "é", "日本", "🙂", "12", "²", "\u3000", "\x85", "\x1c", "_", "--", "\t", "Zug", "<|endoftext|>"]
    texts = ["", "a" * 3000, " " * 900 + "x", "ab" * 200] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*texts, None])], "doc_id long, text string, n_tokens string")
    coded = docs.withColumn("ids", bpe.encode_ids(docs["text"], PATH, public_tokenizers.PATTERN))
    coded = coded.withColumn("back", bpe.decode_ids(coded["ids"], PATH, public_tokenizers.PATTERN))
    digests = {r["doc_id"]: r for r in bpe.encode_digests(docs, PATH, public_tokenizers.PATTERN).collect()}
    for row in coded.collect():
        text = row["text"] or ""
        want = library.encode_ordinary(text)
        assert row["ids"] == want, text
        assert bytes(row["back"]) == text.encode()
        digest = digests[row["doc_id"]]
        assert digest["n_tokens"] == len(want)
        assert digest["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert digest["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_digests(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


# ---- licences


def test_licences_own_inherited_and_edges(spark):
    mit, cc = "Released under the MIT License.", "Licensed under CC BY-NC 4.0."
    data = [
        (1, "a/LICENSE", mit), (2, "a/b/x.txt", "some text\nwithout any"), (3, "a/b/c/y.txt", f"words here\n{cc}\nmore words and more words"),
        (4, "z/x.txt", "nothing"), (5, None, None), (6, "a/b/notice", "The licensee of this house has permission to enter by day, and by night."),
        (7, "a/b/d/e", ""), (8, "a/c/LICENSE", cc), (9, "a/c/q", "q"), (9, "a/c/q", "q"), (10, "a/x", "reserved " + "w " * 50_000),
    ]
    docs = spark.createDataFrame([(*d, "dup") for d in data], "doc_id long, path string, text string, licence string")
    found = {r["id"]: (r["licence"], r["origin"], r["directory"]) for r in licences.scan(docs, docs["path"]).collect()}
    assert found == {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "a"), 3: ("CC-BY-NC-4.0", "own", None), 4: (None, None, None), 5: (None, None, None),
        6: ("MIT", "inherited", "a"), 7: ("MIT", "inherited", "a"), 8: ("CC-BY-NC-4.0", "own", None), 9: ("CC-BY-NC-4.0", "inherited", "a/c"),
        10: ("MIT", "inherited", "a"),
    }
    assert licences.scan(docs.limit(0), docs["path"]).count() == 0


def test_licences_lines_without_licence_words_are_compared(spark):
    """Every pair at the threshold counts, whatever words the line has; plain counting over all lines and templates is the check."""
    lines = [
        "Released under the MIT", "and use in source and binary forms, with or without modification, are permitted", "All rights",
        "free of charge, to any person obtaining a copy of this software", "terms of the Mozilla Public", "of the in and to", "", "the version of this work",
        "Attribution 4.0 International, Creative Commons", "under the Apache, Version 2.0", "CC BY 4.0", "by the source", "mit", "Public Public Public",
        "Released under the MIT " + "word " * 40, "RIGHTS RESERVED, rights", "Source Code Form",
    ]
    rows = [(i, f"d{i}/x", f"{line}\n" + "prose goes on " * 60) for i, line in enumerate(lines)]
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    bags = [Counter(licences._terms_of(n)) for _, n in licences.TEMPLATES]
    held = Counter(t for _, _, text in rows for t in set(licences._terms_of(text)))
    known = {t for bag in bags for t in bag}
    weigh = lambda bag: {t: n * licences.idf(held[t] if t in known else 0, len(rows)) for t, n in bag.items()}
    size = lambda v: sum(x * x for x in v.values()) ** 0.5
    wanted = {}
    for i, _, text in rows:
        scores = []
        for line in text.split("\n"):
            mine = weigh(Counter(licences._terms_of(line)))
            for (name, _), bag in zip(licences.TEMPLATES, bags):
                theirs = weigh(bag)
                score = sum(x * theirs.get(t, 0.0) for t, x in mine.items()) / (size(mine) * size(theirs) or 1.0)
                scores.append((score, name))
        wanted[i] = max(scores)[1] if max(scores)[0] >= licences.THRESHOLD else None
    found = {r["id"]: r["licence"] for r in licences.scan(docs, docs["path"]).collect()}
    assert found == wanted
    assert wanted[0] == "MIT" and wanted[1] == "BSD-3-Clause" and wanted[2] == "Proprietary"


# ---- toxicity


def test_toxicity_separates_held_out_texts(spark):
    rng = random.Random(2)
    ordinary = ["river", "stone", "window", "garden", "letter", "morning", "paper", "yellow", "market", "bridge"]

    def text(bad):
        words = [rng.choice(ordinary) + rng.choice(["", "s", "ed", "ing"]) for _ in range(80)]
        for _ in range(4 * bad):
            words[rng.randrange(80)] = rng.choice(["zorkbrain", "flimhead", "grubsnout"])
        return " ".join(words)

    data = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + [(1000, None), (1001, ""), (1002, "river " * 60_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, x) for i, _, x in data] + [(1000, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    scored = toxicity.score_texts(docs, model).select("doc_id", "score", "predicted", toxicity.held_out(docs["doc_id"]).alias("held")).collect()
    truth = {i: x for i, _, x in data}
    held = [r for r in scored if r["held"] and r["doc_id"] in truth]
    assert len(held) > 100
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scored)
    assert {r["doc_id"]: r["predicted"] for r in scored if r["doc_id"] >= 1000} == {1000: 0, 1001: 0, 1002: 0}
    empty = toxicity.train(docs, labels.limit(0))
    assert max(r["score"] for r in toxicity.score_texts(docs, empty).collect()) < 1e-6
    assert toxicity.score_texts(docs.limit(0), model).count() == 0


def test_decoding_is_bounded_by_tokens(monkeypatch):
    """One Arrow batch of 10,000 documents and one text of 20 million characters under DuckDB's limit of 400 MB; pieces join again."""
    coder = PATH, public_tokenizers.PATTERN
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"]).column("text").combine_chunks()[:10_000]
    ids = bpe._ids(texts, *coder)
    assert len(ids.values) > 10_000_000
    assert bpe._bytes(ids, *coder).cast(pa.string()).equals(texts.fill_null(""))
    long = pa.array(["some words in a long text, " * 740_000, None, "é🙂"])
    ids = bpe._ids(long, *coder)
    assert bpe._bytes(ids, *coder).to_pylist() == [(t or "").encode() for t in long.to_pylist()]
    monkeypatch.setattr(bpe, "SLICE", 3)
    some = pa.array([None, [1, 2, 3, 4, 5, 6, 7], [], [8], None], pa.list_(pa.int32()))
    ranks = {v: k for k, v in bpe.vocabulary(PATH).items()}
    assert bpe._bytes(some, *coder).to_pylist() == [x if x is None else b"".join(ranks[i] for i in x) for x in some.to_pylist()]
    assert bpe._bytes(some[:0], *coder).to_pylist() == []
