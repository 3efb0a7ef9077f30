"""Coded approximate search against brute force."""

import numpy as np
import pytest

from wattmill.operators import coded_search as Q

DIM = 24


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(9)
    middles = rng.normal(size=(20, DIM)) * 3
    rows = (middles[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, DIM))).astype(np.float32)
    asked = (middles[rng.integers(0, 20, 25)] + rng.normal(size=(25, DIM))).astype(np.float32)
    odd = [(5000, None), (5001, []), (5002, [1.0] * 3), (5003, [0.0] * DIM), (5004, [float("nan")] * DIM), (5005, [None] * DIM), (None, None)]
    vectors = spark.createDataFrame([(i, r) for i, r in enumerate(rows.tolist())] + odd, "vec_id long, embedding array<float>").repartition(6)
    queries = spark.createDataFrame([(i, r) for i, r in enumerate(asked.tolist())] + [(99, None)], "query_id long, embedding array<float>")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    order = np.argsort(-(unit(asked.astype(float)) @ unit(rows.astype(float)).T), axis=1, kind="stable")
    return vectors, queries, order


def _hits(found):
    out = {}
    for r in found.collect():
        out.setdefault(r["query_id"], {})[r["rank"]] = r
    return out


@pytest.mark.parametrize("probes", [None, 6])
def test_recall_and_reads(cloud, probes):
    vectors, queries, order = cloud
    index = Q.build(vectors, DIM, lists=16)
    assert index.codes.count() == 4000
    assert {len(r["code"]) for r in index.codes.select("code").distinct().collect()} == {DIM // Q.SLICE}
    got = _hits(Q.search(index, vectors, queries, 5, short=60, probes=probes))
    assert set(got) == set(range(25))
    shared = [len({r["vec_id"] for r in got[q].values()} & set(order[q, :5].tolist())) for q in got]
    assert sum(shared) >= 0.95 * 5 * 25
    assert all(r["read"] <= 60 for rows in got.values() for r in rows.values())
    assert all([rows[i]["similarity"] for i in range(1, 6)] == sorted((r["similarity"] for r in rows.values()), reverse=True) for rows in got.values())


def test_codes_stay_close_to_the_vectors(cloud):
    """The codes' score of a row is its cosine up to a small error."""
    vectors, queries, _ = cloud
    index = Q.build(vectors, DIM)
    (ids, matrix), = Q._tiles(queries, DIM)
    near = Q._short_lists(index, ids, matrix, len(index.centres), 20).toPandas()
    exact = Q.search(index, vectors, queries, 20, short=20).toPandas().merge(near, on=["query_id", "vec_id"])
    assert len(exact) >= 25 * 20 and (exact["near"] - exact["similarity"]).abs().max() < 0.06


def test_large_query_sets_are_cut(cloud, monkeypatch):
    vectors, queries, _ = cloud
    index = Q.build(vectors, DIM)
    want = Q.search(index, vectors, queries, 3).toPandas().sort_values(["query_id", "rank"]).reset_index(drop=True)
    monkeypatch.setattr(Q, "QUERY_BYTES", 8 * Q.ENTRIES * DIM)
    assert len(list(Q._tiles(queries, DIM))) > 5
    got = Q.search(index, vectors, queries, 3).toPandas().sort_values(["query_id", "rank"]).reset_index(drop=True)
    assert got.equals(want[got.columns])


def test_absent_and_small(spark, cloud):
    vectors, queries, _ = cloud
    assert Q.build(vectors.limit(0), DIM) is None
    assert Q.search(None, vectors, queries).count() == 0
    few = spark.createDataFrame([(1, [1.0] * DIM), (2, [1.0] * DIM), (3, [-1.0] * DIM)], "vec_id long, embedding array<double>")
    index = Q.build(few, DIM)
    assert Q.search(index, few, queries.limit(0)).count() == 0
    one = spark.createDataFrame([(7, [2.0] * DIM)], "query_id long, embedding array<double>")
    got = Q.search(index, few, one, 5).orderBy("rank").collect()
    assert [(r["vec_id"], r["similarity"]) for r in got] == [(1, 1.0), (2, 1.0), (3, -1.0)]


def test_queries_search_the_coded_index(spark, tmp_path):
    """The registered queries go through the coded index, on rows with ids and labels of their own."""
    from wattmill.plans.catalog import chat

    rng = np.random.default_rng(5)
    rows = [(i, v, i % 4) for i, v in enumerate(rng.normal(size=(400, 64)).astype(np.float32).tolist())]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    top = chat.coded_top_k(spark, str(tmp_path)).collect()
    assert {(r["query_id"], r["rank"]) for r in top} == {(q, k) for q in range(4) for k in range(1, 6)}
    assert all(r["recall_reached"] and r["share_below"] for r in chat.coded_recall(spark, str(tmp_path)).collect())
