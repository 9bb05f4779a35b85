from __future__ import annotations

import math
import random
import tracemalloc

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessitura.llm import registry, topk


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def found(spark, rows, k=5, every=3):
    out = topk.top_k(topk.quantised(table(spark, rows)), F.col("_id") % every == 0, k)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())


def whole(rows):
    return [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]


def test_same_as_sql(same):
    same(registry.QUERIES["op4_topk"], registry.ORACLE_SQL["op4_topk"])


@pytest.mark.parametrize("kind", ["spread", "ties", "clusters", "few", "copies"])
def test_against_all_pairs(spark, monkeypatch, kind):
    rng = random.Random(kind)
    n = {"few": 4}.get(kind, 400)
    if kind == "clusters":
        monkeypatch.setattr(topk, "GROUP", 8)
        monkeypatch.setattr(topk, "BLOCK", 50)
        centres = [[rng.gauss(0, 3) for _ in range(6)] for _ in range(9)]
        rows = [(i, [x + rng.gauss(0, 0.05) for x in rng.choice(centres)], 0) for i in range(n)]
    elif kind == "ties":
        rows = [(i, [float(rng.randint(-1, 1)) for _ in range(3)], 0) for i in range(n)]
    elif kind == "copies":
        rows = [(i, [1.0, 2.0, 3.0] if i % 4 else [rng.random() for _ in range(3)], 0) for i in range(n)]
    else:
        rows = [(i * 7 - 30, [rng.gauss(0, 1) for _ in range(8)], 0) for i in range(n)]
    assert found(spark, rows) == brute.top_k(whole(rows), lambda i: i % 3 == 0, 5)


def test_far_vectors_are_not_sent(spark, monkeypatch):
    """With clusters, a query's group needs few cells: the bounds are tight, and the result is whole."""
    monkeypatch.setattr(topk, "GROUP", 4)
    monkeypatch.setattr(topk, "BLOCK", 100)
    rng = random.Random(0)
    centres = [[rng.gauss(0, 5) for _ in range(16)] for _ in range(20)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in centres[i % 20]], 0) for i in range(2000)]
    measured = {}
    out = topk.top_k(topk.quantised(table(spark, rows)), F.col("_id") % 50 == 0, 5, measured)
    assert sorted(tuple(r) for r in out.collect()) == [(q, r, v, s) for q, r, v, s in brute.top_k(whole(rows), lambda i: i % 50 == 0, 5)]
    assert measured["replication"] < 6  # of 20 and more groups


def test_components_beyond_64_bits_are_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(0, [3e38], 1), (1, [1.0], 1)])
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(0, [1e15, 1.0], 1), (1, [1e15, 1.0], 1), (3, [1.0, 2.0], 1)])


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (3, None, 1), (6, [float("nan"), 1.0], 1), (9, [None, 1.0], None), (12, [float("inf"), 0.0], 1), (None, [1.0, 1.0], 1), (1, [0.5, 0.5], 1), (2, [3.0], 1), (15, [], 1), (18, [-1e-9, 0.0], 1)]
    want = brute.top_k(whole(rows), lambda i: i % 3 == 0, 5)
    assert found(spark, rows) == want and want


def test_extra_columns_and_repeated_rows(spark):
    rows = [(0, [1.0], 1), (0, [1.0], 1), (1, [2.0], 1)]
    df = table(spark, rows).selectExpr("*", "1 AS _id", "2 AS _v", "3 AS score")
    got = topk.top_k(topk.quantised(df), F.col("_id") % 3 == 0).collect()
    assert {(r["query_id"], r["vec_id"]) for r in got} == {(0, 1)}


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1)]) == []


def test_scores_beyond_doubles():
    a = np.array([[2**30, 1], [2**30 + 1, -1]])
    assert topk._products(a, a)[0, 1] == 2**30 * (2**30 + 1) - 1
    with pytest.raises(OverflowError):
        topk._products(a * 2**10, a)


def test_vectors_without_clusters_are_sent_twice(spark, monkeypatch):
    """No bound rules a cell out: still no copy of the table goes to every group of queries."""
    monkeypatch.setattr(topk, "GROUP", 4)
    monkeypatch.setattr(topk, "BLOCK", 100)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.125) for _ in range(16)], 0) for i in range(2000)]
    measured = {}
    out = topk.top_k(topk.quantised(table(spark, rows)), F.col("_id") % 50 == 0, 5, measured)
    assert sorted(tuple(r) for r in out.collect()) == brute.top_k(whole(rows), lambda i: i % 50 == 0, 5)
    assert measured["replication"] < 4


def test_queries_go_to_few_local_problems_with_clusters(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP", 4)
    monkeypatch.setattr(topk, "BLOCK", 100)
    rng = random.Random(0)
    centres = [[rng.gauss(0, 5) for _ in range(16)] for _ in range(20)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in centres[i % 20]], 0) for i in range(2000)]
    measured = {}
    topk.top_k(topk.quantised(table(spark, rows)), F.col("_id") % 50 == 0, 5, measured)
    assert measured["tasks"] >= 20 and measured["visits"] < measured["tasks"] / 3


def test_memory_does_not_follow_batch_or_pivots():
    rng = np.random.default_rng(0)
    x = rng.integers(-256, 256, (20_000, 8))
    tracemalloc.start()
    topk._nearest(x, x[:1024].astype(float))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 80e6


def test_memory_with_ties_everywhere():
    """Every score of a step reaches the floor: what is looked at stays a step."""
    x = np.random.default_rng(0).integers(-1, 2, (50_000, 12)).astype(np.int8)
    block = topk._Block(np.arange(len(x)), np.zeros(len(x), int), x, 5, lambda q, at: np.full((len(q), len(at)), np.inf))
    tracemalloc.start()
    own, who, score = block.best(np.arange(512), x[:512], np.full(512, topk.NOTHING))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 150e6
    wide = x.astype(int)
    for i in (0, 100, 511):
        products = wide @ wide[i]
        products[i] = -1000
        best = np.lexsort((np.arange(len(x)), -products))[:5]
        assert who[own == i].tolist() == best.tolist() and score[own == i].tolist() == products[best].tolist()


def test_copies_with_one_id_hide_no_other(spark):
    """Seven rows of a query's id stand before the only row that it may return."""
    rows = [(0, [1.0, 0.5], 1)] * 7 + [(1, [1.0, 0.5], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1)
    got = topk.top_k(topk.quantised(df), F.col("_id") % 3 == 0).collect()
    assert len(got) == 5 and {(r["query_id"], r["vec_id"]) for r in got} == {(0, 1)}


def test_scores_beyond_53_bits(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 20)
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(-(2**20), 2**20)) for _ in range(4)], 0) for i in range(100)]
    assert found(spark, rows) == brute.top_k(whole(rows), lambda i: i % 3 == 0, 5)
