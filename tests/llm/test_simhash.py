from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessitura.llm import registry, shared, simhash


def test_fingerprint(odd):
    for _, text, *_ in odd:
        for width in (1, 4, 5):
            assert int(simhash.fingerprint((text or "").encode(), width)[0]) == brute.simhash(text, width)


def test_parts_are_independent():
    both = np.array([simhash.fingerprint(b" ".join(b"%d" % random.Random(i).randrange(9) for _ in range(30)) + b" %d" % i, 5, parts=3) for i in range(200)])
    assert (both[:, 0] != both[:, 1]).all() and (both[:, 1] != both[:, 2]).all()
    assert 28 < np.bitwise_count(both[:, 0] ^ both[:, 1]).mean() < 36


@pytest.mark.parametrize("most", [0, 1, 3, 4, 8])
def test_links_are_complete(spark, most):
    """Random values and copies with a few bits changed: the same components as all pairs give."""
    rng = random.Random(most)
    values = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    for v in list(values):
        for _ in range(rng.randint(0, 4)):
            for b in rng.sample(range(64), rng.randint(1, most + 2)):
                v ^= 1 << b
            values.add(v)
    values = sorted(values)
    want = brute.components(len(values), lambda a, b: (values[a] ^ values[b]).bit_count() <= most)
    rows = [(v - 2**64 if v >= 2**63 else v, i) for i, v in enumerate(values)]
    found = simhash.components(simhash.links(spark.createDataFrame(rows, "_fp0 long, _node long"), most)).collect()
    root = {r["node"]: r["root"] for r in found}
    assert [root.get(i, i) for i in range(len(values))] == want
    if most != 4:
        return
    deep = simhash.components(simhash.links(spark.createDataFrame(rows, "_fp0 long, _node long"), most, deep=True)).collect()
    assert {r["node"]: r["root"] for r in deep} == root


def test_a_dense_group_is_one_component(spark):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    values = list({centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)})
    rows = [(v - 2**64 if v >= 2**63 else v, i) for i, v in enumerate(values)]
    found = simhash.components(simhash.links(spark.createDataFrame(rows, "_fp0 long, _node long"))).collect()
    assert {r["root"] for r in found} == {0} and len(found) == len(values) - 1


@pytest.mark.parametrize("shape", ["chain", "star", "ring", "pairs"])
def test_components(spark, shape):
    n = 300
    edges = {"chain": [(i, i + 1) for i in range(n)], "star": [(7, i) for i in range(n)], "ring": [(i, (i + 1) % n) for i in range(n)], "pairs": [(2 * i, 2 * i + 1) for i in range(n)]}[shape]
    random.Random(0).shuffle(edges)
    nodes = sorted({x for e in edges for x in e})
    have = set(edges)
    want = brute.components(len(nodes), lambda a, b: (a, b) in have or (b, a) in have) if shape == "pairs" else [0] * len(nodes)
    root = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert [root.get(i, i) for i in nodes] == want


@pytest.mark.parametrize("few", [0, 150, 10**6])
@pytest.mark.parametrize("shape", ["chain", "star", "trees"])
def test_components_in_rounds_and_in_one_task(spark, monkeypatch, shape, few):
    """The same roots, whatever number of links goes to one task; few links need no round, which costs the driver its plans."""
    rounds, shape_of = [], simhash._shape
    monkeypatch.setattr(simhash, "FEW_LINKS", few)
    monkeypatch.setattr(simhash, "_shape", lambda state: rounds.append(1) or shape_of(state))
    n = 300
    edges = {"chain": [(i, i + 1) for i in range(n)], "star": [(7, i) for i in range(n)], "trees": [(i, i // 2 * 2 - 20) for i in range(20, n)]}[shape]
    random.Random(1).shuffle(edges)
    nodes = sorted({x for e in edges for x in e})
    place, have = {x: i for i, x in enumerate(nodes)}, set(edges)
    least = brute.components(len(place), lambda a, b: (nodes[a], nodes[b]) in have or (nodes[b], nodes[a]) in have)
    found = simhash.components(spark.createDataFrame(edges + edges[:9], "a long, b long")).collect()
    root = {r["node"]: r["root"] for r in found}
    assert len(found) == len(root) == sum(r != i for i, r in enumerate(least))
    assert [root.get(x, x) for x in nodes] == [nodes[r] for r in least]
    assert bool(rounds) == (few < n - 20)


def test_the_last_plan_is_small(make, monkeypatch):
    """What the driver holds for the last join of groups: neither join with hot keys is planned within the other."""
    monkeypatch.setattr(shared, "LEAST_JOINED", 3)
    found = simhash.near_groups(make([(i, f"text number {i % 7}") for i in range(60)]))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 12
    assert {r["_root"] for r in found.collect()} == set(range(7))


def test_query_against_all_pairs(spark, duck):
    _, rows = duck("SELECT doc_id, text FROM documents", "sf0.001")
    prints = [brute.simhash(t, 4) for _, t in rows]
    root = brute.components(len(rows), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    least = {r: min(rows[i][0] for i in range(len(rows)) if root[i] == r) for r in set(root)}
    found = registry.QUERIES["op10_simhash"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r) for r in found) == sorted((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, root))


def test_odd_rows(make, odd):
    found = simhash.near_groups(make(odd, extra=True)).collect()
    assert len(found) == len(odd)
    by_id = brute.by(found, lambda r: r["_id"])
    empty = {by_id[i][0]["_root"] for i in (11, 12, 13, 41)}
    assert empty == {11}  # no words: fingerprint 0, one group
    assert {r["_root"] for r in by_id[50]} == {50} and len(by_id[50]) == 2
    assert {by_id[i][0]["_root"] for i in (31, 32)} == {31}
    assert len(by_id[shared.NULL_ID]) == 2


def test_keep_one(make, odd):
    kept = simhash.keep_one(make(odd, extra=True))
    assert kept.columns == make(odd, extra=True).columns
    rows = kept.collect()
    ids = [r["doc_id"] for r in rows]
    assert ids.count(50) == 1 and 20 in ids and 32 not in ids and ids.count(None) == 2
    assert [i for i in ids if i in (11, 12, 13, 41)] == [11]
    assert {r["_id"] for r in rows} == {"x"}


def test_near_copies_go_and_others_stay(make):
    """Copies that share over 0.85 of their five-word shingles, and texts that share their vocabulary only."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, groups = [], {}
    for i in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(80, 400))]
        rows.append((10 * i, " ".join(base)))
        for j in range(1, 4):
            copy = list(base)
            for at in rng.sample(range(len(copy)), max(1, len(copy) // 100)):
                copy[at] = "changed"
            rows.append((10 * i + j, " ".join(copy)))
    for i, text in rows:
        mine = set(brute.shingles(text, 5))
        base = set(brute.shingles(dict(rows)[i - i % 10], 5))
        groups[i] = len(mine & base) / len(mine | base)
    near = [i for i in groups if groups[i] > 0.85]
    assert len(near) > 140
    kept = {r["doc_id"] for r in simhash.keep_one(make(rows)).collect()}
    assert {10 * i for i in range(40)} <= kept
    assert sum(i in kept for i in near if i % 10) <= 2


def family(rng, n, changes, words=120):
    """Copies of one text, each with some words changed: pairs of about similarity 0.8, on both sides of it."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for at in rng.sample(range(words), rng.choice(changes)):
            copy[at] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("block", [8_000_000, 3_000])
def test_links_are_verified(make, monkeypatch, block):
    """The same groups as all pairs give, in one block a group and in many."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "PIVOTS", 2)
    monkeypatch.setattr(simhash, "CHUNK", 50)
    monkeypatch.setattr(shared, "LEAST_JOINED", 3 if block < 10_000 else 1000)
    rng = random.Random(5)
    texts = [*family(rng, 60, [0, 1, 1, 2, 3, 4]), *family(rng, 20, [1, 2]), *family(rng, 30, [2, 3]), *[t for f in range(20) for t in family(rng, 3, [0, 1, 2])], "", None, "one"]
    want = brute.near_groups(texts, 5, 6, 8, 0.8)
    assert len(set(want)) > 30
    found = simhash.near_groups(make(list(enumerate(texts))), 8, 5, 6, simhash.bits_at(0.8, 384), 0.8).collect()
    assert [r["_root"] for r in sorted(found, key=lambda r: r["_id"])] == want


def test_repeated_lines_do_not_decide(make):
    """A line that fills most of two texts makes them no copies; a text that repeats its last line stays a copy."""
    rng = random.Random(2)
    word = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    line, text = word(12), word(300)
    rows = [(1, word(200) + f" {line}" * 20), (2, word(200) + f" {line}" * 20), (3, text), (4, text + (" " + " ".join(text.split()[-12:])) * 15)]
    assert sorted(r["doc_id"] for r in simhash.keep_one(make(rows)).collect()) == [1, 2, 3]


def test_hot_keys_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(shared, "LEAST_JOINED", 100)
    rows = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 7, id) AS k")
    lookup = rows.groupBy(F.col("k").alias("l")).agg(F.count("*").alias("n"), F.max("id").alias("top"))
    found = shared.spread(rows, lookup, [("k", "l")], "n", 1000)
    assert sorted((r["id"], r["top"]) for r in found.collect()) == [(i, 999 if i % 3 == 0 or i == 7 else i) for i in range(1000)]


def test_empty_table(make):
    assert simhash.near_groups(make([])).count() == 0
    assert simhash.keep_one(make([])).count() == 0


def test_bits_at():
    assert simhash.bits_at(1.0, 64) == 0
    assert 9 <= simhash.bits_at(0.8, 64, 0) <= 10
    assert simhash.bits_at(0.8, 384) < simhash.bits_at(0.7, 384)
