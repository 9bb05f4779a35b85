from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessitura.llm import mixing, registry, shared


def mixed(df):
    return [r.asDict() for r in mixing.mix(df).collect()]


def check(found, rows):
    """Whole copies up to three, targets as brute force has them, and what is taken near the target."""
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(brute.words(text))
    want = brute.targets(sizes)
    assert len(found) == len(rows)
    for source, mine in brute.by(found, lambda r: r["_source"]).items():
        least = min([r["_size"] for r in mine if r["_size"]], default=0)
        assert {r["_source_size"] for r in mine} == {sizes[source]}
        assert all(abs(r["_target"] - want[source]) <= 1e-6 * max(1, want[source]) for r in mine)
        assert all(0 <= r["_copies"] <= 3 for r in mine)
        taken = sum(r["_copies"] * r["_size"] for r in mine)
        assert abs(taken - want[source]) <= max(least, 1), (source, taken, want[source])


@pytest.mark.parametrize("seed", range(3))
def test_random_sources(make, seed):
    rng = random.Random(seed)
    sources = [None, "", "a", "B", "é", "zz", "𝒳"][: rng.randint(2, 7)]
    weight = [rng.random() ** 3 for _ in sources]
    rows = [(i, " ".join("w" for _ in range(int(rng.expovariate(1 / 30)))), "en", rng.choices(sources, weight)[0]) for i in range(300)]
    check(mixed(make(rows)), rows)


def test_odd_rows(make, odd):
    rows = [(i, t, *(list(r) + [None, None])[:2]) for i, t, *r in odd]
    found = mixed(make(odd, extra=True))
    assert len(found) == len(odd) and all(0 <= r["_copies"] <= 3 for r in found)
    assert {r["_copies"] for r in found if not r["_size"]} == {1}
    assert {r["_source"] for r in found} == {s for *_, s in rows}


def test_reruns_agree_and_hot_cells_are_split(make, monkeypatch):
    rows = [(i, "five words in this text", "en", "hot" if i % 3 else "b") for i in range(500)]
    key = lambda found: sorted((r["_id"], r["_copies"]) for r in found)
    once = mixed(make(rows))
    check(once, rows)
    assert key(once) == key(mixed(make(rows[::-1])))
    monkeypatch.setattr(shared, "LEAST_RANKED", 20)
    check(mixed(make(rows)), rows)


def test_rates_are_exponentially_tilted(make, spark):
    """The rates solve the dual: exp(lambda x) up to the limit, and they meet the target."""
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(1, 400), "en", "a" if i % 2 else "b") for i in range(400)]
    sizes = make(rows).select(F.col("source").alias("_source"), mixing.word_count("text").alias("_size"))
    for goal in mixing.targets(sizes).collect():
        mine = np.array([r["_size"] for r in sizes.where(F.col("_source") == goal["_source"]).collect()])
        tilt = mixing.solve(*np.unique(mine, return_counts=True), goal["_target"])
        assert np.minimum(3.0, np.exp(tilt * mine / mine.mean())) @ mine == pytest.approx(goal["_target"], rel=1e-6)


@pytest.mark.parametrize("share", [0.0, 1e-9, 0.01, 0.999, 1.0, 2.9, 2.999999, 3.0])
@pytest.mark.parametrize("sizes", [[1], [1, 10**6], [5, 5, 5], list(range(1, 300))])
def test_any_target_is_met(sizes, share):
    x, n = np.unique(np.array(sizes), return_counts=True)
    tilt = mixing.solve(x, n, share * sum(sizes))
    with np.errstate(over="ignore"):
        rate = np.minimum(3.0, np.exp(tilt * np.array(sizes) / np.mean(sizes)))
    assert rate @ np.array(sizes) == pytest.approx(share * sum(sizes), rel=1e-6)


def test_repeated_rows_share_the_copies(make):
    rows = [(1, "same words here", "en", "a")] * 40 + [(i, "other words here too", "en", "b") for i in range(2, 30)]
    found = mixed(make(rows))
    check(found, rows)
    assert len([r for r in found if r["_id"] == 1]) == 40


def test_nothing_to_mix(make):
    assert mixed(make([])) == []
    assert [r["_copies"] for r in mixed(make([(1, None, None, None), (2, "", "en", "a")]))] == [1, 1]


def test_query(spark, duck):
    _, rows = duck("SELECT doc_id, text, lang, source FROM documents")
    found = registry.QUERIES["op3_mixing"](spark, "/root/testdata/sf0.01").collect()
    assert sorted((r["doc_id"], r["size"]) for r in found) == sorted((i, len(brute.words(t))) for i, t, *_ in rows)
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    taken, target = {}, {}
    source = {i: s for i, _, _, s in rows}
    for r in found:
        taken[source[r["doc_id"]]] = taken.get(source[r["doc_id"]], 0) + r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 5 for s in target)
