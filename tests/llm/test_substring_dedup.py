from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from tessitura.llm import registry, shared, substring_dedup


def removed(df, k=20, **more):
    return {r["doc_id"]: (r["_n_words"], r["_n_removed"], r["_kept"]) for r in substring_dedup.remove_repeats(df, k, **more).collect()}


def test_same_as_sql(same):
    same(registry.QUERIES["op1_substring_dedup"], registry.ORACLE_SQL["op1_substring_dedup"])


@pytest.mark.parametrize("k", [1, 2, 3, 5, 20])
@pytest.mark.parametrize("seed", [0, 1])
def test_random_texts(make, k, seed, monkeypatch):
    if seed:  # several buckets, and minimisers that are split
        monkeypatch.setattr(substring_dedup, "LEAST_WORDS", 20)
    rng = random.Random(seed)
    vocabulary = ["a", "bb", "c", "dé", "e"][: rng.randint(2, 5)]
    rows = [(i * 3 - 9, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, k - 1, k, k + 1, 60, 300])))) for i in range(25)]
    want = brute.remove_repeats(rows, k)
    assert removed(make(rows), k) == {i: (n, g, kept) for i, (n, g, _, kept) in want.items()}


def test_odd_rows(make, odd):
    rows = [r[:2] for r in odd if r[0] is not None]
    want = brute.remove_repeats(list(dict(rows).items()), 20)  # a repeated row counts once and has the same result
    found = substring_dedup.remove_repeats(make(odd, extra=True)).collect()
    assert len(found) == len(odd)
    got = [(r["doc_id"], r["_n_words"], r["_n_removed"], r["_kept"]) for r in found if r["doc_id"] is not None]
    assert sorted(got) == sorted((i, *want[i][:2], want[i][3]) for i, _ in rows)
    assert found[0]["_id"] == "x" and found[0]["a.b"] == "x"


def test_without_ids(make):
    passage = " ".join(f"w{i}" for i in range(30))
    found = substring_dedup.remove_repeats(make([(None, "a " + passage), (None, "b " + passage), (5, passage), (None, "a " + passage)])).collect()
    assert sorted(r["_n_removed"] for r in found) in ([0, 0, 30, 30], [0, 30, 30, 30])  # the repeated row has its twin's result
    assert {r["_kept"] for r in found if r["doc_id"] == 5} == {""}


def test_one_id_with_different_texts(make):
    rows = [(1, " ".join(f"w{i}" for i in range(n))) for n in (25, 40, 60)]
    assert {r["_n_removed"] for r in substring_dedup.remove_repeats(make(rows)).collect()} == {0}


def test_empty_table(make):
    assert removed(make([])) == {}


def test_one_long_run_is_cut_without_effect(make):
    text = "same " * 3000
    assert removed(make([(1, text), (2, text)])) == {1: (3000, 2999, "same"), 2: (3000, 3000, "")}


def test_split_minimisers_keep_equal_windows_together():
    """One phrase is the minimiser of windows with all kinds of words around it: they spread, equal ones don't."""
    rng = random.Random(1)
    phrase = ["all", "rights", "reserved"]
    texts = [" ".join([*[f"x{rng.randrange(40)}" for _ in range(8)], *phrase, *[f"y{rng.randrange(40)}" for _ in range(8)]]) for _ in range(300)]
    texts += texts[:50]
    words = shared.Words([t.encode() for t in texts])
    split = np.full(substring_dedup.BINS, 5)
    doc, first, count, key = substring_dedup._super_kmers(words, 10, split)
    assert count.sum() == sum(len(t.split()) - 9 for t in texts)
    keys = {}
    for d, f, c, x in zip(doc, first, count, key):
        for w in range(f, f + c):
            keys.setdefault(texts[d].split()[w - words.at[d] : w - words.at[d] + 10].__repr__(), set()).add(int(x))
    assert all(len(v) == 1 for v in keys.values())
    assert len(set(key.tolist())) > len(set(substring_dedup._super_kmers(words, 10)[3].tolist()))


def test_windows_that_share_a_hash_are_told_apart(make, monkeypatch):
    """With a hash of two values every comparison goes through the words themselves."""
    rng = random.Random(5)
    rows = [(i, [rng.choice("abc") for _ in range(40)]) for i in range(6)]
    codes = np.concatenate([np.array([ord(c) for c in w]) for _, w in rows])
    begin, doc, start, count = np.arange(6) * 40, np.arange(6), np.zeros(6, np.int64), np.full(6, 37)
    monkeypatch.setattr(shared, "span_hash", lambda prefix, at, k: (codes[at] % 2).astype(np.uint64))
    got = substring_dedup._firsts(codes, begin, doc, start, count, 4)
    seen, want = set(), []
    for _, w in rows:
        for s in range(37):
            want.append(tuple(w[s : s + 4]) not in seen)
            seen.add(tuple(w[s : s + 4]))
    assert got.tolist() == want
