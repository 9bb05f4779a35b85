from __future__ import annotations

import hashlib
import random

import brute
import numpy as np
import pytest

from tessitura.llm import registry, shared, sketches


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))


def check(found, rows):
    rows = [(i, t or "") for i, t, *_ in ordered(rows)]
    found = sorted(found, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert len(found) == len(rows)
    want = []
    for n, (i, text) in enumerate(rows):
        half = len(text) // 2
        changed = text[: len(text) - half] + rows[(n + 1) % len(rows)][1][:half]
        want.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=repr) == sorted(want, key=repr)


def test_odd_rows(make, odd):
    found = sketches.compare_with_next(make(odd, extra=True)).collect()
    check(found, odd)
    by_id = brute.by(found, lambda r: r["doc_id"])
    assert by_id[31][0]["fingerprint"] == by_id[32][0]["fingerprint"] and by_id[31][0]["near_next"] == 1.0
    assert by_id[11][0]["fingerprint"] == "" and by_id[11][0]["near_next"] == 1.0  # the next has no words either
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_few_rows(make, n):
    rows = [(5 * i, "a few words of text " * (i + 1)) for i in range(n)]
    check(sketches.compare_with_next(make(rows)).collect(), rows)


def test_small_steps(make, monkeypatch):
    monkeypatch.setattr(shared, "STEP_BYTES", 300)
    rng = random.Random(0)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 60)))) for i in range(80)]
    check(sketches.compare_with_next(make(rows)).collect(), rows)


def test_query(spark, duck):
    _, rows = duck("SELECT doc_id, text FROM documents", "sf0.001")
    check(registry.QUERIES["op6_fingerprints"](spark, "/root/testdata/sf0.001").collect(), rows)


def test_sketch_holds_every_hash_below_the_limit():
    rng = random.Random(4)
    texts = ["", "one", "two words", *[" ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 200))) for _ in range(40)]]
    raw = [t.encode() for t in texts]
    every = sketches.sketch_values(raw, 5, 1)
    for scale in (2, 8, 64):
        doc, value = sketches.sketch_values(raw, 5, scale)
        for i, text in enumerate(texts):
            all_of = {int(v) for v in every[1][every[0] == i]}
            assert len(all_of) == len(set(brute.shingles(text, 5)))
            below = {v for v in all_of if v < 2**64 // scale}
            assert {int(v) for v in value[doc == i]} == below


def test_containment_of_unequal_texts_and_merging():
    rng = random.Random(9)
    long = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    part, other = " ".join(long[4000:7000]), " ".join(f"v{i}" for i in range(3000))
    doc, value = sketches.sketch_values([" ".join(long).encode(), part.encode(), other.encode()])
    spelled = sketches.spelled(doc, value, 3)
    pick = lambda i: (np.zeros((doc == i).sum(), np.int64), value[doc == i])
    assert sketches.likeness(pick(0), pick(1), 1)[0] == 1.0
    assert sketches.likeness(pick(0), pick(2), 1)[0] == 0.0
    assert sketches.merge(spelled[0], spelled[1]) == spelled[0]
    assert len(sketches.parse(sketches.merge(spelled[1], spelled[2]))) == len(sketches.parse(spelled[1])) + len(sketches.parse(spelled[2]))


def test_merging_short_texts():
    """The merged sketch is that of both texts' shingles, however few they are."""
    rng = random.Random(7)
    for _ in range(60):
        a, b = (" ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 12))).encode() for _ in "ab")
        doc, value = sketches.sketch_values([a, b])
        one, other = sketches.spelled(doc, value, 2)
        whole = sketches.sketch_values([a, b], scale=1)[1]
        assert sketches.parse(sketches.merge(one, other)).tolist() == sorted({int(v) for v in whole if v < 2**61})


def test_likeness_of_short_texts_is_exact(make):
    """A short text whose sketch is empty: contained in the next, half like it, or not at all."""
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(60):
        text = [f"w{rng.randrange(10**6)}" for _ in range(7)]
        mine, after = " ".join(text), " ".join(text[: rng.choice([0, 5, 7])] + ["and", "more"] * 30)
        rows += [(2 * i, mine), (2 * i + 1, after)]
        a, b = ({*brute.shingles(t, 5)} for t in (mine, after))
        want[2 * i] = len(a & b) / min(len(a), len(b))
    found = {r["doc_id"]: r for r in sketches.compare_with_next(make(rows)).collect()}
    empty = [i for i in want if not found[i]["fingerprint"]]
    assert len(empty) > 20 and all(found[i]["near_next"] == pytest.approx(want[i]) for i in empty)


def test_fingerprint_keeps_columns(make, odd):
    df = make(odd, extra=True)
    found = sketches.fingerprint(df)
    assert found.columns == [*df.columns, "_fingerprint"] and found.where("_text = 'x'").count() == len(odd)
