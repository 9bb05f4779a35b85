"""Each stage against a slow version on its own input, and the whole of it."""

from __future__ import annotations

import zlib

import brute
import corpus_pipeline as pipeline
import numpy as np
import pytest
from tokenizers import Tokenizer

from tessitura.llm import encoding, language_id, shared


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = shared.documents(spark, "/root/testdata/sf0.001"), []
    for name, f in pipeline.STAGES:
        docs = shared.cut(f(spark, docs, "/root/testdata/sf0.001"), f"test-{name}")
        out.append([r.asDict() for r in docs.collect()])
    return out


def texts(rows):
    return sorted((r["doc_id"], r["text"]) for r in rows)


def test_names_and_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "simhash", "substring_dedup", "mixing", "packing"]
    assert all(list(r) == pipeline.COLUMNS for rows in stages[:4] for r in rows)


def test_language_stage(spark, stages, duck):
    _, rows = duck("SELECT doc_id, text FROM documents", "sf0.001")
    docs = shared.documents(spark, "/root/testdata/sf0.001")
    model = language_id.fit(docs.where(~language_id.held_out()))
    rejected = model.predict([t for _, t in rows])[2]
    assert texts(stages[0]) == sorted((i, t) for (i, t), r in zip(rows, rejected) if not r)
    assert len(stages[0]) >= 0.9 * len(rows)


def test_near_duplicate_stage(stages):
    before = sorted(stages[0], key=lambda r: r["doc_id"])
    assert texts(stages[1]) == sorted((before[r]["doc_id"], before[r]["text"]) for r in set(brute.near_groups([r["text"] for r in before], 5, 6, 8, 0.8)))


def test_passage_stage(stages):
    want = brute.remove_repeats([(r["doc_id"], r["text"]) for r in stages[1]], 20)
    kept = {i: k for i, (n, gone, _, k) in want.items() if not n or gone < n}
    assert {r["doc_id"]: " ".join(brute.words(r["text"])) for r in stages[2]} == kept
    same = {r["doc_id"]: r["text"] for r in stages[1]}
    assert all(r["text"] == same[r["doc_id"]] for r in stages[2] if not want[r["doc_id"]][1])
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2])


def test_mixing_stage(stages):
    sizes, taken = {}, {}
    have = {(r["doc_id"], r["text"]) for r in stages[2]}
    copies = brute.counts((r["doc_id"], r["text"]) for r in stages[3])
    assert set(copies) <= have and max(copies.values()) <= 3
    for r in stages[2]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(brute.words(r["text"]))
    for r in stages[3]:
        taken[r["source"]] = taken.get(r["source"], 0) + len(brute.words(r["text"]))
    goals = brute.targets(sizes)
    for r in stages[2]:  # one copy more or less of any document brings no source nearer
        gap, n = goals[r["source"]] - taken.get(r["source"], 0), len(brute.words(r["text"]))
        many = copies[r["doc_id"], r["text"]]
        assert not n or not (gap > 0 and many < 3 or gap < 0 and many > 0) or abs(gap) <= n / 2 + 1


def test_packing_stage(stages):
    coder = Tokenizer.from_file(encoding.tokenizer_path())
    want = []
    for r in stages[3]:
        ids = [*coder.encode(r["text"], add_special_tokens=False).ids, 0]
        want += [(r["doc_id"], a, len(ids[a : a + 1024]), zlib.crc32(np.array(ids[a : a + 1024], "<u4").tobytes())) for a in range(0, len(ids), 1024)]
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in stages[4]) == sorted(want)


def test_run(spark, stages):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    found = pipeline.run(spark, "/root/testdata/sf0.001").select(*names).collect()
    assert sorted(map(tuple, found)) == sorted(tuple(r[n] for n in names) for r in stages[4])


def test_every_stage_takes_odd_rows(spark, make, odd):
    for name, f in pipeline.STAGES:
        for df in (make(odd, extra=True), make([])):
            found = f(spark, df, "/root/testdata/sf0.001")
            n = found.count()
            assert n or not df.count() or name == "language_id"
            assert name == "packing" or found.columns == pipeline.COLUMNS


def test_rows_with_one_id_are_not_multiplied(spark, make):
    rows = [(1, f"{w} " * 40, "en", "a") for w in ("one", "two", "three")] + [(None, f"{w} " * 40, "en", "a") for w in ("four", "five")]
    df = make(rows)
    assert pipeline.mix_sources(spark, df, "").count() == 5  # one source: its target is what it has
    assert pipeline.drop_near_duplicates(spark, df, "").count() == 5
