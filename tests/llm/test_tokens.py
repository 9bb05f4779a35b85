"""Encoding, packing, token files and unigram counts."""

from __future__ import annotations

import random
import re
import zlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessitura.llm import encoding, packing, registry, shared, token_counts, token_files

TOKENIZER = Tokenizer.from_file(encoding.tokenizer_path())


def ids_of(text, end):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(), st.text(alphabet=" \n\t\x0b\x1c\x85\xa0ab'sÉ日1.<|>"), st.sampled_from(["it's  fine\n\n", "<|endoftext|> x", "a <|endoftext|>", "é 's", "　x y"])), max_size=5))
def test_encoding_of_pieces_is_that_of_the_text(texts):
    ids, at = encoding.load(encoding.tokenizer_path()).encode([t.encode() for t in texts], 7)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [ids_of(t, 7) for t in texts]


def test_small_tables_of_pieces(monkeypatch):
    monkeypatch.setattr(encoding, "REMEMBERED", 3)
    coder = encoding.Pieces(TOKENIZER)
    rng = random.Random(0)
    for _ in range(20):
        text = " ".join(rng.choice(["one", "two", "three", "four", "five", "six"]) for _ in range(9))
        ids, _ = coder.encode([text.encode()], 1)
        assert ids.tolist() == ids_of(text, 1)


@pytest.mark.parametrize("seed", range(6))
def test_histogram_packing(seed):
    rng = random.Random(seed)
    size = rng.choice([7, 64, 1024])
    counts = brute.counts(min(size, 1 + int(rng.expovariate(4 / size))) for _ in range(3000))
    patterns = packing.pack_histogram(dict(counts), size)
    used = brute.counts(x for p, n in patterns for x in p for _ in range(n))
    assert used == counts and all(sum(p) <= size for p, _ in patterns)
    assert sum(n for _, n in patterns) <= 1.05 * sum(k * v for k, v in counts.items()) / size + 2


def packed(df, size=1024):
    return [r.asDict() for r in packing.pack(df, size).collect()]


def whole_packing(rows, pieces, size, end=0):
    """Every id lies in one piece, every sequence is gapless and no longer than ``size``."""
    want = brute.counts((i, a, b, zlib.crc32(np.array(x, "<u4").tobytes())) for i, t, *_ in rows for x in [ids_of(t, end)] for a, b in [(0, len(x))])
    texts = {(i, t) for i, t, *_ in rows}
    ids = {(i, t): ids_of(t, end) for i, t in texts}
    by_doc = brute.by(pieces, lambda p: p["_id"])
    for i, mine in by_doc.items():
        cover = sorted((p["_total"], p["_start"], p["_length"], p["_crc"]) for p in mine)
        expect = sorted((len(x), a, min(size, len(x) - a), zlib.crc32(np.array(x[a : a + size], "<u4").tobytes())) for (j, t), x in ids.items() if j == i for _ in range(sum(1 for k, u, *_ in rows if (k, u) == (j, t))) for a in range(0, len(x), size))
        assert cover == expect
    assert set(by_doc) == {i for i, *_ in rows} and len(want) <= len(rows)
    for mine in brute.by(pieces, lambda p: p["_sequence"]).values():
        at = 0
        for p in sorted(mine, key=lambda p: p["_offset"]):
            assert p["_offset"] == at
            at += p["_length"]
        assert at <= size
    return len({p["_sequence"] for p in pieces})


def test_packing_odd_rows(make, odd):
    for size in (8, 1024):
        pieces = packed(make(odd, extra=True), size)
        n = whole_packing(odd, pieces, size)
        assert n <= 1.1 * sum(p["_length"] for p in pieces) / size + 1


def test_packing_query(spark, duck):
    _, rows = duck("SELECT doc_id, text FROM documents", "sf0.001")
    found = registry.QUERIES["op5_packing"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    names = dict(zip(found.columns, ["_id", "_start", "_length", "_crc", "_total", "_sequence", "_offset"]))
    whole_packing(rows, [{names[k]: v for k, v in r.asDict().items()} for r in found.collect()], 1024)


def test_packing_ranks_in_several_groups(make, monkeypatch):
    monkeypatch.setattr(shared, "LEAST_RANKED", 3)
    rows = [(i, "same length") for i in range(300)] + [(1000 + i, "x") for i in range(50)]
    whole_packing(rows, packed(make(rows), 64), 64)


def test_packing_empty_table(make):
    assert packed(make([])) == []


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 65_536, 65_537, 140_001])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2**32 if n % 2 else 50_257, n, dtype=np.uint64).astype(np.uint32)
    data = token_files.encode_file([1, None], [n, 0], ids, kind)
    index = token_files.read_index(data)
    back = np.concatenate([*token_files.decode_blocks(data, index), np.zeros(0, np.uint32)])
    assert back.tolist() == ids.tolist() and index["docs"] == [1, None] and index["tokens"] == [n, 0]
    if n > 1000 and n % 2 == 0:
        assert len(data) < 2 * n + 2000  # the upper planes of small ids take nothing


def test_not_a_plane_file():
    with pytest.raises(ValueError):
        token_files.read_index(b"something else")


def files_of(spark, df, **more):
    folder = shared.scratch_path(spark, "tokens")
    files = token_files.write_tokens(df, folder, **more)
    return [tuple(r) for r in token_files.read_tokens(spark, folder, files).collect()], files


def expected(rows, end=2):
    out, at = [], 0
    for i, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = ids_of(text, end)
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_token_files(spark, make, odd, kind):
    got, files = files_of(spark, make(odd, extra=True), kind=kind)
    assert sorted(got, key=lambda r: r[1]) == expected(odd)
    assert sum(n for _, _, n in files) == sum(r[2] for r in got)


def test_token_files_roll(spark, make, monkeypatch):
    monkeypatch.setattr(token_files, "ROLL", 50)
    monkeypatch.setattr(shared, "STEP_BYTES", 200)
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(60)]
    got, _ = files_of(spark, make(rows))
    assert sorted(got, key=lambda r: r[1]) == expected(rows)


def test_token_files_empty_table(spark, make):
    assert files_of(spark, make([])) == ([], [])


def test_token_files_query(spark, duck):
    _, rows = duck("SELECT doc_id, text FROM documents", "sf0.001")
    found = registry.QUERIES["op9_token_files"](spark, "/root/testdata/sf0.001")
    assert sorted((tuple(r) for r in found.collect()), key=lambda r: r[1]) == expected(rows)


def test_unigram_counts_share_prefixes():
    rng = random.Random(2)
    scores = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))): -rng.random() * 9 for _ in range(60)} | {bytes([c]): -8.0 for c in b"abc"}
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14))) for _ in range(400)})
    assert token_counts.trie_counts(words, token_counts.ends_of(scores)) == [brute.unigram_tokens(w, scores) for w in words]


def plain_counts(text, scores, known={}):  # noqa: B006
    """Words and tokens of a text, pre-token by pre-token."""
    cut = re.findall(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+$", (text or "").encode())
    assert b"".join(cut) == (text or "").encode()
    return len(brute.words(text)), sum(known.get(w) or known.setdefault(w, brute.unigram_tokens(w, scores)) for w in cut)


def test_token_counts(spark, make, odd, monkeypatch):
    scores = token_counts.pieces(token_counts.vocabulary_path())[0]
    monkeypatch.setattr(token_counts, "REMEMBERED", 20)
    rows = [*odd, (90, "two  spaces\n\nand an end \n", None), (91, "\u00a0é日本\u2028 x", None), (92, "ab" * 2000 + " " * 300 + "end", None)]
    want = sorted((i is None, i or 0, *plain_counts(t, scores)) for i, t, *_ in rows)
    found = token_counts.count_tokens(make(rows, extra=True)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["_n_words"], r["_n_tokens"]) for r in found) == want
    assert token_counts.count_tokens(make([])).count() == 0


def test_token_counts_query(spark, duck):
    scores = token_counts.pieces(token_counts.vocabulary_path())[0]
    _, rows = duck("SELECT doc_id, text FROM documents", "sf0.001")
    found = registry.QUERIES["op2_token_counts"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, found)) == sorted((i, *plain_counts(t, scores)) for i, t in rows)


def test_long_words_cost_in_proportion():
    ends = token_counts.pieces(token_counts.vocabulary_path())[1]
    assert token_counts.trie_counts([b"xy" * 200_000], ends)[0] > 1000
