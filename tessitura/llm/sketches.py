"""Threshold-scaled sketches: document fingerprints that keep every shingle hash below a fixed fraction."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.llm import shared

WIDTH = 5
SCALE = 8


def sketch_values(texts: list[bytes], width: int = WIDTH, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash), sorted and distinct: the shingle hashes below 2**64 / scale.

    Words are runs without ASCII white space, A-Z in lower case; a text with fewer than ``width`` words is one
    shingle. A text of few shingles may have none below the limit; its sketch is empty.
    """
    words = shared.Words([x.lower() for x in texts])
    sizes = np.diff(words.at)
    count = np.where(sizes > 0, np.maximum(sizes - width + 1, 1), 0)
    doc = np.repeat(np.arange(len(texts)), count)
    if not len(doc):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = shared.flat_spans(words.at[:-1], count)
    value = shared.span_hash(shared.rolling(words.hashes()[words.codes]), at, np.minimum(sizes, width)[doc])
    kept = value <= np.uint64(2**64 // scale - 1)
    if not kept.any():
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc, value = doc[kept], value[kept]
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])]
    return doc[new], value[new]


def spelled(doc: np.ndarray, value: np.ndarray, n: int) -> list[str]:
    """Each document's sketch as one string of 16 hexadecimal digits a hash, ascending."""
    text = value.astype(">u8").tobytes().hex()
    ends = np.searchsorted(doc, np.arange(n + 1)).tolist()
    return [text[16 * a : 16 * b] for a, b in zip(ends, ends[1:], strict=False)]


def parse(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def merge(a: str, b: str) -> str:
    """The sketch of two documents together: that of all their shingles."""
    return np.union1d(parse(a), parse(b)).astype(">u8").tobytes().hex()


def likeness(a, b, n: int) -> np.ndarray:
    """Of n pairs of sketches, each given as (place, hash): the part of the smaller one that is in the other.

    Two empty sketches are alike (1), an empty one and another are not (0).
    """
    place, value = np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1]))
    order = np.lexsort((value, place))
    place, value = place[order], value[order]
    both = np.bincount(place[1:][(place[1:] == place[:-1]) & (value[1:] == value[:-1])], minlength=n) if len(place) else np.zeros(n)
    x, y = np.bincount(a[0], minlength=n), np.bincount(b[0], minlength=n)
    least = np.minimum(x, y)
    return np.where(least > 0, both / np.maximum(least, 1), (x == y).astype(float))


def settled(a, b, texts_a: list[bytes], texts_b: list[bytes], width: int) -> np.ndarray:
    """:func:`likeness` of the sketches of texts; where one of a pair is empty, that of all shingles of both."""
    n = len(texts_a)
    out = likeness(a, b, n)
    empty = np.flatnonzero((np.bincount(a[0], minlength=n) == 0) | (np.bincount(b[0], minlength=n) == 0))
    if len(empty):
        out[empty] = likeness(*(sketch_values([t[i] for i in empty.tolist()], width, 1) for t in (texts_a, texts_b)), len(empty))
    return out


def edited(text: str, following: str) -> str:
    """The last half of a text's code points replaced by the first as many (or all) of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(width: int, scale: int):
    def rows(held):
        """held: (id, text) in order, the last one only as the next of the one before it."""
        ids, texts = [x[0] for x in held[:-1]], [x[1] for x in held]
        changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        n = len(ids)
        raw, plain = [x.encode() for x in changed], [x.encode() for x in texts]
        own, other = sketch_values(plain, width, scale), sketch_values(raw, width, scale)
        mine = own[0] < n
        here, after = (own[0][mine], own[1][mine]), (own[0][own[0] > 0] - 1, own[1][own[0] > 0])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([None if x == shared.NULL_ID else x for x in ids], pa.int64()), pa.array([len(x) for x in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in raw]),
                pa.array(spelled(*here, n)), pa.array(spelled(*other, n)), pa.array(settled(here, other, plain[:-1], raw, width)), pa.array(settled(here, after, plain[:-1], plain[1:], width)),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches):
        held, size, over = [], 0, False
        for batch in batches:
            for i, text, peek in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if over:  # further copies of the row after the last
                    continue
                held.append((i, text or ""))
                size += len(text or "")
                over = bool(peek)
                if size > shared.STEP_BYTES // 2 and len(held) > 1:
                    yield rows(held)
                    held = held[-1:]
                    size = len(held[0][1])
        if len(held) > 1:
            yield rows(held)

    return run


def compare_with_next(docs: DataFrame, width: int = WIDTH, scale: int = SCALE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint beside that of its edited text and the likeness to it and to the next document.

    Where one of two sketches is empty, a short text's, the likeness is that of all their shingles, which the task has.
    Null texts are empty. Ties of ids are ordered by text, a null id comes first. Texts travel once, to ranges of ids.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return shared.in_order(docs, shared.shuffle_partitions(docs.sparkSession), id_col, text_col, peek=True).mapInArrow(shared.lean(_compare(width, scale)), schema)


def fingerprint(docs: DataFrame, width: int = WIDTH, scale: int = SCALE, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``_fingerprint``; no row travels."""

    def run(batches):
        for batch in batches:
            texts = shared.as_bytes(batch.column(batch.num_columns - 1))
            out: list[str] = []
            for a, b in shared.steps(batch.column(batch.num_columns - 1)):
                out += spelled(*sketch_values(texts[a:b], width, scale), b - a)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.string())], names=names)

    keep = shared.others(docs.columns, ["_fingerprint"])
    schema = docs.select(*[f"`{c}`" for c in keep]).schema.add("_fingerprint", "string")
    names = schema.names
    return docs.select(*shared.carried(keep), F.col(text_col).cast("string").alias("_text")).mapInArrow(shared.lean(run), schema)


def op6_fingerprints(spark, sf_dir):
    return compare_with_next(shared.documents(spark, sf_dir))
