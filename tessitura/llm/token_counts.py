"""Token counts under a unigram model, with the dynamic programming shared along a trie."""

from __future__ import annotations

import base64
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.llm import shared

#: Counts of pre-tokens in each of the two generations that a worker keeps.
REMEMBERED = 500_000
_PIECES: dict = {}
_SEEN: dict[str, list[dict[bytes, int]]] = {}


def pieces(path: str) -> tuple[dict[bytes, float], dict[bytes, float | None]]:
    """Piece to log probability, and the same for all ends of pieces, None where an end is no piece itself.

    Nothing is trained: rank r of the vocabulary has the weight 1 / (r + 2).
    """
    if path not in _PIECES:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        total = math.log(sum(1 / (r + 2) for r in ranks.values()))
        scores = {p: -math.log(r + 2) - total for p, r in ranks.items()}
        _PIECES[path] = (scores, ends_of(scores))
    return _PIECES[path]


def ends_of(scores: dict[bytes, float]) -> dict[bytes, float | None]:
    return {p[i:]: scores.get(p[i:]) for p in scores for i in range(len(p))}


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def trie_counts(words: list[bytes], ends: dict[bytes, float | None]) -> list[int]:
    """Tokens in the most probable segmentation of each word; ``words`` are sorted and distinct.

    Sorted words are a trie walked in depth: what stands on the path is kept in ``best`` and ``tokens`` by depth, so the
    forward scores of a prefix are computed once for all words that share it. best[d] is the score of the best
    segmentation of the first d bytes; ties go to the fewer tokens, then to the longer last piece. Last pieces are tried
    from short to long and only as far as some piece ends like that, so a long word costs in proportion to its length.
    """
    best, tokens, out, before = [0.0], [0], [], b""
    nothing = object()
    get = ends.get
    for word in words:
        depth, most = 0, min(len(word), len(before))
        while depth < most and word[depth] == before[depth]:
            depth += 1
        del best[depth + 1 :], tokens[depth + 1 :]
        for d in range(depth + 1, len(word) + 1):
            top, fewest = -math.inf, 0
            for start in range(d - 1, -1, -1):
                s = get(word[start:d], nothing)
                if s is nothing:
                    break
                if s is not None:
                    value = best[start] + s
                    if value > top or (value == top and tokens[start] + 1 <= fewest):
                        top, fewest = value, tokens[start] + 1
            best.append(top)
            tokens.append(fewest)
        out.append(tokens[len(word)])
        before = word
    return out


def remembered(path: str, words: list[bytes]) -> list[int]:
    """The counts of distinct pre-tokens; those that this worker has seen lately aren't counted anew."""
    new, old = _SEEN.setdefault(path, [{}, {}])
    out = [new.get(w) for w in words]
    missing = []
    for i in [i for i, n in enumerate(out) if n is None]:
        if (n := old.get(words[i])) is None:
            missing.append(i)
        else:
            out[i] = new[words[i]] = n
    missing.sort(key=words.__getitem__)
    for i, n in zip(missing, trie_counts([words[i] for i in missing], pieces(path)[1]), strict=True):
        out[i] = n
        if len(words[i]) < 200:
            new[words[i]] = n
    if len(new) > REMEMBERED:
        _SEEN[path] = [{}, new]
    return out


def pre_tokens(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Texts cut after each word: white space belongs to the word after it, or stands alone at the end. With offsets."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))]
    cut = np.zeros(len(data) + 1, bool)
    cut[begin] = True
    if len(data):
        space = shared._SPACE[data]
        cut[1:-1] |= space[1:] & ~space[:-1]
    edges = np.flatnonzero(cut).astype(np.int32)
    if not len(data):
        edges = edges[:1]
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)]), np.searchsorted(edges, begin)


def _counted(path: str, names: list[str]):
    def run(batches):
        for batch in batches:
            texts, words, tokens = batch.column(batch.num_columns - 1), [], []
            for a, b in shared.steps(texts):
                raw = shared.as_bytes(texts.slice(a, b - a))
                cut, at = pre_tokens(raw)
                found = cut.dictionary_encode()
                spelled = found.dictionary.to_pylist()
                count = np.array(remembered(path, spelled), np.int64)
                solid = np.array([bool(w.strip()) for w in spelled], np.int64)  # of bytes: ASCII white space only
                codes = found.indices.to_numpy(zero_copy_only=False)
                for column, each in ((words, solid), (tokens, count)):
                    reach = np.r_[0, np.cumsum(each[codes])]
                    column.append(reach[at[1:]] - reach[at[:-1]])
            none = [np.zeros(0, np.int64)]
            more = [pa.array(np.concatenate(x or none).astype(np.int64)) for x in (words, tokens)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *more], names=names)

    return run


def count_tokens(docs: DataFrame, vocabulary: str | None = None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with ``_n_words`` and ``_n_tokens``; no row travels.

    Pre-tokens are the words ``[^\\x20\\x09-\\x0D]+`` with the white space before them, and white space that ends a
    text, so every byte of the whole text counts. The distinct ones of a step that its worker hasn't counted lately go into
    one trie. Null and empty texts have no tokens; a text of any length costs in proportion to it. Repeated rows have the
    same counts; a column of the input with the name of a result gives way to it.
    """
    keep = shared.others(docs.columns if keep is None else keep, ["_n_words", "_n_tokens"])
    schema = docs.select(*[f"`{c}`" for c in keep]).schema.add("_n_words", "long").add("_n_tokens", "long")
    return docs.select(*shared.carried(keep), F.col(text_col).cast("string").alias("_input")).mapInArrow(shared.lean(_counted(vocabulary or vocabulary_path(), schema.names)), schema)


def op2_token_counts(spark, sf_dir):
    found = count_tokens(shared.documents(spark, sf_dir), keep=["doc_id"])
    return found.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_tokens").alias("n_tokens"))
