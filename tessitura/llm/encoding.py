"""Whole texts to token ids, with the work on repeated words done once.

A text is cut before each ASCII white-space character that follows a character which surely is none. The pre-tokeniser
of a byte-level BPE ends a token there too, whatever stands around, so encoding the pieces and joining their ids is
the encoding of the text; ``tests/llm`` compares both. Distinct pieces go to the tokenizers library once per batch at
most, and a bounded table in each worker keeps those seen lately.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from tessitura.llm import shared

#: Entries in each of the two generations of the table of pieces.
REMEMBERED = 300_000
#: Pieces that the library gets as one text.
CHAIN = 64
_WHITE = frozenset(b" \t\n\v\f\r")
_LOADED: dict = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    """One tokenizer per worker process."""
    if path not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _LOADED[path] = Pieces(Tokenizer.from_file(path))
    return _LOADED[path]


def _pieces(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts as one binary array, and n_texts + 1 offsets into it."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes, out=begin[1:])
    if not len(data):
        return pa.array([], pa.binary()), np.zeros(len(texts) + 1, np.int64)
    space = shared._SPACE[data]
    solid = (data > 32) & (data < 127)  # printable ASCII
    latin = np.zeros(len(data), bool)  # U+00C0 .. U+00FF, letters and two signs, by their second byte
    latin[1:] = (data[1:] >= 0x80) & (data[:-1] == 0xC3)
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = space[1:] & (solid | latin)[:-1]
    cut[begin] = True
    edges = np.flatnonzero(cut).astype(np.int32)
    array = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
    return array, np.searchsorted(edges, begin)


class Pieces:
    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)  # a byte-level token has a character for each byte
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def lookup(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as the bytes of 32-bit numbers."""
        new, old = self.new, self.old
        out = [new.get(p) for p in pieces]
        missing = []
        for i in [i for i, x in enumerate(out) if x is None]:
            if (x := old.get(pieces[i])) is None:
                missing.append(i)
            else:  # used again, so it stays
                out[i] = new[pieces[i]] = x
        for at in range(0, len(missing), 20_000):
            some = missing[at : at + 20_000]
            for i, x in zip(some, self._fresh([pieces[i] for i in some]), strict=True):
                out[i] = x
        if len(new) + len(missing) > REMEMBERED:
            self.old, self.new = new, {}
        if len(missing) <= REMEMBERED:
            self.new.update((pieces[i], out[i]) for i in missing)
        return out

    def _fresh(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of pieces not seen lately. Those that may stand next to each other in a text go to the library as one."""
        out: list[bytes | None] = [None] * len(pieces)
        chain = [i for i, p in enumerate(pieces) if p[0] in _WHITE and (32 < p[-1] < 127 or (len(p) > 1 and p[-2] == 0xC3))]
        texts = [b"".join([pieces[i] for i in chain[a : a + CHAIN]]).decode() for a in range(0, len(chain), CHAIN)]
        if texts:
            found = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids = np.concatenate(found)
            reach = np.r_[0, np.cumsum(self.sizes[ids])]  # bytes up to each id
            edges = np.r_[0, np.cumsum(np.fromiter((len(pieces[i]) for i in chain), np.int64, len(chain)))]
            cut = np.searchsorted(reach, edges)
            if cut[-1] < len(reach) and np.array_equal(reach[cut], edges):  # else the vocabulary isn't one of bytes
                raw = ids.tobytes()
                for i, a, b in zip(chain, (4 * cut[:-1]).tolist(), (4 * cut[1:]).tolist(), strict=True):
                    out[i] = raw[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self.tokenizer.encode_batch_fast([pieces[i].decode() for i in rest], add_special_tokens=False) if rest else [], strict=True):
            out[i] = np.array(x.ids, np.uint32).tobytes()
        return out

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by ``end_id``, and n_texts + 1 offsets."""
        pieces, at = _pieces(texts)
        found = pieces.dictionary_encode()
        codes = found.indices.to_numpy(zero_copy_only=False)
        spelled = self.lookup(found.dictionary.to_pylist())
        length = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
        ids = np.frombuffer(b"".join(spelled), np.uint32)
        first = np.cumsum(length) - length
        count = length[codes]
        reach = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(count, out=reach[1:])
        ends = reach[at[1:]] + np.arange(1, len(texts) + 1)  # with one end id for each text so far
        offsets = np.zeros(len(texts) + 1, np.int64)
        offsets[1:] = ends
        out = np.empty(int(offsets[-1]), np.uint32)
        inside = np.ones(len(out), bool)
        inside[offsets[1:] - 1] = False
        out[~inside] = end_id
        out[inside] = ids[shared.flat_spans(first[codes], count)]
        return out, offsets
