"""Edit distances and alignments of many pairs of sequences at once, in numpy.

A side of the pairs is two arrays: the symbols (integers) of all sequences, one after the other, and how many each has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

Side = tuple[np.ndarray, np.ndarray]

#: Numbers in an array of one step, so that a few of them stay in a core's cache.
_STEP = 1 << 15
#: Words of 64 bits in the table of a group's symbols; of a step's, 256 times less.
_TABLE = 1 << 21
#: So many symbols are numbered for all pairs, more for each.
_COMMON = 128


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int]:
    """Hits, substitutions, deletions, insertions of one best alignment; ties prefer the diagonal, then deletion.

    A row of distances at a time; hits and substitutions on the best way to a place travel with it, so memory is in
    proportion to the longer text and not to the product of both.
    """
    at = np.arange(len(b) + 1)
    last, hits, replaced = at.copy(), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for word in a:
        differs = b != word
        diagonal, down = last[:-1] + differs, last + 1
        best = down.copy()
        np.minimum(best[1:], diagonal, out=best[1:])
        row = np.minimum.accumulate(best - at) + at  # from the left: one more for each place
        across = np.r_[False, row[1:] == diagonal]
        origin = np.maximum.accumulate(np.where(across | (row == down), at, 0))  # where the insertions before a place begin
        hits = np.where(across, np.r_[0, hits[:-1] + ~differs], hits)[origin]
        replaced = np.where(across, np.r_[0, replaced[:-1] + differs], replaced)[origin]
        last = row
    both = int(hits[-1] + replaced[-1])
    return int(hits[-1]), int(replaced[-1]), len(a) - both, len(b) - both


def alignments(a: Side, b: Side) -> np.ndarray:
    """What :func:`align` gives, a row for each pair; pairs of like lengths share the steps."""
    (x, m), (y, n) = a, b
    first_x, first_y = np.cumsum(m) - m, np.cumsum(n) - n
    found = np.zeros((len(m), 4), np.int64)
    for rows in _alike(n, n + 1, _STEP):
        rows = rows[np.argsort(-m[rows], kind="stable")]  # those that are done are last
        if 3 * _bits(m[rows], n[rows]) + 2 > 64:
            for r in rows:
                found[r] = align(x[first_x[r] : first_x[r] + m[r]], y[first_y[r] : first_y[r] + n[r]])
        else:
            found[rows] = _aligned(padded(x, first_x[rows], m[rows], -1), padded(y, first_y[rows], n[rows], -2), m[rows], n[rows])
    return found


def _bits(m: np.ndarray, n: np.ndarray) -> int:
    return int(max(m[0], n.max()) + 1).bit_length()


def _aligned(x: np.ndarray, y: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A place has one number: its distance less its column, then a field for ties, then the hits on the way to it.

    The least number is so the best way: insertions come from the least distance less column before a place, of those from
    the last column, there rather by the diagonal than from above. The field is for the choice alone and cleared after it.
    Substitutions follow from lengths, distance and hits.
    """
    bits, width = _bits(m, n), y.shape[1]
    kind = np.int32 if 3 * bits + 2 <= 32 else np.int64
    unit = 1 << (2 * bits + 1)
    clear = kind(~((1 << 2 * bits + 1) - (1 << bits)))
    ties = (2 * np.arange(width, -1, -1, dtype=kind)) << kind(bits)
    across, down = ties[1:], ties + kind(unit + (1 << bits))
    place = np.zeros((len(m), width + 1), kind)
    best, via = np.empty_like(place), np.empty((len(m), width), kind)
    active = np.searchsorted(-m, -np.arange(x.shape[1]))  # those with more words than so many
    for i, k in enumerate(active):
        p, q, v = place[:k], best[:k], via[:k]
        np.equal(y[:k], x[:k, i, None], out=v)
        v *= kind(1 - unit)
        v += p[:, :-1]
        v += across
        np.add(p, down, out=q)
        np.minimum(q[:, 1:], v, out=q[:, 1:])
        np.minimum.accumulate(q, axis=1, out=p)
        p &= clear
    last = place[np.arange(len(m)), n].astype(np.int64)
    hits = last & ((1 << bits) - 1)
    replaced = m - 2 * hits - (last >> (2 * bits + 1))
    return np.column_stack([hits, replaced, m - hits - replaced, n - hits - replaced])


def distances(a: Side, b: Side) -> np.ndarray:
    """Edits between the sequences of each pair.

    Bits stand for the differences of neighbours in a column of distances, 64 in a word (Myers, in blocks by Hyyrö). The
    longer sequence stands in words, the other one is read symbol by symbol. A word reads its symbol a step after the one
    before it, whose carry it needs, so one step serves all words of all pairs of like lengths.
    """
    (x, m), (y, n) = a, b
    symbols = np.concatenate([x, y]).astype(np.int64)
    symbols -= symbols.min(initial=0)
    seen = np.zeros(symbols.max(initial=0) + 1, bool)
    seen[symbols] = True
    symbols, known = (np.cumsum(seen) - 1)[symbols], int(seen.sum())
    first_x, first_y, swap = np.cumsum(m) - m, np.cumsum(n) - n + len(x), m < n
    first, other = np.where(swap, first_y, first_x), np.where(swap, first_x, first_y)
    m, n = np.maximum(m, n), np.minimum(m, n)
    found = m.copy()
    some = np.flatnonzero(n)
    words = -(-m[some] // 64)
    for k in _alike(words * (n.max(initial=0) + 1) + n[some], words * np.maximum(256, np.minimum(known, 64 * words) + 1), _TABLE):
        rows = some[k]
        rows = rows[np.argsort(-n[rows], kind="stable")]  # those that are done are last
        found[rows] = _distances(padded(symbols, first[rows], m[rows], -1), padded(symbols, other[rows], n[rows], -1), m[rows], n[rows], known)
    return found


def _distances(x: np.ndarray, y: np.ndarray, m: np.ndarray, n: np.ndarray, known: int) -> np.ndarray:
    count, words, longest = len(m), -(-x.shape[1] // 64), y.shape[1]
    x = np.pad(x, ((0, 0), (0, 64 * words - x.shape[1])), constant_values=-1)
    if known > _COMMON:
        x, y, known = _own(x, y)
    at, one, top = np.arange(words), np.uint64(1), np.uint64(63)
    steps = longest + words - 1
    late = np.full((count, longest + 2 * (words - 1)), known)  # the text backwards, so that a word's symbol is left of the next one's
    late[:, words - 1 : words - 1 + longest] = np.where(y < 0, known, y)[:, ::-1]
    alone = (known + 1) * words > 8 * _TABLE and count == 1  # a table would outgrow the texts
    layout = "F" if words < count else "C"  # numpy is fast along the longer side
    lies = np.transpose if words < count else np.asarray
    if not alone:
        table = np.zeros((count, known + 1, words), np.uint64)
        for bit in range(64):
            r, w = np.nonzero(x[:, bit::64] >= 0)
            table[r, x[r, 64 * w + bit], w] |= one << np.uint64(bit)
        table, late = table.ravel(), np.array(late * words, order=layout)
        base = np.array(np.arange(count)[:, None] * ((known + 1) * words) + at, order=layout)
    up, down, equal, over, right, left, more, less = (np.zeros((count, words), np.uint64, layout) for _ in range(8))  # more, less: carries into a word
    up[:], more[:, 0] = ~np.uint64(0), 1
    where, finals = np.empty((count, words), np.int64, layout), np.zeros((2, count * words), np.uint64)
    ends = (n[:, None] - 1 + at).ravel(layout)
    order = np.argsort(ends, kind="stable")
    bounds = np.searchsorted(ends[order], np.arange(steps + 1))
    active = np.searchsorted(-(n + words - 1), -np.arange(steps))
    for t, k in enumerate(active):
        lo, hi = max(0, t - longest + 1), min(words, t + 1)  # words that have begun and aren't done
        p, q, e, o, r, f, i, j = (z[:k, lo:hi] for z in (up, down, equal, over, right, left, more, less))
        now = late[:k, steps - 1 - t + lo : steps - 1 - t + hi]
        if alone:
            e[0] = np.packbits(x.reshape(words, 64)[lo:hi] == now[0, :, None], axis=1, bitorder="little").view("<u8")[:, 0]
        else:
            np.take(table, lies(np.add(base[:k, lo:hi], now, out=where[:k, lo:hi])), out=lies(e), mode="clip")
        np.bitwise_or(e, q, out=o)
        e |= j
        np.bitwise_and(e, p, out=r)
        r += p
        r ^= p
        r |= e
        np.bitwise_and(p, r, out=f)
        r |= p
        np.invert(r, out=r)
        r |= q
        np.left_shift(r, one, out=e)
        e |= i
        after = more[:k, lo + 1 : hi + 1]
        np.right_shift(r[:, : after.shape[1]], top, out=after)
        np.left_shift(f, one, out=p)
        p |= j
        after = less[:k, lo + 1 : hi + 1]
        np.right_shift(f[:, : after.shape[1]], top, out=after)
        np.bitwise_and(e, o, out=q)
        o |= e
        np.invert(o, out=o)
        p |= o
        if bounds[t] < bounds[t + 1]:
            done = order[bounds[t] : bounds[t + 1]]
            finals[0, done], finals[1, done] = up.ravel(layout)[done], down.ravel(layout)[done]
    bits = np.clip(m[:, None] - 64 * at, 0, 64).astype(np.uint64)
    inside = np.where(bits > top, ~np.uint64(0), (one << np.minimum(bits, top)) - one)
    ones = [np.unpackbits(np.ascontiguousarray(z.reshape(count, words, order=layout) & inside).view(np.uint8), axis=1).sum(axis=1, dtype=np.int64) for z in finals]
    return n + ones[0] - ones[1]


def _own(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each row's symbols numbered anew, those of ``x`` alone; and how many numbers there are."""
    row, most = np.arange(len(x))[:, None], max(x.max(), y.max()) + 1
    known = np.unique((row * most + x)[x >= 0])
    first = np.searchsorted(known, row * most)

    def number(z):
        key = row * most + z
        place = np.minimum(np.searchsorted(known, key), len(known) - 1)
        return np.where((z >= 0) & (known[place] == key), place - first, -1)

    return number(x), number(y), int(np.diff(first[:, 0], append=len(known)).max())


def _alike(keys: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Rows in the order of ``keys`` in groups that have, padded to the largest, ``most`` numbers or are one row."""
    order = np.argsort(keys, kind="stable")
    start = 0
    while start < len(order):
        largest = np.maximum.accumulate(sizes[order[start : start + most]])
        fits = np.searchsorted(largest * np.arange(1, len(largest) + 1), most, side="right")
        yield order[start : (start := start + max(1, int(fits)))]


def padded(symbols: np.ndarray, first: np.ndarray, sizes: np.ndarray, fill: int) -> np.ndarray:
    """A row for each sequence."""
    at = np.arange(sizes.max(initial=0))
    out = np.full((len(sizes), len(at)), fill, symbols.dtype)
    inside = at < sizes[:, None]
    out[inside] = symbols[(first[:, None] + at)[inside]]
    return out
