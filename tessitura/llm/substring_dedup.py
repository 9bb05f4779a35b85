"""Exact removal of repeated word windows by super-k-mer partitioning."""

from __future__ import annotations

import itertools
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.llm import shared

#: Words of the shingle whose hash deals the windows out.
MINIMISER = 3
#: Windows of one super-k-mer at most; a longer run is cut, which changes nothing but the packing.
LONGEST = 255
_SHIFT = 9  # a run of repeats travels as start << 9 | length
#: Minimisers are counted in so many bins; words of one bin and of one bucket that a task takes at least.
BINS, LEAST_WORDS = 65_536, 500_000


def _super_kmers(words: shared.Words, k: int, splits: np.ndarray | None = None):
    """(document, first word, windows, minimiser hash) of the runs of windows that share a minimiser, in reading order.

    Of a minimiser whose bin has ``splits`` above 1 there are as many keys: a second minimiser, the least by another order,
    picks one, so equal windows still have equal keys.
    """
    n = len(words.codes)
    empty = np.zeros(0, np.int64)
    if n < k:
        return empty, empty, empty, empty.astype(np.uint64)
    m = min(MINIMISER, k)
    h = words.hashes()[words.codes]
    mers = h[: n - m + 1].copy()
    for j in range(1, m):
        mers *= np.uint64(0xC2B2AE3D27D4EB4F)
        mers += h[j : n - m + 1 + j]
    least = shared.sliding_min(shared.mix(mers), k - m + 1)
    doc = np.repeat(np.arange(len(words.at) - 1), np.diff(words.at))
    windows = np.flatnonzero(doc[: n - k + 1] == doc[k - 1 :])
    if not len(windows):
        return empty, empty, empty, empty.astype(np.uint64)
    key = least[windows]
    if splits is not None:
        many = splits[(key >> np.uint64(48)).astype(np.int64)]
        if (many > 1).any():
            second = shared.mix(shared.sliding_min(shared.mix(mers ^ np.uint64(0x5851F42D4C957F2D)), k - m + 1)[windows])
            key = np.where(many > 1, shared.mix(key + second % many.astype(np.uint64)), key)
    fresh = np.ones(len(windows), bool)
    fresh[1:] = (windows[1:] != windows[:-1] + 1) | (key[1:] != key[:-1]) | (doc[windows[1:]] != doc[windows[:-1]])
    heads = np.flatnonzero(fresh)
    place = np.arange(len(windows)) - np.repeat(heads, np.diff(np.r_[heads, len(windows)]))
    heads = np.flatnonzero(place % LONGEST == 0)
    count = np.diff(np.r_[heads, len(windows)])
    first = windows[heads]
    return doc[first], first, count, key[heads]


def _weigh(k: int):
    """mapInArrow: texts to (bin, words): how many words the super-k-mers of each bin of minimisers have."""

    def run(batches):
        for batch in batches:
            total = np.zeros(BINS, np.int64)
            for start, stop in shared.steps(batch.column(0), 4_000_000):
                _, _, count, key = _super_kmers(shared.Words(shared.as_bytes(batch.column(0).slice(start, stop - start))), k)
                total += np.bincount((key >> np.uint64(48)).astype(np.int64), count + k - 1, BINS).astype(np.int64)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bin", "words"])

    return run


def _combined(codes, h, ids, at, doc, first, count, key, k):
    """Of super-k-mers with the same words the earliest, and the others, whose windows all start later; twins are in neither."""
    length = count + k - 1
    content = shared.span_hash(shared.rolling(h[codes]), first, length) ^ shared.mix(length.astype(np.uint64))
    where = first - at[doc]
    order = np.lexsort((where, ids[doc], content))
    same = np.r_[False, content[order][1:] == content[order][:-1]]
    lead = order[shared.leaders(same)]
    later = np.flatnonzero(same)
    a, b = lead[later], order[later]
    fits = length[a] == length[b]
    a, b = a[fits], b[fits]
    keep = np.ones(len(order), bool)
    if not len(a):
        return np.arange(len(order)), a
    equal = codes[shared.flat_spans(first[a], length[a])] == codes[shared.flat_spans(first[b], length[b])]
    whole = np.logical_and.reduceat(equal, np.cumsum(length[a]) - length[a])
    a, b = a[whole], b[whole]
    keep[b] = False
    return np.flatnonzero(keep), b[(ids[doc[a]] != ids[doc[b]]) | (where[a] != where[b])]


def _pack(k: int, buckets: int, splits):
    """mapInArrow: documents (id, text) to (bucket, block); a block holds super-k-mers of one bucket, compressed.

    Those with the words of an earlier one in the same step are repeats; they go along without their words.
    """

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=4)
        for batch in batches:
            all_ids = batch.column(0).to_numpy()
            for start, stop in shared.steps(batch.column(1), 4_000_000):
                ids = all_ids[start:stop]
                words = shared.Words(shared.as_bytes(batch.column(1).slice(start, stop - start)))
                doc, first, count, key = _super_kmers(words, k, splits.value)
                if not len(doc):
                    continue
                rows, again = _combined(words.codes, words.hashes(), ids, words.at, doc, first, count, key, k)
                where = (first - words.at[doc]).astype(np.int64)
                known = shared.mix(ids[doc[again]].view(np.uint64)) % np.uint64(buckets)  # any bucket does for what is settled
                order = np.argsort(known, kind="stable")
                again, known = again[order], known[order].astype(np.int64)
                bucket = (key[rows] % np.uint64(buckets)).astype(np.int64)
                rows = rows[np.argsort(bucket, kind="stable")]
                bucket.sort()
                length = count[rows] + k - 1
                text = words.spelled.take(pa.array(words.codes[shared.flat_spans(first[rows], length)]))
                ends = np.frombuffer(text.buffers()[1], np.int32)
                data = memoryview(text.buffers()[2])
                reach = np.r_[0, np.cumsum(length)]
                present = np.union1d(bucket, known)
                blocks = []
                for a, b, c, d in zip(*(np.searchsorted(x, present, side).tolist() for x in (bucket, known) for side in ("left", "right")), strict=True):
                    mine = np.r_[rows[a:b], again[c:d]]
                    head = struct.pack("<qq", b - a, d - c) + ids[doc[mine]].tobytes() + where[mine].tobytes() + count[mine].astype(np.int16).tobytes()
                    blocks.append(squeeze.compress(head + bytes(data[ends[reach[a]] : ends[reach[b]]])))
                yield pa.RecordBatch.from_arrays([pa.array(present.astype(np.int32)), pa.array(blocks, pa.binary())], ["_bucket", "_block"])

    return run


def _firsts(codes: np.ndarray, begin: np.ndarray, doc, start, count, k: int) -> np.ndarray:
    """For every window (row by row): does its word sequence start nowhere earlier? Rows are sorted by (doc, start).

    Windows are sorted by a hash of their words, stably, so the first of a run is the earliest; each later one is then
    compared word by word with it. Windows whose hash is shared by other words are settled one by one.
    """
    at = shared.flat_spans(begin, count)
    hashed = shared.span_hash(shared.rolling(shared.mix(codes.astype(np.uint64))), at, k)
    order = np.argsort(hashed, kind="stable")
    same = np.r_[False, hashed[order][1:] == hashed[order][:-1]] if len(order) else np.zeros(0, bool)
    first = np.ones(len(at), bool)
    later = np.flatnonzero(same)
    a, b = order[shared.leaders(same)[later]], order[later]
    equal = np.ones(len(later), bool)
    for j in range(k):
        equal &= codes[at[a] + j] == codes[at[b] + j]
    row = np.repeat(np.arange(len(count)), count)
    where = start[row] + at - begin[row]
    twin = (doc[row[a]] == doc[row[b]]) & (where[a] == where[b])  # a repeated row of the same document
    first[b[equal & ~twin]] = False
    if not equal.all():
        for value in np.unique(hashed[b[~equal]]):
            seen: dict = {}
            for w in np.flatnonzero(hashed == value).tolist():
                mine = (int(doc[row[w]]), int(where[w]))
                first[w] = seen.setdefault(codes[at[w] : at[w] + k].tobytes(), mine) == mine
    return first


def _solve(k: int):
    """mapInArrow over the blocks of one task: the runs of windows (document, start << 9 | length) that start earlier, too."""

    def run(batches):
        blocks = [x for batch in batches for x in batch.column(1).to_pylist()]
        if not blocks:
            return
        ids, starts, counts, texts = [], [], [], []
        settled = [[], [], []]
        expand = zstandard.ZstdDecompressor()
        while blocks:
            raw = expand.decompress(blocks.pop())
            n, again = struct.unpack_from("<qq", raw)
            m = n + again
            columns = np.frombuffer(raw, np.int64, m, 16), np.frombuffer(raw, np.int64, m, 16 + 8 * m), np.frombuffer(raw, np.int16, m, 16 + 16 * m).astype(np.int64)
            for every, known, column in zip((ids, starts, counts), settled, columns, strict=True):
                every.append(column[:n])
                known.append(column[n:])
            texts.append(raw[16 + 18 * m :])
        doc, start, count = map(np.concatenate, (ids, starts, counts))
        owner, at, length = map(np.concatenate, settled)
        yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array((at << _SHIFT) | length)], ["_owner", "_run"])
        words = shared.Words(texts)
        texts.clear()
        begin = np.cumsum(count + k - 1) - (count + k - 1)
        order = np.lexsort((start, doc))
        doc, start, count, begin = doc[order], start[order], count[order], begin[order]
        later = ~_firsts(words.codes, begin, doc, start, count, k)
        row = np.repeat(np.arange(len(count)), count)
        heads = np.flatnonzero(later & np.r_[True, ~later[:-1] | (row[1:] != row[:-1])]) if len(row) else row
        tails = np.flatnonzero(later & np.r_[~later[1:] | (row[1:] != row[:-1]), True]) if len(row) else row
        place = start[row[heads]] + heads - (np.cumsum(count) - count)[row[heads]]
        yield pa.RecordBatch.from_arrays([pa.array(doc[row[heads]]), pa.array((place << _SHIFT) | (tails - heads + 1))], ["_owner", "_run"])

    return run


def _covered(n: int, runs, k: int) -> np.ndarray:
    """Which of n words lie in a window of the ``runs``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs >> _SHIFT, 1)
    np.add.at(edge, (runs >> _SHIFT) + (runs & ((1 << _SHIFT) - 1)) + k - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def _apply(k: int, as_is: bool, names: list[str]):
    def run(batches):
        for batch in batches:
            kept, sizes, gone = [], [], []
            runs = batch.column(batch.num_columns - 1)
            flat, ends = runs.flatten().to_numpy(), runs.offsets.to_numpy() - runs.offsets[0].as_py()
            for i, text in enumerate(shared.as_bytes(batch.column(batch.num_columns - 2))):
                words = text.split()  # of bytes: ASCII white space only
                n = len(words)
                sizes.append(n)
                removed = 0
                if ends[i + 1] > ends[i]:
                    mine = flat[ends[i] : ends[i + 1]]
                    covered = _covered(n, mine[(mine >> _SHIFT) + (mine & ((1 << _SHIFT) - 1)) <= n - k + 1], k)
                    removed = int(covered.sum())
                    words = list(itertools.compress(words, ~covered))
                gone.append(removed)
                kept.append((text if as_is and not removed else b" ".join(words)).decode())
            extra = [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *extra], names=names)

    return run


def remove_repeats(docs: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, as_is: bool = False) -> DataFrame:
    """Remove every word that lies in a window of ``k`` words which also starts earlier in the corpus.

    Earlier means a smaller id or, in one document, an earlier word. Windows are judged on the input. Returns the
    columns ``keep`` (all but the text by default) with ``_n_words``, ``_n_removed`` and ``_kept``, the words that stay,
    joined by one space; with ``as_is`` a text that loses nothing stays as it is. Words are the runs without ASCII white
    space, unchanged.

    Consecutive windows with the same minimiser travel as one string to the minimiser's bucket; equal strings are
    combined before they do, so a passage that everybody shares costs each task one row. The bucket sorts its windows
    and returns the runs that also start earlier. A first pass counts the words of each bin of minimisers (numbers only,
    65,536 at most): from them comes the number of buckets, and a bin with more than a bucket's share is split by a second
    minimiser, so a task's input is bounded whatever phrase stands in all documents.

    A null or empty text has no words; texts under ``k`` words stay whole. Documents without an id sort first, by a hash
    of their text. Repeated rows of a document (same id, same text) don't remove each other and get the same result; of
    rows with one id and different texts each loses what is repeated at that place in any of them. An empty table stays
    empty.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string").alias("_text")
    weights = np.zeros(BINS, np.int64)
    for r in docs.select(text).mapInArrow(shared.lean(_weigh(k)), "bin long, words long").groupBy("bin").agg(F.sum("words").alias("words")).collect():
        weights[r["bin"]] = r["words"]
    parts = int(max(3 * shared.shuffle_partitions(spark), weights.sum() // (20 * LEAST_WORDS)))
    splits = -(-weights // max(LEAST_WORDS, int(weights.sum()) // parts))
    splits = spark.sparkContext.broadcast(splits if (splits > 1).any() else None)
    source = docs.select(shared.told_apart(id_col, text_col).alias("_id"), text)
    blocks = source.mapInArrow(shared.lean(_pack(k, parts, splits)), "_bucket int, _block binary")
    runs = blocks.repartitionById(parts, F.col("_bucket")).mapInArrow(shared.lean(_solve(k)), "_owner long, _run long")
    runs = runs.groupBy("_owner").agg(F.collect_list("_run").alias("_runs"))
    keep = shared.others([c for c in docs.columns if c != text_col] if keep is None else keep, ["_n_words", "_n_removed", "_kept"])
    rows = docs.select(shared.told_apart(id_col, text_col).alias("_id"), *shared.carried(keep), text)
    both = rows.join(runs, F.col("_id") == F.col("_owner"), "left").drop("_id", "_owner").withColumn("_runs", F.coalesce("_runs", F.array().cast("array<bigint>")))
    schema = docs.select(*[f"`{c}`" for c in keep]).schema.add("_n_words", "long").add("_n_removed", "long").add("_kept", "string")
    return both.mapInArrow(shared.lean(_apply(k, as_is, schema.names)), schema)


def op1_substring_dedup(spark, sf_dir):
    found = remove_repeats(shared.documents(spark, sf_dir), keep=["doc_id"])
    return found.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.sha2("_kept", 256).alias("kept_sha256"))
