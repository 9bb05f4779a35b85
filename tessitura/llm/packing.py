"""Packing documents into sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessitura.llm import encoding, shared


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in order of placement, how often) for ``counts[length]`` pieces of each length.

    Lengths are placed longest first. Each goes to the pattern that is filled least so far; if the piece fits there,
    as many copies of the pattern as there are pieces take one each and become a new pattern, which is counted with
    its like. What fits nowhere opens packs of its own. Work and memory follow ``size``, not the number of pieces.
    """
    open_: dict[int, dict[tuple[int, ...], int]] = {}
    filled: list[int] = []

    def put(pattern: tuple[int, ...], times: int) -> None:
        total = sum(pattern)
        if total not in open_:
            open_[total] = {}
            heapq.heappush(filled, total)
        open_[total][pattern] = open_[total].get(pattern, 0) + times

    for length in sorted(counts, reverse=True):
        left = counts[length]
        if not 0 < length <= size:
            raise ValueError(f"length {length} is not in 1..{size}")
        while left:
            while filled and not open_.get(filled[0]):
                open_.pop(heapq.heappop(filled), None)
            if not filled or filled[0] + length > size:
                # as one by one: a pack is opened, and pieces of this length go there while they fit
                each = size // length
                if left // each:
                    put((length,) * each, left // each)
                if left % each:
                    put((length,) * (left % each), 1)
                break
            patterns = open_[filled[0]]
            pattern, times = patterns.popitem()
            used = min(times, left)
            if times > used:
                patterns[pattern] = times - used
            put((*pattern, length), used)
            left -= used
    return [(p, n) for packs in open_.values() for p, n in packs.items()]


def _pieces(path: str, end_id: int, size: int):
    """mapInArrow: (id, text) to pieces: _id, _start, _length, _crc, _total, and _deal, a number that spreads them, equal rows too."""

    def run(batches):
        coder, made = encoding.load(path), 0

        def deal(n: int) -> np.ndarray:
            nonlocal made
            made += n
            return (shared.mix(np.arange(made - n, made, dtype=np.uint64) + np.uint64(TaskContext.get().partitionId() << 40)) >> np.uint64(1)).astype(np.int64)

        for batch in batches:
            every = batch.column(0)
            for start, stop in shared.steps(batch.column(1)):
                ids, at = coder.encode(shared.as_bytes(batch.column(1).slice(start, stop - start)), end_id)
                data = memoryview(ids.view(np.uint8))
                total = np.diff(at)
                pieces = -(-total // size)
                doc = np.repeat(np.arange(len(total)), pieces)
                first = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * size
                length = np.minimum(size, total[doc] - first)
                begin = at[doc] + first
                crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [every.slice(start, stop - start).take(pa.array(doc)), pa.array(first), pa.array(length), pa.array(crc, pa.int64()), pa.array(total[doc]), pa.array(deal(len(doc)))],
                    ["_id", "_start", "_length", "_crc", "_total", "_deal"],
                )

    return run


def pack(docs: DataFrame, size: int = 1024, end_id: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place: ``_id, _start, _length, _crc, _total, _sequence, _offset``.

    A document is its ids and ``end_id``; one longer than ``size`` is cut into whole sequences and a rest, and the
    rests are packed by the histogram of their lengths (``size`` numbers at most, the only thing the driver sees).
    Patterns come back to pieces by rank: the pieces of a length are numbered, in several groups if there are many, so that a
    common length is no single task's, and a pattern takes the next numbers. Groups go by a number that each piece got
    when it was written, so equal rows spread, too. Null and empty texts are one end id; a
    null id stays null; repeated rows are packed as often as they stand here.
    """
    path = tokenizer or encoding.tokenizer_path()
    schema = "_id long, _start long, _length long, _crc long, _total long"
    pieces = shared.cut(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(shared.lean(_pieces(path, end_id, size)), schema + ", _deal long"), "pieces")
    counts = {r["_length"]: r["n"] for r in pieces.groupBy("_length").agg(F.count("*").alias("n")).collect()}
    # (length, from rank, to rank, sequence of the first, offset): one row for each slot of each pattern
    used, sequence, slots = dict.fromkeys(counts, 0), 0, []
    for pattern, times in sorted(pack_histogram(counts, size)):
        offset = 0
        for length in pattern:
            slots.append((length, used[length], used[length] + times, sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    slots.sort()
    # lengths with more than a tenth of a task's rows are ranked in several groups; there are at most 10 x tasks of them
    limit = max(shared.LEAST_RANKED, sum(counts.values()) // (10 * shared.shuffle_partitions(docs.sparkSession)))
    groups = [-(-counts.get(length, 0) // limit) or 1 for length in range(1, size + 1)]
    salt = F.pmod("_deal", F.element_at(F.array(*map(F.lit, groups)), F.col("_length").cast("int"))).cast("int")
    salted = pieces.withColumn("_salt", salt)
    before: dict[tuple[int, int], int] = {}
    if max(groups) > 1:
        seen: dict[int, int] = {}
        for r in sorted(salted.groupBy("_length", "_salt").agg(F.count("*").alias("n")).collect()):
            before[r["_length"], r["_salt"]] = seen.get(r["_length"], 0)
            seen[r["_length"]] = seen.get(r["_length"], 0) + r["n"]
    key = np.array([(x[0], x[1]) for x in slots], np.int64).reshape(-1, 2)
    low = key[:, 0] << 44 | key[:, 1]
    to_sequence, to_offset, from_rank = (np.array([x[i] for x in slots], np.int64) for i in (3, 4, 1))
    sent = docs.sparkSession.sparkContext.broadcast((before, low, to_sequence, to_offset, from_rank))  # a row a slot and group: at most some 10 x tasks and size x size / 2

    def place(batches):
        before, low, to_sequence, to_offset, from_rank = sent.value
        for batch in batches:
            length, rank, salt = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("_length", "_rank", "_salt"))
            if before:
                rank = rank + np.fromiter((before[k] for k in zip(length.tolist(), salt.tolist(), strict=True)), np.int64, len(rank))
            slot = np.searchsorted(low, length << 44 | rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(to_sequence[slot] + rank - from_rank[slot]), pa.array(to_offset[slot])],
                names=["_id", "_start", "_length", "_crc", "_total", "_sequence", "_offset"],
            )

    order = Window.partitionBy("_length", "_salt").orderBy("_id", "_start", "_crc")
    ranked = salted.withColumn("_rank", F.row_number().over(order).cast("long") - 1)
    return ranked.mapInArrow(shared.lean(place), schema + ", _sequence long, _offset long")


def op5_packing(spark, sf_dir):
    return contract(pack(shared.documents(spark, sf_dir)))


def contract(found: DataFrame) -> DataFrame:
    names = {"_id": "doc_id", "_start": "start", "_length": "length", "_crc": "ids_crc32", "_total": "doc_tokens", "_sequence": "sequence_id", "_offset": "offset"}
    return found.select(*[F.col(a).alias(b) for a, b in names.items()])
