"""Exact top-k by inner product: a Voronoi kNN join."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessitura.llm import shared

#: Pivots at most, and rows of the sample on which they are placed, per pivot, and numbers in that sample at most.
PIVOTS = 1024
SAMPLE_PER_PIVOT = 16
SAMPLE_NUMBERS = 2**22
#: Queries of a cell, about; vectors of a local problem and their bytes as 32-bit numbers, at most.
GROUP, BLOCK, BLOCK_BYTES = 64, 262_144, 64_000_000
#: Local problems that a table is split into even if fewer would do, and vectors that make another one worth it.
SPLIT, WORTH = 64, 2048
#: Stands for a score that isn't known.
NOTHING, LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Rows and queries whose products are in memory at once, and rows of which only the highest score is looked at first.
ROWS, QUERIES, STRIDE = 2048, 512, 32


def quantised(vectors: DataFrame, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``_id, _v``: ``floor(scale * x)`` of each component, on the JVM.

    Rows without an id, and vectors that are null or hold null or non-finite values, take no part. A finite component
    whose number doesn't fit in 64 bits is an error, as its scores couldn't be told.
    """
    x = F.col(vector_col).cast("array<double>")
    far = lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))
    whole = lambda y: F.when(F.abs(y * scale) < 2.0**63, F.floor(y * scale)).when(~far(y), F.raise_error(F.lit("a component doesn't fit in 64 bits")).cast("long"))
    rows = vectors.select(F.col(id_col).cast("long").alias("_id"), x.alias("_x")).where(F.col("_id").isNotNull() & F.col("_x").isNotNull() & ~F.exists("_x", far))
    return rows.select("_id", F.transform("_x", whole).alias("_v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; a shorter one ends in zeros, which changes no inner product."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), shared.flat_spans(np.zeros(len(lengths), np.int64), lengths)] = flat
    return out


def _bytes(x: np.ndarray) -> pa.Array:
    """Each row as one binary value."""
    raw, each = np.ascontiguousarray(x).tobytes(), x.shape[1] * x.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * np.int32(each)), pa.py_buffer(raw)])


#: What inner products are taken in, and below what they are whole there.
KINDS = ((np.float32, 2.0**24), (np.float64, 2.0**53), (np.int64, 2.0**63))


def _kind(a: np.ndarray, b: np.ndarray) -> int:
    """The first of ``KINDS`` in which inner products of rows of these lengths are exact: no partial sum exceeds the product."""
    a, b = a.max(initial=0), b.max(initial=0)
    most = max(a * b, a, b) * (1 + 1e-9)
    for i, (_, below) in enumerate(KINDS):
        if most < below:
            return i
    raise OverflowError("a score doesn't fit in 64 bits")


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    kind = KINDS[_kind(_norms(a), _norms(b))][0]
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _norms(x: np.ndarray) -> np.ndarray:
    out = np.empty(len(x))
    for at in range(0, len(x), ROWS):
        out[at : at + ROWS] = np.sqrt((x[at : at + ROWS].astype(np.float64) ** 2).sum(1))
    return out


def _place(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` pivots: farthest-first on the sample, then a few rounds of means."""
    x = sample.astype(np.float64)
    chosen, far = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
    pivots = x[chosen]
    for _ in range(5):
        cell = _nearest(x, pivots)[0]
        for j in range(len(pivots)):
            if (cell == j).any():
                pivots[j] = x[cell == j].mean(0)
    return pivots


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row and how far it is; a step of rows at a time, so memory doesn't follow the batch."""
    cell, far, square = np.zeros(len(x), np.int64), np.zeros(len(x)), (pivots**2).sum(1)
    for at in range(0, len(x), ROWS):
        step = x[at : at + ROWS].astype(np.float64)
        cell[at : at + ROWS] = near = (square - 2 * step @ pivots.T).argmin(1)
        far[at : at + ROWS] = np.sqrt(((step - pivots[near]) ** 2).sum(1))
    return cell, far


def _chain(points: np.ndarray) -> list[int]:
    """The points in an order in which neighbours are near each other: always on to the nearest one left."""
    left, out = np.ones(len(points), bool), [0]
    while len(out) < len(points):
        left[out[-1]] = False
        out.append(int(np.where(left, ((points - points[out[-1]]) ** 2).sum(1), np.inf).argmin()))
    return out


def _needed_of_equals(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows that can be among the k best of any query: of equal vectors the 2 k with the least ids, k of one id.

    No query takes rows of its own id: k of the 2 k are left to it. Equal rows stand in ascending order of their ids.
    """
    hashes, factors = np.empty(len(x), np.uint64), shared.mix(np.arange(1, x.shape[1] + 1, dtype=np.uint64))
    for at in range(0, len(x), ROWS):
        hashes[at : at + ROWS] = (x[at : at + ROWS].astype(np.int64).view(np.uint64) * factors).sum(1, dtype=np.uint64)
    order = np.argsort(hashes, kind="stable")
    equal = np.r_[False, hashes[order][1:] == hashes[order][:-1]]
    alike = np.flatnonzero(equal)
    for at in range(0, len(alike), ROWS):  # two vectors of one hash only leave more rows
        these = alike[at : at + ROWS]
        equal[these] = (x[order[these]] == x[order[these - 1]]).all(1)
    again = equal & np.r_[False, ids[order][1:] == ids[order][:-1]]
    place = np.arange(len(x))
    few = place - shared.leaders(again) < k
    order, equal = order[few], shared.leaders(equal)[few]
    equal = np.r_[False, equal[1:] == equal[:-1]]
    return np.sort(order[np.arange(len(order)) - shared.leaders(equal) < 2 * k])


class _Block:
    """Vectors of a local problem, by cells, and the k best of them for queries that come in any number."""

    def __init__(self, ids, cells, x, k, bounds):
        few = _needed_of_equals(ids, x, k)
        if len(few) < len(x):
            ids, cells, x = ids[few], cells[few], x[few]
        self.ids, self.x, self.k, self.bounds = ids, x, k, bounds
        starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        self.cells, self.spans = cells[starts], list(zip(starts.tolist(), [*starts[1:].tolist(), len(cells)], strict=True))
        self.lengths, self.kind, self.cast = _norms(self.x), -1, None

    def numbers(self, q):
        """The vectors in numbers in which scores of ``q`` are exact; larger ones stay for the queries that follow."""
        if (kind := _kind(self.lengths, _norms(q))) > self.kind:
            self.kind, self.cast = kind, self.x.astype(KINDS[kind][0])
        return KINDS[self.kind][0], self.cast

    def best(self, own, q, sure):
        """``query, id, score`` of the k best among those that reach ``sure``; ties go to the smaller id."""
        kind, x = self.numbers(q)
        turned, k, n = np.ascontiguousarray(q.astype(kind).T), self.k, len(q)
        none = NOTHING if kind is np.int64 else -np.inf
        score, who = np.full((n, k), none, kind), np.full((n, k), LAST)
        least = np.where(sure == NOTHING, none, sure).astype(kind)
        floor, last = least.copy(), np.full(n, LAST)
        wanted = (self.bounds(q, self.cells) >= sure[:, None]).any(0)
        steps, step = [], STRIDE
        for (start, stop), want in zip(self.spans, wanted.tolist(), strict=True):
            if want and steps and steps[-1][1] == start:
                steps[-1][1] = stop
            elif want:
                steps.append([start, stop])
        for start, stop in steps:
            while start < stop:
                end = min(stop, start + step)
                products = x[start:end] @ turned
                even = (end - start) // STRIDE * STRIDE
                tops = products[:even].reshape(-1, STRIDE, n).max(1)
                if even < end - start:
                    tops = np.concatenate([tops, products[even:].max(0)[None]])
                part, j = np.nonzero(tops >= floor)
                if len(j):
                    row = (part * STRIDE)[:, None] + np.arange(STRIDE)
                    inside = row < end - start
                    found = products[np.where(inside, row, 0), j[:, None]]
                    at, column = np.nonzero(inside & (found >= floor[j][:, None]))
                    row, found, j = row[at, column], found[at, column], j[at]
                    new = self.ids[start + row]
                    good = ((found > floor[j]) | (new < last[j])) & (new != own[j])
                    found, j, new = found[good], j[good], new[good]
                    some = np.unique(j)
                    j, found, new = np.r_[np.repeat(some, k), j], np.r_[score[some].ravel(), found], np.r_[who[some].ravel(), new]
                    order = np.lexsort((new, ~found if kind is np.int64 else -found, j))
                    j, found, new = j[order], found[order], new[order]
                    rank = np.arange(len(j)) - shared.leaders(np.r_[False, j[1:] == j[:-1]][: len(j)])
                    keep = rank < k
                    score[j[keep], rank[keep]], who[j[keep], rank[keep]] = found[keep], new[keep]
                    full = score[:, -1] >= least
                    floor, last = np.where(full, score[:, -1], least), np.where(full, who[:, -1], LAST)
                start, step = end, min(ROWS, 4 * step)
        at, rank = np.nonzero((who != LAST) | (score != none))
        return own[at], who[at, rank], score[at, rank].astype(np.int64)


def top_k(vectors: DataFrame, queries, k: int = 5, measured: dict | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` (``_id``, ``_v``) that meets the condition
    ``queries``, the k rows with the highest inner product, its own id aside; ties go to the smaller id.

    Vectors are grouped by the nearest of at most ``PIVOTS`` pivots. Near cells together make a local problem of at most
    ``BLOCK`` vectors, a larger cell several; each vector is sent to one. First each query is solved in the problem of
    the cell whose pivot scores highest, which tells a score that its k-th best doesn't fall below. No score of a query
    with a vector x of a cell with pivot p and radius R exceeds q.p + |q| R, nor |q| times the cell's longest vector: the
    query then goes to the other problems that have a cell which reaches the sure score, and there to such cells only.
    A task holds its vectors, and queries pass by in steps, so its memory follows neither. Fewer than k other vectors:
    all. Rows with one id are each a candidate and none of their own id's. A score beyond 64 bits is an error.

    ``measured`` gets ``replication``: vectors, of the table and of queries, sent to local problems for each vector there
    is; ``tasks``: how many such problems; ``visits``: how many of them a query goes to.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    whole = shared.cut(vectors.withColumn("_query", queries), "vectors")
    size = whole.agg(F.count("*").alias("n"), F.count_if("_query").alias("q"), F.max(F.size("_v")).alias("d"), F.max(F.aggregate("_v", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x)))).alias("top")).first()
    n, width, top = size["n"], max(1, size["d"] or 0), size["top"] or 0
    if not size["q"] or n < 2:
        return spark.createDataFrame([], schema)
    stored = next(t for t in (np.int8, np.int16, np.int32, np.int64) if top <= np.iinfo(t).max)
    wanted = int(min(PIVOTS, max(1, -(-size["q"] // GROUP), -(-n // BLOCK))))
    sampled = max(wanted, min(SAMPLE_PER_PIVOT * max(wanted, 16), SAMPLE_NUMBERS // width))
    drawn = whole.select("_id", "_v", F.xxhash64("_id", "_v").alias("_hash"))
    if n > 2 * sampled:  # else every partition would send as many rows as the whole sample has
        drawn = drawn.where(F.col("_hash") <= int(2.0**64 * min(1.0, (1.5 * sampled + 64) / n) - 2.0**63 - 2048)).distinct()
    picked = drawn.orderBy("_hash", "_id").limit(sampled).select("_v").toArrow().column(0).combine_chunks()
    pivots = _place(_matrix(picked, width), wanted) if len(picked) else np.zeros((1, width))

    def assign(batches):
        for batch in batches:
            x = _matrix(batch.column(1), width)
            cell, far = _nearest(x, pivots)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(cell.astype(np.int32)), pa.array(far), pa.array(_norms(x)), _bytes(x.astype(stored))], ["_id", "_query", "_cell", "_far", "_norm", "_v"])

    dealt = shared.cut(whole.select("_id", "_v", "_query").mapInArrow(shared.lean(assign), "_id long, _query boolean, _cell int, _far double, _norm double, _v binary"), "cells")
    shared.discard(whole)
    cells = dealt.groupBy("_cell").agg(F.count("*").alias("n"), F.max("_far").alias("far"), F.max("_norm").alias("norm")).collect()
    cells = sorted(cells, key=lambda r: r["_cell"])
    cells = [cells[i] for i in _chain(pivots[[r["_cell"] for r in cells]])]
    most = max(1, min(BLOCK, BLOCK_BYTES // (4 * width), -(-n // min(SPLIT, -(-n // WORTH)))))
    first, parts, tasks, filled = [], [], 0, most + 1
    for r in cells:  # near cells share a task until it is full, a cell that doesn't fit in one has its own
        if filled + r["n"] > most:
            tasks, filled = tasks + 1, 0
        parts.append(-(-r["n"] // most))
        first.append(tasks - 1)
        tasks, filled = tasks + parts[-1] - 1, filled + r["n"]
    first, parts = np.array(first), np.array(parts)
    groups = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])  # cells, in the order of the chain, that share their tasks
    group_of = np.repeat(np.arange(len(groups)), parts[groups])
    cell_at, centre = np.array([r["_cell"] for r in cells]), pivots[[r["_cell"] for r in cells]]
    far, norm = np.array([r["far"] for r in cells]), np.array([r["norm"] for r in cells])
    slack = 1e-9 * (1 + float(top) ** 2 * width)  # of the bounds, which are doubles

    def bounds(q, at):
        """What no score of a query with a vector of a cell exceeds; cells by their places in the chain."""
        q = q.astype(np.float64)
        length = np.sqrt((q**2).sum(1))[:, None]
        return np.minimum(q @ centre[at].T + length * far[at], length * norm[at]) + slack

    def numbers(column):
        return np.frombuffer(b"".join(column.to_pylist()), stored).reshape(-1, width)

    def homes(batches):
        for batch in batches:
            ids, q = batch.column(0).to_numpy(), numbers(batch.column(1))
            home = np.concatenate([(q[at : at + ROWS].astype(np.float64) @ centre.T).argmax(1) for at in range(0, len(q), ROWS)] or [np.zeros(0, np.int64)])
            task = first[home] + (shared.mix(ids.view(np.uint64)) % parts[home].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), batch.column(1), pa.array(home.astype(np.int32)), pa.array(task.astype(np.int32))], ["_id", "_v", "_cell", "_task"])

    def visits(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                step = batch.slice(at, ROWS)
                sure, home = step.column(4).to_numpy(), step.column(3).to_numpy()
                need = bounds(numbers(step.column(1)), slice(None)) >= sure[:, None]
                need = np.logical_or.reduceat(need, groups, axis=1)[:, group_of]
                need[np.arange(len(need)), home] = False
                i, task = np.nonzero(need)
                to = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(need.sum(1))].astype(np.int32)), pa.array(task.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([step.column(0), step.column(1), step.column(2), step.column(4), to], ["_id", "_v", "_cell", "_sure", "_to"])

    def solve(batches):
        now, block, rows = None, None, []  # of one problem at a time
        for batch in batches:
            task, query = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((task[1:] != task[:-1]) | (query[1:] != query[:-1])) + 1).tolist(), len(task)] if len(task) else [0]
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                if task[start] != now:
                    now, block, rows, x = task[start], None, [], None
                if not query[start]:
                    rows.append((batch.column(2)[start:stop].to_numpy().copy(), batch.column(3)[start:stop].to_numpy().copy(), numbers(batch.column(4)[start:stop])))
                    continue
                if block is None and rows:
                    at, ids, x = (np.concatenate(c) for c in zip(*rows, strict=True))
                    rows = []
                    block = _Block(ids, at, x, k, bounds)
                for at in range(start, stop, QUERIES) if block else ():
                    these = batch.slice(at, min(QUERIES, stop - at))
                    found = block.best(these.column(3).to_numpy(), numbers(these.column(4)), these.column(5).to_numpy())
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], ["query_id", "vec_id", "score"])

    place = spark.createDataFrame([(int(c), int(f), int(p), i) for i, (c, f, p) in enumerate(zip(cell_at, first, parts, strict=True))], "_cell int, _first int, _parts int, _at int")
    held = dealt.select("_id", "_v", "_cell").join(F.broadcast(place), "_cell")
    held = held.select((F.col("_first") + F.pmod(F.xxhash64("_id", "_v"), F.col("_parts"))).cast("int").alias("_task"), F.lit(False).alias("_is_query"), F.col("_at").alias("_cell"), "_id", "_v", F.lit(NOTHING).alias("_sure"))
    asked = shared.cut(dealt.where("_query").select("_id", "_v").mapInArrow(shared.lean(homes), "_id long, _v binary, _cell int, _task int"), "queries")

    def local(those):
        """``those`` queries (``_task, _cell, _id, _v, _sure``) in their local problems."""
        if measured is not None:
            measured["visits"] = measured.get("visits", 0) + those.count() / size["q"]
            measured["replication"] = measured.get("replication", 0) + 1 + those.count() / n
            measured["tasks"] = tasks
        both = held.unionByName(those.withColumn("_is_query", F.lit(True)))
        both = both.repartitionById(tasks, F.col("_task")).sortWithinPartitions("_task", "_is_query", "_cell", "_id")
        return both.mapInArrow(shared.lean(solve), "query_id long, vec_id long, score long")

    found = local(asked.withColumn("_sure", F.lit(NOTHING)))
    if tasks > 1:  # else one local problem is the whole
        found = shared.cut(found, "home")
        home = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        sure = found.withColumn("_rank", F.row_number().over(home)).where(F.col("_rank") == k).select("query_id", F.col("score").alias("_sure"))
        known = asked.join(sure, F.col("_id") == F.col("query_id"), "left").select("_id", "_v", "_cell", "_task", F.coalesce("_sure", F.lit(NOTHING)).alias("_sure"))
        there = known.mapInArrow(shared.lean(visits), "_id long, _v binary, _cell int, _sure long, _to array<int>")
        found = found.unionByName(local(there.select("_id", "_v", "_cell", "_sure", F.explode("_to").alias("_task"))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_topk(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(quantised(vectors), F.col("_id") % 50 == 0)


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * d.v[i])) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
