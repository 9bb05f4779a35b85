"""SimHash near-duplicate groups by pigeonring filtering."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.llm import shared

_CODE = 49  # bits of a key above which the number of its part and arc stands
#: Rows of a task that are paired at once, beyond one key's.
CHUNK = 200_000
#: Classes from which on half of the second arc is in the key too. It changes how many rows meet, not which pairs are found.
DEEP = 2_000_000
#: Bytes of shingles (4 each) that a task compares at once, and members of a group that all of its blocks see.
BLOCK, PIVOTS = 8_000_000, 32
#: Links up to which one task finds their components, in some 50 MB; more go through rounds of joins.
FEW_LINKS = 262_144
#: The bits of each byte, each in a byte of its own.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def _majority(values: np.ndarray) -> np.uint64:
    """A bit is 1 if it is set in over half of some 64-bit numbers."""
    lanes = _LANES[values.view(np.uint8)].reshape(-1, 8)
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)  # 255 rows at most fill no byte beyond itself
    counts = sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(values), bitorder="little").view(np.uint64)[0]


def shingles(text: bytes, width: int, seed: int = 42) -> np.ndarray:
    """The XXH64 values of a text's word shingles, repeats included; a text with fewer words is one shingle."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    one = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([one(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return np.array([one(joined[a:b], seed) for a, b in zip(starts[: len(starts) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)], np.uint64)


def majorities(found: np.ndarray, parts: int = 1) -> np.ndarray:
    """``parts`` numbers of 64 bits, the majority of the values; those of the second part on are mixed from the first's."""
    out = np.zeros(parts, np.uint64)
    for p in range(parts if len(found) else 0):
        out[p] = _majority(found if p == 0 else shared.mix(found + np.uint64(p * 0x9E3779B97F4A7C15 % 2**64)))
    return out


def fingerprint(text: bytes, width: int = 4, seed: int = 42, parts: int = 1) -> np.ndarray:
    """``parts`` numbers of 64 bits from all shingles of a text, repeats included. Without words all are 0."""
    return majorities(shingles(text, width, seed), parts)


def bits_at(similarity: float, bits: int, spread: float = 2.0) -> int:
    """Bits in which fingerprints of ``bits`` bits differ at most, but for 1 pair in 40, if that part of all shingles is in both texts.

    The angle between two sets of that Jaccard similarity, over pi, is the chance of a bit to differ; ``spread`` standard
    deviations are added.
    """
    chance = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * chance + spread * math.sqrt(bits * chance * (1 - chance)))


def _names(parts: int) -> list[str]:
    return [f"_fp{p}" for p in range(parts)]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, parts: int = 1, sets: bool = False) -> DataFrame:
    """A row per document: ``_id`` (its id, null as the least long), ``_hash`` of its text and its fingerprint in ``_fp0`` ...

    With ``sets`` repeats don't count, and the distinct shingles come along: ``_set``, one number for all of them, and
    ``_shingles``, the upper 32 bits of each in ascending order.
    """
    more = [("_set", "long"), ("_shingles", "binary")] if sets else []

    def run(batches):
        for batch in batches:
            prints, marks, packed = [], [], []
            for text in shared.as_bytes(batch.column(2)):
                found = shingles(text, width)
                if sets:
                    found = np.unique(found)
                    marks.append(int(shared.mix(found).sum(dtype=np.uint64).view(np.int64)))
                    packed.append(np.unique((found >> np.uint64(32)).astype(np.uint32)).tobytes())
                prints.append(majorities(found, parts))
            prints = np.array(prints, np.uint64).reshape(-1, parts).view(np.int64)
            extra = [pa.array(marks, pa.int64()), pa.array(packed, pa.binary())] if sets else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(prints[:, p].copy()) for p in range(parts)], *extra], ["_id", "_hash", *_names(parts), *[n for n, _ in more]])

    text = F.col(text_col).cast("string")
    schema = ", ".join(f"{n} {t}" for n, t in [("_id", "long"), ("_hash", "long"), *[(n, "long") for n in _names(parts)], *more])
    return docs.select(shared.numbered(id_col).alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text")).mapInArrow(shared.lean(run), schema)


class Ring:
    """How 64 bits are cut into ``segments`` arcs and what a chain of arcs may differ in, for at most ``most`` bits.

    If two values differ in at most ``most`` bits, then some arc starts a chain in which the first L arcs differ in at
    most ``L * most / segments`` bits, for every L (the pigeonring principle). With more segments than ``most`` the
    first arc of that chain is equal in both, so it is the key on which candidates meet.
    """

    def __init__(self, most: int):
        self.most, self.m = most, most + 1
        edges = [round(64 * i / self.m) for i in range(self.m + 1)]
        self.low = edges[:-1]
        self.wide = [b - a for a, b in zip(edges, edges[1:], strict=False)]
        self.budget = [length * most // self.m for length in range(1, self.m + 1)]

    def arc(self, values: np.ndarray, i: int) -> np.ndarray:
        i %= self.m
        return (values >> np.uint64(self.low[i])) & np.uint64((1 << self.wide[i]) - 1)

    def mask(self, i: int, length: int) -> np.uint64:
        return np.uint64(sum(((1 << self.wide[j % self.m]) - 1) << self.low[j % self.m] for j in range(i, i + length)))


class Groups:
    """Union-find over places 0 .. n - 1, many links at a time."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def near(full: np.ndarray, codes: np.ndarray, place: np.ndarray, ring: Ring, groups: Groups, limit: int, chunk: int = 1_000_000) -> None:
    """Link the places of fingerprints (rows of ``full``) that are near and equal in one of the arcs in ``codes``.

    Near: in some part at most ``ring.most`` bits differ, in all parts together at most ``limit``. A fingerprint stands
    here once for each (part, arc) under whose key it was dealt to this task. Within such a group the second arc may
    differ in one bit at most (the budget of a chain of two), so partners are found by probing a sorted list of the first
    two arcs: the list itself and one bit flipped. Those that are in one group already are passed over as a block; the
    other pairs live in steps of ``chunk`` and are never emitted.
    """
    for code in np.unique(codes).tolist():
        part, i = divmod(code, ring.m)
        mine = np.flatnonzero(codes == code)
        if len(mine) < 2:
            continue
        second = ring.wide[(i + 1) % ring.m]
        x = full[mine, part]
        key = (ring.arc(x, i) << np.uint64(second)) | ring.arc(x, i + 1)
        order = np.argsort(key, kind="stable")
        key, x, mine = key[order], x[order], mine[order]
        at = place[mine]
        run = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        masks = [(ring.mask(i, length), ring.budget[length - 1]) for length in range(3, ring.m + 1)]  # the last is the whole part

        def link(a: np.ndarray, b: np.ndarray) -> None:
            apart = groups.root[at[a]] != groups.root[at[b]]
            a, b = a[apart], b[apart]
            for mask, budget in masks:
                good = np.bitwise_count((x[a] ^ x[b]) & mask) <= budget
                a, b = a[good], b[good]
            if full.shape[1] > 1 and len(a):
                good = np.bitwise_count(full[mine[a]] ^ full[mine[b]]).sum(axis=1, dtype=np.int64) <= limit
                a, b = a[good], b[good]
            groups.link(at[a], at[b])

        for step in range(1, 17):  # neighbours first: a dense group is soon one component and needs no more pairs
            a = np.flatnonzero(key[step:] == key[:-step]) if len(key) > step else key[:0]
            if not len(a):
                break
            link(a, a + step)
        for flip in [0] + ([1 << b for b in range(second)] if ring.budget[1] >= 1 else []):
            to = key ^ np.uint64(flip)
            low, high = np.searchsorted(key, to, "left"), np.searchsorted(key, to, "right")
            some = np.flatnonzero((high > low) & (to >= key))
            if not len(some):
                continue
            rank = np.unique(groups.root[at], return_inverse=True)[1]
            by = np.lexsort((rank, run))  # by key, then by group
            block = run * len(key) + rank[by]  # run ascends, so it is the same in this order
            own = run[low[some]] * len(key) + rank[by][some]
            own_low, own_high = np.searchsorted(block, own, "left"), np.searchsorted(block, own, "right")
            ranges = [(own_high, high[some])] if flip == 0 else [(low[some], own_low), (own_high, high[some])]
            for begin, end in ranges:
                count = np.maximum(end - begin, 0)
                full_ones = np.flatnonzero(count)
                reach = np.cumsum(count[full_ones])
                done = 0
                while done < len(full_ones):
                    before = reach[done - 1] if done else 0
                    stop = max(done + 1, int(np.searchsorted(reach, before + chunk, "right")))
                    who = full_ones[done:stop]
                    a = np.repeat(some[who], count[who])
                    b = shared.flat_spans(begin[who], count[who])
                    link(by[a], by[b])
                    done = stop


def _star(nodes: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    """Links (a, b) from every node to the least one of its group; ``root`` has the groups by place."""
    least = np.full(len(nodes), np.iinfo(np.int64).max)
    np.minimum.at(least, root, nodes)
    least = least[root]
    far = least != nodes
    return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(least[far])], ["a", "b"])


def links(classes: DataFrame, most: int = 4, parts: int = 1, limit: int | None = None, deep: bool = False) -> DataFrame:
    """Links (a, b) that join all ``_node`` of ``classes`` (``_fp0`` ..., ``_node``) that are near, see :func:`near`.

    Classes meet under an arc's value. With ``deep`` they meet under an arc and one half of the next: the next differs in
    one bit at most, so one of its halves is equal. A task reads its rows in order of the key and holds ``CHUNK`` of them
    or those of one key; it returns a star for each component in these, so rows are at most those that it read.
    """
    if most < 1:  # equal fingerprints are one class already
        return classes.sparkSession.createDataFrame([], "a long, b long")
    ring, names = Ring(most), _names(parts)
    limit = most if limit is None else limit
    tasks = 2 * shared.shuffle_partitions(classes.sparkSession)
    bits = lambda p, low, wide: F.shiftrightunsigned(names[p], low).bitwiseAND(F.lit((1 << wide) - 1))
    keys = []
    for p in range(parts):
        for i in range(ring.m):
            code, first = F.lit((p * ring.m + i) << _CODE), F.shiftleft(bits(p, ring.low[i], ring.wide[i]), 16)
            if not deep:
                keys.append(code.bitwiseOR(first))
                continue
            j = (i + 1) % ring.m
            half = ring.wide[j] // 2
            keys.append(code.bitwiseOR(first).bitwiseOR(bits(p, ring.low[j], half)))
            keys.append(code.bitwiseOR(F.lit(1 << (_CODE - 1))).bitwiseOR(first).bitwiseOR(bits(p, ring.low[j] + half, ring.wide[j] - half)))
    keyed = classes.select(*names, "_node", F.explode(F.array(*keys)).alias("_key"))

    def solve(rows: np.ndarray) -> pa.RecordBatch:
        nodes, place = np.unique(rows[:, parts], return_inverse=True)
        groups = Groups(len(nodes))
        near(np.ascontiguousarray(rows[:, :parts]).view(np.uint64), rows[:, parts + 1] >> _CODE, place, ring, groups, limit, 1_000_000 // parts)
        return _star(nodes, groups.root)

    def run(batches):
        held = np.zeros((0, parts + 2), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns], axis=1)]) if batch.num_rows else held
            if len(held) >= CHUNK and (whole := int(np.searchsorted(held[:, -1], held[-1, -1], "left"))):
                yield solve(held[:whole])
                held = held[whole:]
        if len(held):
            yield solve(held)

    return keyed.repartition(tasks, "_key").sortWithinPartitions("_key").mapInArrow(shared.lean(run), "a long, b long")


def _shape(state: DataFrame) -> tuple[bool, int, int, int]:
    """Of links (u, v) with u > v: is each node's only link one to a root, how many links, most links of a node in all and to smaller ones."""
    ends = state.select(F.col("u").alias("w"), F.lit(1).alias("up")).union(state.select(F.col("v").alias("w"), F.lit(0).alias("up")))
    nodes = ends.groupBy("w").agg(F.sum("up").alias("ups"), F.count("*").alias("n"))
    open_ = F.coalesce(F.max((F.col("ups") > 1) | (F.col("ups") > 0) & (F.col("n") > F.col("ups"))), F.lit(False))
    found = nodes.agg(open_.alias("open"), *[F.coalesce(x, F.lit(0)).alias(c) for x, c in ((F.sum("ups"), "links"), (F.max("n"), "n"), (F.max("ups"), "ups"))]).first()
    return not found["open"], found["links"], found["n"], found["ups"]


def _solved(links: DataFrame) -> DataFrame:
    """(node, root) of a table of links (u, v) that ``cut`` has written, in one task."""

    def run(batches):
        held = [np.stack([c.to_numpy() for c in batch.columns]) for batch in batches if batch.num_rows]
        if held:
            nodes, place = np.unique(np.concatenate(held, axis=1), return_inverse=True)
            groups = Groups(len(nodes))
            groups.link(*place.reshape(2, -1))
            yield pa.RecordBatch.from_arrays(_star(nodes, groups.root).columns, ["node", "root"])

    found = shared.cut(links.select("u", "v").repartition(1).mapInArrow(shared.lean(run), "node long, root long"), "roots")
    shared.discard(links)
    return found


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node that it reaches.

    Up to ``FEW_LINKS`` links go to one task: a round of joins costs the driver a plan of dozens of exchanges, whatever
    the number of links. More go through alternating large-star and small-star steps, until they are few or every node's
    only link is one to its root; each round is written to the shared folder, so lineage stays short and a lost executor
    costs one at most. Links of a hub stay where they are, and the hub's least neighbour is sent to them. Nothing but four numbers a
    round comes to the driver.
    """
    raw = shared.cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    if raw.count() <= FEW_LINKS:
        return _solved(raw)
    state = shared.cut(raw.distinct(), "edges")
    shared.discard(raw)
    for _ in range(most_rounds):
        done, total, degree, ups = _shape(state)
        if done:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
        if total <= FEW_LINKS:
            return _solved(state)
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"), "n")
        large = shared.spread(both.where("v > u"), low, [("u", "w")], "n", 2 * total, degree).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = shared.spread(large, least, [("u", "w")], "n", 2 * total, ups).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        fresh = shared.cut(small.union(least.select("w", "m")).distinct(), "edges")
        shared.discard(state)
        state = fresh
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")


def compare(full: np.ndarray, offsets: np.ndarray, codes: np.ndarray, probe: np.ndarray, groups: Groups, most: int, limit: int, similarity: float) -> None:
    """Link the places whose fingerprints are near, see :func:`near`, and whose shingles have that Jaccard similarity.

    Place i has the distinct shingles ``codes[offsets[i] : offsets[i + 1]]``. Every pair with a ``probe`` is looked at but
    those that are in one group already.
    """
    sizes = np.diff(offsets)
    flags = np.zeros(int(codes.max(initial=-1)) + 1, bool)
    places = np.arange(len(sizes))
    for a in np.flatnonzero(probe).tolist():
        rest = places[(groups.root != groups.root[a]) & ((places > a) | ~probe)]
        if not len(rest):
            continue
        bits = np.bitwise_count(full[rest] ^ full[a])
        good = (bits.min(axis=1) <= most) & (bits.sum(axis=1, dtype=np.int64) <= limit)
        rest = rest[good & (np.minimum(sizes[rest], sizes[a]) >= similarity * np.maximum(sizes[rest], sizes[a]) - 1e-9) & (sizes[rest] > 0)]
        if not len(rest):
            continue
        mine = codes[offsets[a] : offsets[a + 1]]
        flags[mine] = True
        common = np.add.reduceat(flags[codes[shared.flat_spans(offsets[rest], sizes[rest])]], np.cumsum(sizes[rest]) - sizes[rest], dtype=np.int64)
        flags[mine] = False
        rest = rest[common >= similarity * (sizes[a] + sizes[rest] - common) - 1e-9]
        groups.link(np.full(len(rest), a), rest)


def _checked(rows: DataFrame, parts: int, most: int, limit: int, similarity: float) -> DataFrame:
    """Links (a, b) within each (``_root``, ``_block``, ``_chunk``) of rows (``_node, _label, _probe, _shingles``, fingerprints)."""
    names = _names(parts)
    tasks = 2 * shared.shuffle_partitions(rows.sparkSession)

    def solve(slices: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(slices).combine_chunks()
        if t.num_rows < 2:
            return None
        nodes, label, probe = (t.column(c).to_numpy() for c in ("_node", "_label", "_probe"))
        full = np.stack([t.column(n).to_numpy() for n in names], axis=1).view(np.uint64)
        packed = t.column("_shingles").to_pylist()
        offsets = np.r_[0, np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed)) // 4)]
        codes = np.unique(np.frombuffer(b"".join(packed), np.uint32), return_inverse=True)[1]
        first = np.unique(label, return_index=True, return_inverse=True)
        groups = Groups(len(nodes))
        groups.link(np.arange(len(nodes)), first[1][first[2]])
        compare(full, offsets, codes, probe.astype(bool), groups, most, limit, similarity)
        return _star(nodes, groups.root)

    def run(batches):
        held, now = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("_root", "_block", "_chunk")], axis=1)
            edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for a, b in zip(edges, edges[1:], strict=False):
                if (mine := tuple(key[a])) != now:
                    if held and (done := solve(held)) is not None:
                        yield done
                    held, now = [], mine
                held.append(batch.slice(a, b - a))
        if held and (done := solve(held)) is not None:
            yield done

    where = ["_root", "_block", "_chunk"]
    dealt = rows.select(*where, "_node", "_label", "_probe", *names, "_shingles").repartition(tasks, *where).sortWithinPartitions(*where)
    return dealt.mapInArrow(shared.lean(run), "a long, b long")


def verified(classes: DataFrame, prints: DataFrame, roots: DataFrame, most: int, parts: int, limit: int, similarity: float) -> DataFrame:
    """(node, root) as :func:`components` gives it, of the links whose shingles have the similarity, too.

    ``roots`` are the components of candidates. A component's shingles come together in blocks of ``BLOCK`` bytes: nearly
    all are one block. In a larger one each block is compared with itself and with some ``PIVOTS`` members that all
    blocks see; then whoever isn't in the component's main group is compared with all blocks. So a task's memory is
    bounded, and what a large group of near copies costs grows with those members that don't belong to it.
    """
    names = _names(parts)
    every = roots.union(roots.select("root", "root").distinct())
    rows = classes.join(every, F.col("_node") == F.col("node")).select("_node", F.col("root").alias("_root"), F.col("_least").alias("_i"), F.col("_least_hash").alias("_h"), *names)
    texts = prints.select("_id", "_hash", "_shingles").dropDuplicates(["_id", "_hash"])
    rows = shared.cut(rows.join(texts, (F.col("_i") == F.col("_id")) & (F.col("_h") == F.col("_hash"))).drop("_i", "_h", "_id", "_hash"), "members")
    total = rows.count()
    size = rows.groupBy(F.col("_root").alias("_r")).agg(F.count("*").alias("_n"), F.ceil(F.sum(F.octet_length("_shingles")) / BLOCK).alias("_blocks"))
    rows = shared.spread(rows, size, [("_root", "_r")], "_n", total).drop("_r")
    block = F.pmod(F.xxhash64("_node"), F.greatest("_blocks", F.lit(1)))
    pivot = (F.col("_blocks") > 1) & (F.pmod(F.xxhash64("_node", F.lit(1)), F.col("_n")) < PIVOTS)
    every_block = F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)
    alone = rows.withColumn("_block", F.explode(F.when(pivot, every_block).otherwise(F.array(block)))).withColumn("_chunk", F.lit(0).cast("long"))
    found = shared.cut(_checked(alone.withColumn("_label", F.col("_node")).withColumn("_probe", F.lit(True)), parts, most, limit, similarity), "links")
    done = components(found)
    large = rows.where("_blocks > 1")
    if not large.limit(1).count():
        return done
    large = shared.cut(large.join(done, F.col("_node") == F.col("node"), "left").withColumn("_label", F.coalesce("root", "_node")).drop("node", "root"), "members")
    labels = large.groupBy("_root", "_label").agg(F.count("*").alias("n"))
    main = labels.groupBy(F.col("_root").alias("_r")).agg(F.max_by("_label", F.struct("n", "_label")).alias("_main"), F.sum("n").alias("_all"))
    marked = shared.cut(shared.spread(large, main, [("_root", "_r")], "_all", total).withColumn("_out", F.col("_label") != F.col("_main")).drop("_r", "_all"), "members")
    chunks = marked.where("_out").groupBy(F.col("_root").alias("_r")).agg(F.greatest(F.ceil(F.sum(F.octet_length("_shingles")) / BLOCK), F.lit(1)).alias("_chunks"), F.first("_n").alias("_all"))
    open_ = shared.spread(marked, chunks, [("_root", "_r")], "_all", total)
    every_chunk = F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1)
    data = open_.withColumn("_block", block).withColumn("_chunk", F.explode(every_chunk)).withColumn("_probe", F.lit(False))
    probes = open_.where("_out").withColumn("_chunk", F.pmod(F.xxhash64("_node"), F.col("_chunks"))).withColumn("_block", F.explode(every_block)).withColumn("_probe", F.lit(True))
    return components(found.union(_checked(data.unionByName(probes), parts, most, limit, similarity)))


def near_groups(
    docs: DataFrame, most: int = 4, width: int = 4, parts: int = 1, limit: int | None = None, similarity: float | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Near-duplicate groups: ``_id``, ``_hash``, ``_fp0`` ..., ``_group`` and ``_root``, its least id, per row of docs.

    With one part, texts are near if ``most`` of 64 bits differ at most. Several parts are independent fingerprints: near
    is who differs in at most ``most`` bits of one of them and in at most ``limit`` bits of all, which finds pairs that a
    single one misses. With ``similarity`` these are candidates only, fingerprints are those of the distinct shingles, and
    a link is a candidate whose sets of shingles have that Jaccard similarity (see :func:`verified`).

    Equal fingerprints (with ``similarity`` also equal sets) form one class before anything is paired, so thousands of
    copies cost one candidate. Null and empty texts have fingerprint 0 and are linked like any other. A null id counts as
    the least long. Repeated rows of a document are members of its group. An empty table has no groups.
    """
    names = _names(parts)
    exact = similarity is not None
    keys = [*names, "_set"] if exact else names
    prints = shared.cut(fingerprints(docs, id_col, text_col, width, parts, exact), "simhash")
    classes = prints.groupBy(*keys).agg(F.min(F.struct("_id", "_hash")).alias("_l"), F.count("*").alias("_n"))
    node = F.col("_fp0") if len(keys) == 1 else F.xxhash64(*keys)
    classes = shared.cut(classes.select(*keys, F.col("_l._id").alias("_least"), F.col("_l._hash").alias("_least_hash"), "_n", node.alias("_node")), "classes")
    size = classes.agg(F.count("*").alias("classes"), F.sum("_n").alias("rows")).first()
    limit = most if limit is None else limit
    roots = components(links(classes, most, parts, limit, size["classes"] > DEEP))
    if exact:
        roots = verified(classes, prints, roots, most, parts, limit, similarity)
    rooted = classes.join(roots, F.col("_node") == F.col("node"), "left").select(*[F.col(k).alias("c" + k) for k in keys], "_least", "_n", F.coalesce("root", "_node").alias("_group"))
    least = rooted.groupBy(F.col("_group").alias("_g")).agg(F.min("_least").alias("_root"), F.count("*").alias("_classes"))
    # a table of its own: the next join would hold this one's plan five times
    rooted = shared.cut(shared.spread(rooted, least, [("_group", "_g")], "_classes", size["classes"]), "rooted")
    found = shared.spread(prints.select("_id", "_hash", *keys), rooted, [(k, "c" + k) for k in keys], "_n", size["rows"] or 0)
    return found.select("_id", "_hash", *names, "_group", "_root")


def keep_one(docs: DataFrame, most: int = 8, width: int = 5, parts: int = 6, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the document with the least id, once.

    Documents with one id but different texts, and all without an id, are told apart by their texts; of several in one
    group with the least id the one with the least hash of its text stays. Columns are those of ``docs``.
    """
    since = shared.written()
    groups = near_groups(docs, most, width, parts, bits_at(similarity, 64 * parts), similarity)
    kept = groups.groupBy("_group").agg(F.min(F.struct("_id", "_hash")).alias("k")).select(F.col("k._id").alias("_id"), F.col("k._hash").alias("_hash"))
    kept = shared.cut(kept, "kept")
    shared.tidy(since, kept)  # fingerprints and shingles have done their part
    rows = docs.select(*shared.carried(docs.columns), shared.numbered().alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_hash"))
    return rows.join(kept, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"]).select(*shared.restored(docs.columns))


def op10_simhash(spark, sf_dir):
    found = near_groups(shared.documents(spark, sf_dir))
    real = lambda c: F.when(F.col(c) != shared.NULL_ID, F.col(c))
    return found.select(real("_id").alias("doc_id"), F.lpad(F.lower(F.hex("_fp0")), 16, "0").alias("fingerprint"), real("_root").alias("component_id"))
