"""What the operators of this subpackage have in common: inputs, scratch tables, word splitting, hashing."""

from __future__ import annotations

import atexit
import ctypes
import functools
import sys
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null document id where a number is needed; it sorts first.
NULL_ID = -(2**63)
#: Bytes of text that one vectorised step works on; bounds the memory of a Python worker.
STEP_BYTES = 6_000_000
#: Rows with one key that are always ranked or joined together; a key with more, and more than a tenth of a task's rows, is split.
LEAST_RANKED, LEAST_JOINED = 100, 1000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(rows: DataFrame, lookup: DataFrame, on: list[tuple[str, str]], n: str, total: int, largest: int | None = None) -> DataFrame:
    """Inner join of ``rows``, ``total`` in number, with ``lookup``, which has one row a key and in ``n`` how many rows have it.

    A key with over a tenth of a task's rows isn't shuffled: its rows stay where they are and the row of ``lookup`` is
    sent to them. There are at most 10 x tasks such keys. Names of columns must differ. ``largest``, if known, is what no
    key has more rows than; without a hot key one join does.
    """
    most = max(LEAST_JOINED, total // (10 * shuffle_partitions(rows.sparkSession)))
    same = functools.reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in on])
    if (total if largest is None else largest) <= most:  # so no key has more
        return rows.join(lookup, same)
    hot = F.broadcast(lookup.where(F.col(n) > most))
    cold = rows.join(F.broadcast(lookup.where(F.col(n) > most).select(*[b for _, b in on])), same, "left_anti")
    return rows.join(hot, same).unionByName(cold.join(lookup.where(F.col(n) <= most), same))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``, or one set here where it is unset."""
    set_to = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not set_to:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        set_to = f"/tmp/tessitura-{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(set_to)
    return set_to


_TABLES: list[tuple[SparkSession, str]] = []


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _remove_all() -> None:
    for spark, path in _TABLES:
        try:
            remove(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended before the interpreter
            return


atexit.register(_remove_all)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _TABLES.append((spark, path))
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it: ends its lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the table behind a DataFrame that ``cut`` returned and nothing reads any more."""
    if path := getattr(df, "_scratch", None):
        remove(df.sparkSession, path)


def tidy(since: int, *kept: DataFrame) -> None:
    """Remove the tables written after the first ``since`` ones, but for those behind ``kept``; nothing may read them any more."""
    paths = {getattr(df, "_scratch", None) for df in kept}
    for spark, path in _TABLES[since:]:
        if path not in paths:
            remove(spark, path)
    _TABLES[since:] = [x for x in _TABLES[since:] if x[1] in paths]


def written() -> int:
    """How many tables stand in the shared folder, for :func:`tidy`."""
    return len(_TABLES)


def lean(run):
    """For mapInArrow: ``run``, which gives the memory it no longer uses back to the system at the end of a task.

    Workers are used again, so what one operator once needed would else stay on top of what the next one needs.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform.startswith("linux"):
                trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of some systems has none
                if trim:
                    trim(0)

    return wrapped


def others(columns: list[str], results: list[str]) -> list[str]:
    """The columns of an input that go along: one with the name of a result column gives way to it."""
    return [c for c in columns if c not in results]


def carried(keep: list[str]):
    """Columns under names of their own, so that no input column meets one that an operator needs on the way."""
    return [F.col(f"`{c}`").alias(f"_carried{i}") for i, c in enumerate(keep)]


def restored(keep: list[str]):
    return [F.col(f"_carried{i}").alias(c) for i, c in enumerate(keep)]


def numbered(column: str = "doc_id"):
    """The id as a long without nulls."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def told_apart(id_col: str = "doc_id", text_col: str = "text"):
    """The id; documents without one get numbers by a hash of their text that stand before (nearly) all ids."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID) + F.shiftrightunsigned(F.xxhash64(F.col(text_col).cast("string")), 2))


def id_ranges(docs: DataFrame, parts: int, column: str = "doc_id") -> list[int]:
    """At most ``parts`` - 1 ascending ids that split the rows into ranges of about equal numbers; reads the id only."""
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    found = docs.select(numbered(column).alias("id")).agg(F.percentile_approx("id", F.array(*map(F.lit, at)), F.lit(20 * parts)).alias("p")).first()["p"]
    return sorted(set(found or []))


def range_of(bounds: list[int], column):
    """The 0-based range that an id falls into: how many bounds are at or below it. A balanced tree of comparisons."""
    if not bounds:
        return F.lit(0)
    middle = len(bounds) // 2
    below, above = range_of(bounds[:middle], column), range_of(bounds[middle + 1 :], column)
    return F.when(column < F.lit(bounds[middle]), below).otherwise(above + F.lit(middle + 1))


def steps(texts: pa.Array, most: int = STEP_BYTES):
    """Slices (start, stop) of a text column with at most ``most`` bytes each, one row at least."""
    if not len(texts):
        return
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64))
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield start, stop
        start = stop


def as_bytes(texts: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    return [b"" if x is None else x for x in texts.cast(pa.binary()).to_pylist()]


class Words:
    """The words ``[^\\x20\\x09-\\x0D]+`` of some texts, each distinct one held once.

    codes: the number of every word in reading order; spelled: an Arrow array of the distinct words, each with one
    space after it; at: n_texts + 1 offsets into codes.
    """

    def __init__(self, texts: list[bytes]):
        self._hashes: np.ndarray | None = None
        joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        space = _SPACE[joined]
        starts_here = np.empty(len(joined), bool)
        starts_here[0] = not space[0]
        np.logical_and(~space[1:], space[:-1], out=starts_here[1:])
        keep = ~space
        keep[1:] |= ~space[:-1]
        packed, blank = joined[keep], space[keep]
        packed[blank] = 32
        ends = np.flatnonzero(blank) if len(blank) else np.zeros(0, np.int64)
        if len(ends) and not starts_here.any():
            ends = ends[:0]
        offsets = np.zeros(len(ends) + 1, np.int32)
        offsets[1:] = ends + 1
        words = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
        found = words.dictionary_encode()
        self.codes = found.indices.to_numpy(zero_copy_only=False)
        self.spelled = found.dictionary
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes + 1, out=begin[1:])
        self.at = np.searchsorted(np.flatnonzero(starts_here), begin)

    def hashes(self) -> np.ndarray:
        """64 bits of each distinct word; the same for a word in every process."""
        if self._hashes is None:
            self._hashes = hash_slices(self.spelled)
        return self._hashes


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_MULTIPLIER, _INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS[0][:n], _POWERS[1][:n]


def hash_slices(values: pa.Array) -> np.ndarray:
    """A 64-bit polynomial hash of each value of a binary array."""
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    out = np.zeros(n, np.uint64)
    if len(data):
        first = offsets[:-1] - offsets[0]
        place = np.arange(len(data)) - np.repeat(first, lengths)
        terms = (data.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[0][place]
        full = lengths > 0
        out[full] = np.add.reduceat(terms, first[full])
    return mix(out + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def rolling(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` gives the hash of any run of ``values`` (64-bit numbers)."""
    up, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    _, down = powers(len(prefix))
    return mix((prefix[start + length] - prefix[start]) * down[start])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring numbers."""
    if len(x) < width:
        return x[:0]
    done, out = 1, x
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def flat_spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All places start .. start + length - 1 of each span, one span after the other."""
    total = int(length.sum())
    before = np.cumsum(length) - length
    return np.arange(total) + np.repeat(start - before, length)


def leaders(same: np.ndarray) -> np.ndarray:
    """For sorted keys: the place of the first of each run; same[i] says that i has the key of i - 1."""
    place = np.where(same, 0, np.arange(len(same)))
    return np.maximum.accumulate(place)


def in_order(docs: DataFrame, parts: int, id_col: str = "doc_id", text_col: str = "text", peek: bool = False) -> DataFrame:
    """``_id``, ``_text`` and ``_peek``, dealt by ranges of ids to ascending partitions and sorted in each.

    With ``peek`` each partition ends in one row more, marked by ``_peek`` = 1: the document after its last, or the
    first of all after the last of all. That row is the only text that travels twice. Equal ids are sorted by text; a
    null id comes first.
    """
    bounds = id_ranges(docs, parts, id_col)
    rows = docs.select(numbered(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.withColumn("_range", range_of(bounds, F.col("_id")))
    if peek:
        ids = docs.select(numbered(id_col).alias("_id"))
        firsts = sorted((r["r"], r["low"]) for r in ids.groupBy(range_of(bounds, F.col("_id")).alias("r")).agg(F.min("_id").alias("low")).collect())
        to = {low: firsts[i - 1][0] for i, (_, low) in enumerate(firsts)}  # of the first: the last range
        here = F.array(F.struct(F.col("_range"), F.lit(0).alias("_peek")))
        if to:
            known = F.create_map(*[F.lit(x).cast(t) for low, r in to.items() for x, t in ((low, "long"), (r, "int"))])
            more = F.array(F.struct(F.element_at(known, F.col("_id")).alias("_range"), F.lit(1).alias("_peek")))
            here = F.when(F.col("_id").isin(list(to)), F.concat(here, more)).otherwise(here)
        rows = rows.select("_id", "_text", F.explode(here).alias("_to")).select("_id", "_text", "_to._range", "_to._peek")
    else:
        rows = rows.withColumn("_peek", F.lit(0))
    dealt = rows.repartitionById(len(bounds) + 1, F.col("_range").cast("int"))
    return dealt.sortWithinPartitions("_peek", "_id", "_text").select("_id", "_text", "_peek")
