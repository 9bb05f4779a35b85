"""Token ids in files of bit or byte planes.

A file: the 8 bytes ``TESSPLN1``; the compressed planes of each block, one after the other; a zstandard frame with the
index; the length of that frame as 8 bytes. A block holds up to ``BLOCK`` ids as unsigned 32-bit numbers, transposed:
plane p has bit p (or byte p) of every id of the block. A plane of zeros takes no bytes. The index (JSON) lists the
documents (ids and numbers of tokens) and for each block its number of ids and the lengths of its planes, so a block is
found and read without the others.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessitura.llm import encoding, shared

MAGIC = b"TESSPLN1"
BLOCK = 65_536
#: Ids after which a partition goes on in another file; bounds what a reader holds.
ROLL = 8_000_000


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        raw = np.packbits(np.unpackbits(raw, axis=1, bitorder="little"), axis=0, bitorder="little")
    return [x.tobytes() if x.any() else b"" for x in raw.T]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "bit":
        bits = np.zeros((32, n), np.uint8)
        for p, x in enumerate(planes):
            if x:
                bits[p] = np.unpackbits(np.frombuffer(x, np.uint8), count=n, bitorder="little")
        return np.ascontiguousarray(np.packbits(bits, axis=0, bitorder="little").T).view("<u4").ravel()
    out = np.zeros((n, 4), np.uint8)
    for p, x in enumerate(planes):
        if x:
            out[:, p] = np.frombuffer(x, np.uint8)
    return out.view("<u4").ravel()


def encode_file(doc_ids: list[int], counts: list[int], ids: np.ndarray, kind: str = "byte", level: int = 3) -> bytes:
    squeeze = zstandard.ZstdCompressor(level=level)
    out, blocks = [MAGIC], []
    for at in range(0, len(ids), BLOCK):
        block = ids[at : at + BLOCK]
        planes = [squeeze.compress(x) if x else b"" for x in to_planes(block, kind)]
        blocks.append([len(block), [len(x) for x in planes]])
        out += planes
    index = squeeze.compress(json.dumps({"kind": kind, "docs": doc_ids, "tokens": counts, "blocks": blocks}).encode())
    return b"".join([*out, index, len(index).to_bytes(8, "little")])


def read_index(data: bytes) -> dict:
    if data[:8] != MAGIC:
        raise ValueError("not a plane file")
    n = int.from_bytes(data[-8:], "little")
    return json.loads(zstandard.ZstdDecompressor().decompress(data[-8 - n : -8]))


def decode_blocks(data: bytes, index: dict | None = None):
    """The ids of each block in turn."""
    index = index or read_index(data)
    expand, at = zstandard.ZstdDecompressor(), len(MAGIC)
    for n, lengths in index["blocks"]:
        planes = []
        for size in lengths:
            planes.append(expand.decompress(data[at : at + size]) if size else b"")
            at += size
        yield from_planes(planes, n, index["kind"])


def _store(folder: str, name: str, data: bytes) -> None:
    """Write whole or not at all: under another name first, so that a second attempt of a task does no harm."""
    part = f".{name}.{uuid.uuid4().hex}"
    if folder.startswith("file:"):
        local = "/" + folder.removeprefix("file:").lstrip("/")
        with open(f"{local}/{part}", "wb") as f:
            f.write(data)
        os.replace(f"{local}/{part}", f"{local}/{name}")
        return
    from pyarrow.fs import FileSystem

    store, path = FileSystem.from_uri(folder)
    with store.open_output_stream(f"{path}/{part}") as f:
        f.write(data)
    store.move(f"{path}/{part}", f"{path}/{name}")


def _make_folder(spark: SparkSession, folder: str) -> str:
    """The folder's URI, with the cluster's default store where ``folder`` names none: what Spark's readers take it for."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(p)
    return store.makeQualified(p).toString()


def write_tokens(docs: DataFrame, folder: str, end_id: int = 2, tokenizer: str | None = None, kind: str = "byte", id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int, int]]:
    """Encode every whole text, add ``end_id``, and write files in ascending order of ids; returns (file, documents, ids).

    Ranges of ids go to partitions, each of which writes one file or more; names ascend with the ids. What comes to the
    driver is a row for each file. Null and empty texts are one end id; a null id is written as null, first; repeated
    rows of a document stand one after the other. An empty table makes no file.
    """
    spark = docs.sparkSession
    path = tokenizer or encoding.tokenizer_path()
    folder = _make_folder(spark, folder)

    def run(batches):
        coder, part, made = encoding.load(path), TaskContext.get().partitionId(), 0
        doc_ids, counts, ids, held = [], [], [], 0
        done = {"name": [], "docs": [], "ids": []}

        def flush():
            nonlocal doc_ids, counts, ids, held, made
            name = f"tokens-{part:07d}-{made:05d}.tpl"
            _store(folder, name, encode_file(doc_ids, counts, np.concatenate(ids), kind))
            for k, v in (("name", name), ("docs", len(counts)), ("ids", held)):
                done[k].append(v)
            doc_ids, counts, ids, held, made = [], [], [], 0, made + 1

        for batch in batches:
            for start, stop in shared.steps(batch.column(1)):
                found, at = coder.encode(shared.as_bytes(batch.column(1).slice(start, stop - start)), end_id)
                doc_ids += [None if x == shared.NULL_ID else x for x in batch.column(0).slice(start, stop - start).to_pylist()]
                counts += np.diff(at).tolist()
                ids.append(found)
                held += len(found)
                if held >= ROLL:
                    flush()
        if counts:
            flush()
        yield pa.RecordBatch.from_pydict(done, schema=pa.schema([("name", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

    rows = shared.in_order(docs, shared.shuffle_partitions(spark), id_col, text_col).mapInArrow(shared.lean(run), "name string, docs long, ids long").collect()
    return sorted((r["name"], r["docs"], r["ids"]) for r in rows)


def read_tokens(spark: SparkSession, folder: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """From the files: ``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids_crc32`` of each document."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)
    before, total = {}, 0
    for name, _, n in files:
        before[name] = total
        total += n

    def run(batches):
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = data.as_py()
                index = read_index(data)
                ids = np.concatenate([*decode_blocks(data, index), np.zeros(0, np.uint32)]).astype("<u4")
                ends = np.cumsum(np.array(index["tokens"], np.int64))
                starts = ends - np.array(index["tokens"], np.int64)
                raw = memoryview(ids.view(np.uint8))
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(index["docs"], pa.int64()), pa.array(starts + before[path.rpartition("/")[2]]), pa.array(index["tokens"], pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    found = spark.read.format("binaryFile").option("pathGlobFilter", "tokens-*.tpl").load(folder).select("path", "content")
    return found.mapInArrow(shared.lean(run), schema)


def op9_token_files(spark, sf_dir):
    folder = shared.scratch_path(spark, "tokens")
    return read_tokens(spark, folder, write_tokens(shared.documents(spark, sf_dir), folder))
