"""WAV files to arrays and back, with the standard library and numpy; other codecs plug in."""

from __future__ import annotations

import io
import math
import uuid
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: FN10: a shorter file can't hold audio.
LEAST_BYTES = 1000


def decode(content: bytes, channels: int | None = 1, start_ms: float = 0, end_ms: float | None = None) -> tuple[int, np.ndarray]:
    """SRC7, SRC8, SRC11, DSP10: rate and samples (channels, n) at full scale 1; mixed to mono, or mono doubled and more than two cut.

    Frames outside the range, which is clamped to the file, aren't decoded.
    """
    with wave.open(io.BytesIO(content)) as f:
        rate, width, n, total = f.getframerate(), f.getsampwidth(), f.getnchannels(), f.getnframes()
        first = min(total, max(0, int(start_ms * rate / 1000)))
        last = total if end_ms is None else min(total, max(first, int(end_ms * rate / 1000)))
        f.setpos(first)
        raw = f.readframes(last - first)
    if width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] << 8 | b[:, 1] << 16 | b[:, 2] << 24) >> 8) / 2.0**23
    elif width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(float) - 128) / 128
    else:
        x = np.frombuffer(raw, f"<i{width}") / 2.0 ** (8 * width - 1)
    return rate, with_channels(x.reshape(-1, n).T, channels)


def with_channels(x: np.ndarray, channels: int | None) -> np.ndarray:
    """DSP10: samples (channels, n) mixed to mono, or mono doubled and more than two cut; None leaves them."""
    if channels == 1:
        return x.mean(axis=0, keepdims=True)
    if channels == 2:
        return np.repeat(x, 2, axis=0) if len(x) == 1 else x[:2]
    return x


def resample(x: np.ndarray, rate: int, to: int, lobes: int = 32) -> np.ndarray:
    """DSP5: samples (..., n) at another rate, by a Kaiser-windowed sinc that cuts off at the lower Nyquist frequency.

    An output sample lies ``down / up`` input samples after the one before, so the filter has ``up`` phases, and all
    outputs of a phase are one product of strided windows. Beyond its ends the signal is silent.
    """
    if rate == to or not x.shape[-1]:
        return x
    common = math.gcd(rate, to)
    up, down = to // common, rate // common
    width = min(1.0, to / rate)
    half = math.ceil(lobes / width)
    n, taps = -(-x.shape[-1] * up // down), np.arange(-half, half + 1)
    padded = np.concatenate([np.zeros((*x.shape[:-1], half)), x, np.zeros((*x.shape[:-1], half + 1))], axis=-1)
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * half + 1, axis=-1)
    out = np.zeros((*x.shape[:-1], n))
    for phase in range(min(up, n)):
        at, part = divmod(phase * down, up)
        distance = taps - part / up
        inside = np.clip(1 - (distance / (half + 1)) ** 2, 0, None)
        kernel = width * np.sinc(width * distance) * np.i0(9.0 * np.sqrt(inside)) / np.i0(9.0)
        wanted = len(range(phase, n, up))
        out[..., phase::up] = windows[..., at::down, :][..., :wanted, :] @ (kernel / kernel.sum())
    return out


def encode(samples: np.ndarray, rate: int) -> bytes:
    """SNK6: PCM_16."""
    x = np.atleast_2d(np.asarray(samples, float))
    pcm = np.clip(np.floor(x * 32768), -32768, 32767).astype("<i2")
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(len(x))
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(pcm.T.tobytes())
    return out.getvalue()


def list_files(spark: SparkSession, path: str, glob: str = "*.wav", recursive: bool = False) -> DataFrame:
    """SRC1, SRC2, SRC6: ``path`` and ``length`` of the files that match; contents aren't read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(path).select("path", "length")


def read_wav(spark: SparkSession, path: str, glob: str = "*.wav", channels: int = 1, recursive: bool = False, rate: int | None = None, fallback: Callable[[bytes], tuple[int, np.ndarray]] | None = None) -> DataFrame:
    """SRC7, SRC8, STR2: ``path, md5, sr, samples`` of each file; ``samples`` is mono, or one array per channel.

    With ``rate`` all are resampled to it; ``pitch_windows`` and ``hnr`` take one rate for all rows. What isn't PCM WAV goes
    to ``fallback``, which returns rate and samples (channels, n). Files that neither can read have a null ``sr``.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    rows = reader.load(path).select("path", F.md5("content").alias("md5"), "content")
    return _decoded(rows, ["path", "md5"], channels, rate, fallback)


def read_ranges(files: DataFrame, ranges: DataFrame, channels: int = 1, rate: int | None = None) -> DataFrame:
    """SRC11: the given parts of files (``path, content``): ``path, start_ms, end_ms, sr, samples`` per row of ``ranges``.

    A file travels to its ranges once a range; the frames of the range alone are decoded.
    """
    rows = ranges.select("path", "start_ms", "end_ms").join(files.select("path", "content"), "path")
    return _decoded(rows, ["path", "start_ms", "end_ms"], channels, rate, None)


def _decoded(rows: DataFrame, keep: list[str], channels: int, rate: int | None, fallback) -> DataFrame:
    kind = "array<float>" if channels == 1 else "array<array<float>>"
    ranged = "start_ms" in keep

    def one(content: bytes, *span):
        try:
            found, x = decode(content, channels, *span)
        except (wave.Error, EOFError):
            if fallback is None:
                return None, None
            try:
                found, x = fallback(content)
            except Exception:  # whatever a decoder raises on a broken file
                return None, None
            x = with_channels(np.atleast_2d(x), channels)
        if rate is not None:
            found, x = rate, resample(x, found, rate)
        return found, (x[0] if channels == 1 else x).tolist()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = zip(batch["start_ms"], batch["end_ms"], strict=True) if ranged else [()] * len(batch)
            read = [one(c, *span) for c, span in zip(batch["content"], spans, strict=True)]
            sr = pd.array([r for r, _ in read], dtype="Int32")
            yield batch[keep].assign(sr=sr, samples=pd.Series([x for _, x in read], index=batch.index, dtype=object))

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInPandas(run, f"{kept}, sr int, samples {kind}")


def wav_bytes(rows: DataFrame, samples: str = "samples", sr: str = "sr") -> DataFrame:
    """SNK6: adds the ``wav`` column."""

    @F.pandas_udf("binary")
    def to_wav(x: pd.Series, rate: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else encode(np.stack(a) if len(a) and isinstance(a[0], np.ndarray) else a, int(r)) for a, r in zip(x, rate, strict=True)])

    return rows.withColumn("wav", to_wav(F.col(samples), F.col(sr)))


def write_files(rows: DataFrame, folder: str, name: str = "filename", content: str = "wav") -> str:
    """SNK6-8: a file per row below a folder that all executors reach, by URI; names may have folders of their own.

    A folder without a scheme is one of the session's default store. Where the store can rename, a file is written aside
    first; object stores show a file when it is whole. So a task that runs twice does no harm. Returns the URI.
    """
    jvm = rows.sparkSession._jvm
    place = jvm.org.apache.hadoop.fs.Path(folder)
    uri = place.getFileSystem(rows.sparkSession._jsparkSession.sessionState().newHadoopConf()).makeQualified(place).toString()
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[len("file:") :]

    def run(part) -> None:
        store, root = pyarrow.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
        renames = store.type_name in ("local", "hdfs")
        for r in part:
            target = f"{root}/{r[name]}"
            parent = target.rpartition("/")[0]
            store.create_dir(parent, recursive=True)
            written = f"{parent}/.{uuid.uuid4().hex}" if renames else target
            with store.open_output_stream(written) as f:
                f.write(r[content])
            if renames:
                store.move(written, target)

    rows.select(name, content).foreachPartition(run)
    return uri
