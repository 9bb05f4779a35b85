"""Timed segments: silence, padding, numbering, overlap joins and reassembly."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRACK = "track_id"


def activity_ranges(levels: DataFrame, at: str = "at_ms", min_gap: int = 2000, step: int = 1) -> DataFrame:
    """Ranges of active positions of a track: a gap of at least ``min_gap`` ends one. Gaps and islands."""
    order = Window.partitionBy(TRACK).orderBy(at)
    rows = levels.select(TRACK, at).withColumn("_new", F.coalesce((F.col(at) - F.lag(at).over(order) >= min_gap).cast("int"), F.lit(1)))
    rows = rows.withColumn("_range", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(TRACK, "_range").agg(F.min(at).alias("start_ms"), (F.max(at) + F.lit(step)).alias("end_ms")).drop("_range")


def non_silent(levels: DataFrame, threshold_db: float = -40.0, min_silence: int = 2000, step: int = 1) -> DataFrame:
    """W9: ranges outside silences, from ``track_id, at_ms, rms`` (one row each ``step`` ms, full scale 1).

    A stretch of ``min_silence`` ms is silent if its RMS is at most the threshold; silent stretches are merged, and what
    lies between them is returned. An approximation of a library whose step rules aren't specified.
    """
    n = max(1, min_silence // step)
    track = Window.partitionBy(TRACK).orderBy("at_ms")
    ahead = track.rowsBetween(0, n - 1)
    limit = 10 ** (threshold_db / 20)
    rows = levels.select(TRACK, "at_ms", F.sqrt(F.avg(F.col("rms") * F.col("rms")).over(ahead)).alias("_level"), F.count("*").over(ahead).alias("_n"))
    rows = rows.withColumn("_starts", ((F.col("_level") <= limit) & (F.col("_n") == n)).cast("int"))
    rows = rows.withColumn("_silent", F.max("_starts").over(track.rowsBetween(-(n - 1), 0)) == 1)
    return activity_ranges(rows.where("not _silent"), "at_ms", min_gap=step + 1, step=step)


def vocal_segments(ranges: DataFrame, bounds: DataFrame | tuple[int, int] | None = None, min_segment: int = 3000, keep: int = 100) -> DataFrame:
    """FIL6, W7, W8: drops short ranges by their unpadded length, pads the rest within the track, numbers what is left.

    ``bounds`` has ``track_end_ms`` (and ``track_start_ms``) of each track, or is one start and end for all.
    """
    kept = ranges.where(F.col("end_ms") - F.col("start_ms") >= min_segment)
    begin, end = F.lit(0), None
    if isinstance(bounds, tuple):
        begin, end = F.lit(bounds[0]), F.lit(bounds[1])
    elif bounds is not None:
        kept = kept.join(bounds, TRACK)
        begin, end = F.col("track_start_ms") if "track_start_ms" in bounds.columns else begin, F.col("track_end_ms")
    low, high = F.greatest(F.col("start_ms") - keep, begin), F.col("end_ms") + keep
    number = F.row_number().over(Window.partitionBy(TRACK).orderBy("start_ms"))
    out = kept.withColumn("index", number).withColumn("start_ms", low).withColumn("end_ms", high if end is None else F.least(high, end))
    return out.select(TRACK, "index", "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"), F.format_string("%05d.wav", "index").alias("filename"))


def contained(points: DataFrame, segments: DataFrame, at: str = "at_ms", slot: int = 3_600_000) -> DataFrame:
    """JN7: points of a track within its half-open segments, which may overlap.

    The key of the join is the track and the slot of time: a segment stands in each slot that it reaches, so a long track
    is many keys, and a point meets only segments of its slot.
    """
    slots = F.sequence(F.floor(F.col("start_ms") / slot), F.floor((F.col("end_ms") - 1) / slot))
    s = segments.where("end_ms > start_ms").select(F.col(TRACK).alias("_track"), "index", "start_ms", "end_ms", F.explode(slots).alias("_slot"))
    same = (F.col(TRACK) == F.col("_track")) & (F.floor(F.col(at) / slot) == F.col("_slot"))
    return points.join(s, same & (F.col(at) >= F.col("start_ms")) & (F.col(at) < F.col("end_ms"))).drop("_track", "_slot")


def reassemble(segments: DataFrame, chunks: DataFrame) -> DataFrame:
    """JN1: every segment with its converted chunk, if there is one; ``missing`` marks those that stay silent."""
    marked = chunks.withColumn("_there", F.lit(True))
    return segments.join(marked, [TRACK, "filename"], "left").withColumn("missing", F.col("_there").isNull()).drop("_there")


def overlay(chunks: DataFrame, lengths: DataFrame, sr: int) -> DataFrame:
    """DSP8, JN8: mix ``samples`` of a track's chunks at ``start_ms`` onto silence of ``n_samples``; additive, length fixed."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        n = int(right["n_samples"].iloc[0]) if len(right) else 0
        out = np.zeros(n)
        for start, samples in zip(left["start_ms"], left["samples"], strict=True):
            if samples is None:
                continue
            at = int(start * sr / 1000)
            piece = np.asarray(samples, float)[: max(0, n - at)]
            out[at : at + len(piece)] += piece
        return pd.DataFrame({TRACK: [key[0]], "samples": [out.tolist()]})

    left, right = chunks.select(TRACK, "start_ms", "samples"), lengths.select(TRACK, "n_samples")
    kind = lengths.schema[TRACK].dataType.simpleString()
    return left.groupBy(TRACK).cogroup(right.groupBy(TRACK)).applyInPandas(run, f"{TRACK} {kind}, samples array<double>")


def slice_concat(samples: DataFrame, segments: DataFrame, sr: int) -> DataFrame:
    """DSP9, SET2, FIL12: the given ms ranges of a track's samples one after the other; 100 ms of silence if there are none."""
    ranges = segments.groupBy(TRACK).agg(F.sort_array(F.collect_list(F.struct("index", "start_ms", "end_ms"))).alias("_ranges"))
    total = F.size("samples")

    def piece(r):
        begin, end = F.greatest(F.lit(0), F.floor(r["start_ms"] * sr / 1000).cast("int")), F.least(total, F.floor(r["end_ms"] * sr / 1000).cast("int"))
        return F.when(end > begin, F.slice("samples", begin + 1, F.greatest(end - begin, F.lit(0))))

    joined = samples.join(ranges, TRACK, "left")
    cut = F.flatten(F.filter(F.transform(F.coalesce("_ranges", F.array().cast("array<struct<index:int,start_ms:bigint,end_ms:bigint>>")), piece), lambda p: p.isNotNull()))
    silence = F.array_repeat(F.lit(0.0), int(sr / 10)).cast(samples.schema["samples"].dataType)
    return joined.withColumn("_cut", cut).withColumn("samples", F.when(F.size("_cut") > 0, F.col("_cut")).otherwise(silence)).drop("_cut", "_ranges")


def to_seconds(segments: DataFrame) -> DataFrame:
    """SNK2, PRJ1."""
    return segments.select(TRACK, F.bround(F.col("start_ms") / 1000, 6).alias("start_time"), F.bround(F.col("end_ms") / 1000, 6).alias("end_time"))
