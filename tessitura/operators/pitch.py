"""From pitch frames to windows, stable ranges, note statistics and octave shifts.

Every window function is partitioned by track, so tracks spread over the cluster and nothing meets in one task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions import music
from tessitura.operators import models, signal

TRACK = "track_id"


def frames_per_window(window_ms: float = 500, sr: int = 16000, hop: int = 256) -> int:
    """W1: truncated, so 500 ms are 31 frames at the defaults."""
    return max(1, int(window_ms / 1000 * sr / hop))


def pitch_windows(frames: DataFrame, sr: int = 16000, hop: int = 256, window_ms: float = 500) -> DataFrame:
    """W1, AGG2-7: tumbling windows of whole frames per track; a partial last one is dropped.

    Under three voiced frames a window has no spread, no HNR and a mean of 0.
    """
    wf = frames_per_window(window_ms, sr, hop)
    f = frames.withColumn("_midi", music.f0_midi("f0_hz"))
    voiced = F.coalesce(F.col("voiced"), F.lit(False)) & (F.col("_midi") > 0)
    enough = F.col("n_voiced") >= 3
    grouped = f.groupBy(TRACK, F.floor(F.col("frame_idx") / wf).cast("int").alias("index")).agg(
        F.count("*").alias("_frames"), F.count_if(voiced).alias("n_voiced"), F.stddev_pop(F.when(voiced, F.col("_midi"))).alias("_std"),
        F.avg(F.when(voiced, F.col("_midi"))).alias("_mean"), F.percentile(F.when(voiced, F.col("hnr_db")), 0.5).alias("_hnr"),
    ).where(F.col("_frames") == wf)
    mean = F.when(enough, F.col("_mean")).otherwise(0.0)
    hz = F.when(enough, music.hz("_mean")).otherwise(0.0)
    return grouped.select(
        TRACK, "index", music.rounded(F.col("index") * wf * F.lit(hop) / sr, 3).alias("t_start"), music.rounded(((F.col("index") + 1) * wf - 1) * F.lit(hop) / sr, 3).alias("t_end"),
        music.rounded(F.col("n_voiced") / F.lit(wf), 3).alias("voiced_ratio"), F.when(enough, music.rounded("_std", 3)).alias("std_semitones"), F.when(enough, music.rounded("_hnr", 1)).alias("median_hnr_db"),
        music.rounded(mean, 2).alias("mean_midi"), music.rounded(hz, 1).alias("mean_hz"), music.note_of_hz(hz).alias("note"),
    )


def trailing_baseline(windows: DataFrame, lookback: int = 4) -> DataFrame:
    """W2: median HNR of the previous ``lookback`` positions, nulls aside, the current one not included."""
    before = Window.partitionBy(TRACK).orderBy("index").rowsBetween(-lookback, -1)
    return windows.withColumn("baseline_hnr_db", F.percentile("median_hnr_db", 0.5).over(before))


def mark_stable(windows: DataFrame, std: float = 3.0, voiced: float = 0.9, hnr_drop: float = 6.0) -> DataFrame:
    """W3: on the rounded columns; a null spread is never stable, a null HNR only if nothing came before."""
    based = trailing_baseline(windows)
    hnr_ok = F.when(F.col("baseline_hnr_db").isNull(), F.lit(True)).otherwise(F.coalesce(F.col("median_hnr_db") >= F.col("baseline_hnr_db") - F.lit(hnr_drop), F.lit(False)))
    return based.withColumn("stable", (F.col("voiced_ratio") >= voiced) & F.coalesce(F.col("std_semitones") < std, F.lit(False)) & hnr_ok)


def islands(rows: DataFrame, position: str, step: int) -> DataFrame:
    """Gaps and islands: numbers the runs of rows whose positions are at most ``step`` apart, per track."""
    order = Window.partitionBy(TRACK).orderBy(position)
    fresh = F.coalesce((F.col(position) - F.lag(position).over(order) > step).cast("int"), F.lit(1))
    return rows.withColumn("_fresh", fresh).withColumn("_island", F.sum("_fresh").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_fresh")


def longest_run(stable: DataFrame, gap_tolerance: int = 0) -> DataFrame:
    """W4: per track the longest span of stable windows with at most ``gap_tolerance`` others in a row inside; ties: the earliest."""
    runs = islands(stable.where("stable").select(TRACK, "index"), "index", gap_tolerance + 1)
    spans = runs.groupBy(TRACK, "_island").agg(F.min("index").alias("start_window"), F.max("index").alias("end_window"))
    first = Window.partitionBy(TRACK).orderBy((F.col("end_window") - F.col("start_window")).desc(), "start_window")
    return spans.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").select(TRACK, "start_window", "end_window")


def stable_range(stable: DataFrame, gap_tolerance: int = 0) -> DataFrame:
    """W6, AGG6, AGG10: a row per track with its range, nulls and 0 semitones where nothing is stable."""
    best = longest_run(stable, gap_tolerance)
    inside = F.col("index").between(F.col("start_window"), F.col("end_window"))
    pitched = inside & F.col("stable") & (F.col("mean_midi") > 0)
    low, high = F.col("low_midi"), F.col("high_midi")
    summed = stable.join(best, TRACK, "left").groupBy(TRACK).agg(
        F.count("*").alias("n_windows"), F.count_if("stable").alias("n_stable"), F.first("start_window").alias("start_window"), F.first("end_window").alias("end_window"),
        F.min(F.when(pitched, F.col("mean_midi"))).alias("low_midi"), F.max(F.when(pitched, F.col("mean_midi"))).alias("high_midi"),
        F.min(F.when(inside, F.col("t_start"))).alias("low_time"), F.max(F.when(inside, F.col("t_end"))).alias("high_time"),
    )
    return summed.select(
        TRACK, "n_windows", "n_stable", "start_window", "end_window", "low_midi", "high_midi", F.when(low > 0, music.note_of_hz(music.hz(low))).alias("low"), F.when(high > 0, music.note_of_hz(music.hz(high))).alias("high"),
        F.when(low > 0, music.rounded(music.hz(low), 1)).alias("low_hz"), F.when(high > 0, music.rounded(music.hz(high), 1)).alias("high_hz"), "low_time", "high_time",
        F.coalesce(F.bround(high - low), F.lit(0)).cast("int").alias("semitones"),
    )


def with_hnr(contour: DataFrame, hnr: DataFrame, pad: bool = True) -> DataFrame:
    """JN5: the contour's frames with ``hnr_db`` of the harmonicity frame of the same number, see :func:`hnr_frames`.

    With ``pad`` frames beyond the shorter side have none (stability windows); else they go (statistics per note).
    """
    return contour.join(hnr.select(TRACK, "frame_idx", "hnr_db"), [TRACK, "frame_idx"], "left" if pad else "inner")


def contours(signals: DataFrame, name: str | None = None, length: int = 2048, hop: int = 256, sr: float = 16000, fmin: float = 65.0, fmax: float = 1500.0) -> DataFrame:
    """DSP4: ``track_id, frame_idx, f0_hz, voiced`` of signals (``track_id, samples`` at ``sr``); an unvoiced frame has 0 Hz.

    ``name`` is a pitch tracker registered as ``models.register("pitch", name, ...)`` that takes whole signals and returns
    these columns. Without one, each frame has the pitch of its autocorrelation, and no frame knows its neighbours.
    """
    track = signals.schema[TRACK].dataType.simpleString()
    schema = f"{TRACK} {track}, frame_idx int, f0_hz double, voiced boolean"
    if name is not None:
        return models.apply(signals.select(TRACK, "samples"), "pitch", name, schema)

    @F.pandas_udf("double")
    def pitch_of(x: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else signal.autocorrelation_f0(a, sr, fmin, fmax) for a in x], dtype="float64")

    rows = signal.frames(signals.select(TRACK, "samples"), length, hop).select(TRACK, "frame_idx", pitch_of("frame").alias("_hz"))
    return rows.select(TRACK, "frame_idx", F.coalesce("_hz", F.lit(0.0)).alias("f0_hz"), F.col("_hz").isNotNull().alias("voiced"))


def hnr_frames(signals: DataFrame, length: int = 2048, hop: int = 256, sr: float = 16000, method: str = "autocorrelation", **limits) -> DataFrame:
    """W0, UDF13: ``track_id, frame_idx, hnr_db`` of signals (``track_id, samples`` at ``sr``)."""
    rows = signal.frames(signals.select(TRACK, "samples"), length, hop)
    return rows.select(TRACK, "frame_idx", signal.hnr("frame", sr, method, **limits).alias("hnr_db"))


def note_stats(frames: DataFrame, sr: int = 16000, hop: int = 512) -> DataFrame:
    """AGG1, FIL1, FIL4: HNR statistics of each MIDI note of a track, over voiced frames with a finite HNR."""
    kept = frames.where("voiced and f0_hz > 0 and hnr_db is not null").withColumn("midi", music.midi_int("f0_hz")).where("midi >= 0")
    at = lambda c: music.rounded(F.col(c) * F.lit(hop) / sr, 3)
    stats = kept.groupBy(TRACK, "midi").agg(
        F.avg("hnr_db").alias("_mean"), F.percentile("hnr_db", 0.5).alias("_median"), F.min("hnr_db").alias("_min"), F.count("*").alias("n_frames"), F.min("frame_idx").alias("_first"), F.max("frame_idx").alias("_last")
    )
    return stats.select(
        TRACK, "midi", music.note_of_midi("midi").alias("note"), music.rounded(music.hz("midi"), 1).alias("hz"), music.rounded("_mean", 1).alias("mean_hnr"), music.rounded("_median", 1).alias("median_hnr"),
        music.rounded("_min", 1).alias("min_hnr"), "n_frames", at("_first").alias("first_time"), at("_last").alias("last_time"),
    )


def note_run(notes: DataFrame, hnr_threshold: float = 5.0) -> DataFrame:
    """W5, FIL5, W6: per track the longest run of usable notes at most two semitones apart, by notes, ties to the lowest."""
    usable = islands(notes.where(F.col("median_hnr") >= hnr_threshold), "midi", 2)
    runs = usable.groupBy(TRACK, "_island").agg(
        F.min("midi").alias("low_midi"), F.max("midi").alias("high_midi"), F.count("*").alias("n_notes"), F.min_by("first_time", "midi").alias("low_time"), F.max_by("last_time", "midi").alias("high_time")
    )
    order = Window.partitionBy(TRACK).orderBy(F.desc("n_notes"), "low_midi")
    best = runs.withColumn("_rank", F.row_number().over(order)).where("_rank = 1")
    best = best.select(
        TRACK, "low_midi", "high_midi", "n_notes", music.note_of_midi("low_midi").alias("low"), music.note_of_midi("high_midi").alias("high"), music.rounded(music.hz("low_midi"), 1).alias("low_hz"),
        music.rounded(music.hz("high_midi"), 1).alias("high_hz"), "low_time", "high_time", (F.col("high_midi") - F.col("low_midi") + 1).alias("semitones"),
    )
    return notes.select(TRACK).distinct().join(best, TRACK, "left").withColumn("semitones", F.coalesce("semitones", F.lit(0)))


def singer_stats(frames: DataFrame) -> DataFrame:
    """AGG8, FIL3: a row per track; one without voiced frames keeps nulls and an error."""
    voiced = F.coalesce(F.col("voiced"), F.lit(False)) & (F.col("f0_hz") > 0)
    m = F.when(voiced, music.midi_float("f0_hz"))
    agg = frames.groupBy(TRACK).agg(F.avg(m).alias("_mean"), F.percentile(m, 0.5).alias("_median"), F.min(m).alias("_low"), F.max(m).alias("_high"), F.count(m).alias("n_voiced_frames"))
    hz1 = lambda c: music.rounded(music.hz(c), 1)
    note = lambda c: F.when(F.col(c).isNotNull(), music.note_of_hz(music.hz(c)))
    return agg.select(
        TRACK, hz1("_mean").alias("mean_hz"), note("_mean").alias("mean_note"), music.rounded("_mean", 2).alias("mean_midi"), hz1("_median").alias("median_hz"), note("_median").alias("median_note"), music.rounded("_median", 2).alias("median_midi"),
        hz1("_low").alias("low_hz"), note("_low").alias("low_note"), hz1("_high").alias("high_hz"), note("_high").alias("high_note"), music.rounded(F.col("_high") - F.col("_low"), 1).alias("range_semitones"), "n_voiced_frames",
        F.when(F.col("n_voiced_frames") == 0, "no voiced frames").alias("error"),
    )


def pitch_shift(singers: DataFrame, low_hz, high_hz) -> DataFrame:
    """FN6, JN10: octaves that bring a singer's median into a range given by numbers or by columns of ``singers``."""
    low, high = (F.lit(float(x)) if isinstance(x, (int, float)) else music.col(x) for x in (low_hz, high_hz))
    s = singers.withColumn("_low", low).withColumn("_high", high).withColumn("_centre", (music.midi_float("_low") + music.midi_float("_high")) / 2)
    s = s.withColumn("_exact", F.col("_centre") - F.col("median_midi")).withColumn("_shift", music.octave_shift("_exact")).withColumn("_to", music.hz(F.col("median_midi") + F.col("_shift")))
    moved = lambda c: music.rounded(music.hz(music.midi_float(c) + F.col("_shift")), 1)
    target = F.struct(
        F.col("_low").alias("low_hz"), music.note_of_hz("_low").alias("low_note"), F.col("_high").alias("high_hz"), music.note_of_hz("_high").alias("high_note"),
        music.rounded(music.hz("_centre"), 1).alias("center_hz"), music.note_of_hz(music.hz("_centre")).alias("center_note"),
    )
    return s.select(
        TRACK, target.alias("target_range"), F.col("_shift").alias("shift_semitones"), F.floor(F.col("_shift") / 12).cast("int").alias("shift_octaves"), music.rounded("_exact", 2).alias("shift_exact_semitones"),
        music.rounded("_to", 1).alias("shifted_median_hz"), F.when(F.col("_to").isNotNull(), music.note_of_hz("_to")).alias("shifted_median_note"), moved("low_hz").alias("shifted_low_hz"), moved("high_hz").alias("shifted_high_hz"),
        F.col("_to").between(F.col("_low"), F.col("_high")).alias("median_in_target_range"),
    )
