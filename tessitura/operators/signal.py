"""Signals as arrays: framing, harmonicity, mixing. What has an FFT runs in Arrow batches, the rest as expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessitura.functions.music import col


def frames(signals: DataFrame, length: int = 2048, hop: int = 512, samples: str = "samples") -> DataFrame:
    """W0: a row per whole frame: the other columns, ``frame_idx`` and ``frame``. No padding."""
    n = F.floor((F.size(samples) - length) / hop).cast("int")
    starts = F.when(n >= 0, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    rest = [c for c in signals.columns if c != samples]
    rows = signals.select(*rest, samples, F.explode(starts).alias("frame_idx"))
    return rows.select(*rest, "frame_idx", F.slice(samples, F.col("frame_idx") * hop + 1, F.lit(length)).alias("frame"))


def lags(n: int, sr: float, fmin: float, fmax: float, most: int) -> range | None:
    """The lags of the pitches between fmin and fmax, or None if there are none to search."""
    first, last = max(1, int(sr / fmax)), min(most, int(sr / fmin))
    return range(first, last + 1) if first < last else None


def autocorrelation_hnr(x: np.ndarray, sr: float, fmin: float = 65.0, fmax: float = 1500.0) -> float | None:
    """DSP1 for one frame; None where no harmonicity is defined. The correlation is taken by FFT."""
    found = lags(len(x), sr, fmin, fmax, len(x) - 1)
    centred = np.asarray(x, float)
    centred = centred - centred.mean() if len(centred) else centred
    power = float(centred @ centred)
    if found is None or power < 1e-10:
        return None
    size = 1 << (2 * len(centred) - 1).bit_length()
    spectrum = np.fft.rfft(centred, size)
    correlation = np.fft.irfft(spectrum * spectrum.conj(), size)
    peak = float(np.clip(correlation[found.start : found.stop].max() / (power + 1e-10), 1e-6, 1 - 1e-6))
    return 10 * math.log10(peak / (1 - peak))


def cepstral_hnr(x: np.ndarray, sr: float, fmin: float = 65.0, fmax: float = 1500.0) -> float | None:
    """DSP2 for one frame: the cepstral peak over the median of the searched quefrencies."""
    found = lags(len(x), sr, fmin, fmax, len(x) // 2 - 1)
    if found is None:
        return None
    spectrum = np.fft.rfft(np.asarray(x, float) * np.hanning(len(x)))
    part = np.fft.irfft(np.log(1e-10 + np.abs(spectrum)))[found.start : found.stop]
    floor = max(float(np.median(np.abs(part))), 1e-10)
    return 20 * math.log10(abs(float(part.max())) / floor + 1e-10)


def autocorrelation_f0(x: np.ndarray, sr: float, fmin: float = 65.0, fmax: float = 1500.0, least: float = 0.5) -> float | None:
    """Pitch of one frame from the highest correlation, refined by a parabola; None where it is under ``least`` of the power.

    A lag overlaps less of the frame the longer it is, so correlations are scaled by the overlap. Of peaks within a tenth
    of the highest one the shortest lag counts, as multiples of a period correlate alike.
    """
    found = lags(len(x), sr, fmin, fmax, len(x) // 2)
    centred = np.asarray(x, float) - np.mean(x) if len(x) else np.zeros(0)
    power = float(centred @ centred)
    if found is None or power < 1e-10:
        return None
    size = 1 << (2 * len(centred) - 1).bit_length()
    spectrum = np.fft.rfft(centred, size)
    at = np.arange(found.start - 1, found.stop + 1)
    part = np.fft.irfft(spectrum * spectrum.conj(), size)[at] / power * len(x) / (len(x) - at)
    peaks = 1 + np.flatnonzero((part[1:-1] >= part[:-2]) & (part[1:-1] > part[2:]))
    if not len(peaks) or part[peaks].max() < least:
        return None
    i = int(peaks[part[peaks] >= 0.9 * part[peaks].max()][0])
    a, b, c = part[i - 1 : i + 2]
    return float(sr / (at[i] + 0.5 * (a - c) / (a - 2 * b + c)))


def spectral_hnr(x: np.ndarray, sr: float, f0: float | None, harmonics: int = 10, bandwidth: float = 40.0) -> float | None:
    """DSP3 for one frame: energy near the harmonics of f0 over the rest; None where it isn't finite."""
    if f0 is None or not f0 > 0:
        return None
    energy = np.abs(np.fft.rfft(np.asarray(x, float) * np.hanning(len(x)))) ** 2
    whole = float(energy.sum())
    if whole < 1e-10:
        return None
    at = np.fft.rfftfreq(len(x), 1 / sr)
    centres = f0 * np.arange(1, harmonics + 1)
    centres = centres[centres <= sr / 2]
    near = float(sum(energy[np.abs(at - c) <= bandwidth / 2].sum() for c in centres))
    return 10 * math.log10(near / max(whole - near, 1e-10)) if near > 0 else None


def hnr(frame, sr: float, method: str = "autocorrelation", f0=None, fmin: float = 65.0, fmax: float = 1500.0) -> Column:
    """UDF13: harmonicity of a frame column in dB by ``autocorrelation``, ``cepstral`` or ``spectral``; null where undefined."""
    if method == "spectral":

        @F.pandas_udf("double")
        def of_frames(x: pd.Series, f: pd.Series) -> pd.Series:
            return pd.Series([None if a is None else spectral_hnr(a, sr, b) for a, b in zip(x, f, strict=True)], dtype="float64")

        return of_frames(col(frame), col(f0))
    one = {"autocorrelation": autocorrelation_hnr, "cepstral": cepstral_hnr}.get(method)
    if one is None:
        raise ValueError(f"no such method: {method}")

    @F.pandas_udf("double")
    def of_frame(x: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else one(a, sr, fmin, fmax) for a in x], dtype="float64")

    return of_frame(col(frame))


def dot(a: Column, b: Column) -> Column:
    """AGG12."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def mix(a, b) -> Column:
    """SET4: the sum, as long as the shorter one."""
    a, b = col(a), col(b)
    n = F.least(F.size(a), F.size(b))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x + y)


def subtract(mixture, part) -> Column:
    """SET5."""
    return F.zip_with(col(mixture), col(part), lambda x, y: x - F.coalesce(y, F.lit(0)))


def fit_length(samples, n) -> Column:
    """DSP7: cut or padded with zeros to n samples."""
    s, n = col(samples), F.lit(n) if isinstance(n, int) else n
    return F.concat(F.slice(s, F.lit(1), n), F.array_repeat(F.lit(0.0), F.greatest(n - F.size(s), F.lit(0))))


def noise_gate(samples, threshold_db: float = -40.0, block: int = 1024) -> Column:
    """DSP6: zeros for every block of samples whose RMS is at most the threshold; the rest stays.

    An approximation: attack, release and ratio of the usual gates aren't specified, so none is made up.
    """
    s = col(samples)
    limit = 10 ** (threshold_db / 20)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(s) / block) - 1, F.lit(0)).cast("int"))

    def gated(i: Column) -> Column:
        part = F.slice(s, i * block + 1, F.lit(block))
        power = F.try_divide(dot(part, part), F.size(part))
        return F.when(power > limit * limit, part).otherwise(F.transform(part, lambda x: x * 0))

    return F.when(F.size(s) > 0, F.flatten(F.transform(starts, gated))).otherwise(s)


def to_pcm16(samples) -> Column:
    """FN9, FN8: floats of full scale 1 as 16-bit numbers, clipped."""
    return F.transform(col(samples), lambda x: F.greatest(F.lit(-32768), F.least(F.lit(32767), F.floor(x * 32768).cast("int"))))


def stem_sum(stems: DataFrame, but: str = "vocals") -> DataFrame:
    """AGG13: per track and sample, the sum of all stems other than one, from ``track_id, stem, sample_idx, value``."""
    return stems.where(F.col("stem") != but).groupBy("track_id", "sample_idx").agg(F.sum("value").alias("value"))
