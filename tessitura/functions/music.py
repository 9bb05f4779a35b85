"""Pitch arithmetic as column expressions. Hz at or below zero is unpitched; rounding is half-even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAMES = ("C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B")


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rounded(x, digits: int) -> Column:
    """Half-even to ``digits`` after rounding to 6, so that the order of a distributed sum can't decide a tie."""
    return F.bround(F.bround(col(x), 6), digits)


def midi_float(hz) -> Column:
    """FN2: fractional MIDI number, -1 for unpitched, null for null."""
    hz = col(hz)
    return F.when(hz > 0, 12 * F.log2(hz / 440) + 69).when(hz.isNotNull(), F.lit(-1.0))


def midi_int(hz) -> Column:
    """FN1: nearest MIDI number."""
    return F.bround(midi_float(hz)).cast("int")


def f0_midi(hz) -> Column:
    """FN3: the contour's MIDI column, 0 for unpitched; its small constant differs from FN1."""
    hz = col(hz)
    return F.when(hz > 0, 12 * F.log2(hz / 440 + F.lit(1e-10)) + 69).otherwise(F.lit(0.0))


def hz(midi) -> Column:
    """FN4."""
    return F.lit(440.0) * F.pow(F.lit(2.0), (col(midi) - 69) / 12)


def note_of_midi(midi) -> Column:
    """FN5: name and octave of an integer MIDI number, negative ones included."""
    m = col(midi)
    name = F.element_at(F.array(*map(F.lit, NAMES)), (F.pmod(m, F.lit(12)) + 1).cast("int"))
    return F.concat(name, (F.floor(m / 12) - 1).cast("string"))


def note_of_hz(frequency) -> Column:
    """FN5: ``?`` for unpitched."""
    f = col(frequency)
    return F.when(f > 0, note_of_midi(midi_int(f))).otherwise(F.lit("?"))


def clock(seconds) -> Column:
    """FN7: ``m:ss.ss``."""
    s = col(seconds)
    return F.format_string("%d:%05.2f", F.floor(s / 60).cast("int"), s - 60 * F.floor(s / 60))


def clip(x, low, high) -> Column:
    """FN8."""
    return F.greatest(F.lit(low), F.least(F.lit(high), col(x)))


def octave_shift(semitones) -> Column:
    """FN6: the nearest whole octaves, ties to the even octave."""
    return (F.bround(col(semitones) / 12) * 12).cast("int")
