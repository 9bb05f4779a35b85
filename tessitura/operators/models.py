"""Where models plug in: batch functions over Arrow, loaded once per worker. No model comes with the library."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.operators import signal

SEPARATION = ("demucs", "roformer", "mdxchain", "uvr5")
DEREVERB = ("vrnet", "mbr")

_FACTORIES: dict[tuple[str, str], Callable] = {}
_LOADED: dict[tuple[str, str], Callable] = {}


def register(kind: str, name: str, factory: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]) -> None:
    """UDF1, UDF14: ``factory`` loads a model and returns a function from one batch of rows to another."""
    _FACTORIES[kind, name] = factory


def get(kind: str, name: str | None) -> Callable | None:
    """The factory of a model; None for no name (the stage is skipped)."""
    if name is None:
        return None
    if (kind, name) not in _FACTORIES:
        raise ValueError(f"no {kind} model {name!r}; register() one")
    return _FACTORIES[kind, name]


def apply(rows: DataFrame, kind: str, name: str | None, schema: str) -> DataFrame:
    """UDF2-12, UDF15: run a model over all rows; with no name the rows stay as they are.

    The model is loaded once per Python worker, and batches stream through it, so fetching the next overlaps with
    inference (STM3). The function may return fewer rows than it got: failures drop out (UDF9).
    """
    factory = get(kind, name)
    if factory is None:
        return rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _LOADED.get((kind, name)) or _LOADED.setdefault((kind, name), factory())
        for batch in batches:
            yield model(batch)

    return rows.mapInPandas(run, schema)


def separate_chain(tracks: DataFrame, first: str, second: str) -> DataFrame:
    """UDF4, SET4: ``track_id, vocals, instrumental`` of ``track_id, samples`` by two separation models in a row.

    The first parts the mixture into vocals and instrumental, the second the vocals into lead and backing, which becomes
    part of the instrumental. Both are registered under ``separation``, take ``track_id, samples`` and return
    ``track_id, vocals, instrumental``; a track is once in a batch.
    """
    schema = f"track_id {tracks.schema['track_id'].dataType.simpleString()}, vocals array<double>, instrumental array<double>"
    factories = get("separation", first), get("separation", second)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = (_LOADED.get(k) or _LOADED.setdefault(k, f()) for k, f in zip((("separation", first), ("separation", second)), factories, strict=True))
        for batch in batches:
            split = one(batch)
            again = two(split[["track_id", "vocals"]].rename(columns={"vocals": "samples"}))
            again = again.rename(columns={"instrumental": "backing"})
            yield again.merge(split[["track_id", "instrumental"]], on="track_id")[["track_id", "vocals", "instrumental", "backing"]]

    rows = tracks.select("track_id", "samples").mapInPandas(run, schema + ", backing array<double>")
    return rows.select("track_id", "vocals", signal.mix("instrumental", "backing").alias("instrumental"))


def residual(separated: DataFrame, mixture: str = "samples", vocals: str = "vocals") -> DataFrame:
    """SET5: adds ``instrumental``, what is left of the mixture without the vocals, for models that return vocals alone."""
    return separated.withColumn("instrumental", signal.subtract(mixture, vocals))


def with_fallback(rows: DataFrame, processed: DataFrame, raw: str, done: str, key: str = "track_id") -> DataFrame:
    """UDF7, CTL2: the processed samples where there are some, fitted to the raw ones' length (DSP7), else the raw ones."""
    joined = rows.join(processed.select(key, F.col(done).alias("_done")), key, "left")
    fitted = signal.fit_length("_done", F.size(raw))
    return joined.withColumn(raw, F.when(F.col("_done").isNotNull(), fitted).otherwise(F.col(raw))).withColumn("processed", F.col("_done").isNotNull()).drop("_done")
