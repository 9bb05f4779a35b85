"""CSV and JSON in and out, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessitura import schemas


def read_vad_ms(spark: SparkSession, path: str) -> DataFrame:
    """SRC9: ``start_ms, end_ms`` by header."""
    return spark.read.schema(schemas.VAD_MS).option("header", True).option("enforceSchema", False).csv(path)


def read_vad_seconds(spark: SparkSession, path: str) -> DataFrame:
    """The format that :func:`write_segments` writes."""
    return spark.read.schema(schemas.VAD_SECONDS).option("header", True).option("enforceSchema", False).csv(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """SRC10: one JSON document per file: its typed columns, and ``raw`` with the whole text, so no key is lost."""
    raw = spark.read.text(path, wholetext=True).withColumnRenamed("value", "raw")
    return raw.select("raw", F.from_json("raw", schemas.TRACK_METADATA).alias("m")).select("m.*", "raw")


def f0_rows(frames: DataFrame, *keep: str) -> DataFrame:
    """SNK1: the columns of the F0 file as text of fixed decimals; an HNR that is null or not finite is an empty field."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    fixed = lambda c, d: F.when(finite(c), F.format_string(f"%.{d}f", F.col(c)))
    return frames.select(*keep, fixed("time", 6).alias("time"), fixed("f0_hz", 3).alias("f0_hz"), fixed("f0_midi", 3).alias("f0_midi"), F.col("voiced").cast("int").alias("voiced"), fixed("hnr_db", 2).alias("hnr_db"))


def write_f0(frames: DataFrame, path: str, track: str | None = None) -> None:
    """SNK1: the F0 file of one track in order of time; with ``track``, a column, a folder for each of its values.

    A track is one task's rows and one file; tracks are dealt over the tasks and none waits for a sort of all.
    """
    if track is None:
        rows = f0_rows(frames.orderBy("time"))
    else:
        ordered = frames.repartition(track).sortWithinPartitions(track, "time")
        rows = f0_rows(ordered, track)
    out = rows.write.mode("overwrite").option("header", True).option("emptyValue", "")
    (out if track is None else out.partitionBy(track)).csv(path)


def write_segments(segments: DataFrame, path: str) -> None:
    """SNK2: ``start_time,end_time`` in seconds."""
    segments.write.mode("overwrite").option("header", True).csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """SNK3-5: a JSON object per line; text stays as it is, nulls are left out."""
    rows.write.mode("overwrite").json(path)


def pretty(row) -> "F.Column":
    """SNK3, SNK11: a struct as indented JSON."""
    return F.to_json(row, {"pretty": "true"})
