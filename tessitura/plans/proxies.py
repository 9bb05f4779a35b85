"""Views of the test tables that stand for audio-derived data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessitura.session import table

HOUR = 3_600_000


def _ms(ts):
    return F.unix_millis(ts.cast("timestamp"))


def frames(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """Pitch frames: a track per user, a frame per event."""
    e = table(spark, sf_dir, "events")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    voiced = F.col("event_type") != "error"
    k = F.get_json_object("props", "$.k").cast("int")
    return e.select(
        F.col("user_id").alias("track_id"), (F.row_number().over(order) - 1).alias("frame_idx"), voiced.alias("voiced"),
        F.when(voiced, F.lit(65) + F.col("value") if wide else F.lit(220) + F.col("value") / 10).otherwise(0.0).alias("f0_hz"), F.when(voiced & (k >= 5), k / 5.0 - 2).alias("hnr_db"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript pairs: the whole texts of a turn and the next one, and who speaks as their languages."""
    c = table(spark, sf_dir, "conversations")
    order = Window.partitionBy("conv_id").orderBy("turn")
    rows = c.select("conv_id", "turn", "text", "role", *[F.lead(x).over(order).alias(f"next_{x}") for x in ("text", "turn", "role")]).where(F.col("next_turn") == F.col("turn") + 1)
    return rows.select("conv_id", "turn", F.col("text").alias("source_text"), F.col("next_text").alias("converted_text"), F.col("role").alias("source_language"), F.col("next_role").alias("converted_language"))


def span(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """The first and the last moment of the table in ms since 1970: two numbers, as bounds for all tracks."""
    low, high = table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).select(_ms(F.col("min(ts)")), _ms(F.col("max(ts)"))).first()
    return low or 0, high or 0


def levels(spark: SparkSession, sf_dir: str, low: int) -> DataFrame:
    """Active moments in ms from ``low`` on, the table's first event: a track per user."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("track_id"), "event_id", (_ms(F.col("ts")) - F.lit(low)).alias("at_ms"))


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of the stages of a run: a track per customer."""
    cents = F.bround(F.abs("c_acctbal") * 100).cast("long")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("track_id"), F.md5("c_name").alias("source_md5"), F.md5("c_mktsegment").alias("rvc_md5"), (F.col("c_custkey") % 11 != 0).alias("separated"),
        F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey") % 4 != 0).alias("dereverbed"), (F.col("c_nationkey") % 3 != 0).alias("has_instrumental"), (cents % 7 != 0).alias("lyrics_ok"), (cents % 6).cast("int").alias("num_segments"),
        (F.floor(cents / 10) % 5).cast("int").alias("_most"),
    )
    return rows.withColumn("num_converted", F.least("num_segments", "_most")).drop("_most")


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("track_id"), F.col("embedding").alias("samples"))
