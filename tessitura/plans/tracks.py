"""The staged run over tracks as a plan: which tracks run, what each stage's outcome means, and the documents that result."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.functions import text
from tessitura.operators import jobs, models, pitch


@dataclass(frozen=True)
class RunConfig:
    """D16: the parameters of a run; names outside the known backends are refused (FIL11)."""

    separation_backend: str | None = None
    dereverb_backend: str | None = None
    f0_up_key: int = 0
    f0_method: str = "rmvpe"
    index_rate: float = 0.75
    rms_mix_rate: float = 0.25
    protect: float = 0.33
    min_silence_ms: int = 2000
    silence_db: float = -40.0
    keep_silence_ms: int = 100
    min_segment_ms: int = 3000
    do_separation: bool = True
    do_rvc: bool = True
    do_reassembly: bool = True
    do_lyrics_eval: bool = False
    force: bool = False
    no_cache: bool = False

    def __post_init__(self) -> None:
        jobs.check_backend(self.separation_backend, models.SEPARATION)
        jobs.check_backend(self.dereverb_backend, models.DEREVERB)

    @property
    def overwrites(self) -> bool:
        """CTL7: without a cache everything is done anew."""
        return self.force or self.no_cache

    def key(self) -> str:
        """Eight digits of the parameters that change an output, so other parameters aren't taken for done."""
        kept = {k: v for k, v in asdict(self).items() if k not in ("force", "no_cache")}
        return hashlib.md5(json.dumps(kept, sort_keys=True).encode()).hexdigest()[:8]


def keyed(tracks: DataFrame, config: RunConfig) -> DataFrame:
    """STR4: ``stem`` from the contents' md5 of source and model, and ``params_key``."""
    model = F.col("rvc_md5") if config.do_rvc and "rvc_md5" in tracks.columns else F.lit(None).cast("string")
    return tracks.withColumn("stem", text.output_stem("source_md5", model)).withColumn("params_key", F.lit(config.key()))


def pending(tracks: DataFrame, outputs: DataFrame, config: RunConfig) -> DataFrame:
    """FIL10: the keyed tracks that have no output yet; all of them if outputs are overwritten."""
    rows = keyed(tracks, config)
    return rows if config.overwrites else rows.join(outputs.select("stem", "params_key").distinct(), ["stem", "params_key"], "left_anti")


def outcomes(tracks: DataFrame, config: RunConfig) -> DataFrame:
    """CTL1, CTL2, CTL9: what the stages' results mean for a track.

    ``tracks`` has ``separated, dereverbed, has_instrumental, lyrics_ok`` (booleans) and ``num_segments,
    num_converted``; null is a stage that failed or did not run. A failed separation, no segment and no converted one end
    a track; a failed dereverberation falls back to the raw vocals, some converted segments are enough, and a failed
    lyrics evaluation is a warning. Added: ``status, vocals, mixed, warning``.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    count = lambda c: F.coalesce(F.col(c), F.lit(0))
    separation, rvc, reassembly, lyrics = (F.lit(x) for x in (config.do_separation, config.do_rvc, config.do_reassembly, config.do_lyrics_eval))
    status = (
        F.when(separation & ~yes("separated"), "separation_error").when(count("num_segments") == 0, "no_segments").when(rvc & (count("num_converted") == 0), "conversion_error").otherwise("ok")
    )
    ok = status == "ok"
    partial = rvc & (count("num_converted") < count("num_segments"))
    wanted = F.lit(config.dereverb_backend is not None)
    warning = F.array_join(
        F.array_compact(F.array(
            F.when(wanted & ~yes("dereverbed"), "dereverberation failed"), F.when(partial, "some segments weren't converted"), F.when(lyrics & ~yes("lyrics_ok"), "lyrics evaluation failed"),
        )), "; ",
    )
    return (
        tracks.withColumn("status", status).withColumn("vocals", F.when(ok, F.when(wanted & yes("dereverbed"), "dereverbed").otherwise("raw")))
        .withColumn("mixed", ok & reassembly & separation & yes("has_instrumental")).withColumn("warning", F.when(ok, warning))
    )


def stage_flags(config: RunConfig):
    """PRJ4."""
    return F.struct(
        F.lit(config.do_separation).alias("separation"), F.lit(config.dereverb_backend is not None).alias("dereverberation"), F.lit(True).alias("desilencing"), F.lit(config.do_rvc).alias("rvc"),
        F.lit(config.do_reassembly and config.do_separation).alias("reassembly"),
    )


def metadata(rows: DataFrame, config: RunConfig) -> DataFrame:
    """PRJ3, SNK3, AGG14: one JSON document per finished track, in ``metadata``; absent values are left out."""
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("string")
    body = F.struct(
        have("source_audio").alias("source_audio"), F.col("source_md5"), have("rvc_checkpoint_dir").alias("rvc_checkpoint_dir"), have("rvc_md5").alias("rvc_md5"), stage_flags(config).alias("stages"),
        F.lit(config.separation_backend).cast("string").alias("separation_backend"), F.lit(config.f0_up_key).alias("f0_up_key"), F.lit(config.f0_method).alias("f0_method"), F.lit(config.index_rate).alias("index_rate"),
        F.lit(config.rms_mix_rate).alias("rms_mix_rate"), F.lit(config.protect).alias("protect"), F.col("num_segments"), F.col("num_converted"), F.concat("stem", F.lit(".wav")).alias("output_wav"),
    )
    return rows.where("status = 'ok'").withColumn("metadata", F.to_json(body))


def summary(rows: DataFrame) -> DataFrame:
    """CTL3, AGG15: how many tracks succeeded; a failed one never stops the others."""
    return rows.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("succeeded"), F.count_if(F.coalesce("mixed", F.lit(False))).alias("mixed"), F.sum("num_segments").alias("segments"), F.sum("num_converted").alias("converted"))


def transposition(singers: DataFrame, ranges: DataFrame | None = None, on: str = "model_id", override: int | None = None) -> DataFrame:
    """CTL6, JN10: the shift of each track: given outright, or from the usable range of its model.

    ``ranges`` has ``on, low_hz, high_hz``; a track whose model has no range gets a null shift.
    """
    if override is not None:
        return singers.select(pitch.TRACK, F.lit(override).cast("int").alias("shift_semitones"))
    both = singers.join(ranges.select(on, F.col("low_hz").alias("range_low_hz"), F.col("high_hz").alias("range_high_hz")), on, "left")
    return pitch.pitch_shift(both, "range_low_hz", "range_high_hz").select(pitch.TRACK, "shift_semitones")
