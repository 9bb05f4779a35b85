"""Files in and out, the incremental run, and the plan over tracks."""

from __future__ import annotations

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessitura import schemas
from tessitura.plans import tracks
from tessitura.sources import audio, files
from tessitura.streaming import incremental

DATA = os.environ.get("TEST_DATA", "/root/testdata")


def test_wav_round_trip(spark, tmp_path):
    wave = np.sin(np.arange(4000) / 20) * 0.5
    rows = spark.createDataFrame([("a.wav", wave.tolist(), 8000), ("b.wav", (wave / 2).tolist(), 8000)], "filename string, samples array<double>, sr int")
    audio.write_files(audio.wav_bytes(rows), str(tmp_path / "out"))
    (tmp_path / "out" / "broken.wav").write_bytes(b"RIFF")
    listed = audio.list_files(spark, str(tmp_path / "out"))
    assert listed.count() == 3 and listed.where(F.col("length") >= audio.LEAST_BYTES).count() == 2
    found = {r["path"].rpartition("/")[2]: r for r in audio.read_wav(spark, str(tmp_path / "out")).collect()}
    assert found["broken.wav"]["sr"] is None and found["a.wav"]["sr"] == 8000
    assert np.abs(np.array(found["a.wav"]["samples"]) - wave).max() < 1 / 32768 + 1e-6
    stereo = {r["path"].rpartition("/")[2]: r for r in audio.read_wav(spark, str(tmp_path / "out"), channels=2).collect()}
    assert len(stereo["b.wav"]["samples"]) == 2


@pytest.mark.parametrize("channels", [1, 2, 3])
def test_channels(channels):
    data = audio.encode(np.tile(np.linspace(-1, 0.9, 50), (channels, 1)), 44100)
    assert audio.decode(data, 1)[1].shape == (1, 50) and audio.decode(data, 2)[1].shape == (2, 50) and audio.decode(data, None)[1].shape == (channels, 50)


@pytest.mark.parametrize("rates", [(44100, 16000), (16000, 44100), (48000, 44100)])
def test_resampling(rates):
    tone = lambda rate, hz: np.sin(2 * np.pi * hz * np.arange(rate // 4) / rate)
    got = audio.resample(np.stack([tone(rates[0], 440), tone(rates[0], 1000)]), *rates)
    want = np.stack([tone(rates[1], 440), tone(rates[1], 1000)])
    assert got.shape == want.shape and np.abs(got - want)[:, 500:-500].max() < 1e-4
    assert audio.resample(np.zeros((1, 0)), *rates).shape == (1, 0)


def test_tones_beyond_the_lower_rate_go():
    assert np.abs(audio.resample(np.sin(2 * np.pi * 12000 * np.arange(22050) / 44100), 44100, 16000)[500:-500]).max() < 1e-4


def test_rates_ranges_and_fallback(spark, tmp_path):
    wave = np.sin(2 * np.pi * 440 * np.arange(4410) / 44100) * 0.5
    rows = spark.createDataFrame([("deep/er/a.wav", wave.tolist(), 44100)], "filename string, samples array<double>, sr int")
    uri = audio.write_files(audio.wav_bytes(rows), str(tmp_path / "out"))
    assert uri.startswith("file:///") and [p.name for p in (tmp_path / "out").rglob("*") if p.is_file() and not p.name.endswith(".crc")] == ["a.wav"]
    (tmp_path / "out" / "b.wav").write_bytes(b"other codec")
    (tmp_path / "out" / "c.wav").write_bytes(b"broken")

    def other(content):
        if content == b"broken":
            raise ValueError
        return 8000, np.zeros(800)

    found = {r["path"].rpartition("/")[2]: r for r in audio.read_wav(spark, str(tmp_path / "out"), recursive=True, rate=16000, fallback=other).collect()}
    assert {k: (r["sr"], r["samples"] and len(r["samples"])) for k, r in found.items()} == {"a.wav": (16000, 1600), "b.wav": (16000, 1600), "c.wav": (None, None)}
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "a.wav").load(uri)
    path = files.first()["path"]
    spans = spark.createDataFrame([(path, 10, 20), (path, 90, 200), (path, 150, 200)], "path string, start_ms long, end_ms long")
    cut = {r["start_ms"]: r["samples"] for r in audio.read_ranges(files, spans).collect()}
    assert {k: len(v) for k, v in cut.items()} == {10: 441, 90: 441, 150: 0} and np.abs(np.array(cut[10]) - wave[441:882]).max() < 1 / 32768 + 1e-6


def test_f0_of_many_tracks(spark, tmp_path):
    rows = [(t, i, i * 0.016, 440.0, 69.0, True, float("-inf") if i == 0 else 1.0) for i in reversed(range(300)) for t in ("x", "y", "z")]
    files.write_f0(spark.createDataFrame(rows, schemas.F0_FRAME).repartition(7), str(tmp_path / "f0"), track="track_id")
    for t in "xyz":
        (found,) = (tmp_path / "f0" / f"track_id={t}").glob("part-*.csv")
        lines = found.read_text().split("\n")
        assert lines[:2] == ["time,f0_hz,f0_midi,voiced,hnr_db", "0.000000,440.000,69.000,1,"]
        assert [float(x.split(",")[0]) for x in lines[1:301]] == [round(i * 0.016, 6) for i in range(300)]


def test_csv_files(spark, tmp_path):
    (tmp_path / "vad.csv").write_text("start_ms,end_ms\n0,1500\n2000,2500\n")
    assert [tuple(r) for r in files.read_vad_ms(spark, str(tmp_path / "vad.csv")).collect()] == [(0, 1500), (2000, 2500)]
    seconds = spark.createDataFrame([(0.0, 1.5)], schemas.VAD_SECONDS)
    files.write_segments(seconds, str(tmp_path / "seconds"))
    assert [tuple(r) for r in files.read_vad_seconds(spark, str(tmp_path / "seconds")).collect()] == [(0.0, 1.5)]
    frames = spark.createDataFrame([("t", 0, 0.0, 440.0, 69.0, True, 1.0), ("t", 1, 0.016, 0.0, 0.0, False, None)], schemas.F0_FRAME)
    files.write_f0(frames, str(tmp_path / "f0"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "f0").glob("part-*.csv")))
    assert lines.split("\n")[:3] == ["time,f0_hz,f0_midi,voiced,hnr_db", "0.000000,440.000,69.000,1,1.00", "0.016000,0.000,0.000,0,"]


def test_metadata_files(spark, tmp_path):
    (tmp_path / "metadata.json").write_text(json.dumps({"source_md5": "x", "stages": {"rvc": True}, "unknown": [1]}, indent=2))
    row = files.read_metadata(spark, str(tmp_path / "metadata.json")).first()
    assert row["source_md5"] == "x" and row["stages"]["rvc"] and row["stages"]["separation"] is None and json.loads(row["raw"])["unknown"] == [1]


def test_each_file_is_processed_once(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("in", "out", "progress"))
    run = lambda: incremental.process_new(spark, source, "id long", lambda df: df.withColumn("twice", F.col("id") * 2), sink, checkpoint)
    spark.range(3).write.parquet(source)
    run()
    run()
    spark.range(3, 5).write.mode("append").parquet(source)
    run()
    assert sorted(r["twice"] for r in spark.read.parquet(sink).collect()) == [0, 2, 4, 6, 8]


TRACKS = "track_id int, source_md5 string, rvc_md5 string, separated boolean, dereverbed boolean, has_instrumental boolean, lyrics_ok boolean, num_segments int, num_converted int"


def test_track_outcomes(spark):
    rows = [
        (1, "a", "m", True, True, True, True, 3, 3), (2, "b", "m", False, None, None, None, None, None), (3, "c", "m", True, False, True, False, 4, 2), (4, "d", "m", True, True, False, True, 0, 0),
        (5, "e", "m", True, True, True, True, 2, 0), (6, "f", "m", None, None, None, None, 1, 1),
    ]
    df = spark.createDataFrame(rows, TRACKS)
    found = {r["track_id"]: (r["status"], r["vocals"], r["mixed"], r["warning"]) for r in tracks.outcomes(df, tracks.RunConfig(dereverb_backend="mbr", do_lyrics_eval=True)).collect()}
    assert found == {
        1: ("ok", "dereverbed", True, ""), 2: ("separation_error", None, False, None), 3: ("ok", "raw", True, "dereverberation failed; some segments weren't converted; lyrics evaluation failed"),
        4: ("no_segments", None, False, None), 5: ("conversion_error", None, False, None), 6: ("separation_error", None, False, None),
    }
    bare = {r["track_id"]: (r["status"], r["mixed"]) for r in tracks.outcomes(df, tracks.RunConfig(do_separation=False, do_rvc=False)).collect()}
    assert bare[6] == ("ok", False) and bare[5] == ("ok", False) and bare[4] == ("no_segments", False)
    config = tracks.RunConfig(separation_backend="uvr5")
    docs = [json.loads(r["metadata"]) for r in tracks.metadata(tracks.keyed(tracks.outcomes(df, config), config), config).collect()]
    assert len(docs) == 2 and docs[0]["stages"] == {"separation": True, "dereverberation": False, "desilencing": True, "rvc": True, "reassembly": True} and docs[0]["output_wav"] == "source_a_rvcmodel_m.wav"
    assert tuple(tracks.summary(tracks.outcomes(df, config)).first()) == (6, 2, 2, 10, 6)


def test_pending_tracks(spark):
    df = spark.createDataFrame([(1, "a", "m"), (2, "b", "m")], "track_id int, source_md5 string, rvc_md5 string")
    config = tracks.RunConfig()
    done = tracks.keyed(df.where("track_id = 1"), config)
    left = lambda c: sorted(r["track_id"] for r in tracks.pending(df, done, c).collect())
    assert left(config) == [2] and left(tracks.RunConfig(force=True)) == [1, 2] and left(tracks.RunConfig(no_cache=True)) == [1, 2] and left(tracks.RunConfig(f0_up_key=12)) == [1, 2]
    assert tracks.keyed(df, tracks.RunConfig(do_rvc=False)).first()["stem"].endswith("norvc")
    with pytest.raises(ValueError):
        tracks.RunConfig(separation_backend="none")


def test_transposition(spark):
    singers = spark.createDataFrame([(1, "m", 45.0, 110.0, 120.0), (2, "n", 45.0, 110.0, 120.0)], "track_id int, model_id string, median_midi double, low_hz double, high_hz double")
    ranges = spark.createDataFrame([("m", 220.0, 440.0)], "model_id string, low_hz double, high_hz double")
    assert {r["track_id"]: r["shift_semitones"] for r in tracks.transposition(singers, ranges).collect()} == {1: 24, 2: None}
    assert {r["shift_semitones"] for r in tracks.transposition(singers, override=-12).collect()} == {-12}


def test_command_line(spark, tmp_path, capsys):
    from tessitura.__main__ import main

    out = str(tmp_path / "out")
    main(["job_summary", f"{DATA}/sf0.001", out, "--format", "json"])
    assert spark.read.json(out).first()["total"] == 200
    main(["stable_range", f"{DATA}/sf0.001", out, "--explain"])
    assert "Window" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["no_such_query", "a", "b"])
