"""Hand-worked cases and slow versions of the pitch, segment, text, job and signal operators."""

from __future__ import annotations

import math
import os
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessitura.functions import edits, music, text
from tessitura.operators import jobs, models, pitch, segments, signal
from tessitura.operators.text_eval import evaluate_pairs
from tessitura.plans import batch, catalogue

DATA = os.environ.get("TEST_DATA", "/root/testdata")


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_notes(spark):
    r = one(spark, a=music.note_of_hz(F.lit(440.0)), none=music.note_of_hz(F.lit(0.0)), low=music.note_of_midi(F.lit(-7)), m=music.midi_int(F.lit(0.0)), mid=music.midi_int(F.lit(261.63)), zero=music.f0_midi(F.lit(0.0)), clock=music.clock(F.lit(75.5)))
    assert (r["a"], r["none"], r["low"], r["m"], r["mid"], r["zero"], r["clock"]) == ("A4", "?", "F-2", -1, 60, 0.0, "1:15.50")


@pytest.mark.parametrize(("semitones", "octaves"), [(6.0, 0), (18.0, 24), (-6.0, 0), (7.0, 12), (-18.0, -24), (0.0, 0)])
def test_octave_ties(spark, semitones, octaves):
    assert one(spark, s=music.octave_shift(F.lit(semitones)))["s"] == octaves


def longest_run(mask, tolerance):
    best = None
    for i in range(len(mask)):
        gap = 0
        if not mask[i]:
            continue
        for j in range(i, len(mask)):
            gap = 0 if mask[j] else gap + 1
            if gap > tolerance:
                break
            if mask[j] and (best is None or j - i > best[1] - best[0]):
                best = (i, j)
    return best


@pytest.mark.parametrize("tolerance", [0, 1, 2])
def test_longest_run(spark, tolerance):
    rng = random.Random(tolerance)
    masks = [[1, 1, 0, 1, 1], [1, 0, 1], [1, 1, 0], [0, 0], *[[rng.random() < 0.6 for _ in range(rng.randint(1, 30))] for _ in range(80)]]
    rows = [(t, i, bool(x)) for t, m in enumerate(masks) for i, x in enumerate(m)]
    found = {r["track_id"]: (r["start_window"], r["end_window"]) for r in pitch.longest_run(spark.createDataFrame(rows, "track_id int, index int, stable boolean"), tolerance).collect()}
    assert found == {t: b for t, m in enumerate(masks) if (b := longest_run(m, tolerance))}


def test_note_run(spark):
    rows = [(1, m, 6.0, 0.0, 1.0) for m in (60, 62, 63, 66)] + [(2, 50, 1.0, 0.0, 1.0)]
    found = {r["track_id"]: (r["low_midi"], r["high_midi"], r["semitones"]) for r in pitch.note_run(spark.createDataFrame(rows, "track_id int, midi int, median_hnr double, first_time double, last_time double")).collect()}
    assert found == {1: (60, 63, 4), 2: (None, None, 0)}


def frames(spark, rows):
    return spark.createDataFrame(rows, "track_id int, frame_idx int, f0_hz double, voiced boolean, hnr_db double")


def test_windows_drop_the_partial_one(spark):
    rows = [(1, i, 440.0, True, 10.0) for i in range(12)] + [(2, i, 440.0, i < 2, 5.0) for i in range(5)]
    found = sorted(pitch.pitch_windows(frames(spark, rows), window_ms=80).collect(), key=lambda r: (r["track_id"], r["index"]))
    assert [(r["track_id"], r["index"]) for r in found] == [(1, 0), (1, 1), (2, 0)]
    assert (found[0]["note"], found[0]["std_semitones"], found[0]["median_hnr_db"], found[0]["voiced_ratio"]) == ("A4", 0.0, 10.0, 1.0)
    assert (found[2]["note"], found[2]["std_semitones"], found[2]["median_hnr_db"], found[2]["mean_midi"]) == ("?", None, None, 0.0)
    assert pitch.frames_per_window() == 31 and pitch.frames_per_window(hop=512) == 15 and pitch.frames_per_window(1) == 1


def test_trailing_baseline_and_stability(spark):
    rng = random.Random(8)
    values = [None if rng.random() < 0.3 else round(rng.uniform(0, 20), 1) for _ in range(60)]
    df = spark.createDataFrame([(1, i, 1.0, 0.1, v) for i, v in enumerate(values)], "track_id int, index int, voiced_ratio double, std_semitones double, median_hnr_db double")
    found = sorted(pitch.mark_stable(df, hnr_drop=3.0).collect(), key=lambda r: r["index"])
    for i, r in enumerate(found):
        before = [v for v in values[max(0, i - 4) : i] if v is not None]
        base = statistics.median(before) if before else None
        assert r["baseline_hnr_db"] == (pytest.approx(base) if before else None)
        assert r["stable"] == (True if base is None else values[i] is not None and values[i] >= base - 3.0)


def test_transposing_by_an_octave_moves_notes(spark):
    rng = random.Random(1)
    rows = [(1, i, rng.uniform(100, 400), True, rng.uniform(0, 9)) for i in range(200)]
    low = {r["midi"]: r["n_frames"] for r in pitch.note_stats(frames(spark, rows)).collect()}
    high = {r["midi"]: r["n_frames"] for r in pitch.note_stats(frames(spark, [(a, b, 2 * c, d, e) for a, b, c, d, e in rows])).collect()}
    assert high == {m + 12: n for m, n in low.items()}


def test_singer_without_voice_keeps_a_row(spark):
    found = {r["track_id"]: r for r in pitch.singer_stats(frames(spark, [(1, 0, 0.0, False, None), (2, 0, 440.0, True, None)])).collect()}
    assert found[1]["error"] == "no voiced frames" and found[1]["mean_hz"] is None and found[2]["mean_note"] == "A4" and found[2]["error"] is None


def test_segments(spark):
    ranges = spark.createDataFrame([(1, 50, 3050), (1, 10_000, 12_999), (1, 20_000, 24_000)], "track_id int, start_ms long, end_ms long")
    bounds = spark.createDataFrame([(1, 24_050)], "track_id int, track_end_ms long")
    found = sorted(tuple(r) for r in segments.vocal_segments(ranges, bounds).collect())
    assert found == [(1, 1, 0, 3150, 3150, "00001.wav"), (1, 2, 19_900, 24_050, 4150, "00002.wav")]


def test_non_silent_ranges(spark):
    loud = [*range(0, 300, 10), *range(700, 900, 10)]
    rows = [(1, t, 0.5 if t in loud else 0.0) for t in range(0, 1200, 10)]
    found = sorted((r["start_ms"], r["end_ms"]) for r in segments.non_silent(spark.createDataFrame(rows, "track_id int, at_ms long, rms double"), min_silence=200, step=10).collect())
    assert found == [(0, 300), (700, 900)]


def test_overlay_and_slices(spark):
    chunks = spark.createDataFrame([(1, 0, [1.0, 1.0]), (1, 1000, [2.0, 2.0, 2.0]), (1, 5000, None)], "track_id int, start_ms long, samples array<double>")
    lengths = spark.createDataFrame([(1, 4), (2, 2)], "track_id int, n_samples int")
    found = {r["track_id"]: r["samples"] for r in segments.overlay(chunks, lengths, 2).collect()}
    assert found == {1: [1.0, 1.0, 2.0, 2.0], 2: [0.0, 0.0]}
    samples = spark.createDataFrame([(1, [float(i) for i in range(20)]), (2, [1.0] * 20)], "track_id int, samples array<double>")
    cuts = spark.createDataFrame([(1, 2, 1500, 99_000), (1, 1, 0, 200), (2, 1, 90_000, 99_000)], "track_id int, index int, start_ms long, end_ms long")
    found = {r["track_id"]: r["samples"] for r in segments.slice_concat(samples, cuts, 10).collect()}
    assert found == {1: [0.0, 1.0, 15.0, 16.0, 17.0, 18.0, 19.0], 2: [0.0]}


@pytest.mark.parametrize(("raw", "plain"), [("Don't  STOP!", "dont stop"), ("  É a b\x1cc — d_1 ", "é a b c d_1"), ("", ""), ("日本、語", "日本語")])
def test_normalise(spark, raw, plain):
    assert one(spark, x=text.normalise(F.lit(raw)))["x"] == plain


def test_error_rates(spark):
    rng = random.Random(6)
    some = lambda: " ".join(rng.choice(["a", "bb", "ccc", "dd", "é"]) for _ in range(rng.randint(0, 12)))
    rows = [(some(), some()) for _ in range(60)] + [("", ""), ("", "a"), ("a", None), ("a b", "b c"), ("x", "x")]
    for r in evaluate_pairs(spark.createDataFrame(rows, "source_text string, converted_text string")).collect():
        a, b = (r["source_text"] or "").split(), (r["converted_text"] or "").split()
        if not a or not b:
            assert (r["wer"], r["hits"], bool(r["note"])) == (0.0 if a == b else 1.0, None, True)
            continue
        edits = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, edits = edits, [i]
            for j, y in enumerate(b, 1):
                edits.append(min(last[j - 1] + (x != y), last[j] + 1, edits[j - 1] + 1))
        assert r["word_edits"] == edits[-1] == r["substitutions"] + r["deletions"] + r["insertions"] and r["wer"] == edits[-1] / len(a)
        assert r["hits"] + r["substitutions"] + r["deletions"] == len(a) and r["hits"] + r["substitutions"] + r["insertions"] == len(b)
        assert r["wip"] == pytest.approx(r["hits"] ** 2 / len(a) / len(b)) and r["mer"] == pytest.approx(edits[-1] / (edits[-1] + r["hits"]))


def test_word_distance_of_many_distinct_words(spark):
    """More distinct words than there are characters of 16 bits for them; equal ones stay equal, others don't."""
    a = [f"w{i}" for i in range(38_000)]
    b = [a[35_327], a[35_328], a[37_999], "new"]
    df = spark.createDataFrame([(a[:36_000], b[:2]), (a[-300:], b)], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(text.word_distance(F.col("a"), F.col("b"))).collect()] == [35_998, 300]


@pytest.mark.parametrize("seed", range(4))
def test_alignment(seed):
    rng = random.Random(seed)
    for _ in range(60):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in "ab")
        table = [list(range(len(b) + 1))]
        for i, x in enumerate(a, 1):
            table.append([i])
            for j, y in enumerate(b, 1):
                table[i].append(min(table[i - 1][j - 1] + (x != y), table[i - 1][j] + 1, table[i][j - 1] + 1))
        i, j, counts = len(a), len(b), [0, 0, 0, 0]
        while i or j:
            if i and j and table[i][j] == table[i - 1][j - 1] + (a[i - 1] != b[j - 1]):
                counts[int(a[i - 1] != b[j - 1])] += 1
                i, j = i - 1, j - 1
            elif i and table[i][j] == table[i - 1][j] + 1:
                counts[2], i = counts[2] + 1, i - 1
            else:
                counts[3], j = counts[3] + 1, j - 1
        assert text.align(a, b) == tuple(counts)
    assert text.align(["a"] * 3000, ["a"] * 2999 + ["b"]) == (2999, 1, 0, 0)


def test_points_in_overlapping_segments(spark):
    rng = random.Random(3)
    points = [(t, rng.randint(0, 10_000)) for t in (1, 2) for _ in range(100)]
    spans = [(t, i, s, s + rng.choice([0, 1, 50, 4000])) for t in (1, 2, 3) for i, s in enumerate(rng.sample(range(9000), 12))]
    found = segments.contained(spark.createDataFrame(points, "track_id int, at_ms long"), spark.createDataFrame(spans, "track_id int, index int, start_ms long, end_ms long"), slot=700)
    assert sorted((r["track_id"], r["at_ms"], r["index"]) for r in found.collect()) == sorted((t, p, i) for t, p in points for u, i, a, b in spans if t == u and a <= p < b)


def test_harmonicity_of_frames_beside_a_contour(spark):
    tone = np.sin(2 * np.pi * 220 * np.arange(4000) / 16000).tolist()
    hnr = pitch.hnr_frames(spark.createDataFrame([(1, tone)], "track_id int, samples array<double>"), 2048, 512)
    contour = frames(spark, [(1, i, 220.0, True, None) for i in range(6)]).drop("hnr_db")
    padded = {r["frame_idx"]: r["hnr_db"] for r in pitch.with_hnr(contour, hnr).collect()}
    assert [padded[i] is not None and padded[i] > 10 for i in range(6)] == [True] * 4 + [False] * 2
    assert pitch.with_hnr(contour, hnr, pad=False).count() == 4


def test_checkpoints(spark):
    names = [("a", "G_1.pth"), ("a", "D_1.pth"), ("b", "G_2.pth"), ("b", "voice.pth"), ("b", "b.index"), ("b", "added_z.index"), ("c", "._G_3.pth"), ("c", "readme")]
    files = spark.createDataFrame(names, "folder string, name string")
    usable = {(r["folder"], r["name"]) for r in jobs.inference_checkpoints(files, "folder").collect()}
    assert usable == {("a", "G_1.pth"), ("b", "voice.pth"), ("c", "._G_3.pth")}
    assert [r["name"] for r in jobs.best_index(files, "folder").collect()] == ["added_z.index"]
    assert [r["name"] for r in jobs.stem_file(files, "folder", "VOICE").collect()] == ["voice.pth"]


def test_jobs(spark):
    listing = spark.createDataFrame([(f"run/{i}/{n}",) for i in range(4) for n in (*jobs.REQUIRED, "vad_segments.csv") if (i, n) not in ((1, "metadata.json"), (2, "vad_segments.csv"))], "path string")
    gate = {r["subprefix"]: (r["complete"], r["has_vad_segments_csv"]) for r in jobs.file_gate(listing).collect()}
    assert gate == {"run/0/": (True, True), "run/1/": (False, True), "run/2/": (True, False), "run/3/": (True, True)}
    items = jobs.prefixes(listing, "run/")
    done = spark.createDataFrame([("run/0/",)], "subprefix string")
    plan = lambda **k: sorted(r["subprefix"] for r in jobs.plan_jobs(items, done, **k).collect())
    assert plan(limit=2) == ["run/1/"] and plan(limit=2, overwrite=True) == ["run/0/", "run/1/"] and plan(only="run/3/") == ["run/3/"] and len(plan()) == 3
    summary = jobs.job_summary(spark.createDataFrame([("ok",), ("skipped_missing",), ("skipped_already_done",), ("download_error",)], "status string")).first()
    assert tuple(summary) == (4, 1, 2, 1, 1)


def test_metadata_upsert_keeps_other_keys(spark):
    docs = spark.createDataFrame([(1, '{"a": null, "lyrics_eval": 1, "deep": {"x": [1, 2.5]}}'), (2, '{"b": "é"}'), (3, '{"c": 1}')], "id int, doc string")
    values = spark.createDataFrame([(1, '{"wer": 0.5}'), (2, "null")], "id int, value string")
    import json

    found = {r["id"]: json.loads(r["doc"]) for r in jobs.upsert_key(docs, values, "lyrics_eval", "doc", "id").collect()}
    assert found == {1: {"a": None, "lyrics_eval": {"wer": 0.5}, "deep": {"x": [1, 2.5]}}, 2: {"b": "é", "lyrics_eval": None}, 3: {"c": 1}}
    assert one(spark, a=jobs.has_key(F.lit('{"lyrics_eval": null}'), "lyrics_eval"), b=jobs.has_key(F.lit("{}"), "lyrics_eval")).asDict() == {"a": True, "b": False}


def plain_autocorrelation(x, sr, fmin, fmax):
    x = np.asarray(x, float) - np.mean(x)
    lags = range(int(sr / fmax), min(int(sr / fmin), len(x) - 1) + 1)
    r = max(sum(x[i] * x[i + k] for i in range(len(x) - k)) for k in lags) / ((x @ x) + 1e-10)
    r = min(max(r, 1e-6), 1 - 1e-6)
    return 10 * math.log10(r / (1 - r))


def test_harmonicity(spark):
    rng = np.random.default_rng(0)
    t = np.arange(2048) / 16000
    tone, noise = np.sin(2 * np.pi * 220 * t), rng.normal(size=2048)
    assert signal.autocorrelation_hnr(tone[:400], 16000, 100) == pytest.approx(plain_autocorrelation(tone[:400], 16000, 100, 1500.0))
    for f in (lambda x: signal.autocorrelation_hnr(x, 16000), lambda x: signal.spectral_hnr(x, 16000, 220.0)):
        assert f(tone) > f(tone + 0.3 * noise) > f(noise)
    assert signal.autocorrelation_hnr(np.zeros(2048), 16000) is None and signal.spectral_hnr(tone, 16000, 0.0) is None and signal.cepstral_hnr(tone[:10], 16000) is None
    df = spark.createDataFrame([(tone.tolist(), 220.0), (None, None)], "frame array<double>, f0 double")
    for method in ("autocorrelation", "cepstral", "spectral"):
        found = [r[0] for r in df.select(signal.hnr("frame", 16000, method, "f0")).collect()]
        assert found[0] is not None and found[1] is None
    with pytest.raises(ValueError):
        signal.hnr("frame", 16000, "other")


def test_signal_arrays(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0], [1.0, 1.0])], "track_id int, a array<double>, b array<double>")
    r = df.select(signal.mix("a", "b").alias("m"), signal.subtract("a", signal.fit_length("b", 3)).alias("s"), signal.fit_length("a", 2).alias("f"), signal.to_pcm16(F.array(F.lit(2.0), F.lit(-2.0), F.lit(0.5))).alias("p"), signal.dot(F.col("a"), F.col("a")).alias("d")).first()
    assert (r["m"], r["s"], r["f"], r["p"], r["d"]) == ([2.0, 3.0], [0.0, 1.0, 3.0], [1.0, 2.0], [32767, -32768, 16384], 14.0)
    assert [r["frame"] for r in signal.frames(df.select("track_id", F.col("a").alias("samples")), 2, 1).collect()] == [[1.0, 2.0], [2.0, 3.0]]
    assert signal.frames(df.select("track_id", F.col("b").alias("samples")), 3, 1).count() == 0


def test_models_plug_in(spark):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(6)], "id long, text string")

    def factory():
        def model(batch: pd.DataFrame) -> pd.DataFrame:
            return batch[batch["id"] % 2 == 0].assign(text=lambda d: d["text"].str.upper())

        return model

    models.register("transcribe", "fake", factory)
    assert sorted(r["text"] for r in models.apply(rows, "transcribe", "fake", "id long, text string").collect()) == ["TEXT 0", "TEXT 2", "TEXT 4"]
    assert models.apply(rows, "transcribe", None, "id long, text string") is rows
    with pytest.raises(ValueError):
        models.apply(rows, "transcribe", "unknown", "id long")
    with pytest.raises(ValueError):
        jobs.check_backend("unknown", models.SEPARATION)


def test_contours_of_tones(spark):
    tone = lambda hz: (0.5 * np.sin(2 * np.pi * hz * np.arange(8192) / 16000) + 0.2 * np.sin(4 * np.pi * hz * np.arange(8192) / 16000)).tolist()
    noise = np.random.default_rng(1).normal(size=8192).tolist()
    signals = spark.createDataFrame([(1, tone(110.0)), (2, tone(441.5)), (3, noise), (4, [0.0] * 8192), (5, []), (6, None)], "track_id int, samples array<double>")
    found = pitch.contours(signals).groupBy("track_id").agg(F.avg("f0_hz").alias("hz"), F.count_if("voiced").alias("voiced"), F.count("*").alias("n")).collect()
    got = {r["track_id"]: r for r in found}
    assert set(got) == {1, 2, 3, 4} and abs(got[1]["hz"] - 110) < 1 and abs(got[2]["hz"] - 441.5) < 2
    assert got[1]["voiced"] == got[1]["n"] == 25 and got[3]["voiced"] == got[4]["voiced"] == 0


def test_pitch_tracker_plugs_in(spark):
    models.register("pitch", "fixed", lambda: lambda rows: pd.DataFrame({"track_id": rows["track_id"], "frame_idx": 0, "f0_hz": 220.0, "voiced": True}))
    signals = spark.createDataFrame([(1, [0.0])], "track_id int, samples array<double>")
    assert [tuple(r) for r in pitch.contours(signals, "fixed").collect()] == [(1, 0, 220.0, True)]


def test_chain_of_separations(spark):
    def halves():
        return lambda rows: pd.DataFrame({"track_id": rows["track_id"], "vocals": [np.array(x) / 2 for x in rows["samples"]], "instrumental": [np.array(x) / 2 for x in rows["samples"]]})

    models.register("separation", "one", halves)
    models.register("separation", "two", halves)
    rows = spark.createDataFrame([(1, [1.0, -2.0]), (2, [])], "track_id int, samples array<double>")
    got = {r["track_id"]: (r["vocals"], r["instrumental"]) for r in models.separate_chain(rows, "one", "two").collect()}
    assert got == {1: ([0.25, -0.5], [0.75, -1.5]), 2: ([], [])}
    left = models.residual(spark.createDataFrame([([1.0, 2.0], [0.25])], "samples array<double>, vocals array<double>")).first()
    assert left["instrumental"] == [0.75, 2.0]


def test_raw_samples_where_a_model_failed(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0])], "track_id int, samples array<double>")
    done = spark.createDataFrame([(1, [0.5])], "track_id int, clean array<double>")
    got = {r["track_id"]: (r["samples"], r["processed"]) for r in models.with_fallback(rows, done, "samples", "clean").collect()}
    assert got == {1: ([0.5, 0.0, 0.0], True), 2: ([1.0], False)}


def test_noise_gate_keeps_lengths(spark):
    rows = spark.createDataFrame([(1, [0.001, 0.001, 0.5, 0.5, 0.001]), (2, []), (3, None)], "id int, x array<double>")
    got = {r["id"]: r["y"] for r in rows.select("id", signal.noise_gate("x", -40, 2).alias("y")).collect()}
    assert got == {1: [0.0, 0.0, 0.5, 0.5, 0.0], 2: [], 3: None}


def test_report_lines(spark):
    results = spark.createDataFrame([("ok", 0.5, 0.25), ("skipped_missing", None, None), ("download_error", None, None)], "status string, wer double, cer double")
    assert batch.lines(results) == ["total: 3", "ok: 1", "skipped: 1", "errors: 1", "mean_wer: 0.5", "mean_cer: 0.25", "median_wer: 0.5", "exit_code: 1"]


def test_alignments_of_many_pairs():
    """Pairs that share steps have what each has alone, with numbers of 32 and of 64 bits."""
    rng = random.Random(3)
    for symbols, longest, count in ((3, 12, 400), (9, 90, 60), (4, 1100, 3)):
        pairs = [[[rng.randrange(symbols) for _ in range(rng.randint(0, longest))] for _ in "ab"] for _ in range(count)]
        sides = [(np.array([w for p in pairs for w in p[i]], np.int32), np.array([len(p[i]) for p in pairs])) for i in (0, 1)]
        assert [tuple(r) for r in edits.alignments(*sides)] == [text.align(*p) for p in pairs]


def test_alignment_of_a_batch_takes_steps_of_its_longest_pair(spark, monkeypatch):
    """Work in Python is for the longest of the pairs and not for each: it was the whole of wer_counts and wer_rates."""
    import pyarrow as pa

    monkeypatch.setattr(edits, "align", None)  # one pair at a time
    rows = [["a", "b", "c"], [], None, ["a", "x"]], [["a", "c"], ["a"], ["a"], ["a", "y"]]
    got = text.alignment.func(*(pa.array(r, pa.list_(pa.string())) for r in rows)).to_pylist()
    assert [r and tuple(r.values()) for r in got] == [(2, 0, 1, 0), (0, 0, 0, 1), None, (1, 1, 0, 0)]
    df = spark.createDataFrame([("a b c", "a c"), ("", "b"), (None, None)], "source_text string, converted_text string")
    assert [(r["hits"], r["deletions"], r["note"]) for r in evaluate_pairs(df).collect()] == [(2, 1, None), (None, None, "one text is empty"), (None, None, "both texts are empty")]


def test_distances_of_many_pairs(monkeypatch):
    """Pairs that share steps against a slow version: symbols in one table, in a table of each pair, and without a table."""
    rng = random.Random(5)
    for symbols, longest, count in ((3, 9, 300), (30, 200, 40), (400, 200, 30), (2, 400, 4)):
        pairs = [[[rng.randrange(symbols) for _ in range(rng.randint(0, longest))] for _ in "ab"] for _ in range(count)]
        side = lambda i, some: (np.array([w for p in some for w in p[i]], np.int32), np.array([len(p[i]) for p in some]))
        slow = [sum(text.align(*p)[1:]) for p in pairs]
        assert edits.distances(side(0, pairs), side(1, pairs)).tolist() == slow
        with monkeypatch.context() as less:
            less.setattr(edits, "_TABLE", 1)
            assert [int(edits.distances(side(0, [p]), side(1, [p]))[0]) for p in pairs[:30]] == slow[:30]


def test_any_number_of_distinct_words(spark):
    """Over 2**20 of them in a pair were an error."""
    df = spark.range(1).select(F.transform(F.sequence(F.lit(0), F.lit(1 << 20)), lambda i: i.cast("string")).alias("a"), F.array(F.lit("7"), F.lit("x")).alias("b"))
    assert df.select(text.word_distance("a", "b")).first()[0] == 1 << 20


def test_char_distance_is_levenshtein(spark):
    rows = [("", ""), ("", "é"), (None, "a"), ("日本語", "日本"), ("𝄞a", "a𝄞"), ("kitten " * 40, "sitting " * 31)]
    df = spark.createDataFrame(rows, "a string, b string").select(text.char_distance("a", "b").alias("x"), F.levenshtein("a", "b").alias("y"))
    assert [r["x"] for r in df.collect()] == [r["y"] for r in df.collect()]


@pytest.mark.parametrize("name", ["batch_evaluation", "batch_report"])
def test_a_collection_is_scored_once(spark, name):
    """The join that wrote the entries back had all pairs scored a second time."""
    plan = catalogue.QUERIES[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
