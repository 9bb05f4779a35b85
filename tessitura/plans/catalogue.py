"""Every query of the engine by name, with its SQL for comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessitura.functions import music, text
from tessitura.operators import jobs, pitch, segments, signal
from tessitura.operators.text_eval import evaluate_pairs
from tessitura.plans import batch, proxies, tracks
from tessitura.session import table

#: Five frames a window, and thresholds that all bind on the test tables.
WINDOW = {"sr": 16000, "hop": 256, "window_ms": 80}
LIMITS = {"std": 0.8, "voiced": 0.8, "hnr_drop": 2.0}
TARGET = (110.0, 220.0)
_HOUR = proxies.HOUR


def _r6(df, *columns):
    for c in columns:
        df = df.withColumn(c, F.bround(c, 6))
    return df


def _windows(spark, d):
    return pitch.pitch_windows(proxies.frames(spark, d), **WINDOW)


def _stable(spark, d):
    return pitch.mark_stable(_windows(spark, d), **LIMITS)


def pitch_scale(spark, d):
    f = proxies.frames(spark, d)
    return f.select(
        "track_id", "frame_idx", F.bround(music.midi_float("f0_hz"), 6).alias("midi"), music.midi_int("f0_hz").alias("midi_int"), F.bround(music.f0_midi("f0_hz"), 6).alias("f0_midi"),
        F.bround(music.hz(music.midi_int("f0_hz")), 6).alias("note_hz"), music.note_of_hz("f0_hz").alias("note"),
    )


def pitch_windows(spark, d):
    return _windows(spark, d)


def trailing_hnr_baseline(spark, d):
    return _r6(pitch.trailing_baseline(_windows(spark, d)), "baseline_hnr_db").select("track_id", "index", "median_hnr_db", "baseline_hnr_db")


def stable_windows(spark, d):
    return _stable(spark, d).select("track_id", "index", "stable")


def stable_range(spark, d):
    return pitch.stable_range(_stable(spark, d))


def stable_range_gap1(spark, d):
    return pitch.stable_range(_stable(spark, d), 1)


def stable_range_gap2(spark, d):
    return pitch.stable_range(_stable(spark, d), 2)


def note_stats(spark, d):
    return pitch.note_stats(proxies.frames(spark, d, wide=True))


def note_run(spark, d):
    return pitch.note_run(pitch.note_stats(proxies.frames(spark, d, wide=True)), 5.0)


def singer_stats(spark, d):
    return pitch.singer_stats(proxies.frames(spark, d, wide=True))


def octave_shift(spark, d):
    found = pitch.pitch_shift(pitch.singer_stats(proxies.frames(spark, d, wide=True)), *TARGET)
    return found.select("track_id", *[F.col(f"target_range.{c}").alias(f"target_{c}") for c in ("low_note", "high_note", "center_hz", "center_note")], *[c for c in found.columns if c not in ("track_id", "target_range")])


def text_normalize(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", text.normalise("text").alias("normalized"))


def wer_cer(spark, d):
    found = evaluate_pairs(proxies.pairs(spark, d), details=False)
    return _r6(found, "wer", "cer").select("conv_id", "turn", "word_edits", "char_edits", "wer", "cer", "note", "language_mismatch")


def wer_counts(spark, d):
    found = evaluate_pairs(proxies.pairs(spark, d))
    return found.select("conv_id", "turn", (F.col("substitutions") + F.col("deletions") + F.col("insertions")).alias("word_edits"), (F.col("hits") + F.col("substitutions") + F.col("deletions")).alias("n_source"), (F.col("hits") + F.col("substitutions") + F.col("insertions")).alias("n_converted"))


def wer_rates(spark, d):
    """MER, WIL and WIP of texts against themselves with every third word gone, whose alignment is unique: hits and deletions."""
    c = table(spark, d, "conversations")
    words = text.tokens(text.normalise("text"))
    rows = c.select("conv_id", "turn", F.array_join(words, " ").alias("source_text"), F.array_join(F.filter(words, lambda w, i: i % 3 != 2), " ").alias("converted_text"))
    return _r6(evaluate_pairs(rows), "mer", "wil", "wip").select("conv_id", "turn", "mer", "wil", "wip")


def _segments(spark, d, low, high):
    ranges = segments.activity_ranges(proxies.levels(spark, d, low), min_gap=12 * _HOUR, step=0)
    return segments.vocal_segments(ranges, (0, high - low), min_segment=6 * _HOUR, keep=_HOUR)


def vocal_segments(spark, d):
    return _segments(spark, d, *proxies.span(spark, d))


def segment_seconds(spark, d):
    return segments.to_seconds(_segments(spark, d, *proxies.span(spark, d)))


def segment_overlap_join(spark, d):
    low, high = proxies.span(spark, d)
    return segments.contained(proxies.levels(spark, d, low), _segments(spark, d, low, high), slot=24 * _HOUR).select("track_id", "event_id", "index")


def reassemble_left(spark, d):
    s = _segments(spark, d, *proxies.span(spark, d))
    chunks = s.where(F.col("index") % 3 != 0).select("track_id", "filename", F.col("duration_ms").alias("chunk_ms"))
    return segments.reassemble(s, chunks).select("track_id", "index", "filename", "chunk_ms", "missing")


def _jobs(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("subprefix"), "lang", "n_chars"), table(spark, d, "labels").select(F.col("doc_id").alias("subprefix"))


def job_plan(spark, d):
    listing, done = _jobs(spark, d)
    return jobs.plan_jobs(listing, done, limit=500).select("subprefix", "lang")


def _statuses(spark, d):
    listing, done = _jobs(spark, d)
    found = jobs.outcomes(listing.withColumn("complete", F.col("n_chars") >= 500), "complete", done)
    failed = F.when(F.col("subprefix") % 17 == 0, "inference_error").when(F.col("subprefix") % 19 == 0, "download_error").otherwise("ok")
    return found.withColumn("status", F.coalesce("status", failed))


def job_outcomes(spark, d):
    return _statuses(spark, d).select("subprefix", "status")


def job_summary(spark, d):
    return jobs.job_summary(_statuses(spark, d))


def file_gate(spark, d):
    files = table(spark, d, "documents").select(F.concat(F.lit("run/"), F.floor(F.col("doc_id") / 3).cast("string"), F.lit("/"), F.element_at(F.array(*map(F.lit, jobs.REQUIRED)), (F.col("doc_id") % 3 + 1).cast("int"))).alias("path"), "n_chars")
    return jobs.file_gate(files.where("n_chars > 600").select("path")).select("subprefix", "complete")


def checkpoint_pick(spark, d):
    kinds = F.element_at(F.array(*map(F.lit, ("G_", "D_", "added_", "", "_G_"))), (F.col("p_partkey") % 5 + 1).cast("int"))
    end = F.when(F.col("p_size") % 2 == 0, ".pth").otherwise(".index")
    files = table(spark, d, "part").select(F.concat("p_brand", F.lit("/"), F.floor(F.col("p_partkey") / 40).cast("string")).alias("folder"), F.concat(kinds, F.regexp_replace("p_name", "[^A-Za-z0-9]+", "_"), F.lit("_"), F.col("p_partkey").cast("string"), end).alias("name"), "p_retailprice")
    pth = jobs.first_by(jobs.inference_checkpoints(files, "folder"), "folder", "name").select("folder", F.col("name").alias("pth"))
    index = jobs.best_index(files, "folder", valid=F.col("p_retailprice") > 950).select("folder", F.col("name").alias("index"))
    return files.select("folder").distinct().join(pth, "folder", "left").join(index, "folder", "left")


_RUN = tracks.RunConfig(separation_backend="uvr5", dereverb_backend="mbr", do_lyrics_eval=True)


def _outcomes(spark, d):
    return tracks.outcomes(tracks.keyed(proxies.staged(spark, d), _RUN), _RUN)


def track_outcomes(spark, d):
    return _outcomes(spark, d).select("track_id", "stem", "status", "vocals", "mixed", "warning")


def track_summary(spark, d):
    return tracks.summary(_outcomes(spark, d))


def track_pending(spark, d):
    done = tracks.keyed(proxies.staged(spark, d).where("num_segments > 2"), _RUN)
    return tracks.pending(proxies.staged(spark, d), done, _RUN).select("track_id", "stem")


def uri_parse(spark, d):
    return table(spark, d, "pages").select("page_id", text.bucket_of("url").alias("bucket"), text.prefix_of("url").alias("prefix"), text.prefix_of("url", False).alias("bare_prefix"), text.last_segment("url").alias("last_segment"))


def content_key(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5("text").alias("content_md5"), text.path_key("source").alias("path_key"), text.output_stem(F.md5("text"), F.when(F.col("lang") == "en", text.path_key("lang"))).alias("stem"))


def metadata_json(spark, d):
    e = table(spark, d, "events")
    body = F.struct(F.col("event_id").alias("id"), F.struct((F.col("event_type") == "error").alias("failed"), F.get_json_object("props", "$.k").cast("int").alias("k")).alias("stages"))
    parsed = F.from_json(F.to_json(body), "id bigint, stages struct<failed:boolean,k:int>, extra string")
    return e.select("event_id", F.to_json(body).alias("json"), parsed["stages"]["k"].alias("k"), parsed["extra"].alias("extra"))


def backend_choice(spark, d):
    return jobs.choose_backend(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", ("demucs", "roformer", "mdxchain", "uvr5"), "7")


def frame_signal(spark, d):
    f = signal.frames(proxies.signals(spark, d), 16, 8)
    return f.select("track_id", "frame_idx", F.bround(F.aggregate("frame", F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("total"), F.size("frame").alias("n"))


def hnr_autocorr(spark, d):
    return proxies.signals(spark, d).select("track_id", F.bround(signal.hnr("samples", 20.0, fmin=1.0, fmax=10.0), 6).alias("hnr_db"))


def hnr_cepstral(spark, d):
    return proxies.signals(spark, d).select("track_id", music.rounded(signal.hnr("samples", 1000.0, "cepstral", fmin=50, fmax=500), 4).alias("hnr_db"))


def hnr_spectral(spark, d):
    return proxies.signals(spark, d).select("track_id", music.rounded(signal.hnr("samples", 1000.0, "spectral", f0=F.lit(100.0)), 4).alias("hnr_db"))


def mix_overlay(spark, d):
    s = proxies.signals(spark, d).withColumn("samples", F.col("samples").cast("array<double>")).withColumn("half", F.slice("samples", 1, 32))
    total = lambda c: F.bround(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 6)
    return s.select("track_id", total(signal.mix("samples", "half")).alias("mixed"), total(signal.subtract("samples", signal.fit_length("half", 64))).alias("rest"), F.size(signal.mix("samples", "half")).alias("n_mixed"))


def stem_sum(spark, d):
    # five neighbouring vectors are the stems of one track
    s = proxies.signals(spark, d).select(F.floor(F.col("track_id") / 5).alias("track_id"), F.concat(F.lit("stem"), (F.col("track_id") % 5).cast("string")).alias("stem"), F.posexplode("samples").alias("sample_idx", "value"))
    return _r6(signal.stem_sum(s.withColumn("value", F.col("value").cast("double")), "stem0"), "value")


def metadata_upsert(spark, d):
    """The documents of all events with one key set anew on every second of them."""
    docs = table(spark, d, "events").select("event_id", F.concat(F.lit('{"k":'), F.get_json_object("props", "$.k"), F.lit(',"lyrics_eval":null}')).alias("doc"))
    values = docs.where("event_id % 2 = 0").select("event_id", F.to_json(F.struct((F.col("event_id") % 7).alias("wer"))).alias("value"))
    found = jobs.upsert_key(docs, values, "lyrics_eval", "doc", "event_id")
    return found.select("event_id", F.get_json_object("doc", "$.k").cast("int").alias("k"), F.get_json_object("doc", "$.lyrics_eval.wer").cast("long").alias("wer"), jobs.has_key(F.col("doc"), "lyrics_eval").alias("has_key"))


def signal_slices(spark, d):
    """Two ranges of every signal one after the other at 1,000 samples a second: one within it, one that reaches beyond."""
    s = proxies.signals(spark, d)
    cuts = s.select("track_id", F.explode(F.array(*[F.struct(F.lit(i).alias("index"), a.cast("long").alias("start_ms"), b.cast("long").alias("end_ms")) for i, a, b in ((1, F.col("track_id") % 30, F.col("track_id") % 30 + 10), (2, F.lit(50), F.lit(99)))])).alias("r")).select("track_id", "r.*")
    found = segments.slice_concat(s, cuts, 1000)
    return found.select("track_id", F.size("samples").alias("n"), F.bround(F.aggregate("samples", F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("total"))


def signal_overlay(spark, d):
    """Three chunks of every signal mixed onto 60 samples of silence; two overlap, one is cut at the end."""
    s = proxies.signals(spark, d).withColumn("samples", F.col("samples").cast("array<double>"))
    chunk = lambda at, n: F.struct(F.lit(at).cast("long").alias("start_ms"), F.slice("samples", 1, n).alias("samples"))
    chunks = s.select("track_id", F.explode(F.array(chunk(0, 20), chunk(10, 20), chunk(50, 20))).alias("c")).select("track_id", "c.*")
    found = segments.overlay(chunks, s.select("track_id", F.lit(60).alias("n_samples")), 1000)
    return found.select("track_id", F.posexplode("samples").alias("i", "value")).select("track_id", "i", F.bround("value", 6).alias("value"))


def non_silent(spark, d):
    """Signals as levels of 10 ms each; 50 ms under -18 dB are a silence, which is about the median level."""
    s = proxies.signals(spark, d).select("track_id", F.posexplode("samples").alias("i", "x"))
    return segments.non_silent(s.select("track_id", (F.col("i") * 10).alias("at_ms"), F.col("x").cast("double").alias("rms")), -18.0, 50, 10)


def f0_with_hnr(spark, d):
    """Contours joined to harmonicity by frame: every second track has fewer frames of it."""
    f = proxies.frames(spark, d)
    hnr = f.where("track_id % 2 = 0 or frame_idx < 20").select("track_id", "frame_idx", F.col("hnr_db").alias("hnr"))
    padded, cut = pitch.with_hnr(f.drop("hnr_db"), hnr.withColumnRenamed("hnr", "hnr_db")), pitch.with_hnr(f.drop("hnr_db"), hnr.withColumnRenamed("hnr", "hnr_db"), pad=False)
    return padded.select("track_id", "frame_idx", "hnr_db", F.lit("pad").alias("rule")).unionByName(cut.select("track_id", "frame_idx", "hnr_db", F.lit("cut").alias("rule")))


def noise_gate(spark, d):
    """Blocks of 8 samples under -18 dB become silence, which is about half of them."""
    s = proxies.signals(spark, d).select("track_id", F.col("samples").cast("array<double>").alias("samples"))
    gated = s.select("track_id", signal.noise_gate("samples", -18.0, 8).alias("x"))
    return gated.select("track_id", F.size("x").alias("n"), F.size(F.filter("x", lambda v: v != 0)).alias("n_heard"), F.bround(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


def _evaluated(spark, d):
    """Every transcript pair is an item; some lack a file, a readable document or transcripts, some are done already."""
    pairs = proxies.pairs(spark, d).withColumn("subprefix", F.format_string("run/%d-%d/", "conv_id", "turn")).withColumn("_n", F.col("conv_id") * 10 + F.col("turn"))
    names = F.array(*map(F.lit, jobs.REQUIRED))
    listing = pairs.select(F.col("_n"), "subprefix", F.explode(names).alias("name")).where("_n % 7 != 0 or name != 'metadata.json'").select(F.concat("subprefix", "name").alias("path"))
    document = F.when(F.col("_n") % 11 == 0, "{").when(F.col("_n") % 5 == 0, '{"k":1,"lyrics_eval":null}').otherwise('{"k":1}')
    transcripts = pairs.withColumn("error", F.when(F.col("_n") % 13 == 0, "none"))
    return batch.evaluate(listing, pairs.select("subprefix", document.alias("document")), transcripts, details=False)


def batch_evaluation(spark, d):
    found = _evaluated(spark, d).withColumn("recorded", F.get_json_object("document", "$.lyrics_eval.wer").cast("double"))
    return _r6(found, "wer", "cer", "recorded").select("subprefix", "status", "wer", "cer", "recorded", F.get_json_object("document", "$.k").cast("int").alias("k"))


def batch_report(spark, d):
    return batch.report(_evaluated(spark, d))


QUERIES = {
    f.__name__: f
    for f in (
        pitch_scale, pitch_windows, trailing_hnr_baseline, stable_windows, stable_range, stable_range_gap1, stable_range_gap2, note_stats, note_run, singer_stats, octave_shift, text_normalize, wer_cer, wer_counts, wer_rates,
        vocal_segments, segment_seconds, segment_overlap_join, reassemble_left, job_plan, job_outcomes, job_summary, file_gate, checkpoint_pick, track_outcomes, track_summary, track_pending, uri_parse, content_key, metadata_json, backend_choice, frame_signal,
        hnr_autocorr, hnr_cepstral, hnr_spectral, mix_overlay, stem_sum, metadata_upsert, signal_slices, signal_overlay, non_silent, f0_with_hnr, noise_gate, batch_evaluation, batch_report,
    )
}

# SQL -----------------------------------------------------------------------------------------------------------------

_NOTES = "['C','C#','D','D#','E','F','F#','G','G#','A','A#','B']"


def _midi(hz: str) -> str:
    return f"CASE WHEN {hz} > 0 THEN 12*log2({hz}/440)+69 ELSE -1 END"


def _hz(m: str) -> str:
    return f"440*pow(2, ({m} - 69)/12.0)"


def _name(m: str) -> str:
    return f"({_NOTES}[CAST((({m}) % 12 + 12) % 12 AS INT) + 1] || CAST(CAST(floor(({m})/12.0) - 1 AS BIGINT) AS VARCHAR))"


def _note(hz: str) -> str:
    return f"CASE WHEN {hz} > 0 THEN {_name(f'CAST(round_even(12*log2({hz}/440)+69, 0) AS INT)')} ELSE '?' END"


def _frames(hz: str) -> str:
    k = "CAST(json_extract_string(props, '$.k') AS INT)"
    return (
        "frames AS (SELECT user_id AS track_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS frame_idx, event_type <> 'error' AS voiced, "
        f"CASE WHEN event_type <> 'error' THEN {hz} ELSE 0 END AS f0_hz, CASE WHEN event_type <> 'error' AND {k} >= 5 THEN {k}/5.0 - 2 END AS hnr_db FROM events)"
    )


_NARROW, _WIDE = _frames("220 + value/10"), _frames("65 + value")
_WINDOWS = f"""{_NARROW},
m AS (SELECT *, CASE WHEN f0_hz > 0 THEN 12*log2(f0_hz/440 + 1e-10)+69 ELSE 0 END AS midi FROM frames),
g AS (SELECT track_id, CAST(floor(frame_idx/5.0) AS INT) AS w, count(*) AS n, count(*) FILTER (voiced AND midi > 0) AS nv, stddev_pop(midi) FILTER (voiced AND midi > 0) AS sd,
      avg(midi) FILTER (voiced AND midi > 0) AS mean, median(hnr_db) FILTER (voiced AND midi > 0) AS hnr FROM m GROUP BY 1, 2 HAVING count(*) = 5),
h AS (SELECT *, CASE WHEN nv >= 3 THEN {_hz('mean')} ELSE 0 END AS mhz FROM g),
windows AS (SELECT track_id, w AS "index", round_even(w*5*256/16000.0, 3) AS t_start, round_even((w*5+4)*256/16000.0, 3) AS t_end, round_even(nv/5.0, 3) AS voiced_ratio, CASE WHEN nv >= 3 THEN round_even(sd, 3) END AS std_semitones,
      CASE WHEN nv >= 3 THEN round_even(hnr, 1) END AS median_hnr_db, round_even(CASE WHEN nv >= 3 THEN mean ELSE 0 END, 2) AS mean_midi, round_even(mhz, 1) AS mean_hz, {_note('mhz')} AS note FROM h)"""
_STABLE = f"""{_WINDOWS},
b AS (SELECT *, median(median_hnr_db) OVER (PARTITION BY track_id ORDER BY "index" ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS baseline FROM windows),
stable AS (SELECT *, (voiced_ratio >= 0.8 AND coalesce(std_semitones < 0.8, false) AND (baseline IS NULL OR coalesce(median_hnr_db >= baseline - 2.0, false))) AS stable FROM b)"""


def _range(gap: int) -> str:
    return f"""WITH {_STABLE},
s AS (SELECT track_id, "index" AS i, CASE WHEN "index" - lag("index") OVER (PARTITION BY track_id ORDER BY "index") <= {gap + 1} THEN 0 ELSE 1 END AS fresh FROM stable WHERE stable),
isl AS (SELECT track_id, i, sum(fresh) OVER (PARTITION BY track_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM s),
sp AS (SELECT track_id, k, min(i) AS a, max(i) AS z FROM isl GROUP BY 1, 2),
best AS (SELECT track_id, a, z FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY z - a DESC, a) AS r FROM sp) WHERE r = 1),
j AS (SELECT t.track_id, count(*) AS n_windows, count(*) FILTER (t.stable) AS n_stable, min(a) AS start_window, min(z) AS end_window,
      min(mean_midi) FILTER (t.stable AND mean_midi > 0 AND "index" BETWEEN a AND z) AS low_midi, max(mean_midi) FILTER (t.stable AND mean_midi > 0 AND "index" BETWEEN a AND z) AS high_midi,
      min(t_start) FILTER ("index" BETWEEN a AND z) AS low_time, max(t_end) FILTER ("index" BETWEEN a AND z) AS high_time
      FROM stable t LEFT JOIN best ON t.track_id = best.track_id GROUP BY 1)
SELECT track_id, n_windows, n_stable, start_window, end_window, low_midi, high_midi, CASE WHEN low_midi > 0 THEN {_note(_hz('low_midi'))} END AS low, CASE WHEN high_midi > 0 THEN {_note(_hz('high_midi'))} END AS high,
      CASE WHEN low_midi > 0 THEN round_even({_hz('low_midi')}, 1) END AS low_hz, CASE WHEN high_midi > 0 THEN round_even({_hz('high_midi')}, 1) END AS high_hz, low_time, high_time,
      CAST(coalesce(round_even(high_midi - low_midi, 0), 0) AS INT) AS semitones FROM j"""


_NOTE_STATS = f"""{_WIDE},
k AS (SELECT *, CAST(round_even({_midi('f0_hz')}, 0) AS INT) AS midi FROM frames WHERE voiced AND f0_hz > 0 AND hnr_db IS NOT NULL),
notes AS (SELECT track_id, midi, {_name('midi')} AS note, round_even({_hz('midi')}, 1) AS hz, round_even(avg(hnr_db), 1) AS mean_hnr, round_even(median(hnr_db), 1) AS median_hnr, round_even(min(hnr_db), 1) AS min_hnr,
      count(*) AS n_frames, round_even(min(frame_idx)*512/16000.0, 3) AS first_time, round_even(max(frame_idx)*512/16000.0, 3) AS last_time FROM k WHERE midi >= 0 GROUP BY track_id, midi)"""
_SINGER = f"""{_WIDE},
v AS (SELECT track_id, CASE WHEN voiced AND f0_hz > 0 THEN 12*log2(f0_hz/440)+69 END AS m FROM frames),
s AS (SELECT track_id, avg(m) AS mean, median(m) AS med, min(m) AS low, max(m) AS high, count(m) AS n FROM v GROUP BY 1),
singer AS (SELECT track_id, round_even({_hz('mean')}, 1) AS mean_hz, CASE WHEN n > 0 THEN {_note(_hz('mean'))} END AS mean_note, round_even(mean, 2) AS mean_midi, round_even({_hz('med')}, 1) AS median_hz,
      CASE WHEN n > 0 THEN {_note(_hz('med'))} END AS median_note, round_even(med, 2) AS median_midi, round_even({_hz('low')}, 1) AS low_hz, CASE WHEN n > 0 THEN {_note(_hz('low'))} END AS low_note, round_even({_hz('high')}, 1) AS high_hz,
      CASE WHEN n > 0 THEN {_note(_hz('high'))} END AS high_note, round_even(high - low, 1) AS range_semitones, n AS n_voiced_frames, CASE WHEN n = 0 THEN 'no voiced frames' END AS error FROM s)"""
_NORMAL = r"trim(regexp_replace(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}_\s\x0b\x1c-\x1f\x85\p{{Z}}]', '', 'g'), '[\s\x0b\x1c-\x1f\x85\p{{Z}}]+', ' ', 'g'))"
_WORDS = "list_filter(string_split({}, ' '), lambda x: x <> '')"
_PAIRS = f"""p AS (SELECT conv_id, turn, text, role, lead(text) OVER w AS next_text, lead(turn) OVER w AS next_turn, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
q AS (SELECT conv_id, turn, role IS DISTINCT FROM next_role AS mismatch, {_WORDS.format(_NORMAL.format("coalesce(text, '')"))} AS a, {_WORDS.format(_NORMAL.format("coalesce(next_text, '')"))} AS b FROM p WHERE next_turn = turn + 1),
dp AS (SELECT conv_id, turn, a, b, 0 AS i, list_transform(range(0, len(b) + 1), lambda j: CAST(j AS BIGINT)) AS edits FROM q
       UNION ALL
       SELECT conv_id, turn, a, b, i + 1, list_transform(range(0, len(b) + 1), lambda j: list_min(best[1:j + 1]) + j)
       FROM (SELECT *, list_transform(range(0, len(b) + 1), lambda j: CASE WHEN j = 0 THEN i + 1 ELSE least(edits[j] + CASE WHEN a[i + 1] = b[j] THEN 0 ELSE 1 END, edits[j + 1] + 1) END - j) AS best FROM dp WHERE i < len(a))),
d AS (SELECT conv_id, turn, edits[len(b) + 1] AS word_edits FROM dp WHERE i = len(a)),
-- levenshtein() counts bytes: each distinct character of a pair becomes one ASCII character
k AS (SELECT *, list_distinct(string_split(array_to_string(a, ' ') || array_to_string(b, ' ') || ' ', '')) AS k FROM q),
c AS (SELECT *, array_to_string(list_transform(string_split(array_to_string(a, ' '), ''), lambda x: chr(CAST(list_position(k, x) AS INT))), '') AS x,
      array_to_string(list_transform(string_split(array_to_string(b, ' '), ''), lambda x: chr(CAST(list_position(k, x) AS INT))), '') AS y FROM k),
e AS (SELECT c.*, word_edits, levenshtein(x, y) AS char_edits FROM c JOIN d USING (conv_id, turn))"""
_RATES = """CASE WHEN len(a) = 0 AND len(b) = 0 THEN 0.0 WHEN len(a) = 0 OR len(b) = 0 THEN 1.0 ELSE round_even(CAST(word_edits AS DOUBLE)/len(a), 6) END AS wer,
CASE WHEN len(a) = 0 AND len(b) = 0 THEN 0.0 WHEN len(a) = 0 OR len(b) = 0 THEN 1.0 ELSE round_even(CAST(char_edits AS DOUBLE)/length(array_to_string(a, ' ')), 6) END AS cer"""
_EVALUATED = f"""{_PAIRS},
i AS (SELECT 'run/' || conv_id || '-' || turn || '/' AS subprefix, conv_id * 10 + turn AS n, {_RATES} FROM e),
s AS (SELECT subprefix, n, CASE WHEN n % 7 = 0 THEN 'skipped_missing' WHEN n % 11 = 0 THEN 'download_error' WHEN n % 5 = 0 THEN 'skipped_already_done' WHEN n % 13 = 0 THEN 'inference_error' ELSE 'ok' END AS status, wer, cer FROM i),
v AS (SELECT subprefix, n, status, CASE WHEN status = 'ok' THEN wer END AS wer, CASE WHEN status = 'ok' THEN cer END AS cer FROM s)"""
_LEVELS = """lv AS (SELECT user_id AS track_id, event_id, date_diff('millisecond', (SELECT min(ts) FROM events), ts) AS at_ms FROM events),
nw AS (SELECT track_id, at_ms, CASE WHEN at_ms - lag(at_ms) OVER (PARTITION BY track_id ORDER BY at_ms) < 43200000 THEN 0 ELSE 1 END AS fresh FROM lv),
rg AS (SELECT track_id, at_ms, sum(fresh) OVER (PARTITION BY track_id ORDER BY at_ms ROWS UNBOUNDED PRECEDING) AS k FROM nw),
ranges AS (SELECT track_id, k, min(at_ms) AS a, max(at_ms) AS z FROM rg GROUP BY 1, 2 HAVING max(at_ms) - min(at_ms) >= 21600000),
seg AS (SELECT track_id, CAST(row_number() OVER (PARTITION BY track_id ORDER BY a) AS INT) AS "index", greatest(a - 3600000, 0) AS start_ms, least(z + 3600000, (SELECT max(at_ms) FROM lv)) AS end_ms FROM ranges),
segs AS (SELECT *, end_ms - start_ms AS duration_ms, lpad(CAST("index" AS VARCHAR), 5, '0') || '.wav' AS filename FROM seg)"""
_STATUS = """st AS (SELECT d.doc_id AS subprefix, CASE WHEN d.n_chars < 500 THEN 'skipped_missing' WHEN d.doc_id IN (SELECT doc_id FROM labels) THEN 'skipped_already_done' WHEN d.doc_id % 17 = 0 THEN 'inference_error'
      WHEN d.doc_id % 19 = 0 THEN 'download_error' ELSE 'ok' END AS status FROM documents d)"""

_TRACKS = """r AS (SELECT *, CAST(round_even(abs(c_acctbal) * 100, 0) AS BIGINT) AS cents FROM customer),
s AS (SELECT c_custkey AS track_id, 'source_' || md5(c_name) || '_rvcmodel_' || md5(c_mktsegment) AS stem, c_custkey % 11 <> 0 AS separated, c_nationkey % 5 <> 0 AND c_nationkey % 4 <> 0 AS dereverbed, c_nationkey % 3 <> 0 AS has_instrumental,
      cents % 7 <> 0 AS lyrics_ok, CAST(cents % 6 AS INT) AS segments, CAST(least(cents % 6, CAST(floor(cents / 10.0) AS BIGINT) % 5) AS INT) AS converted FROM r),
o AS (SELECT *, CASE WHEN NOT separated THEN 'separation_error' WHEN segments = 0 THEN 'no_segments' WHEN converted = 0 THEN 'conversion_error' ELSE 'ok' END AS status FROM s),
t AS (SELECT *, CASE WHEN status = 'ok' THEN CASE WHEN dereverbed THEN 'dereverbed' ELSE 'raw' END END AS vocals, status = 'ok' AND has_instrumental AS mixed, CASE WHEN status = 'ok' THEN
      concat_ws('; ', CASE WHEN NOT dereverbed THEN 'dereverberation failed' END, CASE WHEN converted < segments THEN 'some segments weren''t converted' END, CASE WHEN NOT lyrics_ok THEN 'lyrics evaluation failed' END) END AS warning FROM o)"""

#: The discrete Fourier transform of signals of 64 samples under a Hann window.
_DFT = """x AS (SELECT vec_id, list_transform(range(0, 64), lambda n: CAST(embedding[n + 1] AS DOUBLE) * (0.5 - 0.5 * cos(2 * pi() * n / 63))) AS x FROM embeddings),
f AS (SELECT vec_id, list_transform(range(0, 33), lambda k: list_sum(list_transform(range(0, 64), lambda n: x[n + 1] * cos(2 * pi() * k * n / 64)))) AS re,
      list_transform(range(0, 33), lambda k: list_sum(list_transform(range(0, 64), lambda n: x[n + 1] * sin(2 * pi() * k * n / 64)))) AS im FROM x)"""

ORACLE_SQL = {
    "track_outcomes": f"WITH {_TRACKS} SELECT track_id, stem, status, vocals, mixed, warning FROM t",
    "track_summary": f"WITH {_TRACKS} SELECT count(*) AS total, count(*) FILTER (status = 'ok') AS succeeded, count(*) FILTER (mixed) AS mixed, CAST(sum(segments) AS BIGINT) AS segments, CAST(sum(converted) AS BIGINT) AS converted FROM t",
    "track_pending": f"WITH {_TRACKS} SELECT track_id, stem FROM t WHERE segments <= 2",
    "pitch_scale": f"WITH {_NARROW} SELECT track_id, frame_idx, round_even({_midi('f0_hz')}, 6) AS midi, CAST(round_even({_midi('f0_hz')}, 0) AS INT) AS midi_int, round_even(CASE WHEN f0_hz > 0 THEN 12*log2(f0_hz/440 + 1e-10)+69 ELSE 0 END, 6) AS f0_midi, "
    f"round_even({_hz(f'round_even({_midi("f0_hz")}, 0)')}, 6) AS note_hz, {_note('f0_hz')} AS note FROM frames",
    "pitch_windows": f"WITH {_WINDOWS} SELECT * FROM windows",
    "trailing_hnr_baseline": f"WITH {_STABLE} SELECT track_id, \"index\", median_hnr_db, round_even(baseline, 6) AS baseline_hnr_db FROM stable",
    "stable_windows": f"WITH {_STABLE} SELECT track_id, \"index\", stable FROM stable",
    "stable_range": _range(0),
    "stable_range_gap1": _range(1),
    "stable_range_gap2": _range(2),
    "note_stats": f"WITH {_NOTE_STATS} SELECT * FROM notes",
    "note_run": f"""WITH {_NOTE_STATS},
u AS (SELECT *, CASE WHEN midi - lag(midi) OVER (PARTITION BY track_id ORDER BY midi) <= 2 THEN 0 ELSE 1 END AS fresh FROM notes WHERE median_hnr >= 5),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY track_id ORDER BY midi ROWS UNBOUNDED PRECEDING) AS k FROM u),
r AS (SELECT track_id, k, min(midi) AS low_midi, max(midi) AS high_midi, count(*) AS n_notes, arg_min(first_time, midi) AS low_time, arg_max(last_time, midi) AS high_time FROM i GROUP BY 1, 2),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY n_notes DESC, low_midi) AS o FROM r) WHERE o = 1),
t AS (SELECT DISTINCT track_id FROM notes)
SELECT t.track_id, low_midi, high_midi, n_notes, {_name('low_midi')} AS low, {_name('high_midi')} AS high, round_even({_hz('low_midi')}, 1) AS low_hz, round_even({_hz('high_midi')}, 1) AS high_hz, low_time, high_time, coalesce(high_midi - low_midi + 1, 0) AS semitones
FROM t LEFT JOIN b ON t.track_id = b.track_id""",
    "singer_stats": f"WITH {_SINGER} SELECT * FROM singer",
    "octave_shift": f"""WITH {_SINGER},
c AS (SELECT *, (12*log2(110.0/440)+69 + 12*log2(220.0/440)+69)/2 AS centre FROM singer),
x AS (SELECT *, centre - median_midi AS exact, CAST(round_even((centre - median_midi)/12, 0)*12 AS INT) AS shift FROM c),
y AS (SELECT *, {_hz('median_midi + shift')} AS moved FROM x)
SELECT track_id, {_note('110.0')} AS target_low_note, {_note('220.0')} AS target_high_note, round_even({_hz('centre')}, 1) AS target_center_hz, {_note(_hz('centre'))} AS target_center_note, shift AS shift_semitones, CAST(floor(shift/12.0) AS INT) AS shift_octaves,
round_even(exact, 2) AS shift_exact_semitones, round_even(moved, 1) AS shifted_median_hz, CASE WHEN moved IS NOT NULL THEN {_note('moved')} END AS shifted_median_note, round_even({_hz('12*log2(low_hz/440)+69 + shift')}, 1) AS shifted_low_hz,
round_even({_hz('12*log2(high_hz/440)+69 + shift')}, 1) AS shifted_high_hz, moved BETWEEN 110.0 AND 220.0 AS median_in_target_range FROM y""",
    "text_normalize": f"SELECT conv_id, turn, {_NORMAL.format('text')} AS normalized FROM conversations",
    "wer_rates": f"""WITH w AS (SELECT conv_id, turn, len({_WORDS.format(_NORMAL.format("coalesce(text, '')"))}) AS n FROM conversations), h AS (SELECT *, n - n // 3 AS hits FROM w)
SELECT conv_id, turn, CASE WHEN n > 0 THEN round_even((n - hits) / n, 6) END AS mer, CASE WHEN n > 0 THEN round_even(1 - hits / n, 6) END AS wil, CASE WHEN n > 0 THEN round_even(hits / n, 6) END AS wip FROM h""",
    "noise_gate": """WITH b AS (SELECT vec_id, UNNEST(range(0, len(embedding), 8)) AS o, embedding FROM embeddings),
g AS (SELECT vec_id, list_transform(embedding[o + 1:o + 8], lambda x: CAST(x AS DOUBLE)) AS p FROM b),
h AS (SELECT vec_id, len(p) AS n, CASE WHEN list_sum(list_transform(p, lambda x: x * x)) / len(p) > pow(10, -1.8) THEN p END AS p FROM g)
SELECT vec_id AS track_id, CAST(sum(n) AS INT) AS n, CAST(sum(coalesce(len(list_filter(p, lambda x: x <> 0)), 0)) AS INT) AS n_heard, round_even(sum(coalesce(list_sum(p), 0.0)), 6) AS total FROM h GROUP BY 1""",
    "batch_evaluation": f"""WITH RECURSIVE {_EVALUATED} SELECT subprefix, status, wer, cer, wer AS recorded, CASE WHEN n % 11 <> 0 THEN 1 END AS k FROM v""",
    "batch_report": f"""WITH RECURSIVE {_EVALUATED} SELECT count(*) AS total, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status LIKE 'skipped%') AS skipped, count(*) FILTER (status LIKE '%error') AS errors,
round_even(avg(wer), 6) AS mean_wer, round_even(avg(cer), 6) AS mean_cer, round_even(median(wer), 6) AS median_wer, CAST(count(*) FILTER (status LIKE '%error') > 0 AS INT) AS exit_code FROM v""",
    "wer_cer": f"""WITH RECURSIVE {_PAIRS} SELECT conv_id, turn, word_edits, char_edits,
{_RATES},
CASE WHEN len(a) = 0 AND len(b) = 0 THEN 'both texts are empty' WHEN len(a) = 0 OR len(b) = 0 THEN 'one text is empty' END AS note, mismatch AS language_mismatch FROM e""",
    "wer_counts": f"""WITH RECURSIVE {_PAIRS} SELECT conv_id, turn, CASE WHEN len(a) > 0 AND len(b) > 0 THEN word_edits END AS word_edits, CASE WHEN len(a) > 0 AND len(b) > 0 THEN len(a) END AS n_source,
CASE WHEN len(a) > 0 AND len(b) > 0 THEN len(b) END AS n_converted FROM e""",
    "vocal_segments": f"WITH {_LEVELS} SELECT track_id, \"index\", start_ms, end_ms, duration_ms, filename FROM segs",
    "segment_seconds": f"WITH {_LEVELS} SELECT track_id, round_even(start_ms/1000.0, 6) AS start_time, round_even(end_ms/1000.0, 6) AS end_time FROM segs",
    "segment_overlap_join": f"WITH {_LEVELS} SELECT lv.track_id, lv.event_id, s.\"index\" FROM lv JOIN segs s ON lv.track_id = s.track_id AND lv.at_ms >= s.start_ms AND lv.at_ms < s.end_ms",
    "reassemble_left": f"WITH {_LEVELS} SELECT track_id, \"index\", filename, CASE WHEN \"index\" % 3 <> 0 THEN duration_ms END AS chunk_ms, \"index\" % 3 = 0 AS missing FROM segs",
    "job_plan": "WITH l AS (SELECT doc_id AS subprefix, lang FROM documents ORDER BY doc_id LIMIT 500) SELECT subprefix, lang FROM l WHERE subprefix NOT IN (SELECT doc_id FROM labels)",
    "job_outcomes": f"WITH {_STATUS} SELECT subprefix, status FROM st",
    "job_summary": f"WITH {_STATUS} SELECT count(*) AS total, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status LIKE 'skipped%') AS skipped, count(*) FILTER (status LIKE '%error') AS errors, CAST(count(*) FILTER (status LIKE '%error') > 0 AS INT) AS exit_code FROM st",
    "file_gate": "SELECT 'run/' || CAST(CAST(floor(doc_id/3.0) AS BIGINT) AS VARCHAR) || '/' AS subprefix, count(DISTINCT doc_id % 3) = 3 AS complete FROM documents WHERE n_chars > 600 GROUP BY 1",
    "checkpoint_pick": """WITH f AS (SELECT p_brand || '/' || CAST(CAST(floor(p_partkey/40.0) AS BIGINT) AS VARCHAR) AS folder, (['G_','D_','added_','','_G_'])[CAST(p_partkey % 5 + 1 AS INT)] || regexp_replace(p_name, '[^A-Za-z0-9]+', '_', 'g') || '_' || CAST(p_partkey AS VARCHAR)
      || CASE WHEN p_size % 2 = 0 THEN '.pth' ELSE '.index' END AS name, p_retailprice FROM part),
p AS (SELECT *, NOT (starts_with(name, 'D_') OR starts_with(name, 'G_') OR starts_with(name, '_D_') OR starts_with(name, '_G_') OR starts_with(name, '._D_') OR starts_with(name, '._G_')) AS usable FROM f WHERE name LIKE '%.pth'),
q AS (SELECT *, bool_or(usable) OVER (PARTITION BY folder) AS any_usable FROM p),
pth AS (SELECT folder, min(name) AS pth FROM q WHERE CASE WHEN any_usable THEN usable ELSE NOT contains(name, 'D_') END GROUP BY 1),
ix AS (SELECT folder, name AS "index" FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY NOT starts_with(name, 'added_'), name) AS r FROM f WHERE name LIKE '%.index' AND p_retailprice > 950) WHERE r = 1),
d AS (SELECT DISTINCT folder FROM f)
SELECT d.folder, pth.pth, ix."index" FROM d LEFT JOIN pth ON d.folder = pth.folder LEFT JOIN ix ON d.folder = ix.folder""",
    "uri_parse": r"""WITH x AS (SELECT page_id, regexp_extract(url, '^[a-z0-9+.-]+://([^/]+)', 1) AS b, regexp_replace(regexp_extract(url, '^[a-z0-9+.-]+://[^/]+/?(.*)$', 1), '/+$', '') AS p, regexp_replace(url, '/+$', '') AS u FROM pages)
SELECT page_id, CASE WHEN b <> '' THEN b END AS bucket, CASE WHEN p = '' THEN '' ELSE p || '/' END AS prefix, p AS bare_prefix, string_split(u, '/')[-1] AS last_segment FROM x""",
    "content_key": "SELECT doc_id, md5(text) AS content_md5, substr(md5(source), 1, 10) AS path_key, 'source_' || md5(text) || '_rvcmodel_' || CASE WHEN lang = 'en' THEN substr(md5(lang), 1, 10) ELSE 'norvc' END AS stem FROM documents",
    "metadata_json": """SELECT event_id, '{"id":' || CAST(event_id AS VARCHAR) || ',"stages":{"failed":' || CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END || ',"k":' || json_extract_string(props, '$.k') || '}}' AS json,
CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(NULL AS VARCHAR) AS extra FROM events""",
    "backend_choice": "SELECT o_orderkey, (['demucs','roformer','mdxchain','uvr5'])[CAST(CAST('0x' || substr(md5('7:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 4 + 1 AS INT)] AS backend FROM orders",
    "frame_signal": "SELECT vec_id AS track_id, CAST(i AS INT) AS frame_idx, round_even(list_sum(list_transform(embedding[i*8+1:i*8+16], lambda x: CAST(x AS DOUBLE))), 6) AS total, CAST(16 AS INT) AS n FROM (SELECT vec_id, embedding, unnest(range(0, 7)) AS i FROM embeddings)",
    "hnr_autocorr": """WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings), c AS (SELECT vec_id, list_transform(x, lambda v: v - list_sum(x)/64) AS c FROM x),
e AS (SELECT vec_id, c, list_sum(list_transform(c, lambda v: v*v)) AS e FROM c),
l AS (SELECT vec_id, e, k, list_sum(list_transform(range(1, 65 - k), lambda i: c[i]*c[i+k])) AS s FROM (SELECT vec_id, e, c, unnest(range(2, 21)) AS k FROM e)),
r AS (SELECT vec_id, e, least(greatest(max(s)/(e + 1e-10), 1e-6), 1 - 1e-6) AS r FROM l GROUP BY vec_id, e)
SELECT vec_id AS track_id, CASE WHEN e >= 1e-10 THEN round_even(10*log10(r/(1-r)), 6) END AS hnr_db FROM r""",
    "hnr_cepstral": f"""WITH {_DFT},
l AS (SELECT vec_id, list_transform(range(0, 33), lambda k: ln(1e-10 + sqrt(re[k + 1] * re[k + 1] + im[k + 1] * im[k + 1]))) AS g FROM f),
c AS (SELECT vec_id, list_transform(range(2, 21), lambda n: (g[1] + CASE WHEN n % 2 = 0 THEN g[33] ELSE -g[33] END + 2 * list_sum(list_transform(range(1, 32), lambda k: g[k + 1] * cos(2 * pi() * k * n / 64)))) / 64) AS c FROM l)
SELECT vec_id AS track_id, round_even(20 * log10(abs(list_max(c)) / greatest(list_median(list_transform(c, lambda x: abs(x))), 1e-10) + 1e-10), 4) AS hnr_db FROM c""",
    "hnr_spectral": f"""WITH {_DFT},
e AS (SELECT vec_id, list_transform(range(0, 33), lambda k: re[k + 1] * re[k + 1] + im[k + 1] * im[k + 1]) AS e FROM f),
s AS (SELECT vec_id, list_sum(e) AS whole, list_sum(list_transform(range(1, 6), lambda h: coalesce(list_sum(list_transform(list_filter(range(0, 33), lambda k: abs(k * 1000 / 64.0 - 100 * h) <= 20), lambda k: e[k + 1])), 0))) AS near FROM e)
SELECT vec_id AS track_id, CASE WHEN whole >= 1e-10 AND near > 0 THEN round_even(10 * log10(near / greatest(whole - near, 1e-10)), 4) END AS hnr_db FROM s""",
    "metadata_upsert": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, CASE WHEN event_id % 2 = 0 THEN event_id % 7 END AS wer, true AS has_key FROM events",
    "signal_slices": """WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x, vec_id % 30 AS s FROM embeddings)
SELECT vec_id AS track_id, CAST(24 AS INT) AS n, round_even(list_sum(x[s + 1:s + 10]) + list_sum(x[51:64]), 6) AS total FROM x""",
    "signal_overlay": """WITH x AS (SELECT vec_id, embedding AS x, unnest(range(0, 60)) AS i FROM embeddings)
SELECT vec_id AS track_id, CAST(i AS INT) AS i, round_even(CASE WHEN i < 20 THEN CAST(x[i + 1] AS DOUBLE) ELSE 0 END + CASE WHEN i BETWEEN 10 AND 29 THEN CAST(x[i - 9] AS DOUBLE) ELSE 0 END + CASE WHEN i >= 50 THEN CAST(x[i - 49] AS DOUBLE) ELSE 0 END, 6) AS value FROM x""",
    "non_silent": """WITH x AS (SELECT vec_id, i, CAST(embedding[i + 1] AS DOUBLE) AS v FROM (SELECT vec_id, embedding, unnest(range(0, 64)) AS i FROM embeddings)),
w AS (SELECT *, sqrt(avg(v * v) OVER o) <= pow(10, -18 / 20.0) AND count(*) OVER o = 5 AS starts FROM x WINDOW o AS (PARTITION BY vec_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
m AS (SELECT *, bool_or(starts) OVER (PARTITION BY vec_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS silent FROM w),
g AS (SELECT vec_id, i, i - row_number() OVER (PARTITION BY vec_id ORDER BY i) AS k FROM m WHERE NOT silent)
SELECT vec_id AS track_id, CAST(min(i) * 10 AS INT) AS start_ms, CAST(max(i) * 10 + 10 AS INT) AS end_ms FROM g GROUP BY vec_id, k""",
    "f0_with_hnr": f"""WITH {_NARROW} SELECT track_id, frame_idx, CASE WHEN track_id % 2 = 0 OR frame_idx < 20 THEN hnr_db END AS hnr_db, 'pad' AS rule FROM frames
UNION ALL SELECT track_id, frame_idx, hnr_db, 'cut' AS rule FROM frames WHERE track_id % 2 = 0 OR frame_idx < 20""",
    "mix_overlay": """WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings)
SELECT vec_id AS track_id, round_even(2*list_sum(x[1:32]), 6) AS mixed, round_even(list_sum(x[33:64]), 6) AS rest, CAST(32 AS INT) AS n_mixed FROM x""",
    "stem_sum": """WITH x AS (SELECT CAST(floor(vec_id / 5.0) AS BIGINT) AS track_id, embedding AS x, unnest(range(1, 65)) AS i FROM embeddings WHERE vec_id % 5 <> 0)
SELECT track_id, CAST(i - 1 AS INT) AS sample_idx, round_even(sum(CAST(x[i] AS DOUBLE)), 6) AS value FROM x GROUP BY 1, 2""",
}


def _half_even(sql: str) -> str:
    """``round_even(x, d)`` for 0 < d < 6 as integer arithmetic on x in millionths, which no binary fraction disturbs."""
    mark, at = "round_even(", 0
    while (at := sql.find(mark, at)) >= 0:
        depth, end = 1, at + len(mark)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        x, _, digits = sql[at + len(mark) : end - 1].rpartition(",")
        if 0 < (d := int(digits)) < 6:
            unit = 10 ** (6 - d)
            whole = f"floor(n / {unit}.0)"
            up = f"CASE WHEN 2 * (n - {whole} * {unit}) > {unit} OR (2 * (n - {whole} * {unit}) = {unit} AND CAST({whole} AS BIGINT) % 2 <> 0) THEN 1 ELSE 0 END"
            new = f"list_transform([CAST(round(({x}) * 1000000) AS BIGINT)], lambda n: ({whole} + {up}) / {10**d}.0)[1]"
            sql = sql[:at] + new + sql[end:]
        else:
            at += len(mark)
    return sql


ORACLE_SQL = {name: _half_even(sql) for name, sql in ORACLE_SQL.items()}
