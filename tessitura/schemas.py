"""Explicit schemas of the data model; nothing is inferred."""

from __future__ import annotations

F0_FRAME = "track_id string, frame_idx int, time double, f0_hz double, f0_midi double, voiced boolean, hnr_db double"
PITCH_WINDOW = (
    "track_id string, index int, t_start double, t_end double, voiced_ratio double, std_semitones double, "
    "median_hnr_db double, mean_midi double, mean_hz double, note string, stable boolean"
)
NOTE_STATS = (
    "track_id string, midi int, note string, hz double, mean_hnr double, median_hnr double, min_hnr double, "
    "n_frames bigint, first_time double, last_time double"
)
VOCAL_SEGMENT = "track_id string, index int, start_ms bigint, end_ms bigint, duration_ms bigint, filename string"
TRANSCRIPT = "text string, language string, segments array<struct<start:double,end:double,text:string>>"
LYRICS_EVAL = (
    "source_text string, converted_text string, source_language string, converted_language string, wer double, cer double, "
    "substitutions int, deletions int, insertions int, hits int, mer double, wil double, wip double, note string, vad_source string"
)
STAGES = "separation:boolean,dereverberation:boolean,desilencing:boolean,rvc:boolean,reassembly:boolean"
TRACK_METADATA = (
    f"source_audio string, source_md5 string, rvc_checkpoint_dir string, rvc_md5 string, stages struct<{STAGES}>, separation_backend string, "
    "f0_up_key int, f0_method string, index_rate double, rms_mix_rate double, protect double, num_segments int, num_converted int, "
    "output_wav string, timestamps_csv string"
)
JOB_RESULT = "subprefix string, status string, wer double, cer double, infer_s double, source_language string, converted_language string, error string"
VAD_MS = "start_ms bigint, end_ms bigint"
VAD_SECONDS = "start_time double, end_time double"
