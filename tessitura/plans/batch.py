"""The evaluation of a collection of items: which are complete, which are done, their error rates, and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.operators import jobs
from tessitura.operators.text_eval import evaluate_pairs

_SCORES = ("wer", "cer", "source_language", "converted_language", "substitutions", "deletions", "insertions", "hits", "mer", "wil", "wip", "note", "language_mismatch")


def evaluate(listing: DataFrame, documents: DataFrame, transcripts: DataFrame, block: str = "lyrics_eval", overwrite: bool = False, details: bool = True) -> DataFrame:
    """SRC5, JN2, FIL9, CTL4, SNK9: ``subprefix, status``, scores and the new ``document`` of every item of ``listing``.

    ``listing`` has the ``path`` of every file, ``documents`` an item's metadata as JSON (``subprefix, document``) and
    ``transcripts`` its texts (``subprefix, source_text, converted_text`` and languages; ``error`` is not null where
    there are none). Items without all required files are skipped, then those whose document has ``block``. An item without
    a document or with an unreadable one can't be fetched, one without transcripts wasn't inferred. Each is one row; joins
    are on ``subprefix``.
    """
    gate = jobs.file_gate(listing).select("subprefix", "complete")
    items = gate.join(documents.select("subprefix", "document"), "subprefix", "left")
    readable = F.try_parse_json("document").isNotNull()
    has = readable & F.coalesce(jobs.has_key(F.col("document"), block), F.lit(False))
    status = F.when(~F.col("complete"), "skipped_missing")
    if not overwrite:
        status = status.when(has, "skipped_already_done")
    items = items.withColumn("status", status.when(~readable, "download_error"))
    scored = evaluate_pairs(transcripts.where("error is null"), details=details)
    kept = [c for c in _SCORES if c in scored.columns]
    entry = F.to_json(F.struct("source_text", "converted_text", *kept))
    found = items.join(scored.select("subprefix", *kept, entry.alias("_entry")), "subprefix", "left")
    found = found.withColumn("status", F.coalesce("status", F.when(F.col("_entry").isNull(), "inference_error").otherwise("ok")))
    ok = F.col("status") == "ok"
    result = found.select("subprefix", "status", "document", *[F.when(ok, F.col(c)).alias(c) for c in kept], F.when(ok, F.col("_entry")).alias("_entry"))
    return result.withColumn("document", jobs.with_key("document", block, "_entry")).drop("_entry")  # in its own row: to join it would score all pairs again


def report(results: DataFrame) -> DataFrame:
    """SNK10, AGG9: one row: the counts of :func:`jobs.job_summary` with the mean and the median rates of scored items."""
    mean = lambda c: F.bround(F.avg(c), 6)
    counts = results.agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.startswith("status", F.lit("skipped"))).alias("skipped"),
        F.count_if(F.endswith("status", F.lit("error"))).alias("errors"), mean("wer").alias("mean_wer"), mean("cer").alias("mean_cer"), F.bround(F.percentile("wer", 0.5), 6).alias("median_wer"),
    )
    return counts.withColumn("exit_code", (F.col("errors") > 0).cast("int"))


def lines(results: DataFrame) -> list[str]:
    """SNK10: the report as text; the driver gets one row of counts."""
    return [f"{name}: {value}" for name, value in report(results).first().asDict().items()]
