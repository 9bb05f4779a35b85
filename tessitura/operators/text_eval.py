"""Transcript pairs: word and character error rates and their details."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.functions import text


def evaluate_pairs(pairs: DataFrame, source: str = "source_text", converted: str = "converted_text", details: bool = True) -> DataFrame:
    """TXT1-6: adds ``wer, cer``, the details, ``note`` and ``language_mismatch`` to every pair.

    Texts are normalised first. Two empty ones score 0, one empty 1, both with a note and without details. Distances
    and alignments are computed in Python, for all pairs of a batch at once. Whole texts count; time is in proportion to the
    product of their lengths.
    """
    rows = pairs.withColumn("_a", text.tokens(text.normalise(F.coalesce(F.col(source), F.lit(""))))).withColumn("_b", text.tokens(text.normalise(F.coalesce(F.col(converted), F.lit("")))))
    a, b = F.array_join("_a", " "), F.array_join("_b", " ")
    none, one = (F.size("_a") == 0) & (F.size("_b") == 0), (F.size("_a") == 0) | (F.size("_b") == 0)
    score = lambda edits, whole: F.when(none, 0.0).when(one, 1.0).otherwise(F.try_divide(edits, whole))
    rows = rows.withColumn("word_edits", text.word_distance("_a", "_b")).withColumn("char_edits", text.char_distance(a, b))
    rows = rows.withColumn("wer", score(F.col("word_edits"), F.size("_a"))).withColumn("cer", score(F.col("char_edits"), F.length(a)))
    rows = rows.withColumn("note", F.when(none, "both texts are empty").when(one, "one text is empty"))
    if {"source_language", "converted_language"} <= set(pairs.columns):
        rows = rows.withColumn("language_mismatch", ~F.col("source_language").eqNullSafe(F.col("converted_language")))
    if details:
        rows = rows.withColumn("_d", F.when(~one, text.alignment("_a", "_b")))
        for c in ("hits", "substitutions", "deletions", "insertions"):
            rows = rows.withColumn(c, F.col(f"_d.{c}"))
        edits = F.col("substitutions") + F.col("deletions") + F.col("insertions")
        rows = rows.withColumn("mer", F.try_divide(edits, edits + F.col("hits")))
        rows = rows.withColumn("wip", F.try_divide(F.col("hits"), F.size("_a")) * F.try_divide(F.col("hits"), F.size("_b"))).withColumn("wil", 1 - F.col("wip")).drop("_d")
    return rows.drop("_a", "_b")
