"""License scans with DataFrame functions only: a projection of the scan, without a shuffle."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessitura.llm import shared
from tessitura.llm.license_rules import GAP, rules

#: One of these stands in every text that a rule can match, so other texts are done after the count of their words.
GATES = ("licen", "copyright", "rights reserved", "public domain", "publicdomain", "creative commons", "creativecommons", "cc by", "cc-by", "cc0", "gpl", "mpl", "apache", "bsd", "wtfpl", "cecill", "commons clause", "open data commons", "the mit", "mit no attribution", "permission is hereby", "permission to use", "redistribution and use", "neither the name", "advertising", "permission notice", "redistributions ", "endorse or promote", "following acknowledg", "misrepresented", "altered source versions", "contributing authors", "cryptographic software", "openssl toolkit", "jpeg group", "linking this library", "classpath exception", "deal in the software", "free to copy", "same terms as", "personal use", "written permission", "trade secret", "polyform", "openrail", "as-is", "what the fuck", "not evil", "confidential", "unauthori", "noderiv", "no-deriv", "commercial use", "either version")
_BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


def _rule_table(found: list) -> Column:
    """The rules as a constant, by keyword."""
    by: dict[str, list] = {}
    for label, word, exp, rank, sure in found:
        by.setdefault(word, []).append(F.struct(F.lit(label).alias("label"), F.lit(exp).alias("exp"), F.lit(rank).alias("rank"), F.lit(sure).alias("sure")))
    return F.array(*[F.struct(F.lit(word).alias("word"), F.array(*some).alias("rules")) for word, some in by.items()])


def _detections(low: Column, table: Column) -> Column:
    """Every match of every rule whose keyword stands in the text: (start, -end, rank, label, sure), by these, sorted."""

    def of_rule(rule: Column) -> Column:
        hits = F.regexp_extract_all(low, rule["exp"], F.lit(0))
        gaps = F.split(low, rule["exp"], -1)
        start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.expr("cast(array() as array<struct<start:int,back:int,rank:int,label:string,sure:int>>)").alias("found"))

        def step(acc: Column, hit: Column) -> Column:
            begin = acc["at"] + F.length(F.get(gaps, acc["i"]))
            end = begin + F.length(hit)
            one = F.struct(begin.cast("int").alias("start"), (-end).cast("int").alias("back"), rule["rank"].alias("rank"), rule["label"].alias("label"), rule["sure"].alias("sure"))
            return F.struct(end.cast("int").alias("at"), (acc["i"] + 1).cast("int").alias("i"), F.array_append(acc["found"], one).alias("found"))

        return F.aggregate(hits, start, step, lambda acc: acc["found"])

    named = F.flatten(F.transform(F.filter(table, lambda group: F.contains(low, group["word"])), lambda group: group["rules"]))
    return F.array_sort(F.flatten(F.transform(named, of_rule)))


def _standing(found: Column) -> Column:
    """Detections that lie in no other: of equal intervals the one of the best priority stays.

    Sorted by start, then by end downwards, then by priority, one lies in another exactly if an earlier one ends no sooner.
    """
    begin = F.struct(F.lit(0).alias("end"), F.expr("cast(array() as array<struct<label:string,sure:int>>)").alias("kept"))

    def step(acc: Column, d: Column) -> Column:
        inside = -d["back"] <= acc["end"]
        more = F.array_union(acc["kept"], F.array(F.struct(d["label"], d["sure"])))
        return F.struct(F.when(inside, acc["end"]).otherwise(-d["back"]).alias("end"), F.when(inside, acc["kept"]).otherwise(more).alias("kept"))

    return F.aggregate(found, begin, step, lambda acc: acc["kept"])


def scan(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) with ``_n_words, _n_base, _first_word, _last_word, _base_labels,
    _labels, _score``.

    Base: places where the words of a phrase stand one after the other. Labels of the method: hundreds of signature
    rules, each tried only where its keyword stands; a detection inside another is dropped, of two on one interval the
    better priority stays. Line ends, tabs and comment signs between words count as one space. ``_score`` is the confidence of the surest detection, 0 without any. Null texts are empty: no
    words, empty labels, null places. Whole texts are scanned, and nothing but the row itself is needed for it.
    """
    keep = shared.others(docs.columns if keep is None else keep, ["_n_words", "_n_base", "_first_word", "_last_word", "_base_labels", "_labels", "_score"])
    along = [f"_carried{i}" for i in range(len(keep))]
    rows = docs.select(*shared.carried(keep), F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase).alias("_low"))
    edge = lambda c: F.when(c.rlike(f"^{_BREAK}"), 1).otherwise(0)
    n = F.when(F.col("_low") == "", 0).otherwise(F.size(F.split("_low", _BREAK, -1)) - edge(F.substring("_low", 1, 1)) - edge(F.right("_low", F.lit(1))))
    rows = rows.withColumn("_n_words", n.cast("long"))
    # each word with a space of its own on both sides, so that phrases next to each other don't share one
    spaced = F.concat(F.lit(" "), F.array_join(F.array_remove(F.split("_low", _BREAK, -1), ""), "  "), F.lit(" "))
    rows = rows.withColumn("_spaced", F.when(F.contains("_low", F.lit("license")), spaced))
    rows = rows.withColumn("_flat", F.regexp_replace("_low", GAP, " "))
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in _BASE:
        words = phrase.split()
        inside = F.lit("".join(f" {w} " for w in words))
        size = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))  # noqa: E731  spaces: two a word
        n_here = (F.length("_spaced") - F.length(F.replace(F.col("_spaced"), inside, F.lit("")))) / len("".join(f" {w} " for w in words))
        here = F.contains("_spaced", inside)
        counts.append(F.coalesce(F.when(here, n_here), F.lit(0)))
        firsts.append(F.when(here, size(F.substring_index("_spaced", "".join(f" {w} " for w in words), 1)) / 2))
        lasts.append(F.when(here, F.col("_n_words") - size(F.substring_index("_spaced", "".join(f" {w} " for w in words), -1)) / 2 - len(words)))
        labels.append(F.when(here, F.lit(label)))
    gated = F.lit(False)
    for word in GATES:
        here = F.contains("_flat", F.lit(word))
        gated = gated | (here & F.col("_flat").rlike(r"\bmpl") if word == "mpl" else here)  # not example, simple, template
    kept = F.when(gated, _standing(_detections(F.col("_flat"), _rule_table(rules()))))
    rows = rows.select(
        *along, "_n_words", sum(counts[1:], counts[0]).cast("long").alias("_n_base"), F.least(*firsts).cast("long").alias("_first_word"), F.greatest(*lasts).cast("long").alias("_last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("_base"), kept.alias("_kept"),
    )
    every = F.array_sort(F.array_union("_base", F.coalesce(F.transform("_kept", lambda d: d["label"]), F.expr("cast(array() as array<string>)"))))
    score = F.greatest(F.coalesce(F.array_max(F.transform("_kept", lambda d: d["sure"])), F.lit(0)), F.when(F.col("_n_base") > 0, 80).otherwise(0)) / 100.0
    return rows.select(*shared.restored(keep), "_n_words", "_n_base", "_first_word", "_last_word", F.array_join("_base", ",").alias("_base_labels"), F.array_join(every, ",").alias("_labels"), score.cast("double").alias("_score"))


def op8_license_scan(spark, sf_dir):
    found = scan(shared.documents(spark, sf_dir), keep=["doc_id"])
    return found.select("doc_id", *[F.col("_" + c).alias(c) for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])
