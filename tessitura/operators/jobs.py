"""Batch jobs over file collections: what to run, what is done, how it went, and which files to use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions import text

REQUIRED = ("vocals.wav", "acapella.wav", "metadata.json")
STATUSES = ("ok", "skipped_missing", "skipped_already_done", "download_error", "inference_error")


def prefixes(listing: DataFrame, root: str = "") -> DataFrame:
    """SRC3: the first level below ``root`` of the ``path`` column, each once."""
    below = F.substring(F.col("path"), len(root) + 1, 1 << 20)
    return listing.where(F.col("path").startswith(root) & below.contains("/")).select(F.concat(F.lit(root), F.substring_index(below, "/", 1), F.lit("/")).alias("subprefix")).distinct()


def file_gate(listing: DataFrame, required: tuple[str, ...] = REQUIRED, optional: tuple[str, ...] = ("vad_segments.csv",)) -> DataFrame:
    """SRC4, SRC5, JN2, JN3: per prefix whether all required files are there, and each optional one. One aggregation."""
    named = listing.select(F.regexp_extract("path", "^(.*/)[^/]+$", 1).alias("subprefix"), text.last_segment("path").alias("_name"))
    has = lambda n: F.coalesce(F.bool_or(F.col("_name") == n), F.lit(False))
    complete = has(required[0])
    for n in required[1:]:
        complete = complete & has(n)
    return named.groupBy("subprefix").agg(complete.alias("complete"), *[has(n).alias("has_" + n.replace(".", "_")) for n in optional])


def plan_jobs(listing: DataFrame, done: DataFrame, key: str = "subprefix", limit: int | None = None, only=None, overwrite: bool = False) -> DataFrame:
    """FIL8-10, JN4, LIM1: the items to run. ``limit`` counts submitted items in order, before done ones are taken out."""
    items = listing.where(F.col(key) == F.lit(only)) if only is not None else listing
    if limit is not None:
        items = items.orderBy(key).limit(limit)
    return items if overwrite else items.join(done.select(key).distinct(), key, "left_anti")


def outcomes(submitted: DataFrame, complete: str, done: DataFrame, key: str = "subprefix", overwrite: bool = False) -> DataFrame:
    """CTL4 for items that don't reach inference: missing files come before already done; the rest is null."""
    marked = submitted.join(done.select(key).distinct().withColumn("_done", F.lit(True)), key, "left")
    status = F.when(~F.col(complete), "skipped_missing")
    if not overwrite:
        status = status.when(F.col("_done"), "skipped_already_done")
    return marked.withColumn("status", status).drop("_done")


def job_summary(results: DataFrame, submitted: Column | None = None) -> DataFrame:
    """AGG9, AGG15: totals by kind of status, and the exit code (CTL5)."""
    counts = results.agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.startswith("status", F.lit("skipped"))).alias("skipped"),
        F.count_if(F.endswith("status", F.lit("error"))).alias("errors"),
    )
    return counts.withColumn("exit_code", (F.col("errors") > 0).cast("int"))


def upsert_key(documents: DataFrame, values: DataFrame, key: str, name: str, on: str) -> DataFrame:
    """SNK9: replaces one top-level key of JSON documents; all other keys, known or not, stay as they are."""
    joined = documents.join(values.select(F.col(on), F.col("value").alias("_value")), on, "left")
    return joined.withColumn(name, with_key(name, key, "_value")).drop("_value")


def with_key(document: str, key: str, value: str) -> Column:
    """A JSON document with one top-level key replaced by a JSON value; as it is where the value is null.

    The document is read as a map of variants, so a missing key and a null one stay different.
    """
    old = F.from_json(F.to_json(F.from_json(F.col(document), "map<string,variant>")), "map<string,variant>")
    kept = F.map_filter(old, lambda k, v: k != key)
    entry = F.map_from_arrays(F.array(F.lit(key)), F.array(F.parse_json(value)))
    return F.when(F.col(value).isNull(), F.col(document)).otherwise(F.to_json(F.map_concat(kept, entry)))


def has_key(document: Column, key: str) -> Column:
    """FIL9: whether a JSON object has a top-level key, with whatever value, null included."""
    return F.array_contains(F.json_object_keys(document), F.lit(key))


_TRAINING = r"^(?:\._|_)?[DG]_"


def inference_checkpoints(files: DataFrame, group: str, name: str = "name") -> DataFrame:
    """FIL7: ``.pth`` files of a group that aren't training states; if none is left, those without ``D_`` in the name."""
    found = files.where(F.endswith(F.col(name), F.lit(".pth"))).withColumn("_usable", ~F.col(name).rlike(_TRAINING))
    any_ = F.max("_usable").over(Window.partitionBy(group))
    return found.withColumn("_any", any_).where(F.when(F.col("_any"), F.col("_usable")).otherwise(~F.contains(F.col(name), F.lit("D_")))).drop("_usable", "_any")


def best_index(files: DataFrame, group: str, name: str = "name", valid: Column | None = None) -> DataFrame:
    """TOP1, SET1: the first valid ``.index`` file of a group: those that start with ``added_`` come first, then by name."""
    found = files.where(F.endswith(F.col(name), F.lit(".index")) & (F.lit(True) if valid is None else valid))
    return first_by(found, group, (~F.startswith(F.col(name), F.lit("added_"))).cast("int"), F.col(name))


def first_by(rows: DataFrame, group: str, *order) -> DataFrame:
    """TOP2: the first row of each group."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where("_rank = 1").drop("_rank")


def stem_file(files: DataFrame, group: str, *keywords: str, name: str = "name") -> DataFrame:
    """TOP3: the first file of a group whose name holds one of the keywords, whatever the case."""
    hit = F.lit(False)
    for k in keywords:
        hit = hit | F.contains(F.lower(F.col(name)), F.lit(k.lower()))
    return first_by(files.where(hit), group, F.col(name))


def choose_backend(rows: DataFrame, key: str, backends: tuple[str, ...], seed: str = "0") -> DataFrame:
    """UDF1, H8: one of several backends per row by a hash of seed and key, so reruns agree."""
    number = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")
    return rows.withColumn("backend", F.element_at(F.array(*map(F.lit, backends)), (number % len(backends) + 1).cast("int")))


def check_backend(name: str | None, known: tuple[str, ...]) -> str | None:
    """FIL11, D15."""
    if name is not None and name not in known:
        raise ValueError(f"{name!r} is none of {', '.join(known)}")
    return name
