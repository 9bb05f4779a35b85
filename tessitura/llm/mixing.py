"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessitura.llm import shared

#: Copies of a document at most.
MOST = 3
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(column):
    """How many words ``[^\\x20\\x09-\\x0D]+`` a text has; null has none."""
    return F.coalesce(F.regexp_count(F.col(column).cast("string"), F.lit(_WORD)), F.lit(0)).cast("long")


def identity(id_col: str = "doc_id", text_col: str = "text"):
    """A hash that tells documents apart, also those without an id."""
    return F.xxhash64(shared.numbered(id_col), F.col(text_col).cast("string"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """``_source, _source_size, _target``: all words shared by weight, no source above ``most`` times its own.

    Sources are ordered by code point (of their UTF-8 bytes), null last, and weighed by ``weights`` in turn. What a
    source can't take is shared by weight among the others. A source is full from a level on that is proportional to
    its words per weight, so the full ones are a prefix in that order and one window over the sources finds them all.
    """
    totals = sizes.groupBy("_source").agg(F.sum("_size").alias("_source_size"))
    # one row per source from here on
    position = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("_source").isNull(), F.encode(F.col("_source"), "UTF-8"))) - 1
    weighed = totals.withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(position, F.lit(len(weights))) + 1).cast("int")))
    every = Window.partitionBy(F.lit(0))
    ascending = every.orderBy(F.col("_source_size") / F.col("_weight"), F.col("_source").isNull(), F.encode(F.col("_source"), "UTF-8"))
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("_source_size").over(every) - most * F.coalesce(F.sum("_source_size").over(before), F.lit(0))
    weight_left = F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    leveled = weighed.withColumn("_level", left / weight_left).withColumn("_full", F.col("_weight") * F.col("_level") >= most * F.col("_source_size"))
    level = F.min(F.when(~F.col("_full"), F.struct(F.col("_source_size") / F.col("_weight"), F.col("_level").alias("level")))).over(every)["level"]
    return leveled.withColumn("_share", level).select(
        "_source", "_source_size", F.when(F.col("_full"), F.lit(float(most)) * F.col("_source_size")).otherwise(F.least(F.col("_weight") * F.col("_share"), F.lit(float(most)) * F.col("_source_size"))).alias("_target")
    )


def solve(sizes: np.ndarray, counts: np.ndarray, target: float, most: int = MOST, tolerance: float = 1e-9) -> float:
    """The multiplier of one source's entropy balancing problem, from the histogram of its sizes.

    Of all rates r(d) in 0 .. most with sum r(d) size(d) = target, those of least relative entropy to one copy each are
    min(most, exp(lambda x(d))) with x = size / mean size. Constraints of different sources share no document, so the
    convex dual falls apart into one number per source, and sources are solved where their histograms are. Newton steps
    are kept inside the bracket found so far; a step outside halves it, so the search ends at any target.
    """
    mean = float((sizes * counts).sum() / max(counts.sum(), 1))
    if mean <= 0 or target <= 0:
        return 0.0 if target > 0 or mean <= 0 else -math.inf
    x, mass = sizes / mean, (sizes * counts).astype(float)
    if target >= most * mass.sum() * (1 - 1e-12):
        return math.inf
    low, high, at = -1.0, 1.0, 0.0
    now = lambda v: np.minimum(most, np.exp(np.minimum(v * x, 20.0)))
    while (mass * now(low)).sum() > target:
        low *= 2
    while (mass * now(high)).sum() < target:
        high *= 2
    for _ in range(400):
        rate = now(at)
        gap = float((mass * rate).sum() - target)
        if abs(gap) <= tolerance * target or high - low <= 1e-15 * max(1.0, abs(at)):
            return at
        low, high = (low, at) if gap > 0 else (at, high)
        slope = float((mass * x * rate)[rate < most].sum())
        step = at - gap / slope if slope > 0 else low
        at = step if low < step < high else (low + high) / 2
    raise ArithmeticError(f"no rates for a target of {target} words")


def _round(most: int):
    """applyInPandas over the cells of one source: rates, and from them whole copies per cell; the rest of each goes to the next smaller size."""

    def run(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        cells = cells.sort_values(["_size", "_group"], ascending=[False, True])
        sizes, counts = cells["_size"].to_numpy(float), cells["_n"].to_numpy(float)
        multiplier = solve(sizes, counts, float(cells["_target"].iloc[0]), most)
        mean = max(float((sizes * counts).sum() / max(counts.sum(), 1)), 1e-300)
        with np.errstate(invalid="ignore"):
            rates = np.where(sizes > 0, np.minimum(most, np.exp(np.minimum(multiplier * sizes / mean, 20.0))), 1.0)
        carry, out = 0.0, []
        for n, size, rate in zip(cells["_n"].tolist(), cells["_size"].tolist(), rates.tolist(), strict=True):
            want = n * rate * size + carry
            copies = min(most * n, max(0, int(want / size + 0.5))) if size else n
            carry = want - copies * size
            out.append(copies)
        for i, (n, size) in enumerate(zip(cells["_n"].tolist(), cells["_size"].tolist(), strict=True)):
            # what the small ones couldn't take in, where a document more or less brings the sum nearer
            if size and 2 * abs(carry) > size:
                more = min(int(abs(carry) / size + 0.5), most * n - out[i]) if carry > 0 else -min(int(-carry / size + 0.5), out[i])
                out[i] += more
                carry -= more * size
        return cells.assign(_copies=out)[["_source", "_size", "_group", "_n", "_copies"]]

    return run


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``_id, _hash, _source, _size, _source_size, _target, _copies`` of every row of ``docs``.

    Rates come from :func:`solve` and are rounded into copies: documents of a source and size have one rate and form a
    cell (a large one is several, by a hash of id and text). A cell takes a whole number of copies, and what is left over
    goes to the next smaller size and, if the small ones can't take it in, to any other that brings the sum nearer, so no
    copy more or less brings a source nearer to its target. Within a cell all documents get the same copies but for the
    first ones by ``_hash``, that of id and text (:func:`identity`), so reruns agree. Repeated rows are counted before
    anything is ranked and are documents of their own, told apart by nothing, so any of them may get the copy. A document
    without words counts nothing and keeps one copy; of a source without a target nothing with words is taken. A null
    source is one of its own; an empty table gives an empty mix. One task holds the cells of a source: its distinct
    sizes, no more than its longest document has words, and 10 x tasks at most for large ones. The targets take one row a
    source through one task.
    """
    ident = identity(id_col, text_col)
    sized = docs.select(F.col(source_col).alias("_source"), word_count(text_col).alias("_size"), shared.numbered(id_col).alias("_id"), ident.alias("_hash"))
    sized = shared.cut(sized.groupBy("_source", "_size", "_id", "_hash").agg(F.count("*").alias("_m")), "sizes")
    counts = shared.cut(sized.groupBy("_source", "_size").agg(F.sum("_m").alias("_n")), "counts")
    goals = shared.cut(targets(counts.select("_source", (F.col("_n") * F.col("_size")).alias("_size")), weights, most), "targets")
    # cells with a tenth of a task's rows are ranked in several groups; there are at most 10 x tasks of them
    tasks = shared.shuffle_partitions(docs.sparkSession)
    limit = max(shared.LEAST_RANKED, (counts.agg(F.sum("_n")).first()[0] or 0) // (10 * tasks))
    big = counts.where(F.col("_n") > limit).select(F.col("_source").alias("_bs"), F.col("_size").alias("_bz"), F.ceil(F.col("_n") / limit).alias("_groups"))
    with_groups = sized.join(F.broadcast(big), F.col("_source").eqNullSafe(F.col("_bs")) & (F.col("_size") == F.col("_bz")), "left")
    grouped = with_groups.withColumn("_group", F.pmod("_hash", F.coalesce("_groups", F.lit(1))).cast("int")).drop("_bs", "_bz", "_groups")
    cells = grouped.groupBy("_source", "_size", "_group").agg(F.sum("_m").alias("_n"))
    aims = goals.select(F.col("_source").alias("_s"), "_source_size", "_target")
    kind = docs.schema[source_col].dataType.simpleString()
    rounded = cells.join(aims.drop("_source_size"), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s").groupBy("_source").applyInPandas(_round(most), f"_source {kind}, _size long, _group int, _n long, _copies long")
    plan = rounded.join(aims, F.col("_source").eqNullSafe(F.col("_s"))).select(
        F.col("_source").alias("_ps"), F.col("_size").alias("_pz"), F.col("_group").alias("_pg"), "_n", "_copies", "_source_size", "_target"
    )
    before = F.sum("_m").over(Window.partitionBy("_source", "_size", "_group").orderBy("_hash", "_id").rowsBetween(Window.unboundedPreceding, -1))
    ranked = grouped.withColumn("_before", F.coalesce(before, F.lit(0)))
    placed = ranked.join(plan, F.col("_source").eqNullSafe(F.col("_ps")) & (F.col("_size") == F.col("_pz")) & (F.col("_group") == F.col("_pg")))
    even = F.floor(F.col("_copies") / F.col("_n"))
    placed = placed.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1)))
    more = F.when(F.col("_before") + F.col("_i") < F.col("_copies") - even * F.col("_n"), 1).otherwise(0)
    return placed.select("_id", "_hash", "_source", "_size", "_source_size", "_target", (even + more).cast("long").alias("_copies"))


def op3_mixing(spark, sf_dir):
    found = mix(shared.documents(spark, sf_dir))
    real = F.when(F.col("_id") != shared.NULL_ID, F.col("_id"))
    return found.select(real.alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_copies") * F.col("_size")).alias("taken"))
