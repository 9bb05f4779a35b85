"""From raw documents to packed sequences: language ID, near duplicates, repeated passages, source mix, packing.

Every stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as Parquet and read again as the
next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessitura.llm import language_id, mixing, packing, shared, simhash, substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those too far from every known language."""
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.identify(docs, model, keep=COLUMNS).where("not _rejected").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates keep the document with the least id.

    Near: five-word shingles with a similarity of 0.8 and more. One fingerprint of 64 bits can't tell: at that similarity
    it differs in 10 bits, give or take 3. So there are six of them: a pair is a candidate if 8 bits of one differ at
    most and all together in no more than texts of that similarity do. Candidates are linked if their distinct shingles
    have the similarity.
    """
    return simhash.keep_one(docs, most=8, width=5, parts=6, similarity=0.8).select(*COLUMNS)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove passages of 20 words and more that stand earlier; documents of which nothing is left go."""
    found = substring_dedup.remove_repeats(docs, keep=["doc_id", "lang", "source"], as_is=True)
    left = found.where("_n_removed < _n_words or _n_words = 0")
    return left.select("doc_id", F.col("_kept").alias("text"), "lang", "source", F.char_length("_kept").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes, none to three.

    Rows with one id, text and source are one document here, with the copies of all.
    """
    copies = mixing.mix(docs).where("_copies > 0").groupBy("_id", "_hash", "_source").agg(F.sum("_copies").alias("_copies"))
    rows = docs.select(*COLUMNS, shared.numbered().alias("_key"), mixing.identity().alias("_ident")).dropDuplicates(["_key", "_ident", "source"])
    rows = rows.join(copies, (F.col("_key") == F.col("_id")) & (F.col("_ident") == F.col("_hash")) & F.col("source").eqNullSafe(F.col("_source")))
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    return packing.contract(packing.pack(docs))


STAGES = [
    ("language_id", identify_language),
    ("simhash", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Tokens and SimHash values are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        before, since = docs, shared.written()
        docs = shared.cut(stage(spark, docs, sf_dir), f"stage-{name}")
        shared.tidy(since, docs)
        shared.discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
