"""Small tables of documents that hold what real ones hold: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Rows (id, text[, lang[, source]]) as documents; extra columns have names that operators might use."""

    def build(rows, extra=False):
        full = [(i, t, *(list(r) + [None, None])[:2], None if t is None else len(t)) for i, t, *r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        if extra:
            for name in ("_id", "_text", "_hash", "_group", "_key", "_copies", "_n_words", "_input", "_low", "_runs", "_score", "words", "size", "a.b"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df.repartition(3) if full else df

    return build


@pytest.fixture(scope="session")
def odd():
    """Rows with every oddity; ids are distinct but for one repeated row and two without an id."""
    rng = random.Random(3)
    vocabulary = ["alpha", "beta", "gamma", "delta", "Éclair", "naïve", "日本", "mit", "license", "the", "GNU", "general", "public"]
    some = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared_passage = some(40)
    rows = [(10, some(30), "en", "a"), (11, None, "en", "b"), (12, "", None, None), (13, " \t\n\x0b\x0c\r ", "de", "b"), (14, "one", "de", "c"), (15, "x" * 5000, "en", "c")]
    rows += [(20 + i, some(5) + "  " + shared_passage + "\n" + some(3), "en", "a") for i in range(6)]
    rows += [(30, some(6000), "fr", None), (31, shared_passage, "fr", "d"), (32, shared_passage, "fr", "d"), (40, "again " * 60, "en", "a"), (41, None, None, None)]
    rows += [(50, "repeated row " * 8, "en", "a"), (50, "repeated row " * 8, "en", "a"), (None, "no id " + some(25), "en", "b"), (None, "no id either " + some(30), "en", "b"), (-7, some(22), "es", "é")]
    return rows
