"""One local session for all tests, and a comparison with DuckDB over the same tables."""

from __future__ import annotations

import math
import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = os.environ.get("TEST_DATA", "/root/testdata")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    """Rows of a SQL text over the tables of a scale."""

    def run(sql: str, sf: str = "sf0.01"):
        con = duckdb.connect()
        for name in TABLES:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{sf}/{name}.parquet')")
        cursor = con.execute(sql)
        return [c[0] for c in cursor.description], cursor.fetchall()

    return run


def _plain(x):
    if isinstance(x, float):
        return "NaN" if math.isnan(x) else round(x, 6) + 0.0
    return x


def rows_of(columns, rows):
    """Rows as sorted tuples with their columns in order of name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def same(spark, duck):
    """Assert that a query and a SQL text give the same rows, duplicates and all."""

    def check(query, sql: str, sf: str = "sf0.01"):
        df = query(spark, f"{DATA}/{sf}")
        columns, expected = duck(sql, sf)
        assert sorted(df.columns) == sorted(columns)
        got = rows_of(df.columns, [tuple(r) for r in df.collect()])
        want = rows_of(columns, expected)
        assert len(got) == len(want)
        assert got == want

    return check
