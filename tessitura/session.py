"""Session settings and the tables that the queries read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "tessitura", **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; a cluster's own settings win where they are given."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
