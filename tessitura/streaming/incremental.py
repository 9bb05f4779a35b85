"""STM4: process what is new and stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def process_new(spark: SparkSession, source: str, schema: str, transform: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, source_format: str = "parquet", **options: str) -> StreamingQuery:
    """Every file of ``source`` that no earlier run has seen goes through ``transform`` into ``sink`` (Parquet).

    Progress is kept in ``checkpoint``; a batch that is run again replaces its own output, so each file counts once.
    """
    rows = spark.readStream.format(source_format).schema(schema).options(**options).load(source)

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
