"""Raw snapshot files that arrive over time, cleaned as they land."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import clean
from tidemark.sources import schemas
from tidemark.sources.readers import read_table
from tidemark.sources.writers import write_snapshots


def clean_arrivals(
    spark: SparkSession, entity: str, source: str, target: str, checkpoint: str
) -> StreamingQuery:
    """Clean every raw CSV not seen before and add it to its snapshots, then stop.

    The silver rules work row by row, so the batch code runs unchanged on each micro-batch. A
    micro-batch is added under a key of its own: files that arrive late add to a snapshot, and a
    replayed micro-batch that has landed is not written again. The key names the stream's checkpoint as
    well, so that two streams may share a target.
    """
    stream = hashlib.sha1(checkpoint.encode()).hexdigest()[:8]
    raw = (
        spark.readStream.schema(schemas.RAW[entity])
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(source)
    )

    def land(batch: DataFrame, number: int) -> None:
        write_snapshots(batch, target, key=f"{stream}-{number}")

    return (
        clean.SILVER[entity](raw)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_arrivals(spark: SparkSession, target: str, snapshot=None) -> DataFrame:
    """All rows that have arrived, or those of one snapshot."""
    return read_table(spark, target, snapshot)
