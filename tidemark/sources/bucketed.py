"""Tables stored in buckets of their join key, so that joins on it need no shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidemark.settings import KEYS

ROWS_PER_BUCKET = 2_000_000


def buckets_for(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two, so that tables of different sizes line up when Spark reads the larger in coarser buckets."""
    return 1 << (max(1, -(-rows // per_bucket)) - 1).bit_length()


def store(df: DataFrame, table: str, path: str, keys: Sequence[str] = tuple(KEYS), buckets: int | None = None) -> None:
    """Write a catalogue table at ``path``, bucketed and sorted by the keys.

    Rows are dealt to their buckets first, so that a bucket is one file. Rows whose key is null match nothing in a
    join; they share a bucket.
    """
    n = buckets or buckets_for(df.count())
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (
        df.repartition(n, *keys)
        .write.bucketBy(n, *keys)
        .sortBy(*keys)
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(table)
    )


def join(spark: SparkSession, tables: Sequence[str], keys: Sequence[str] = tuple(KEYS), how: str = "left") -> DataFrame:
    """Join stored tables to the first one on their bucket keys; sort-merge, bucket by bucket, without a shuffle.

    Tables in more buckets than the others are read in as many as those have.
    """
    spark.conf.set("spark.sql.bucketing.coalesceBucketsInJoin.enabled", "true")
    return reduce(lambda a, b: a.join(b.hint("merge"), list(keys), how), [spark.table(t) for t in tables])


def aggregate(spark: SparkSession, table: str, aggregates: Sequence, keys: Sequence[str] = tuple(KEYS)) -> DataFrame:
    """Group a stored table by its bucket keys, without a shuffle."""
    return spark.table(table).groupBy(*keys).agg(*aggregates)
