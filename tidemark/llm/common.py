"""Helpers the operators share: Arrow batches in tasks, and files in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.session import shared_folder

BATCH_ROWS = 500
BATCH_BYTES = str(8 << 20)

Columns = dict[str, list]


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of texts holds in memory, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def map_batches(
    df: DataFrame, columns: Sequence, fn: Callable[[], Callable[..., Columns]], schema: str
) -> DataFrame:
    """Apply a function of column lists to each Arrow batch of the chosen columns.

    ``fn()`` runs once per task and returns the function, so that a task can load what it needs
    (a tokenizer, an automaton) once. Only the chosen columns reach the scan and Python.
    """
    small_batches(df.sparkSession)
    arrow = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = fn()
        for batch in batches:
            out = step(*[c.to_pylist() for c in batch.columns])
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], f.type) for f in arrow], schema=arrow
            )

    return df.select(*columns).mapInArrow(run, schema)


def new_folder(spark: SparkSession, kind: str) -> str:
    """Name a folder of its own below the folder that all executors share."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex[:12]}"


def file_system(path: str):
    """File system and plain path of a path or URI, on the driver or in a task."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path


def publish(fs, draft: str, name: str) -> None:
    """Give a finished file its name, also where an earlier attempt of the task has left one."""
    try:
        fs.move(draft, name)
    except OSError:  # some file systems do not rename onto a file
        fs.delete_file(name)
        fs.move(draft, name)
