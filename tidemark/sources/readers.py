"""Scans: raw files, snapshot tables and files of several formats."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import commits
from tidemark.sources.json_records import to_lines


class NoData(Exception):
    """The input is absent or empty."""


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema; quotes inside quoted fields are doubled."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)  # a header in another order is an error, not a mix-up
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, snapshot=None) -> DataFrame:
    """Snapshot table as last published: all snapshots in one frame, or one of them by partition pruning.

    A folder of plain Parquet files by snapshot is read as it stands.
    """
    manifest = commits.newest(spark, path)
    if manifest is None:
        df = spark.read.parquet(path)
    else:
        df = commits.read(spark, path, manifest, None if snapshot is None else [snapshot])
    if snapshot is None:
        return df
    return df.where(F.col("snapshot_date") == F.lit(snapshot).cast("date"))


def read_if_present(
    spark: SparkSession, path: str, snapshot=None, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table if it exists and holds the snapshot, else an empty frame of ``schema`` or None."""
    try:
        df = read_table(spark, path, snapshot)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        df = None
    if df is not None and (snapshot is None or not df.isEmpty()):
        return df
    return None if schema is None else spark.createDataFrame([], schema)


def read_first_present(frames: Sequence[DataFrame | None]) -> list[DataFrame]:
    """The sources that exist; an error when there is none."""
    present = [f for f in frames if f is not None]
    if not present:
        raise NoData("none of the sources exists")
    return present


def _first_line(spark: SparkSession, path: str) -> str | None:
    """The first line that is not blank."""
    first = spark.read.text(path).where(F.trim("value") != "").select(F.trim("value")).first()
    return first and first[0]


def looks_like_json(first_line: str | None) -> bool:
    """Whether text whose first line that is not blank is this one starts like JSON records."""
    return first_line is not None and first_line[0] in "{["


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON records in any layout and mix of layouts; records that do not parse are skipped.

    The records are found by as many tasks as the files have splits, and written once, a line each.
    """
    folder = to_lines(spark, path)
    lines = spark.read.text(folder)
    if schema is None:
        schema = spark.read.option("mode", "DROPMALFORMED").json(folder).schema
    struct = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    told = T.StructType([*struct.fields, T.StructField(_MALFORMED, T.StringType())])
    parsed = lines.select(
        F.from_json("value", told, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _MALFORMED}).alias("r")
    )
    return parsed.where(F.col("r").isNotNull() & F.col(f"r.{_MALFORMED}").isNull()).select(
        *[F.col(f"r.`{c}`") for c in struct.fieldNames()]
    )


_MALFORMED = "__malformed"


def read_any(
    spark: SparkSession,
    path: str,
    allowed: Sequence[str] = ("parquet", "jsonl", "json", "csv"),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read by extension; a ``.csv`` or unknown file that starts like JSON is read as JSON.

    Raises ``NoData`` for a missing, zero-byte or row-less input and ``ValueError`` for an
    extension outside ``allowed``.
    """
    extension = os.path.splitext(path.rstrip("/"))[1].lstrip(".").lower()
    if extension in ("parquet", "jsonl", "csv", "json") and extension not in allowed:
        raise ValueError(f"unsupported file format: {extension}")
    try:
        if extension == "parquet":
            df = spark.read.parquet(path)
        elif extension == "jsonl":
            reader = spark.read.option("mode", "DROPMALFORMED")
            df = (reader.schema(schema) if schema else reader).json(path)
        elif looks_like_json(_first_line(spark, path)):
            df = read_json_records(spark, path, schema)
        else:
            reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
            df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
        if df.isEmpty():
            raise NoData(f"no rows in {path}")
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise NoData(f"nothing to read at {path}") from e
        raise
    return df


def read_or_none(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """``read_any`` with no data as None."""
    try:
        return read_any(spark, path, **options)
    except NoData:
        return None


def read_scoring_input(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Batch-scoring input: parquet or CSV only.

    A CSV is read in one scan where its ``schema`` is given; without one Spark looks for types first.
    """
    extension = os.path.splitext(path.rstrip("/"))[1].lstrip(".").lower()
    if extension not in ("parquet", "csv"):
        raise ValueError(f"unsupported file format: {extension or path}")
    return read_any(spark, path, allowed=("parquet", "csv"), schema=schema)
