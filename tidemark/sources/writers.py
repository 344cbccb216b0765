"""Sinks: idempotent snapshot tables, predictions, monitoring and registry records."""

from __future__ import annotations

import logging
import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources import commits

log = logging.getLogger(__name__)


def write_snapshots(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    max_records_per_file: int = 5_000_000,
    months: Iterable | None = None,
    key: str | None = None,
    notes: Mapping | None = None,
    by_month: bool = False,
) -> None:
    """Publish the rows by snapshot: a snapshot in ``df`` replaces the old one, others stay.

    ``months`` are the snapshots that are being rebuilt: one of them without rows in ``df`` is cleared. With a
    ``key`` the rows are added to their snapshots instead, once however often that is tried. All that a
    call changes becomes visible in one step; ``notes`` are kept with it. Rows that come ``by_month`` from files
    of a snapshot each are not shuffled.
    """
    if key is not None:
        commits.add_once(df, path, key, max_records_per_file)
    else:
        commits.replace_months(df, path, months or (), fmt, max_records_per_file, dict(notes or {}), by_month=by_month)


def write_compact(
    df: DataFrame, path: str, files: int | None = None, max_records_per_file: int = 5_000_000
) -> None:
    """Write a table as few, well filled files: ``files`` of them, or as the data size asks.

    The rows are dealt out anew, so the work above keeps its own parallelism.
    """
    df = df.hint("rebalance") if files is None else df.repartition(files)
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(path)


def write_predictions(df: DataFrame, path: str, default_format: str = "csv") -> str:
    """Write scored rows in the format the path's extension names, else the default; returns it."""
    extension = os.path.splitext(path.rstrip("/"))[1].lstrip(".").lower()
    fmt = extension if extension in ("csv", "json", "parquet") else default_format
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
    return fmt


def copy_for_monitoring(scored: DataFrame, path: str, key: str | None = None) -> bool:
    """Add a scored batch to the monitoring table, once; a failure never fails the scoring run.

    The ``key`` names the batch; without one its rows do, apart from the time they were scored at, so that a
    batch that is scored or written again is not stored twice. Batches lie by the day of scoring.
    """
    try:
        if key is None:
            key = commits.fingerprint(scored, ["timestamp"])
        by_day = scored.withColumn(commits.PARTITION, F.to_date("timestamp")).withColumn("batch", F.lit(key))
        commits.add_once(by_day, path, key)
        return True
    except Exception as reason:
        log.warning("monitoring copy failed: %s", reason)
        return False


def write_scored(
    scored: DataFrame, path: str, monitoring_path: str, default_format: str = "csv", key: str | None = None
) -> bool:
    """Write a scored batch and copy what was written, so the batch is scored once."""
    fmt = write_predictions(scored, path, default_format)
    reader = scored.sparkSession.read.schema(scored.schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    return copy_for_monitoring(reader.load(path), monitoring_path, key)


def write_monitoring_summary(summary: DataFrame, path: str, run: str | None = None) -> None:
    """Add the one-row monitoring document as JSON; a ``run`` that is repeated replaces its own."""
    if run is None:
        summary.write.mode("append").json(path)
    else:
        summary.write.mode("overwrite").json(f"{path}/run-{run}")


def write_registry(registry: DataFrame, best: DataFrame, path: str) -> None:
    """Write ``(model, metric, value)`` rows and the best model's row."""
    registry.write.mode("overwrite").parquet(f"{path}/metrics")
    best.write.mode("overwrite").json(f"{path}/best_model")
