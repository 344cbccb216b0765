"""A stored table of snapshot states: each run reads the rows of its own months only."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import states
from tidemark.operators.drift import reference_edges
from tidemark.sources import commits


def update(df: DataFrame, path: str, columns: Sequence[str], months: Iterable = (), bins: int = 10) -> commits.Manifest:
    """Replace the states of the snapshots in ``df``, and clear those of ``months`` it has no rows of.

    The first run fixes the bin edges, from its own rows; later ones count in the same bins.
    """
    seen = commits.newest(df.sparkSession, path)
    edges = (seen.notes.get("edges") if seen else None) or reference_edges(df, columns, bins)
    rows = states.snapshot_states(df, columns, edges)
    return commits.replace_months(rows, path, months, notes={"edges": edges})


def stored(spark: SparkSession, path: str, months: Iterable | None = None) -> DataFrame:
    manifest = commits.newest(spark, path)
    if manifest is None:
        raise FileNotFoundError(path)
    return commits.read(spark, path, manifest, months)


def profile(spark: SparkSession, path: str, months: Iterable | None = None) -> DataFrame:
    """Profile of some months, or of all, from their states."""
    return states.profile(stored(spark, path, months))


def psi(spark: SparkSession, path: str, reference: Column, overflow: str = "drop") -> DataFrame:
    """Stability index of every snapshot and feature against the reference snapshots."""
    return states.psi_by_snapshot(stored(spark, path), reference, overflow)


def rolling(spark: SparkSession, path: str, months: int) -> DataFrame:
    """Profile over each snapshot and the ``months - 1`` calendar months before it."""
    rows = stored(spark, path)
    ends = rows.select(F.col(states.SNAPSHOT).alias("until")).distinct()
    at = F.explode(F.sequence(F.lit(0), F.lit(months - 1)))
    reach = ends.select("until", at.alias("back")).withColumn(
        states.SNAPSHOT, F.add_months("until", -F.col("back"))
    )
    return states.profile(rows.join(reach, states.SNAPSHOT), ("until", "feature"))
