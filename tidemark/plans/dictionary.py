"""Stored category dictionaries: a value keeps its code, whatever is built later or again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lookups import category_codes
from tidemark.session import checkpointed
from tidemark.sources import commits

FIRST = commits.PARTITION  # the first snapshot a value was seen in


def stored(spark, path: str, column: str, code: str) -> DataFrame | None:
    """The dictionary as last published: ``(column, code, snapshot_date)``."""
    manifest = commits.newest(spark, path)
    return None if manifest is None else commits.read(spark, path, manifest).select(column, code, FIRST)


def with_values_of(df: DataFrame, path: str, column: str, code: str) -> DataFrame:
    """The stored dictionary ``(column, code)``, after the values of ``df`` it does not know have joined its end.

    New values are numbered in sorted order after the last code, by key range; known ones are not read again but
    for an anti join. ``df`` has a ``snapshot_date``, of which the smallest is kept with a new value. Null is no value.
    Two runs that add values at once do not give a code twice: the slower one looks again.
    """
    spark = df.sparkSession
    found = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(FIRST).alias(FIRST))
    found = checkpointed(found)
    for _ in range(commits.ATTEMPTS):
        seen = commits.newest(spark, path)
        fresh, first = found, 0
        if seen is not None:
            known = commits.read(spark, path, seen)
            fresh = found.join(known, column, "left_anti")
            first = (known.agg(F.max(code)).first()[0] or 0) + 1 if not known.isEmpty() else 0
        if fresh.isEmpty():
            break
        coded = category_codes(fresh, column, code, first).join(fresh, column)
        if commits.add_after(coded.select(column, code, FIRST), path, seen):
            break
    else:
        raise commits.Conflict(path)
    known = stored(spark, path, column, code)
    if known is None:  # no table yet, and no value
        known = found.select(column, F.lit(0).alias(code))
    return known.select(column, code)
