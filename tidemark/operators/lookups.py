"""Joins to smaller tables, and category codes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import running_totals
from tidemark.settings import KEYS

SPREAD = 1024  # parts that rows with a null key are dealt to


def _with_part(df: DataFrame, keys: Sequence[str], driving: bool) -> DataFrame:
    """Add ``__part``, a further join key: 0, but any of ``SPREAD`` where a key is null.

    A null key matches nothing, so such rows of the driving side need not meet in one partition.
    """
    none = F.pmod(F.hash(*keys), F.lit(1))  # 0, computed so that it stays a join key
    if not driving:
        return df.withColumn("__part", none)
    unknown = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    dealt = F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int")
    return df.withColumn("__part", F.when(unknown, dealt).otherwise(none))


def join_features(tables: Sequence[DataFrame], keys: Sequence[str] = tuple(KEYS)) -> DataFrame:
    """Left-join tables to the first one on shared keys.

    All joins share the key, so each table is shuffled once however many there are; adaptive
    execution broadcasts a side that turns out small and splits skewed keys.
    """
    on = [*keys, "__part"]
    first = _with_part(tables[0], keys, True)
    others = [_with_part(t, keys, False) for t in tables[1:]]
    return reduce(lambda a, b: a.join(b, on, "left"), others, first).drop("__part")


def labelled(labels: DataFrame, features: DataFrame, how: str, keys=tuple(KEYS)) -> DataFrame:
    """Labels with their features: ``left`` keeps unmatched labels, ``inner`` drops them.

    Labels with a null key, which match nothing, are dealt out and do not meet in one task.
    """
    on = [*keys, "__part"]
    return _with_part(labels, keys, True).join(_with_part(features, keys, False), on, how).drop("__part")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def category_codes(df: DataFrame, column: str, code: str = "code", first: int = 0) -> DataFrame:
    """Dictionary ``(column, code)``: ``first`` and up, in sorted order of the non-null values.

    Values are ranked by range, so that no task holds a dictionary that is nearly as long as the table.
    """
    values = distinct_values(df, column).withColumn("__one", F.lit(1))
    ranked = running_totals(values, order=column, sums=["__one"])
    return ranked.select(column, (F.col("cum___one") + (first - 1)).cast("int").alias(code))


def with_codes(
    df: DataFrame, column: str, code: str = "code", null_code: int | None = None, dictionary: DataFrame | None = None
) -> DataFrame:
    """Add the category code of ``column``, from ``dictionary`` or numbered anew; null values get ``null_code``."""
    known = category_codes(df, column, code) if dictionary is None else dictionary.select(column, code)
    coded = join_features([df, known], [column])
    value: Column = F.col(code)
    if null_code is not None:
        value = F.coalesce(value, F.lit(null_code))
    return coded.select(*df.columns, value.alias(code))
