"""Snapshot spines, date windows and date filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_of_month_spine(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """First day of every month from the month of ``start`` to ``end``, both inclusive.

    ``bounds`` is a frame of date ranges, usually one row.
    """
    months = F.sequence(F.trunc(start, "MM"), F.col(end), F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias("snapshot_date"))


def monthly_spine(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Every month-step from ``start`` itself while not after ``end``.

    Each step is counted from ``start``, so a 31st gives 28 February and then 31 March.
    """
    months = F.sequence(F.col(start), F.col(end), F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias("snapshot_date"))


def model_windows(train_date: Column, train_months: int = 12, oot_months: int = 2) -> list[Column]:
    """Train/test and out-of-time date windows that end the day before a training date."""
    oot_start = F.add_months(train_date, -oot_months)
    return [
        F.add_months(oot_start, -train_months).alias("train_test_start"),
        F.date_sub(oot_start, 1).alias("train_test_end"),
        oot_start.alias("oot_start"),
        F.date_sub(train_date, 1).alias("oot_end"),
    ]


def at_snapshot(df: DataFrame, date, column: str = "snapshot_date") -> DataFrame:
    """Rows of one snapshot; the frame unchanged when it carries no snapshot column."""
    if column not in df.columns:
        return df
    day = date if isinstance(date, Column) else F.lit(date)
    return df.where(F.col(column) == day.cast("date"))


def between_dates(df: DataFrame, start, end, column: str = "snapshot_date") -> DataFrame:
    """Rows dated from ``start`` to ``end``, both inclusive."""
    low, high = (d if isinstance(d, Column) else F.lit(d) for d in (start, end))
    return df.where(F.col(column).between(low.cast("date"), high.cast("date")))


def on_spine(df: DataFrame, spine: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Rows whose snapshot is on the spine: a whole backfill as one semi join.

    A short spine is broadcast by its size and then also prunes partitions of ``df``.
    """
    return df.join(spine, column, "left_semi")
