"""Running totals and exact order statistics without a global sort in one task.

A window over a few large groups (one per dataset, feature or class) would put each group in
one task. Here ordered work is cut into key ranges first: each range is sorted on its own and
carries the total of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


class _Zone(NamedTuple):
    """Value range that holds the two middle ranks, its rows, and the ranks counted inside it."""

    low: float
    high: float
    rows: int
    first: int
    second: int


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where null equals null; the left side's key columns stay."""
    if not on:
        return left.crossJoin(right)  # one row for the whole frame on the right
    there = {c: f"__on_{c}" for c in on}
    matches = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(t)) for c, t in there.items()])
    return left.join(right.withColumnsRenamed(there), matches, how).drop(*there.values())


def _with_range(rows: DataFrame, order: str) -> DataFrame:
    """Add ``__range``, a number that grows with ``order``.

    There are a few times as many ranges as shuffle partitions, a power of two.

    Splitters are the values with the smallest hashes: a uniform sample of the rows' values that
    depends on the data alone, so a recomputed task sees the same ranges. A row finds its range
    by binary search, in generated code. The sample keeps whole rows so that all readers of
    ``rows`` ask for the same columns and share one shuffle.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = 1 << max(6, (4 * partitions - 1).bit_length())
    splitters = (
        rows.orderBy(F.xxhash64(order), order)
        .limit(ranges - 1)
        .agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("__k"), *rows.columns))).alias("all"))
        .select(F.filter(F.transform("all", lambda r: r["__k"]), lambda k: k.isNotNull()))
    )
    rows = rows.withColumns({"__splitters": splitters.scalar(), "__range": F.lit(0)})
    step = ranges // 2
    while step:
        splitter = F.get("__splitters", F.col("__range") + (step - 1))
        rows = rows.withColumn(
            "__range",
            F.col("__range") + F.when(splitter <= F.col(order), step).otherwise(0),
        )
        step //= 2
    return rows.drop("__splitters")


def running_totals(
    rows: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_<name>``: the inclusive running sum of each column of ``sums`` along ``order``.

    ``rows`` must hold one row per ``(by, order)``; aggregate duplicates away first, which also
    collapses hot values before the shuffle.
    """
    by = list(by)
    ranged = _with_range(rows, order)
    totals = ranged.groupBy(*by, "__range").agg(*[F.sum(c).alias(c) for c in sums])
    earlier = W.partitionBy(*by).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "__range",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__before_{c}") for c in sums],
    )
    inside = (
        W.partitionBy(*by, "__range").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    )
    # every range has its offset; a left join keeps the range lookup out of pushed-down null filters
    return (
        join_null_safe(ranged, offsets, [*by, "__range"], "left")
        .select(
            *rows.columns,
            *[
                (F.sum(c).over(inside) + F.col(f"__before_{c}")).alias(f"cum_{c}")
                for c in sums
            ],
        )
    )


def bracket(value: Column, accuracy: int = 10_000) -> Column:
    """Aggregate: two values that should lie on either side of the middle, by a quantile sketch."""
    margin = 2.0 / accuracy
    return F.percentile_approx(value, [max(0.0, 0.5 - margin), min(1.0, 0.5 + margin)], accuracy)


def value_counts(df: DataFrame, columns: Sequence[str], as_type: str = "double") -> DataFrame:
    """Rows per value of each column, missing ones left out: ``(feature, value, n)``."""
    value = {c: F.col(c).cast(as_type) for c in columns}
    if as_type == "double":
        value = {c: F.nanvl(v, F.lit(None)) for c, v in value.items()}
    return (
        df.select(*[v.alias(c) for c, v in value.items()])
        .unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_medians(
    df: DataFrame,
    columns: Sequence[str],
    accuracy: int = 10_000,
    brackets: Mapping[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Exact interpolated median of each numeric column: rows ``(feature, median)``.

    Cheap scans instead of a sort: a quantile sketch brackets the middle of each column, and
    exact counts say whether the bracket really holds it (else the outer side is taken). Only the
    few values inside that zone are then ordered, so the result never depends on the sketch's
    error. Two numbers and a few counts per column pass through the driver. ``brackets``
    (see ``bracket``) save their scan where the caller has them.
    """
    columns = list(columns)
    wide = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    if brackets is None:
        brackets = wide.agg(*[bracket(F.col(c), accuracy).alias(c) for c in columns]).first().asDict()
    columns = [c for c in columns if brackets[c] is not None]
    if not columns:
        return df.sparkSession.createDataFrame([], "feature string, median double")
    counts = wide.agg(
        *[
            F.struct(
                F.count(c).alias("n"),
                F.count_if(F.col(c) < brackets[c][0]).alias("below"),
                F.count_if(F.col(c) <= brackets[c][1]).alias("upto"),
            ).alias(c)
            for c in columns
        ]
    ).first()
    zones = {c: middle_zone(*brackets[c], **counts[c].asDict()) for c in columns}
    # a zone of one value is the median itself
    known = [c for c in columns if zones[c].low == zones[c].high]
    open_ = {c: zones[c] for c in columns if c not in known}
    medians = [df.sparkSession.range(1).select(F.lit(c).alias("feature"), F.lit(float(zones[c].low)).alias("median")) for c in known]
    if open_:
        zoned = wide.select(*[F.when(F.col(c).between(z.low, z.high), F.col(c)).alias(c) for c, z in open_.items()])
        medians.append(ordered_medians(open_, value_counts(zoned, list(open_))))
    return reduce(DataFrame.unionByName, medians)


def ordered_medians(zones: dict[str, _Zone], counted: DataFrame) -> DataFrame:
    """Median of each feature ``(feature, median)`` from counts that hold at least its zone's values."""
    inside = [(F.col("feature") == c) & F.col("value").between(z.low, z.high) for c, z in zones.items()]
    values = counted.where(reduce(Column.__or__, inside))
    ordered = running_totals(values, "value", ["n"], ["feature"])
    ranks = F.lit(None)
    for c, z in zones.items():
        ranks = F.when(F.col("feature") == c, F.array(F.lit(z.first), F.lit(z.second))).otherwise(ranks)

    def at(i: int) -> Column:
        rank = F.get(ranks, F.lit(i))
        hit = (rank < F.col("cum_n")) & (rank >= F.col("cum_n") - F.col("n"))
        return F.max(F.when(hit, F.col("value")))

    return ordered.groupBy("feature").agg(((at(0) + at(1)) / 2).alias("median"))


def middle_zone(low: float, high: float, n: int, below: int, upto: int) -> _Zone:
    """Where the two middle ranks of ``n`` rows lie, given the rows below ``low`` and up to ``high``."""
    first, second = (n - 1) // 2, n // 2
    if first < below:
        low, below = float("-inf"), 0
    if second >= upto:
        high, upto = float("inf"), n
    return _Zone(low, high, upto - below, first - below, second - below)
