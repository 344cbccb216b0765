"""Profiles of snapshots as states that merge: a month's rows are read once, whatever is asked later.

A state is one row per snapshot and feature: counts, moments, extremes, counts per bin, and sketches
of the distinct values and of the distribution. States of any months add up to the profile of their rows:
counts, moments, extremes and bins as a scan of all rows would give them, distinct values and quantiles within
the error of the sketches.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.drift import _bin, psi_of_bins
from tidemark.operators.profile import known

SNAPSHOT = "snapshot_date"
OUTSIDE = (0, -1, -2)  # bins of missing, too small and too large values
DISTINCT_BITS = 12  # 2**12 registers: 1.6 % standard error
QUANTILE_K = 400  # 0.7 % error of rank


def snapshot_states(df: DataFrame, columns: Sequence[str], edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """One row per snapshot and column; all columns in one scan, merged in part before the only shuffle.

    ``edges`` are bin edges by column, as ``drift.reference_edges`` gives them; a column without has no bins.
    """
    # a row's bin is found once, ahead of the counts that compare it: within them it would be found for each bin
    inputs = []
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    for k, c in enumerate(columns):
        bins = len(edges[c]) - 1 if c in edges else 0
        numbers = [*OUTSIDE, *range(1, bins + 1)] if bins else []
        number = known(df, c).try_cast("double")
        inputs += [number.alias(f"__v{k}"), known(df, c).cast("string").alias(f"__t{k}")]
        if bins:
            inputs.append(_bin(number, list(edges[c])).alias(f"__b{k}"))
        value, place = F.col(f"__v{k}"), F.col(f"__b{k}")
        aggregates.append(
            F.struct(
                F.count(value).alias("n"),
                F.avg(value).alias("mean"),
                (F.var_pop(value) * F.count(value)).alias("m2"),
                F.min(value).alias("low"),
                F.max(value).alias("high"),
                F.hll_sketch_agg(f"__t{k}", DISTINCT_BITS).alias("distinct_values"),
                F.kll_sketch_agg_double(value, QUANTILE_K).alias("quantiles"),
                F.array(
                    *[F.struct(F.lit(b).alias("bin"), F.count_if(place == b).alias("n")) for b in numbers]
                ).cast("array<struct<bin:int,n:bigint>>").alias("bins"),
            ).alias(f"__s{k}")
        )
    wide = df.select(SNAPSHOT, *inputs).groupBy(SNAPSHOT).agg(*aggregates)
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col("__rows").alias("rows"), F.col(f"__s{k}").alias("s"))
        for k, c in enumerate(columns)
    ]
    return wide.select(SNAPSHOT, F.inline(F.array(*rows))).select(SNAPSHOT, "feature", "rows", "s.*")


def _merged_moments(parts: Column) -> Column:
    """Count, mean and sum of squared distances from it, part by part (Chan's update)."""

    def add(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.when(b["n"] == 0, a).otherwise(
            F.struct(
                n.alias("n"),
                (a["mean"] + gap * b["n"] / n).alias("mean"),
                (a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n).alias("m2"),
            )
        )

    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(parts, start, add)


def profile(states: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """The states merged per ``by``: missing values, moments, extremes, and estimates from the sketches."""
    parts = F.array_sort(F.collect_list(F.struct(F.coalesce(SNAPSHOT, F.lit("1-01-01").cast("date")).alias("at"), "n", "mean", "m2")))
    merged = states.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        parts.alias("parts"),  # one a snapshot
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_values")).alias("distinct_estimate"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    ).withColumn("m", _merged_moments(F.col("parts")))
    n = F.col("m.n")
    return merged.select(
        *by,
        "rows",
        (F.col("rows") - n).alias("missing_count"),
        F.when(n > 0, F.col("m.mean")).alias("mean"),
        F.when(n > 1, F.sqrt(F.col("m.m2") / (n - 1))).alias("std"),
        "low",
        "high",
        "distinct_estimate",
        F.when(n > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(0.5))).alias("median_estimate"),
    )


def psi_by_snapshot(states: DataFrame, reference: Column, overflow: str = "drop") -> DataFrame:
    """Stability index of every snapshot against the snapshots that ``reference`` holds for.

    All snapshots in one job over a few numbers each. A feature without bins has infinite drift.
    """
    bins = states.select(SNAPSHOT, "feature", reference.alias("__r"), F.inline("bins").alias("bin", "n"))
    before = bins.where("__r").groupBy("feature", "bin").agg(F.sum("n").alias("r"))
    now = bins.groupBy(SNAPSHOT, "feature", "bin").agg(F.sum("n").alias("c"))
    cells = now.join(before, ["feature", "bin"], "left").na.fill(0, ["r"])
    known_psi = psi_of_bins(cells, [SNAPSHOT, "feature"], overflow)
    without = states.where(F.size("bins") == 0).select(SNAPSHOT, "feature", F.lit(float("inf")).alias("psi"))
    return known_psi.unionByName(without)
