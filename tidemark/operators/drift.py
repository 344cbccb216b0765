"""Population drift between a reference frame and a current frame."""

from __future__ import annotations

from collections.abc import Sequence
from math import isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.ordering import running_totals
from tidemark.operators.profile import known, quality, shape
from tidemark.operators.project import common_numeric, numeric_columns, string_columns
from tidemark.settings import MonitorRule

EPSILON = 1e-10


def _columns(reference: DataFrame, current: DataFrame) -> list[str]:
    if not set(reference.columns) & set(current.columns):
        raise ValueError("no common columns")
    columns = common_numeric(reference, current)
    if not columns:
        raise ValueError("no common numeric columns")
    return columns


def equal_width_edges(low: float, high: float, bins: int) -> list[float]:
    """Bin edges of equal width over [low, high], the first moved down by 0.1 % of the width.

    A constant is widened by 0.1 % of its value (0.001 at zero) on both sides instead.
    """
    if low == high:
        pad = 0.001 * abs(low) if low else 0.001
        low, high = low - pad, high + pad
        first = low
    else:
        first = low - 0.001 * (high - low)
    step = (high - low) / bins
    return [first, *(low + step * i for i in range(1, bins)), high]


def reference_edges(
    reference: DataFrame, columns: Sequence[str], bins: int
) -> dict[str, list[float]]:
    """Edges of every column of finite values: one min/max scan, two numbers per column.

    An infinite reference value leaves a column without edges, and so with infinite drift.
    """
    aggregates = []
    for c in columns:
        value = known(reference, c).try_cast("double")
        aggregates += [F.min(value).alias(f"lo_{c}"), F.max(value).alias(f"hi_{c}")]
    row = reference.agg(*aggregates).first()
    return {
        c: equal_width_edges(row[f"lo_{c}"], row[f"hi_{c}"], bins)
        for c in columns
        if row[f"lo_{c}"] is not None and isfinite(row[f"lo_{c}"]) and isfinite(row[f"hi_{c}"])
    }


def _bin(value: Column, edges: list[float]) -> Column:
    """Right-closed bin 1, 2, ..., the first also closed on the left.

    0 marks a missing value, -1 one below and -2 one above all edges.
    """
    inner = sum(((value > e).cast("int") for e in edges[1:-1]), F.lit(1))
    return (
        F.when(value.isNull(), F.lit(0))
        .when(value < edges[0], F.lit(-1))
        .when(value > edges[-1], F.lit(-2))
        .otherwise(inner)
    )


def psi_of_bins(cells: DataFrame, by: Sequence[str], overflow: str = "drop") -> DataFrame:
    """``by`` and ``psi`` from counts ``r`` and ``c`` of each ``bin``, numbered as ``_bin`` does.

    A bin that is empty on both sides adds nothing, so the bins that occur are enough.
    """
    counted = F.col("bin") > 0 if overflow == "drop" else F.col("bin") != 0
    of_group = W.partitionBy(*by)  # at most bins + 3 rows
    cells = cells.withColumns(
        {
            "r_total": F.sum(F.when(counted, F.col("r"))).over(of_group),
            "c_total": F.sum(F.when(counted, F.col("c"))).over(of_group),
            "c_known": F.sum(F.when(F.col("bin") != 0, F.col("c"))).over(of_group),
        }
    )
    # a side with every value out of range has no shares at all and adds nothing
    r = F.try_divide(F.col("r"), F.col("r_total")) + EPSILON
    c = F.try_divide(F.col("c"), F.col("c_total")) + EPSILON
    value = F.coalesce(F.sum(F.when(counted, (c - r) * F.ln(c / r))), F.lit(0.0))
    nothing = F.coalesce(F.max("c_known"), F.lit(0)) == 0
    return cells.groupBy(*by).agg(F.when(nothing, F.lit(float("inf"))).otherwise(value).alias("psi"))


def psi(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str] | None = None,
    bins: int = 10,
    overflow: str = "drop",
) -> DataFrame:
    """Population stability index per numeric column: ``(feature, psi)``.

    Bins come from the reference. With ``overflow="drop"`` current values outside them are left
    out and the rest is renormalised; ``"bucket"`` counts them in two extra bins instead, so a
    population that moved away altogether shows as drift. An empty side gives infinity, and so does
    an infinite value in the reference.

    Both frames shrink to a count per (feature, side, bin) before the only shuffle.
    """
    listed = list(columns or _columns(reference, current))
    edges = reference_edges(reference, listed, bins)
    columns = list(edges)
    infinite = F.lit(float("inf"))
    unknown = F.explode(F.lit([c for c in listed if c not in edges] or [""])).alias("feature")
    never = reference.sparkSession.range(1).select(unknown, infinite.alias("psi"))
    if not columns:
        return never

    def bins_of(df: DataFrame, side: str) -> DataFrame:
        binned = df.select(
            *[_bin(known(df, c).try_cast("double"), edges[c]).alias(c) for c in columns]
        )
        return (
            binned.unpivot([], columns, "feature", "bin")
            .groupBy("feature", "bin")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(
                "feature",
                "bin",
                *[(F.col("n") if s == side else F.lit(0).cast("long")).alias(s) for s in "rc"],
            )
        )

    cells = (
        bins_of(reference, "r")
        .unionByName(bins_of(current, "c"))
        .groupBy("feature", "bin")
        .agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    )
    out = psi_of_bins(cells, ["feature"], overflow)
    return out if len(columns) == len(listed) else out.unionByName(never)


def psi_drift(
    reference: DataFrame,
    current: DataFrame,
    rule: MonitorRule = MonitorRule(),
    columns: Sequence[str] | None = None,
    overflow: str = "drop",
) -> DataFrame:
    """PSI, threshold and drift flag per feature."""
    values = psi(reference, current, columns, rule.psi_bins, overflow)
    return values.select(
        "feature",
        "psi",
        F.lit(rule.psi_threshold).alias("threshold"),
        (F.col("psi") > rule.psi_threshold).alias("drift_detected"),
    )


def drift_summary(drift: DataFrame) -> DataFrame:
    """Features analysed, features drifted and their %."""
    total = F.count(F.lit(1))
    drifted = F.count_if("drift_detected")
    return drift.agg(
        total.alias("total_features_analyzed"),
        total.alias("numeric_features"),
        drifted.alias("features_with_drift"),
        F.coalesce(F.try_divide(drifted * 100.0, total), F.lit(0.0)).alias("drift_percentage"),
    )


def mean_shift(
    reference: DataFrame, current: DataFrame, rule: MonitorRule = MonitorRule()
) -> DataFrame:
    """Dataset drift by mean shift: share of reference columns whose mean moved too far.

    A column moved when its current mean is more than two reference standard deviations away.
    The share is over all numeric reference columns, including ones the current frame lacks.
    """
    columns = numeric_columns(reference)
    shared = [c for c in columns if c in current.columns]
    if not shared:
        raise ValueError("no common numeric columns")
    ref = reference.agg(
        F.struct(
            *[F.avg(known(reference, c).try_cast("double")).alias(f"m_{c}") for c in shared],
            *[F.stddev_samp(known(reference, c).try_cast("double")).alias(f"s_{c}") for c in shared],
        ).alias("r")
    ).scalar()
    now = current.agg(
        *[F.avg(known(current, c).try_cast("double")).alias(c) for c in shared]
    ).withColumn("__r", ref)

    def moved(c: str) -> Column:
        far = F.abs(F.col(c) - F.col(f"__r.m_{c}"))
        return F.coalesce(far > F.col(f"__r.s_{c}") * rule.mean_shift_stds, F.lit(False))

    drifted = sum((moved(c).cast("int") for c in shared), F.lit(0))
    out = now.select(drifted.alias("drift_count"))
    share = F.col("drift_count") / F.lit(len(columns))
    return out.select(
        "drift_count",
        share.alias("drift_share"),
        (share > rule.drift_share).alias("drift_detected"),
        F.when(share > rule.drift_share, "ALERT").otherwise("OK").alias("status"),
        F.lit("manual_statistical").alias("method"),
    )


def ks_distance(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per numeric column: ``(feature, distance)``."""
    columns = list(columns or _columns(reference, current))

    def counts(df: DataFrame, side: str) -> DataFrame:
        return df.select(*[known(df, c).try_cast("double").alias(c) for c in columns]).unpivot(
            [], columns, "feature", "value"
        ).where(F.col("value").isNotNull()).withColumn("ref", F.lit(int(side == "r")))

    both = (
        counts(reference, "r")
        .unionByName(counts(current, "c"))
        .groupBy("feature", "value")
        .agg(F.sum("ref").alias("r"), F.sum(1 - F.col("ref")).alias("c"))
    )
    # sizes are one map entry per feature
    sizes = both.groupBy("feature").agg(F.sum("r").alias("r"), F.sum("c").alias("c"))
    ordered = running_totals(both, "value", ["r", "c"], ["feature"])
    gap = F.abs(
        F.try_divide(F.col("cum_r"), F.col("__r")) - F.try_divide(F.col("cum_c"), F.col("__c"))
    )
    # a column without values on one side is as far away as can be
    return (
        ordered.join(sizes.select("feature", F.col("r").alias("__r"), F.col("c").alias("__c")), "feature")
        .groupBy("feature")
        .agg(F.coalesce(F.max(gap), F.lit(1.0)).alias("distance"))
    )


def js_divergence(
    reference: DataFrame, current: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Jensen-Shannon divergence (base 2) per categorical column: ``(feature, distance)``."""
    columns = list(columns)

    def values(df: DataFrame, side: int) -> DataFrame:
        return (
            df.select(*[F.col(c).cast("string").alias(c) for c in columns])
            .unpivot([], columns, "feature", "value")
            .where(F.col("value").isNotNull())
            .withColumn("ref", F.lit(side))
        )

    counts = (
        values(reference, 1)
        .unionByName(values(current, 0))
        .groupBy("feature", "value")
        .agg(F.sum("ref").alias("r"), F.sum(1 - F.col("ref")).alias("c"))
    )
    sizes = counts.groupBy("feature").agg(F.sum("r").alias("all_r"), F.sum("c").alias("all_c"))
    p, q = F.try_divide(F.col("r"), F.col("all_r")), F.try_divide(F.col("c"), F.col("all_c"))
    middle = (p + q) / 2

    def half(share: Column) -> Column:
        return F.when(share > 0, share * F.log2(share / middle)).otherwise(F.lit(0.0)) / 2

    return (
        # a column without values on one side is as far away as can be
        counts.join(sizes, "feature")
        .groupBy("feature")
        .agg(F.coalesce(F.sum(half(p) + half(q)), F.lit(1.0)).alias("distance"))
    )


def dataset_drift(
    reference: DataFrame, current: DataFrame, threshold: float = 0.1, share: float = 0.5
) -> DataFrame:
    """Distribution distance of every shared column and the share of columns that drifted.

    Numeric columns use the Kolmogorov-Smirnov distance, text columns the Jensen-Shannon
    divergence; a column drifts above ``threshold``, the dataset at or above ``share``.
    """
    numeric = common_numeric(reference, current)
    texts = sorted(set(string_columns(reference)) & set(string_columns(current)))
    parts = []
    if numeric:
        parts.append(ks_distance(reference, current, numeric))
    if texts:
        parts.append(js_divergence(reference, current, texts))
    if not parts:
        raise ValueError("no common columns")
    distances = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    score = F.count_if(F.col("distance") > threshold) / F.count(F.lit(1))
    return distances.agg(score.alias("drift_score")).select(
        F.when(F.col("drift_score") >= share, "DRIFT_DETECTED").otherwise("OK").alias("status"),
        (F.col("drift_score") >= share).alias("drift_detected"),
        "drift_score",
        F.lit("distribution_distance").alias("method"),
    )


def alerts(quality_row: DataFrame, summary_row: DataFrame) -> DataFrame:
    """Alert messages and overall status from one quality row and one drift summary row."""
    both = quality_row.withColumn("__drift", _as_struct(summary_row))
    messages = _messages(
        F.col("status"), F.col("missing_percentage"), lambda name: F.col(f"__drift.{name}")
    )
    return both.select(messages.alias("alerts")).select("alerts", _status())


def _as_struct(one: DataFrame) -> Column:
    return one.select(F.struct(*one.columns).alias("s")).scalar()


def _messages(quality_status: Column, missing_percentage: Column, drift) -> Column:
    # fixed texts of the alert messages
    return F.array_compact(
        F.array(
            F.when(
                quality_status == "ALERT",
                F.format_string("Data quality issue: %.1f%% missing values", missing_percentage),
            ),
            F.when(
                drift("features_with_drift") > 0,
                F.format_string(
                    "PSI drift detected: %d/%d features (%.1f%%)",
                    drift("features_with_drift"),
                    drift("total_features_analyzed"),
                    drift("drift_percentage"),
                ),
            ),
        )
    )


def _status() -> Column:
    return F.when(F.size("alerts") > 0, "ALERT").otherwise("OK").alias("status")


def monitoring_summary(
    reference: DataFrame, current: DataFrame, rule: MonitorRule = MonitorRule(), source: str = ""
) -> DataFrame:
    """One nested row: shapes, data quality, PSI per feature, summary, alerts and status."""
    total, drifted = F.count(F.lit(1)), F.count_if("drift_detected")
    drift = psi_drift(reference, current, rule).agg(
        F.map_from_entries(
            F.sort_array(
                F.collect_list(
                    F.struct("feature", F.struct("psi", "drift_detected", "threshold").alias("v"))
                )
            )
        ).alias("psi_results"),
        (drifted > 0).alias("drift_detected"),
        F.struct(
            total.alias("total_features_analyzed"),
            total.alias("numeric_features"),
            drifted.alias("features_with_drift"),
            F.try_divide(drifted * 100.0, total).alias("drift_percentage"),
        ).alias("summary"),
    )
    row = quality(current, rule).select(F.struct("*").alias("data_quality"))
    row = row.withColumns(
        {
            "psi_drift_results": _as_struct(drift),
            "reference_rows": shape(reference, "reference").select("rows").scalar(),
        }
    )
    messages = _messages(
        F.col("data_quality.status"),
        F.col("data_quality.missing_percentage"),
        lambda name: F.col(f"psi_drift_results.summary.{name}"),
    )
    return row.withColumn("alerts", messages).select(
        F.current_timestamp().alias("timestamp"),
        F.lit(source).alias("current_data_path"),
        F.array("data_quality.total_rows", "data_quality.columns").alias("current_data_shape"),
        F.array("reference_rows", F.lit(len(reference.columns))).alias("reference_data_shape"),
        "data_quality",
        "psi_drift_results",
        "alerts",
        _status(),
    )
