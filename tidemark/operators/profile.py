"""Counts, missing-value profiles, column statistics and data-quality checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ordering import bracket, middle_zone, ordered_medians, value_counts
from tidemark.operators.project import numeric_columns
from tidemark.session import checkpointed
from tidemark.settings import DATASET_ORDER, KEYS, MonitorRule


def known(df: DataFrame, column: str) -> Column:
    """The value with NaN counted as missing."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(value), value)
    return value


def rows_by_snapshot(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Row count of every snapshot in one pass."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def _long(row: DataFrame, per_column: dict[str, Column]) -> DataFrame:
    """Turn a one-row frame of per-column structs into one row per column."""
    return row.select(F.inline(F.array(*per_column.values())))


def _listed(df: DataFrame, rows: dict[str, tuple], schema: str) -> DataFrame:
    """A few known values per column as a frame of literals."""
    fields = [f.split() for f in schema.split(", ")]
    one = df.sparkSession.range(1)
    structs = {c: F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(row, fields)]) for c, row in rows.items()}
    return _long(one, structs)


def _estimated_counts(df: DataFrame) -> DataFrame:
    """``(feature, rows, filled, unique_values)`` by sketches, in one pass without a shuffle of values."""
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    for c in df.columns:
        aggregates += [F.count(known(df, c)).alias(f"__n_{c}"), F.approx_count_distinct(known(df, c)).alias(f"__u_{c}")]
    per_column = {
        c: F.struct(
            F.lit(c).alias("feature"),
            F.col("__rows").alias("rows"),
            F.col(f"__n_{c}").alias("filled"),
            F.col(f"__u_{c}").alias("unique_values"),
        )
        for c in df.columns
    }
    return _long(df.agg(*aggregates), per_column)


def _exact_counts(df: DataFrame) -> DataFrame:
    """``(feature, rows, filled, unique_values)``: values are counted per (feature, value), then per feature.

    One pass; a row is repeated once per column with that column's value alone, in a slot of its type, and not
    with all its columns, as one distinct count beside another asks for.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    slots = {t: f"__v{i}" for i, t in enumerate(dict.fromkeys(types.values()))}
    cells = []
    for c, its in types.items():
        cells += [F.lit(c), *[known(df, c) if t == its else F.lit(None).cast(t) for t in slots]]
    long = df.select(F.stack(F.lit(len(types)), *cells).alias("feature", *slots.values()))
    per_value = long.groupBy("feature", *slots.values()).agg(F.count(F.lit(1)).alias("n"))
    filled = F.coalesce(*[F.when(F.col(v).isNotNull(), F.col("n")) for v in slots.values()])
    return per_value.groupBy("feature").agg(
        F.sum("n").alias("rows"), F.coalesce(F.sum(filled), F.lit(0)).alias("filled"), F.count(filled).alias("unique_values")
    )


def missing_profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: missing count and %, type, distinct non-null values, numeric or not."""
    numeric = set(numeric_columns(df))
    rows = {f.name: (f.name, f.dataType.simpleString(), f.name in numeric) for f in df.schema.fields}
    columns = _listed(df, rows, "feature string, dtype string, is_numeric boolean")
    counts = _estimated_counts(df) if approximate else _exact_counts(df)
    none = F.lit(0).cast("long")
    missing = F.col("rows") - F.col("filled")
    return columns.join(counts, "feature", "left").select(
        "feature",
        F.coalesce(missing, none).alias("missing_count"),
        F.coalesce(F.try_divide(missing * 100, F.col("rows")), F.lit(0.0)).alias("missing_percentage"),
        "dtype",
        F.coalesce("unique_values", none).alias("unique_values"),
        "is_numeric",
    )


def modes(df: DataFrame, columns: Sequence[str], as_type: str) -> DataFrame:
    """Most frequent value of each column, the smallest one on a tie: ``(feature, mode)``.

    Two-step aggregation: values are counted over the whole cluster first, so a column's group
    only ever sees its distinct values, one accumulator at a time.
    """
    return most_frequent(value_counts(df, columns, as_type))


def most_frequent(counted: DataFrame) -> DataFrame:
    """Mode of each feature from its value counts."""
    return counted.groupBy("feature").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")
    )


MODE_BUCKETS = 512


def _heavy_value(value: Column) -> Column:
    """Aggregate: a value that is likely the most frequent, null where a sketch sees none."""
    # nulls are items of the sketch too
    top = F.call_function("approx_top_k", value, F.lit(2), F.lit(1_000))
    return F.get(F.filter(F.transform(top, lambda t: t["item"]), lambda v: v.isNotNull()), F.lit(0))


def column_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, exact median, mode and sample standard deviation of numeric columns.

    Three scans. The first gives moments, a bracket of the middle and a likely mode; the second counts
    rows per bucket of the values' hashes, below and in the bracket, and equal to the likely mode. No value in a bucket
    with fewer rows than that can be the mode, and no value outside the bracket the median, so the
    third counts, and shuffles, only the others. Up to ``5 * MODE_BUCKETS`` counts per column reach the driver.
    """
    columns = list(columns)
    # -0.0 hashes like 0.0
    wide = df.select(*[(known(df, c).cast("double") + 0.0).alias(c) for c in columns])
    first = wide.agg(
        *[
            F.struct(
                F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), bracket(F.col(c)).alias("bracket"), _heavy_value(F.col(c)).alias("heavy")
            ).alias(c)
            for c in columns
        ]
    ).first()
    found = [c for c in columns if first[c]["bracket"] is not None]
    kept, zones, medians = {}, {}, {}
    for c, counted in _bucket_counts(wide, {c: first[c] for c in found}).items():
        zone = middle_zone(*first[c]["bracket"], sum(counted.values()), *[sum(n for k, n in counted.items() if k & bit) for bit in (4, 2)])
        if zone.low == zone.high:
            medians[c] = float(zone.low)
        else:
            zones[c] = zone
        buckets: dict[int, int] = {}
        for k, n in counted.items():
            buckets[k >> 3] = buckets.get(k >> 3, 0) + n
        hits = sum(n for k, n in counted.items() if k & 1)
        likely = [k for k, n in buckets.items() if n >= hits]
        keep = F.lit(True) if len(likely) == len(buckets) else _bucket(F.col(c)).isin(likely)
        if c in zones:
            keep = keep | F.col(c).between(zone.low, zone.high)
        kept[c] = F.when(keep, F.col(c)).alias(c)
    rows = {c: (c, first[c]["mean"], first[c]["std"], medians.get(c)) for c in columns}
    moments = _listed(df, rows, "feature string, mean double, std double, known double")
    if not found:
        return moments.select("feature", "mean", F.col("known").alias("median"), F.lit(None).cast("double").alias("mode"), "std")
    counted = checkpointed(value_counts(wide.select(*kept.values()), found))
    out = moments.join(most_frequent(counted), "feature", "left")
    median = F.col("known")
    if zones:
        out = out.join(ordered_medians(zones, counted), "feature", "left")
        median = F.coalesce("known", "median")
    return out.select("feature", "mean", median.alias("median"), "mode", "std")


def _bucket(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(MODE_BUCKETS))


def _bucket_counts(wide: DataFrame, seen: dict) -> dict[str, dict[int, int]]:
    """Rows of each column per code: the bucket times 8, and 4 below the bracket, 2 up to its end, 1 the likely mode."""
    codes = []
    for c, s in seen.items():
        low, high = s["bracket"]
        value = F.col(c)
        flags = F.when(value < low, 4).otherwise(0) + F.when(value <= high, 2).otherwise(0)
        if s["heavy"] is not None:
            flags = flags + F.when(value == s["heavy"], 1).otherwise(0)
        codes.append(F.when(value.isNotNull(), _bucket(value) * 8 + flags).alias(c))
    out: dict[str, dict[int, int]] = {c: {} for c in seen}
    if codes:
        long = wide.select(*codes).unpivot([], list(seen), "feature", "code").where("code IS NOT NULL")
        for feature, code, n in long.groupBy("feature", "code").agg(F.count(F.lit(1))).collect():
            out[feature][code] = n
    return out


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """Count and share of each class, and how unbalanced the majority is to the minority."""
    counts = df.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    whole = counts.agg(
        F.struct(
            F.sum("n").alias("rows"),
            F.max("n").alias("most"),
            F.min("n").alias("least"),
            F.min_by("class", F.struct(-F.col("n"), F.col("class"))).alias("majority"),
            F.min_by("class", F.struct(F.col("n"), F.col("class"))).alias("minority"),
        ).alias("w")
    ).scalar()
    counts = counts.withColumn("__w", whole)
    imbalance = F.try_divide(F.col("__w.most").cast("double"), F.col("__w.least"))
    return counts.select(
        "class",
        F.col("n").alias("class_count"),
        (F.col("n") / F.col("__w.rows")).alias("class_ratio"),
        F.col("__w.majority").alias("majority_class"),
        F.col("__w.minority").alias("minority_class"),
        imbalance.alias("imbalance_ratio"),
        F.when(imbalance < 3, "mild").when(imbalance < 10, "moderate").otherwise("severe").alias(
            "severity"
        ),
    )


def cross_tab(df: DataFrame, by: str, column: str, values: Sequence) -> DataFrame:
    """Row counts of ``by`` x ``column`` with 0 in empty cells."""
    return df.groupBy(by).agg(
        *[F.count_if(F.col(column) == v).alias(f"{column}_{v}") for v in values]
    )


def positive_rates(
    df: DataFrame, by: str = "dataset", label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Actual and predicted positive rate, their difference and the size of each dataset."""
    actual, predicted = F.avg(label), F.avg(prediction)
    return df.groupBy(by).agg(
        actual.alias("actual_positive_rate"),
        predicted.alias("predicted_positive_rate"),
        (predicted - actual).alias("difference"),
        F.count(F.lit(1)).alias("sample_size"),
    )


def in_dataset_order(df: DataFrame, column: str = "dataset", order=tuple(DATASET_ORDER)) -> DataFrame:
    place = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(column))
    return df.orderBy(F.when(place == 0, len(order) + 1).otherwise(place), column)


def tagged_union(frames: dict[str, DataFrame], tag: str = "dataset") -> DataFrame:
    """All rows of the named frames under each other, tagged with the frame's name."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    whole = tagged[0]
    for df in tagged[1:]:
        whole = whole.unionByName(df)
    return whole


def health_check(df: DataFrame, label: str = "label") -> DataFrame:
    """Target counts, nulls left and infinite values in numeric columns, in one pass."""
    floats = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    ]

    def total(flags: list[Column]) -> Column:
        return F.sum(sum((x.cast("long") for x in flags), F.lit(0).cast("long")))

    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(label) == 0).alias("label_0"),
        F.count_if(F.col(label) == 1).alias("label_1"),
        total([known(df, c).isNull() for c in df.columns]).alias("missing_values"),
        total([F.coalesce(F.abs(c) == float("inf"), F.lit(False)) for c in floats]).alias(
            "infinite_values"
        ),
    )


def quality(df: DataFrame, rule: MonitorRule = MonitorRule()) -> DataFrame:
    """Rows, columns, missing cells and their %, with an OK / WARNING / ALERT status."""
    cells = sum((known(df, c).isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    width = len(df.columns)
    one = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum(cells), F.lit(0)).alias("missing_values"),
    )
    pct = F.try_divide(F.col("missing_values") * 100.0, F.col("total_rows") * width)
    return one.select(
        F.when(pct > rule.missing_alert_pct, "ALERT")
        .when(pct > rule.missing_warning_pct, "WARNING")
        .otherwise("OK")
        .alias("status"),
        "total_rows",
        "missing_values",
        F.round(pct, 2).alias("missing_percentage"),
        F.lit(width).alias("columns"),
    )


def remaining_missing(df: DataFrame) -> DataFrame:
    return quality(df).select("missing_values")


def shape(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("frame"), "rows", F.lit(len(df.columns)).alias("columns")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str] = tuple(KEYS)) -> DataFrame:
    """Keys that occur more than once; an empty result means joins on them cannot fan out."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")
    )


class DuplicateKeys(Exception):
    """A table repeats a key that a join relies on."""


def require_unique_keys(df: DataFrame, keys: Sequence[str] = tuple(KEYS)) -> None:
    """Raise ``DuplicateKeys`` if a complete key occurs twice; keys with a null match nothing."""
    complete = df.select(*keys).na.drop()
    found = duplicate_keys(complete, keys).first()
    if found is not None:
        raise DuplicateKeys(f"{found['occurrences']} rows for {[found[k] for k in keys]}")
