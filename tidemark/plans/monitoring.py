"""Monitoring job: load, quality, drift, summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import metrics, profile
from tidemark.operators.drift import monitoring_summary
from tidemark.settings import MonitorRule
from tidemark.sources.readers import read_any, read_or_none
from tidemark.sources.writers import write_monitoring_summary


def monitor(
    spark: SparkSession,
    reference_path: str,
    current_path: str,
    output: str | None = None,
    rule: MonitorRule = MonitorRule(),
) -> DataFrame:
    """Summary row of one monitoring run; a failure, also while it runs, becomes a row with status ERROR.

    The summary is computed once; either row is written to ``output``.
    """
    try:
        plan = monitoring_summary(
            read_any(spark, reference_path), read_any(spark, current_path), rule, current_path
        )
        summary = spark.createDataFrame(plan.collect(), plan.schema)  # one row
    except Exception as reason:
        summary = spark.range(1).select(
            F.current_timestamp().alias("timestamp"),
            F.lit(current_path).alias("current_data_path"),
            F.lit(str(reason).partition("\n")[0]).alias("error"),
            F.lit("ERROR").alias("status"),
        )
    if output:
        write_monitoring_summary(summary, output)
    return summary


def compare_datasets(
    spark: SparkSession, datasets: dict[str, tuple[str, str]], score: str = "confidence"
) -> DataFrame | None:
    """Metrics per dataset from ``name -> (labels path, predictions path)``.

    A dataset whose files or columns are missing is left out; None when none is left.
    """
    joined = {}
    for name, (labels_path, predictions_path) in datasets.items():
        truth, predicted = read_or_none(spark, labels_path), read_or_none(spark, predictions_path)
        if truth is None or predicted is None:
            continue
        if "label" not in truth.columns or "prediction" not in predicted.columns:
            continue
        kept = [c for c in ("Customer_ID", "snapshot_date", "prediction", score) if c in predicted.columns]
        rows = metrics.labels_with_predictions(truth, predicted.select(kept))
        value = F.col(score) if score in rows.columns else F.col("prediction").cast("double")
        joined[name] = rows.select("label", "prediction", value.alias("score"))
    if not joined:
        return None
    return profile.in_dataset_order(metrics.evaluate(profile.tagged_union(joined)))
