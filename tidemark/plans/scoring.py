"""Batch scoring as one lazy plan from scan to prediction table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.calendar import at_snapshot
from tidemark.operators.impute import Imputer, fill_from_batch
from tidemark.operators.models import ScoringModel
from tidemark.operators.project import align_features, feature_columns
from tidemark.operators.scaling import Scaler
from tidemark.settings import DECISION_THRESHOLD, KEYS


def score_snapshots(model: ScoringModel, features: DataFrame, snapshot=None) -> DataFrame:
    """Predictions of one snapshot, or of all snapshots in one job when none is given."""
    rows = features if snapshot is None else at_snapshot(features, snapshot)
    scored = model.score(rows.select(*KEYS, *model.features))
    return scored.select(
        *KEYS, F.lit(model.version).alias("model_name"), F.col("score").alias("model_predictions")
    )


def preprocess(
    df: DataFrame,
    features: Sequence[str] | None = None,
    imputer: Imputer | None = None,
    scaler: Scaler | None = None,
    imputation: str = "fitted",
) -> DataFrame:
    """Model input beside the original row, kept as ``__row``.

    Features are aligned to the model's list, imputed and scaled. ``imputation`` is ``fitted``,
    ``batch`` (the batch's own medians and modes) or ``zero``.
    """
    if imputation == "fitted" and imputer is None:
        raise ValueError("no fitted imputer; ask for batch or zero imputation")
    features = list(features or feature_columns(df))
    rows = df.withColumn("__row", F.struct(*df.columns))
    rows = align_features(rows, features, ["__row"])
    if imputation == "fitted":
        rows = imputer.transform(rows)
    elif imputation == "batch":
        rows = fill_from_batch(rows, features)
    else:
        rows = rows.na.fill(0, features)
    return scaler.transform(rows) if scaler is not None else rows


def score_batch(
    df: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    features: Sequence[str] | None = None,
    imputer: Imputer | None = None,
    scaler: Scaler | None = None,
    imputation: str = "fitted",
    threshold: float = DECISION_THRESHOLD,
    version: str = "unknown",
) -> DataFrame:
    """All input columns plus prediction, confidence, threshold, run time and model version.

    ``scorer`` adds ``confidence`` (probability of class 1) to preprocessed rows. One that knows
    no probabilities adds ``prediction`` instead, and the confidence is null.
    """
    scored = scorer(preprocess(df, features, imputer, scaler, imputation))
    if "confidence" in scored.columns:
        prediction = (F.col("confidence") >= threshold).cast("int")
        confidence = F.col("confidence")
    else:
        prediction = F.col("prediction").cast("int")
        confidence = F.lit(None).cast("double")
    return scored.select(
        "__row.*",
        prediction.alias("prediction"),
        confidence.alias("confidence"),
        F.lit(threshold).alias("threshold_used"),
        F.current_timestamp().alias("timestamp"),
        F.lit(version).alias("model_version"),
    )


def score_batch_with(model: ScoringModel, df: DataFrame, imputation: str = "fitted") -> DataFrame:
    """Batch scoring with a saved bundle: its own columns, imputer, scaler and threshold.

    Raises ``ValueError`` if fitted imputation is asked of a bundle without imputer.
    """
    return score_batch(
        df,
        lambda rows: model.score(rows, "confidence"),
        model.features,
        model.imputer,
        None,  # the bundle scales inside ``score``
        imputation,
        model.threshold,
        model.version,
    )
