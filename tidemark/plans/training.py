"""Model training for a training date: windows, split, scaling, fits, comparison."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import models, split
from tidemark.operators.calendar import model_windows
from tidemark.operators.impute import Imputer, fit_imputer
from tidemark.operators.lookups import labelled
from tidemark.operators.scaling import Scaler, fit_scaler
from tidemark.session import checkpointed, dealt
from tidemark.settings import DECISION_THRESHOLD, KEYS, ImputeRule


@dataclass(frozen=True)
class Prepared:
    """Rows tagged train / test / oot with folds on the training rows."""

    rows: DataFrame
    features: list[str]
    scaler: Scaler
    imputer: Imputer | None

    @property
    def train(self) -> DataFrame:
        return self.rows.where(F.col("split") == "train")


def prepare(
    labels: DataFrame,
    features_store: DataFrame,
    train_date: str,
    features: Sequence[str],
    hashed: Column,
    impute: ImputeRule | None = None,
    how: str = "left",
) -> Prepared:
    """Join labels to features, split by time and class, impute and fit the scaler.

    Everything fitted is fitted on training rows. Folds are assigned by key before any
    resampling, so that copies of a row never straddle folds.
    """
    names = ["train_start", "train_end", "oot_start", "oot_end"]
    windows = dict(zip(names, model_windows(F.lit(train_date).cast("date"))))
    rows = labelled(labels, features_store, how, KEYS)
    rows = split.out_of_time(rows, *[windows[n] for n in names])
    # splitting, fitting and every training iteration read these rows: join them once
    rows = checkpointed(rows.withColumn("__hash", hashed))
    in_time = rows.where(F.col("split") == "train_test").drop("split")
    in_time = split.stratified_split(in_time, "label", F.col("__hash"))
    train = split.stratified_folds(
        in_time.where(F.col("split") == "train"), "label", split.key_hash("__hash", seed=7)
    )
    no_fold = F.lit(None).cast("int").alias("fold")
    rest = in_time.where(F.col("split") == "test").unionByName(rows.where(F.col("split") == "oot"))
    imputer = fit_imputer(train, impute, features) if impute else None
    whole = train.unionByName(rest.select("*", no_fold)).drop("__hash")
    if imputer is not None:
        whole = imputer.transform(whole)
    whole = checkpointed(whole)
    features = [f for f in features if f in whole.columns]
    scaler = fit_scaler(whole.where(F.col("split") == "train"), features)
    return Prepared(whole, features, scaler, imputer)


def train_and_compare(
    data: Prepared,
    specs: Sequence[models.Candidate] | None = None,
    threshold: float = DECISION_THRESHOLD,
    version: str = "unknown",
    calibrate: bool = True,
    bootstrap_rows: int | None = None,
) -> tuple[list[models.ScoringModel], DataFrame, dict[str, str]]:
    """Fit every candidate and compare on the test rows.

    Returns the fitted models, their comparison, and the reason of each candidate that failed
    (a failed candidate is left out, the rest go on). With ``bootstrap_rows`` the candidates are
    trained on a class-proportional draw of that many rows instead of all.
    """
    fitted, failed = [], {}
    train = data.train
    if bootstrap_rows is not None:
        train = checkpointed(
            split.exact_bootstrap(train, "label", split.key_hash(*KEYS), bootstrap_rows)
        )
    for spec in specs or models.candidates():
        try:
            model = models.fit_candidate(
                spec, train, data.features, data.scaler, calibrate=calibrate, version=version
            )
        except Exception as reason:
            failed[spec.name] = str(reason)
            continue
        fitted.append(replace(model, imputer=data.imputer, threshold=threshold))
    if not fitted:
        raise RuntimeError(f"no candidate could be trained: {failed}")
    test = data.rows.where(F.col("split") == "test")
    return fitted, models.compare(fitted, test), failed


def rate_splits(model: models.ScoringModel, data: Prepared) -> DataFrame:
    """Metrics of a model on the train, test and out-of-time rows."""
    # the metrics read the scores more than once
    rows = dealt(data.rows, data.rows.count())
    scored = checkpointed(model.score(rows).select("split", "label", "score"))
    return models.rate(scored, ["split"], model.threshold)
