"""Classifiers on Spark ML: candidates, class weights, calibration, validation, search."""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.operators.impute import Imputer, read_imputer, save_imputer
from tidemark.operators.scaling import Scaler
from tidemark.session import dealt
from tidemark.settings import DECISION_THRESHOLD, FOLDS, SEARCH_GRID, SEED


def with_class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Add the balanced weight n / (k * n_class) of each row's class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # one map entry per class
    sizes = counts.agg(
        F.map_from_entries(F.collect_list(F.struct(label, "n"))).alias("by_class"),
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("classes"),
    ).select(F.struct("*").alias("s"))
    weighted = df.withColumn("__s", sizes.scalar())
    weight = F.col("__s.rows") / (
        F.col("__s.classes") * F.try_element_at("__s.by_class", F.col(label))
    )
    return weighted.withColumn(name, weight).drop("__s")


# --- feature vectors ------------------------------------------------------------------------


@dataclass(frozen=True)
class FourierMap:
    """Random Fourier features whose inner products approach an RBF kernel."""

    directions: list[list[float]]
    phases: list[float]

    def vector(self, inputs: Sequence[str]) -> Column:
        x = F.array(*[F.col(c).cast("double") for c in inputs])
        scale = math.sqrt(2.0 / len(self.phases))
        maps = F.from_json(
            F.lit(json.dumps([{"w": w, "b": b} for w, b in zip(self.directions, self.phases)])),
            "array<struct<w:array<double>,b:double>>",
        )

        def wave(m: Column) -> Column:
            products = F.zip_with(x, m["w"], lambda v, w: v * w)
            return F.cos(F.aggregate(products, m["b"], lambda total, p: total + p)) * scale

        return array_to_vector(F.transform(maps, wave))


def fourier_map(df: DataFrame, inputs: Sequence[str], size: int = 100, seed: int = SEED) -> FourierMap:
    """Map for gamma = 1 / (columns * variance of all values), fitted by one aggregation."""
    d = len(inputs)
    totals = df.agg(
        F.sum(sum((F.col(c) for c in inputs), F.lit(0.0))).alias("s"),
        F.sum(sum((F.col(c) * F.col(c) for c in inputs), F.lit(0.0))).alias("q"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    cells = max(totals["n"] * d, 1)
    variance = totals["q"] / cells - (totals["s"] / cells) ** 2
    gamma = 1.0 / (d * variance) if variance > 0 else 1.0 / d
    rng = np.random.default_rng(seed)
    directions = rng.normal(0.0, math.sqrt(2.0 * gamma), (size, d))
    return FourierMap(directions.tolist(), rng.uniform(0.0, 2 * math.pi, size).tolist())


# --- candidates ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Candidate:
    """An estimator with what it needs around it."""

    name: str
    estimator: Callable[[int], object]  # training rows -> Spark ML estimator
    scaled: bool = False
    balanced: bool = False
    kernel: bool = False
    # slope that makes an uncalibrated margin a probability; None where there is no such margin
    slope: float | None = None
    params: dict = field(default_factory=dict)
    # a pass over fewer rows takes less than another task does
    rows_a_task: int = 500


def candidates(**overrides: dict) -> list[Candidate]:
    """The four classifiers that are compared.

    Parameters are fixed values; ``random_forest={"numTrees": 20}`` overrides some of them.
    """
    forest = {"numTrees": 200, "maxDepth": 20}
    boosting = {
        "maxIter": 100,
        "maxDepth": 5,
        "stepSize": 0.1,
        "subsamplingRate": 0.8,
        "minInstancesPerNode": 10,
    }
    logistic = {"C": 1.0, "maxIter": 2000, "tol": 1e-4}
    svm = {"C": 1.0, "maxIter": 100, "fourier_features": 100}
    forest.update(overrides.get("random_forest", {}))
    boosting.update(overrides.get("gradient_boosting", {}))
    logistic.update(overrides.get("logistic_regression", {}))
    svm.update(overrides.get("svm", {}))
    return [
        Candidate(
            "random_forest",
            lambda n: RandomForestClassifier(seed=SEED, **forest),
            balanced=True,
            params=forest,
        ),
        Candidate(
            "gradient_boosting",
            lambda n: GBTClassifier(seed=SEED, **boosting),
            slope=2.0,
            params=boosting,
        ),
        Candidate(
            "logistic_regression",
            # the penalty is stated against a summed loss; Spark averages the loss over rows
            lambda n: LogisticRegression(
                regParam=1.0 / (logistic["C"] * max(n, 1)),
                elasticNetParam=0.0,
                standardization=False,
                maxIter=logistic["maxIter"],
                tol=logistic["tol"],
            ),
            scaled=True,
            balanced=True,
            slope=1.0,
            params=logistic,
            rows_a_task=50_000,
        ),
        Candidate(
            "svm",
            lambda n: LinearSVC(
                regParam=1.0 / (svm["C"] * max(n, 1)), standardization=False, maxIter=svm["maxIter"]
            ),
            scaled=True,
            balanced=True,
            kernel=True,
            params=svm,
            rows_a_task=50_000,
        ),
    ]


def candidate(name: str, **params) -> Candidate:
    return next(c for c in candidates(**{name: params}) if c.name == name)


# --- fitted models ---------------------------------------------------------------------------


def raw_score(model, df: DataFrame, name: str) -> DataFrame:
    """Add the model's score for class 1: the margin, or the probability of a forest."""
    scored = model.transform(df)
    source = "probability" if "RandomForest" in type(model).__name__ else "rawPrediction"
    score = vector_to_array(F.col(source))[1]
    return scored.withColumn(name, score).drop("rawPrediction", "probability", "prediction")


def _sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


@dataclass(frozen=True)
class ScoringModel:
    """Everything scoring needs: columns, imputer, scaler, members and threshold in one piece.

    Each member is a Spark ML model with a slope and intercept that turn its raw score into a
    probability; the score is the mean over members.
    """

    name: str
    features: list[str]
    members: list[tuple[object, float, float]]
    scaler: Scaler | None = None
    fourier: FourierMap | None = None
    imputer: Imputer | None = None
    threshold: float = DECISION_THRESHOLD
    version: str = "unknown"
    params: dict = field(default_factory=dict)

    def vectors(self, df: DataFrame) -> DataFrame:
        return _vectors(df, self.features, self.scaler, self.fourier)

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        """Add the probability of class 1 as ``name``; the input columns stay as they are."""
        kept = df.columns
        rows = df.withColumn("__row", F.struct(*kept))
        rows = self.vectors(rows)
        parts = []
        for i, (model, slope, intercept) in enumerate(self.members):
            rows = raw_score(model, rows, f"__raw{i}")
            parts.append(_sigmoid(F.col(f"__raw{i}") * slope + intercept))
        probability = sum(parts[1:], parts[0]) / len(parts)
        return rows.select("__row.*", probability.alias(name))


def _vectors(
    df: DataFrame, features: Sequence[str], scaler: Scaler | None, fourier: FourierMap | None
) -> DataFrame:
    if scaler is not None:
        df = scaler.transform(df)
    if fourier is not None:
        return df.withColumn("features", fourier.vector(features))
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def platt(scored: DataFrame, score: str, label: str = "label") -> tuple[float, float]:
    """Slope and intercept of a sigmoid through held-out scores, with smoothed targets."""
    sizes = scored.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    ).first()
    high = (sizes["pos"] + 1.0) / (sizes["pos"] + 2.0)
    low = 1.0 / (sizes["neg"] + 2.0)
    target = F.when(F.col(label) == 1, high).otherwise(low)
    # a soft target is one row of each class weighted by it
    both = scored.select(
        F.col(score).alias("__x"),
        F.explode(
            F.array(
                F.struct(F.lit(1.0).alias("label"), target.alias("weight")),
                F.struct(F.lit(0.0).alias("label"), (1 - target).alias("weight")),
            )
        ).alias("__t"),
    ).select("__x", "__t.*")
    vectors = VectorAssembler(inputCols=["__x"], outputCol="features").transform(both)
    fit = LogisticRegression(weightCol="weight", maxIter=100, tol=1e-8).fit(vectors)
    return float(fit.coefficients[0]), float(fit.intercept)


def fit_candidate(
    spec: Candidate,
    train: DataFrame,
    features: Sequence[str],
    scaler: Scaler | None = None,
    label: str = "label",
    calibrate: bool = True,
    fold: str = "fold",
    folds: int = FOLDS,
    version: str = "unknown",
) -> ScoringModel:
    """Fit one candidate; with ``calibrate`` one member per fold, its sigmoid on the held-out rows.

    ``train`` carries a fold column when calibrating (see ``split.stratified_folds``).
    """
    scaler = scaler if spec.scaled else None
    fourier = None
    if spec.kernel:
        scaled = scaler.transform(train) if scaler else train
        fourier = fourier_map(scaled, features, spec.params["fourier_features"])
    kept = [label, *([fold] if calibrate else [])]
    n = train.count()
    rows = with_class_weights(train, label) if spec.balanced else train.withColumn("weight", F.lit(1.0))
    rows = dealt(rows.select(*kept, *features, "weight"), n, spec.rows_a_task)
    rows = _vectors(rows, features, scaler, fourier).select(*kept, "features", "weight").persist()
    try:

        def fit(part: DataFrame, size: int):
            estimator = spec.estimator(size)
            estimator.setFeaturesCol("features").setLabelCol(label)
            if spec.balanced:
                estimator.setWeightCol("weight")
            return estimator.fit(part)

        if not calibrate:
            if spec.slope is None:
                raise ValueError(f"{spec.name} has no margin to turn into a probability; calibrate it")
            members = [(fit(rows, n), spec.slope, 0.0)]
        else:
            members = []
            for k in range(folds):
                model = fit(rows.where(F.col(fold) != k), n * (folds - 1) // folds)
                held_out = raw_score(model, rows.where(F.col(fold) == k), "__raw")
                members.append((model, *platt(held_out, "__raw", label)))
    finally:
        rows.unpersist()
    return ScoringModel(
        spec.name, list(features), members, scaler, fourier, version=version, params=spec.params
    )


# --- validation and comparison ----------------------------------------------------------------


def rate(df: DataFrame, by: Sequence[str], threshold: float, label: str = "label") -> DataFrame:
    """All metrics of scored rows per group at a threshold."""
    return metrics.evaluate(metrics.decide(df, "score", threshold), by, label)


def cross_validate(
    fit: Callable[[DataFrame], ScoringModel],
    df: DataFrame,
    threshold: float = 0.5,
    outer: str = "outer_fold",
    folds: int = FOLDS,
    label: str = "label",
) -> DataFrame:
    """Mean and population deviation over folds of AUC, F1, precision and recall, out of fold."""
    scored = None
    for k in range(folds):
        model = fit(df.where(F.col(outer) != k))
        held_out = df.where(F.col(outer) == k)
        part = model.score(dealt(held_out, held_out.count())).select(outer, label, "score")
        scored = part if scored is None else scored.unionByName(part)
    per_fold = rate(scored, [outer], threshold, label)
    names = {"auc": "auc", "f1": "f1_score", "precision": "precision", "recall": "recall"}
    return per_fold.agg(
        *[F.avg(c).alias(f"{n}_mean") for n, c in names.items()],
        *[F.stddev_pop(c).alias(f"{n}_std") for n, c in names.items()],
    )


def compare(models: Sequence[ScoringModel], test: DataFrame, label: str = "label") -> DataFrame:
    """Test metrics of each fitted model at its own threshold, one scan of ``test`` per model."""
    parts = []
    test = dealt(test, test.count())
    for place, m in enumerate(models):
        scored = metrics.decide(m.score(test).select(label, "score"), "score", m.threshold)
        parts.append(
            scored.select(
                F.lit(m.name).alias("model"), F.lit(place).alias("place"),
                F.lit(m.threshold).alias("threshold"), label, "score", "prediction",
            )
        )
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return metrics.evaluate(rows, ["model", "place", "threshold"], label)


def best_model(comparison: DataFrame, by: str = "f1_score") -> DataFrame:
    """The model with the highest metric; the first candidate wins a tie."""
    order = F.struct(F.col(by), -F.col("place"))
    return comparison.agg(
        F.max_by("model", order).alias("best_model"),
        F.max(by).alias("best_score"),
        F.lit("f1" if by == "f1_score" else by).alias("best_metric"),
        F.max_by("threshold", order).alias("threshold"),
    )


def registry(comparison: DataFrame) -> DataFrame:
    """Comparison as ``(model, metric, value)`` rows."""
    values = [c for c, t in comparison.dtypes if c not in ("model", "place")]
    wide = comparison.select("model", *[F.col(c).cast("double").alias(c) for c in values])
    return wide.unpivot(["model"], values, "metric", "value")


# --- hyper-parameter search --------------------------------------------------------------------

# grid name -> Spark parameter; the penalties reg_alpha and reg_lambda have no counterpart
_SPARK_NAME = {
    "n_estimators": "maxIter",
    "max_depth": "maxDepth",
    "learning_rate": "stepSize",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
    "gamma": "minInfoGain",
    "min_child_weight": "minInstancesPerNode",
}


def draw_params(n: int, grid: dict = SEARCH_GRID, seed: int = SEED) -> list[dict]:
    """``n`` distinct points in random order (all of them when there are fewer).

    Axes without a Spark counterpart are left out: points that differ only there are one model.
    """
    names = [name for name in grid if name in _SPARK_NAME]
    points = [dict(zip(names, values)) for values in itertools.product(*(grid[name] for name in names))]
    return random.Random(seed).sample(points, min(n, len(points)))


def random_search(
    train: DataFrame,
    features: Sequence[str],
    n_iter: int = 100,
    grid: dict = SEARCH_GRID,
    label: str = "label",
    fold: str = "fold",
    folds: int = FOLDS,
    parallelism: int = 4,
    seed: int = SEED,
) -> tuple[CrossValidatorModel, list[dict]]:
    """Random search of boosted trees by cross-validated AUC of scores over given folds."""
    estimator = GBTClassifier(featuresCol="features", labelCol=label, seed=seed)
    draws = draw_params(n_iter, grid, seed)
    maps = []
    for point in draws:
        params = {}
        for name, value in point.items():
            spark_name = _SPARK_NAME[name]
            value = str(value) if spark_name == "featureSubsetStrategy" else value
            params[estimator.getParam(spark_name)] = (
                float(value) if spark_name == "minInfoGain" else value
            )
        maps.append(params)
    rows = dealt(train.select(label, fold, *features), train.count())
    rows = _vectors(rows, features, None, None).select(label, fold, "features").persist()
    try:
        search = CrossValidator(
            estimator=estimator,
            estimatorParamMaps=maps,
            evaluator=BinaryClassificationEvaluator(labelCol=label, numBins=0),
            numFolds=folds,
            foldCol=fold,
            parallelism=parallelism,
        )
        return search.fit(rows), draws
    finally:
        rows.unpersist()


def search_results(spark: SparkSession, fitted: CrossValidatorModel, draws: list[dict]) -> DataFrame:
    """One row per draw: the grid point and its mean and deviation of AUC over folds."""
    rows = [
        (i, json.dumps(p, sort_keys=True), float(m), float(s))
        for i, (p, m, s) in enumerate(zip(draws, fitted.avgMetrics, fitted.stdMetrics))
    ]
    return spark.createDataFrame(rows, "draw int, params string, auc_mean double, auc_std double")


# --- persistence -------------------------------------------------------------------------------


def save_model(model: ScoringModel, spark: SparkSession, path: str) -> None:
    """Write members, scaler, imputer and metadata under one folder."""
    for i, (member, _, _) in enumerate(model.members):
        PipelineModel([member]).write().overwrite().save(f"{path}/member_{i}")
    meta = {
        "name": model.name,
        "features": model.features,
        "sigmoids": [[a, b] for _, a, b in model.members],
        "scaler": vars(model.scaler) if model.scaler else None,
        "fourier": vars(model.fourier) if model.fourier else None,
        "threshold": model.threshold,
        "version": model.version,
        "params": model.params,
        "imputer": model.imputer is not None,
    }
    one = spark.createDataFrame([(json.dumps(meta),)], "value string")
    one.write.mode("overwrite").text(f"{path}/metadata")
    if model.imputer is not None:
        save_imputer(model.imputer, spark, f"{path}/imputer")


def load_model(spark: SparkSession, path: str) -> ScoringModel:
    """The bundle as it was saved, its imputer included."""
    meta = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    members = [
        (PipelineModel.load(f"{path}/member_{i}").stages[0], a, b)
        for i, (a, b) in enumerate(meta["sigmoids"])
    ]
    return ScoringModel(
        meta["name"],
        meta["features"],
        members,
        Scaler(**meta["scaler"]) if meta["scaler"] else None,
        FourierMap(**meta["fourier"]) if meta["fourier"] else None,
        read_imputer(spark, f"{path}/imputer") if meta["imputer"] else None,
        meta["threshold"],
        meta["version"],
        meta["params"],
    )
