"""Training, validation, persistence and scoring on a small separable panel."""

import datetime as dt

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators import models, split
from tidemark.plans import scoring, training

FEATURES = ["fe_1", "fe_2"]


@pytest.fixture(scope="module")
def panel(spark):
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0
    label = (F.pmod("id", F.lit(4)) == 0).cast("int")
    return spark.range(480).select(
        F.col("id").alias("Customer_ID"),
        F.add_months(F.lit("2023-07-01").cast("date"), F.pmod("id", F.lit(14)).cast("int")).alias(
            "snapshot_date"
        ),
        label.alias("label"),
        (label * 0.8 + noise).alias("fe_1"),
        F.when(F.pmod("id", F.lit(10)) != 0, noise * 100).alias("fe_2"),
    )


@pytest.fixture(scope="module")
def data(panel):
    from tidemark.settings import ImputeRule

    labels = panel.select("Customer_ID", "snapshot_date", "label")
    return training.prepare(
        labels, panel.drop("label"), "2024-09-01", FEATURES,
        split.integer_hash(F.col("Customer_ID")), ImputeRule(),
    )


@pytest.fixture(scope="module")
def model(data):
    spec = models.candidate("logistic_regression")
    return models.fit_candidate(spec, data.train, data.features, data.scaler)


def test_windows_and_splits(data):
    spans = {
        r["split"]: (r["low"], r["high"])
        for r in data.rows.groupBy("split").agg(
            F.min("snapshot_date").alias("low"), F.max("snapshot_date").alias("high")
        ).collect()
    }
    assert spans["oot"] == (dt.date(2024, 7, 1), dt.date(2024, 8, 1))
    assert spans["train"][1] <= dt.date(2024, 6, 1) and spans["test"][1] <= dt.date(2024, 6, 1)
    assert data.rows.where("fe_2 is null").isEmpty()
    folds = {r["fold"] for r in data.train.select("fold").distinct().collect()}
    assert folds == {0, 1, 2}


def test_model_separates(model, data):
    rows = {r["split"]: r for r in training.rate_splits(model, data).collect()}
    assert rows["oot"]["auc"] > 0.9 and rows["test"]["auc"] > 0.9


def test_probabilities_are_calibrated(model, data):
    row = model.score(data.rows).agg(F.avg("score").alias("p"), F.avg("label").alias("y")).first()
    assert abs(row["p"] - row["y"]) < 0.1


def test_logistic_weights_match_newton(data):
    """Balanced, L2-penalised logistic regression against Newton's method on the same rows."""
    import numpy as np

    spec = models.candidate("logistic_regression", tol=1e-9)
    fitted = models.fit_candidate(spec, data.train, data.features, data.scaler, calibrate=False)
    rows = data.scaler.transform(data.train).select(*data.features, "label").toPandas()
    x = np.column_stack([np.ones(len(rows)), rows[data.features].to_numpy()])
    y = rows["label"].to_numpy()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    beta, penalty = np.zeros(3), np.diag([0.0, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (weight * (p - y)) + penalty @ beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        beta -= np.linalg.solve(hessian, gradient)
    ml = fitted.members[0][0]
    assert np.allclose([ml.intercept, *ml.coefficients], beta, atol=1e-3)


def test_save_and_reload_score_equally(spark, model, data, tmp_path):
    path = str(tmp_path / "model")
    models.save_model(model, spark, path)
    again = models.load_model(spark, path)
    rows = again.score(model.score(data.rows.select(*data.features), "a"), "b")
    assert rows.where("a <> b").isEmpty() and again.features == model.features


def test_backfill_equals_its_months(model, data):
    store = data.rows.select("Customer_ID", "snapshot_date", *data.features)
    whole = scoring.score_snapshots(model, store)
    july = scoring.score_snapshots(model, store, "2024-07-01")
    same = whole.where("snapshot_date = '2024-07-01'")
    assert july.exceptAll(same).isEmpty() and july.count() == same.count() > 0
    assert whole.columns == ["Customer_ID", "snapshot_date", "model_name", "model_predictions"]


def test_scorer_without_probability(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "Customer_ID int, fe_1 double")
    out = scoring.score_batch(
        df, lambda rows: rows.withColumn("prediction", (F.col("fe_1") > 1).cast("int")), ["fe_1"],
        imputation="zero",
    ).orderBy("Customer_ID").collect()
    assert [(r["prediction"], r["confidence"], r["fe_1"]) for r in out] == [(1, None, 2.0), (0, None, None)]


def test_best_model_keeps_the_first_on_a_tie(spark):
    rows = [("a", 0, 0.7, 0.5), ("b", 1, 0.7, 0.9), ("c", 2, 0.7, 0.9)]
    df = spark.createDataFrame(rows, "model string, place int, threshold double, f1_score double")
    assert models.best_model(df).first()["best_model"] == "b"


def test_failed_candidate_is_left_out(data):
    def broken(n):
        raise RuntimeError("no")

    bad = models.Candidate("bad", broken)
    good = models.candidate("logistic_regression")
    fitted, comparison, failed = training.train_and_compare(data, [bad, good], calibrate=False)
    assert [m.name for m in fitted] == ["logistic_regression"] and "no" in failed["bad"]
    assert comparison.count() == 1


def test_grid_draws_are_distinct():
    draws = models.draw_params(100)
    assert len(draws) == 100 and len({str(sorted(d.items())) for d in draws}) == 100
    assert len(models.draw_params(10_000)) == 192  # the penalties do nothing in Spark's trees


@pytest.mark.parametrize(
    "name, params",
    [("random_forest", {"numTrees": 5, "maxDepth": 3}), ("svm", {"maxIter": 5, "fourier_features": 20})],
)
def test_other_candidates_fit(data, name, params):
    spec = models.candidate(name, **params)
    fitted = models.fit_candidate(spec, data.train, data.features, data.scaler)
    assert training.rate_splits(fitted, data).where("split = 'test'").first()["auc"] > 0.8


def test_a_missing_imputer_is_told(spark, model, data):
    plain = replace(model, imputer=None)
    rows = data.rows.select("Customer_ID", *data.features)
    with pytest.raises(ValueError, match="no fitted imputer"):
        scoring.score_batch_with(plain, rows)
    assert scoring.score_batch_with(plain, rows, "zero").count() == rows.count()


def test_reload_restores_imputer_rule_and_donors(spark, model, data, tmp_path):
    from tidemark.operators.impute import fit_imputer
    from tidemark.settings import ImputeRule

    gap = F.pmod(F.hash("Customer_ID"), F.lit(5)) == 0
    first = data.features[0]
    rows = data.rows.select("Customer_ID", *data.features).withColumn(first, F.when(~gap, F.col(first)))
    rule = ImputeRule(per_feature={first: "knn"}, knn_neighbors=3)
    bundle = replace(model, imputer=fit_imputer(rows.select(*data.features), rule))
    path = str(tmp_path / "model")
    models.save_model(bundle, spark, path)
    again = models.load_model(spark, path)
    assert again.imputer.rule == rule and again.imputer.fits == bundle.imputer.fits
    assert again.imputer.donors.count() == rows.count()
    before, after = (
        scoring.score_batch_with(m, rows).select("Customer_ID", F.col("confidence").alias(n))
        for m, n in ((bundle, "a"), (again, "b"))
    )
    both = before.join(after, "Customer_ID")
    assert both.count() >= rows.count() and both.where("a <> b or a is null").isEmpty()


def test_decision_without_probabilities(spark):
    from tidemark.operators import metrics

    df = spark.createDataFrame([(0.5,), (0.69,), (0.7,)], "score double")
    assert [r.prediction for r in metrics.decide(df).collect()] == [0, 0, 1]
    assert [r.prediction for r in metrics.decide(df, probability=False).collect()] == [1, 1, 1]


def _sizes(df):
    return [n for n in df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]


def test_rows_of_a_fit_are_dealt_to_all_cores(spark, data):
    """Few rows with long passes: those a candidate is fitted on do not lie in one task, wherever they come from."""
    cores = spark.sparkContext.defaultParallelism
    fitted = []

    class Estimator(models.LogisticRegression):
        def fit(self, part):
            fitted.append(_sizes(part))
            return super().fit(part)

    rows = data.train.coalesce(1)
    wide = replace(models.candidate("logistic_regression"), estimator=lambda n: Estimator(), rows_a_task=40)
    models.fit_candidate(wide, rows, data.features, data.scaler, calibrate=False)
    n = rows.count()
    tasks = min(cores, -(-n // 40))
    assert tasks > 1 and len(fitted[0]) == tasks and max(fitted[0]) <= 1.5 * n / tasks
    models.fit_candidate(replace(wide, rows_a_task=10**6), rows, data.features, data.scaler, calibrate=False)
    assert fitted[1] == [n]


def test_linear_fits_keep_few_rows_in_one_task():
    """Their passes are short: a task more, and the second stage of its sums, costs more than it saves."""
    size = {c.name: c.rows_a_task for c in models.candidates()}
    assert size["svm"] == size["logistic_regression"] == 50_000 and size["random_forest"] == size["gradient_boosting"] == 500
