"""Classification metrics per dataset, by aggregation only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordering import join_null_safe, running_totals
from tidemark.session import checkpointed
from tidemark.settings import DECISION_THRESHOLD, NO_PROBABILITY_THRESHOLD


def decide(
    df: DataFrame, score: str = "score", threshold: float | None = None, probability: bool = True
) -> DataFrame:
    """Add ``prediction``: 1 where the score reaches the threshold.

    The default threshold is that for probabilities, or for scores of a model that gives none.
    """
    if threshold is None:
        threshold = DECISION_THRESHOLD if probability else NO_PROBABILITY_THRESHOLD
    return df.withColumn("prediction", (F.col(score) >= threshold).cast("int"))


def confusion(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """True/false positives and negatives per group; absent cells are 0."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(0.0))


def threshold_metrics(cells: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 from confusion counts; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return cells.withColumns(
        {
            "accuracy": _or_zero(tp + tn, tp + fp + fn + tn),
            "precision": _or_zero(tp, tp + fp),
            "recall": _or_zero(tp, tp + fn),
            "f1_score": _or_zero(2 * tp, 2 * tp + fp + fn),
            "sample_size": tp + fp + fn + tn,
        }
    )


def ranking_metrics(
    df: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    score: str = "score",
    prediction: str | None = None,
) -> DataFrame:
    """ROC-AUC (ties at mid-rank), Gini and average precision per group.

    Rows collapse to counts per distinct score before anything is ordered. One class alone gives
    AUC 0. When ``prediction`` is named, a group holding a null, NaN or infinite score is rated
    on its hard predictions instead.
    """
    by = list(by)
    y = F.col(label) == 1
    value = F.col(score).cast("double")
    bad = value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))
    hit = F.col(prediction) == 1 if prediction else F.lit(False)
    # the only look at the rows: ranges, running totals and sizes all come from these counts
    per_score = checkpointed(
        df.groupBy(*by, F.when(~bad, value).alias("__score")).agg(
            F.count_if(y).alias("__pos"),
            F.count_if(~y).alias("__neg"),
            F.count_if(y & hit).alias("__hit_pos"),
            F.count_if(~y & hit).alias("__hit_neg"),
            F.count_if(bad).alias("__n_bad"),
        )
    )
    sizes = per_score.groupBy(*by).agg(
        F.sum("__pos").alias("__P"),
        F.sum("__neg").alias("__N"),
        F.sum("__hit_pos").alias("__TP"),
        F.sum("__hit_neg").alias("__FP"),
        F.sum("__n_bad").alias("__bad"),
    )
    counts = per_score.select(*by, "__score", "__pos", "__neg")
    ordered = running_totals(counts, "__score", ["__pos", "__neg"], by)
    ordered = _with_sizes(ordered, sizes, by)
    pos, neg = F.col("__P"), F.col("__N")
    # thresholds from the highest score down, for average precision
    pos_above = pos - F.col("cum___pos") + F.col("__pos")
    neg_above = neg - F.col("cum___neg") + F.col("__neg")
    sums = ordered.groupBy(*by).agg(
        F.sum(
            F.col("__pos").cast("double") * (F.col("cum___neg") - F.col("__neg") / 2)
        ).alias("__pairs"),
        F.sum(
            F.try_divide(F.col("__pos"), pos)
            * F.try_divide(pos_above.cast("double"), pos_above + neg_above)
        ).alias("__ap"),
    )
    sums = _with_sizes(sums, sizes, by)
    rated = F.col("__pairs") / (pos.cast("double") * neg)
    if prediction:
        by_hit = (1 + F.col("__TP") / pos - F.col("__FP") / neg) / 2
        rated = F.when(F.col("__bad") > 0, by_hit).otherwise(rated)
    auc = F.when((pos == 0) | (neg == 0), F.lit(0.0)).otherwise(rated)
    return sums.select(
        *by,
        auc.alias("auc"),
        F.round(2 * auc - 1, 3).alias("gini"),
        F.coalesce("__ap", F.lit(0.0)).alias("average_precision"),
    )


def _with_sizes(rows: DataFrame, sizes: DataFrame, by: list[str]) -> DataFrame:
    if by:
        return join_null_safe(rows, sizes, by)
    one = sizes.select(F.struct(*sizes.columns).alias("s")).scalar()
    return rows.withColumn("__s", one).select("*", "__s.*").drop("__s")


def evaluate(
    df: DataFrame,
    by: Sequence[str] = ("dataset",),
    label: str = "label",
    score: str = "score",
    prediction: str = "prediction",
) -> DataFrame:
    """Threshold and ranking metrics of each dataset side by side; without ``by`` of all rows.

    Rows without a dataset name form a dataset of their own.
    """
    by = list(by)
    flat = threshold_metrics(confusion(df, by, label, prediction))
    return join_null_safe(flat, ranking_metrics(df, by, label, score, prediction), by)


def predicted_class_counts(
    df: DataFrame, by: Sequence[str] = (), prediction: str = "prediction"
) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count_if(F.col(prediction) == 0).alias("predicted_0"),
        F.count_if(F.col(prediction) == 1).alias("predicted_1"),
    )


def labels_with_predictions(
    labels: DataFrame, predictions: DataFrame, keys: Sequence[str] = ("Customer_ID", "snapshot_date")
) -> DataFrame:
    """Labels joined to predictions on every key column both frames carry.

    Joining on the customer alone would pair each snapshot with all others of that customer.
    """
    shared = [k for k in keys if k in labels.columns and k in predictions.columns]
    if not shared:
        raise ValueError(f"labels and predictions share none of {list(keys)}")
    return labels.join(predictions, shared, "inner")


def distribution_comparison(df: DataFrame, by: str = "dataset") -> DataFrame:
    """Label and prediction counts, positive rates and their difference per dataset, one pass."""
    actual, predicted = F.avg("label"), F.avg("prediction")
    return df.groupBy(by).agg(
        F.count_if(F.col("label") == 0).alias("label_0"),
        F.count_if(F.col("label") == 1).alias("label_1"),
        F.count_if(F.col("prediction") == 0).alias("prediction_0"),
        F.count_if(F.col("prediction") == 1).alias("prediction_1"),
        actual.alias("actual_positive_rate"),
        predicted.alias("predicted_positive_rate"),
        (predicted - actual).alias("difference"),
        F.count(F.lit(1)).alias("sample_size"),
    )
