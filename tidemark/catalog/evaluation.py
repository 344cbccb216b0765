"""Classification metrics."""

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog import views as V
from tidemark.operators import metrics, profile
from tidemark.sources import surrogates as S


def _decided(spark, sf_dir):
    return metrics.decide(S.scores(spark, sf_dir))


_CELLS = """cells AS (SELECT dataset, count(*) FILTER (label=1 AND prediction=1) AS tp, count(*) FILTER (label=0 AND prediction=1) AS fp,
 count(*) FILTER (label=1 AND prediction=0) AS fn, count(*) FILTER (label=0 AND prediction=0) AS tn FROM decided GROUP BY dataset)"""

_FLAT = """round((tp+tn)::double/(tp+fp+fn+tn), 6) AS accuracy,
 round(coalesce(tp::double/nullif(tp+fp,0), 0), 6) AS precision, round(coalesce(tp::double/nullif(tp+fn,0), 0), 6) AS recall,
 round(coalesce(2*tp::double/nullif(2*tp+fp+fn,0), 0), 6) AS f1_score, tp+fp+fn+tn AS sample_size"""

# every positive paired with every negative, through counts per distinct score
_AUC = """per AS (SELECT dataset, score, count(*) FILTER (label=1) AS pos, count(*) FILTER (label=0) AS neg FROM decided GROUP BY ALL),
 cum AS (SELECT *, sum(neg) OVER (PARTITION BY dataset ORDER BY score) - neg AS below,
  sum(pos) OVER (PARTITION BY dataset ORDER BY score DESC) AS pos_above, sum(neg) OVER (PARTITION BY dataset ORDER BY score DESC) AS neg_above,
  sum(pos) OVER (PARTITION BY dataset) AS p, sum(neg) OVER (PARTITION BY dataset) AS n FROM per),
 rates AS (SELECT dataset, sum(pos*(below + neg/2.0::double))/(any_value(p)::double*any_value(n)) AS auc,
  sum(pos::double/p * pos_above::double/(pos_above+neg_above)) AS ap FROM cum GROUP BY dataset)"""


def _rounded(df):
    floats = [f for f, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, 6) for c in floats})


@query(
    "evl_threshold_metrics",
    f"WITH {V.DECIDED}, {_CELLS} SELECT dataset, {_FLAT} FROM cells",
)
def threshold_metrics(spark, sf_dir):
    cells = metrics.confusion(_decided(spark, sf_dir), ["dataset"])
    return _rounded(metrics.threshold_metrics(cells).drop("tp", "fp", "fn", "tn"))


@query(
    "evl_auc",
    f"WITH {V.DECIDED}, {_AUC} SELECT dataset, round(auc, 6) AS auc FROM rates",
)
def auc(spark, sf_dir):
    return _rounded(metrics.ranking_metrics(S.scores(spark, sf_dir), ["dataset"])).select(
        "dataset", "auc"
    )


@query(
    "evl_auc_whole_table",
    """WITH per AS (SELECT l_extendedprice AS score, count(*) FILTER (l_returnflag='R') AS pos, count(*) FILTER (l_returnflag<>'R') AS neg FROM lineitem GROUP BY ALL),
 cum AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM per)
 SELECT round(sum(pos*(below + neg/2.0::double))/(sum(pos)::double*sum(neg)), 6) AS auc FROM cum""",
)
def auc_whole_table(spark, sf_dir):
    """One group over the whole table with nearly distinct scores: the case a window cannot take."""
    lines = S.table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.col("l_extendedprice").alias("score"),
    )
    return _rounded(metrics.ranking_metrics(lines)).select("auc")


@query(
    "evl_average_precision",
    f"WITH {V.DECIDED}, {_AUC} SELECT dataset, round(ap, 6) AS average_precision FROM rates",
)
def average_precision(spark, sf_dir):
    return _rounded(metrics.ranking_metrics(S.scores(spark, sf_dir), ["dataset"])).select(
        "dataset", "average_precision"
    )


@query(
    "evl_gini",
    f"WITH {V.DECIDED}, {_AUC} SELECT dataset, round(2*auc - 1, 3) AS gini FROM rates",
)
def gini(spark, sf_dir):
    return metrics.ranking_metrics(S.scores(spark, sf_dir), ["dataset"]).select("dataset", "gini")


@query("evl_confusion_matrix", f"WITH {V.DECIDED}, {_CELLS} SELECT * FROM cells")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion(_decided(spark, sf_dir), ["dataset"])


@query(
    "evl_predicted_classes",
    f"""WITH {V.DECIDED} SELECT dataset, count(*) FILTER (prediction=0) AS predicted_0, count(*) FILTER (prediction=1) AS predicted_1 FROM decided GROUP BY dataset""",
)
def predicted_classes(spark, sf_dir):
    return metrics.predicted_class_counts(_decided(spark, sf_dir), ["dataset"])


@query(
    "evl_decision_threshold",
    f"WITH {V.DECIDED} SELECT Customer_ID, score, prediction FROM decided",
)
def decision_threshold(spark, sf_dir):
    return _decided(spark, sf_dir).select("Customer_ID", "score", "prediction")


@query(
    "evl_dataset_comparison",
    f"""WITH {V.DECIDED}, {_CELLS}, {_AUC} SELECT dataset, tp, fp, fn, tn, {_FLAT}, round(auc, 6) AS auc, round(2*auc - 1, 3) AS gini, round(ap, 6) AS average_precision
 FROM cells JOIN rates USING (dataset)""",
)
def dataset_comparison(spark, sf_dir):
    compared = profile.in_dataset_order(metrics.evaluate(_decided(spark, sf_dir)))
    return _rounded(compared).withColumn("gini", F.round("gini", 3))


@query(
    "evl_decision_without_probability",
    f"WITH {V.SCORES} SELECT Customer_ID, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS prediction FROM scores",
)
def decision_without_probability(spark, sf_dir):
    decided = metrics.decide(S.scores(spark, sf_dir), probability=False)
    return decided.select("Customer_ID", "prediction")


@query(
    "evl_whole_frame_and_unnamed",
    f"""WITH {V.DECIDED}, n AS (SELECT CASE WHEN dataset <> 'OOT2' THEN dataset END AS dataset, label, prediction FROM decided)
 SELECT dataset, count(*) AS sample_size, round(count(*) FILTER (label = prediction)::double/count(*), 6) AS accuracy FROM n GROUP BY dataset
 UNION ALL SELECT 'all rows', count(*), round(count(*) FILTER (label = prediction)::double/count(*), 6) FROM n""",
)
def whole_frame_and_unnamed(spark, sf_dir):
    """Rows without a dataset name are a dataset; without grouping the whole frame is one."""
    named = F.when(F.col("dataset") != "OOT2", F.col("dataset"))
    rows = metrics.decide(S.scores(spark, sf_dir)).withColumn("dataset", named)
    whole = metrics.evaluate(rows, []).withColumn("dataset", F.lit("all rows"))
    both = metrics.evaluate(rows).unionByName(whole)
    return _rounded(both.select("dataset", "sample_size", "accuracy"))
