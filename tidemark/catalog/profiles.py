"""Aggregations, profiles, quality checks and splits."""

from math import factorial

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog import views as V
from tidemark.operators import clean, labels, metrics, profile, split
from tidemark.sources import surrogates as S


def _fin(spark, sf_dir):
    return clean.silver_financials(S.financials(spark, sf_dir))


def _panel(spark, sf_dir):
    return labels.loan_daily(S.loans(spark, sf_dir))


@query(
    "agg_rows_by_snapshot",
    f"WITH {V.LOANS} SELECT snapshot_date, count(*) AS row_count FROM loans GROUP BY snapshot_date",
)
def rows_by_snapshot(spark, sf_dir):
    return profile.rows_by_snapshot(S.loans(spark, sf_dir))


BAD_RATE_SQL = f"""WITH {V.PANEL} SELECT mob, round(avg(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END), 6) AS bad_rate, count(*) AS loans
 FROM panel GROUP BY mob ORDER BY mob"""


@query("agg_bad_rate_by_mob", BAD_RATE_SQL)
def bad_rate_by_mob(spark, sf_dir):
    curve = labels.bad_rate_curve(_panel(spark, sf_dir))
    return curve.withColumn("bad_rate", F.round("bad_rate", 6))


_PROFILED = [
    "Customer_ID", "snapshot_date", "Annual_Income", "Num_Credit_Card", "Delay_from_due_date",
    "Total_EMI_per_month", "Credit_Mix", "Payment_Behaviour",
]
_DTYPES = {"Customer_ID": "string", "snapshot_date": "date", "Credit_Mix": "string", "Payment_Behaviour": "string"}


@query(
    "agg_missing_profile",
    f"WITH {V.SILVER_FINANCIALS} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count(*) - count({c}) AS missing_count, round((count(*) - count({c}))*100.0::double/count(*), 6) AS missing_percentage,
 '{_DTYPES.get(c, "double")}' AS dtype, count(DISTINCT {c}) AS unique_values, {str(c not in _DTYPES).lower()} AS is_numeric FROM silver_fin"""
        for c in _PROFILED
    ),
)
def missing_profile(spark, sf_dir):
    out = profile.missing_profile(_fin(spark, sf_dir).select(_PROFILED))
    return out.withColumn("missing_percentage", F.round("missing_percentage", 6))


_STATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "agg_column_statistics",
    "WITH "
    + ", ".join(
        f"m_{c} AS (SELECT {c} AS mode FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        for c in _STATS
    )
    + " "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(median({c}), 6) AS median, (SELECT mode FROM m_{c}) AS mode, round(stddev_samp({c}), 6) AS std FROM lineitem"""
        for c in _STATS
    ),
)
def column_statistics(spark, sf_dir):
    stats = profile.column_statistics(S.table(spark, sf_dir, "lineitem"), _STATS)
    return stats.withColumns({c: F.round(c, 6) for c in ["mean", "median", "std"]})


@query(
    "agg_class_distribution",
    """WITH c AS (SELECT quality AS class, count(*) AS n FROM labels GROUP BY quality),
 w AS (SELECT max(n) AS most, min(n) AS least, sum(n) AS total FROM c),
 x AS (SELECT (SELECT class FROM c ORDER BY n DESC, class LIMIT 1) AS majority_class, (SELECT class FROM c ORDER BY n, class LIMIT 1) AS minority_class)
 SELECT class, n AS class_count, round(n/total, 6) AS class_ratio, majority_class, minority_class, round(most/least, 6) AS imbalance_ratio,
 CASE WHEN most/least < 3 THEN 'mild' WHEN most/least < 10 THEN 'moderate' ELSE 'severe' END AS severity FROM c, w, x""",
)
def class_distribution(spark, sf_dir):
    out = profile.class_distribution(S.table(spark, sf_dir, "labels"), "quality")
    return out.withColumns({c: F.round(c, 6) for c in ["class_ratio", "imbalance_ratio"]})


@query(
    "agg_label_cross_tab",
    f"""WITH {V.DECIDED} SELECT dataset, count(*) FILTER (label=0) AS label_0, count(*) FILTER (label=1) AS label_1 FROM decided GROUP BY dataset""",
)
def label_cross_tab(spark, sf_dir):
    return profile.cross_tab(S.scores(spark, sf_dir), "dataset", "label", [0, 1])


@query(
    "agg_prediction_cross_tab",
    f"""WITH {V.DECIDED} SELECT dataset, count(*) FILTER (prediction=0) AS prediction_0, count(*) FILTER (prediction=1) AS prediction_1 FROM decided GROUP BY dataset""",
)
def prediction_cross_tab(spark, sf_dir):
    decided = metrics.decide(S.scores(spark, sf_dir))
    return profile.cross_tab(decided, "dataset", "prediction", [0, 1])


_RATES = """SELECT dataset, round(avg(label), 6) AS actual_positive_rate, round(avg(prediction), 6) AS predicted_positive_rate,
 round(avg(prediction) - avg(label), 6) AS difference, count(*) AS sample_size FROM decided GROUP BY dataset"""


def _rounded_rates(df):
    return profile.positive_rates(df).withColumns(
        {
            c: F.round(c, 6)
            for c in ["actual_positive_rate", "predicted_positive_rate", "difference"]
        }
    )


@query("agg_positive_rates", f"WITH {V.DECIDED} {_RATES}")
def positive_rates(spark, sf_dir):
    return _rounded_rates(metrics.decide(S.scores(spark, sf_dir)))


@query(
    "srt_dataset_order",
    f"WITH {V.DECIDED} {_RATES} ORDER BY CASE dataset WHEN 'Training' THEN 1 WHEN 'OOT1' THEN 2 ELSE 3 END",
)
def dataset_order(spark, sf_dir):
    rates = _rounded_rates(metrics.decide(S.scores(spark, sf_dir)))
    return profile.in_dataset_order(rates)


@query(
    "set_tagged_union",
    f"WITH {V.SCORES} SELECT Customer_ID, label, score, dataset FROM scores",
)
def tagged_union(spark, sf_dir):
    scores = S.scores(spark, sf_dir)
    frames = {
        name: scores.where(F.col("dataset") == name).drop("dataset")
        for name in ["Training", "OOT1", "OOT2"]
    }
    return profile.tagged_union(frames)


@query(
    "agg_health_check",
    f"""WITH {V.SILVER_FINANCIALS}, h AS (SELECT CASE WHEN Credit_Mix = 'Good' THEN 1 ELSE 0 END AS label, CASE WHEN Delay_from_due_date > 20 THEN 'infinity'::double ELSE Annual_Income END AS Annual_Income, Total_EMI_per_month, Delay_from_due_date FROM silver_fin)
 SELECT count(*) AS rows, count(*) FILTER (label=0) AS label_0, count(*) FILTER (label=1) AS label_1,
 3*count(*) - count(Annual_Income) - count(Total_EMI_per_month) - count(Delay_from_due_date) AS missing_values, count(*) FILTER (Delay_from_due_date > 20) AS infinite_values FROM h""",
)
def health_check(spark, sf_dir):
    rows = _fin(spark, sf_dir).select(
        F.when(F.col("Credit_Mix") == "Good", 1).otherwise(0).alias("label"),
        F.when(F.col("Delay_from_due_date") > 20, float("inf")).otherwise(F.col("Annual_Income")).alias("Annual_Income"),
        "Total_EMI_per_month",
        "Delay_from_due_date",
    )
    return profile.health_check(rows)


_QUALITY_SQL = (
    V.SILVER_FINANCIALS
    + ", m AS (SELECT count(*) AS total_rows, "
    + " + ".join(f"count(*) - count({c})" for c in _PROFILED)
    + " AS missing_values FROM silver_fin)"
)


@query(
    "qlt_frame_quality",
    f"""WITH {_QUALITY_SQL} SELECT CASE WHEN missing_values*100.0/(total_rows*8) > 20 THEN 'ALERT' WHEN missing_values*100.0/(total_rows*8) > 10 THEN 'WARNING' ELSE 'OK' END AS status,
 total_rows, missing_values, round(missing_values*100.0::double/(total_rows*8), 2) AS missing_percentage, 8 AS columns FROM m""",
)
def frame_quality(spark, sf_dir):
    return profile.quality(_fin(spark, sf_dir).select(_PROFILED))


@query(
    "qlt_frame_shapes",
    """SELECT 'reference' AS frame, count(*) AS rows, 6 AS columns FROM events WHERE ts < TIMESTAMP '2024-01-16'
 UNION ALL SELECT 'current', count(*), 6 FROM events WHERE ts >= TIMESTAMP '2024-01-16'""",
)
def frame_shapes(spark, sf_dir):
    events = S.table(spark, sf_dir, "events")
    return profile.shape(events.where("ts < '2024-01-16'"), "reference").unionByName(
        profile.shape(events.where("ts >= '2024-01-16'"), "current")
    )


@query(
    "qlt_duplicate_keys",
    f"""WITH {V.LOANS} SELECT Customer_ID, snapshot_date, count(*) AS occurrences FROM loans GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_keys(spark, sf_dir):
    return profile.duplicate_keys(S.loans(spark, sf_dir))


def hash_sql(key: str, seed: int = 42) -> str:
    """The integer hash in SQL."""
    one, two = (f"(({key} & 2147483647) * {a} + ({key} >> 31) * {b} + {seed}) % {p}" for p, a, b in split.MIXERS)
    return f"({one}) * 2147483648 + ({two})"


_HASHED = f"scores_h AS (SELECT *, {hash_sql('Customer_ID')} AS h FROM scores)"


@query(
    "smp_stratified_split",
    f"""WITH {V.SCORES}, {_HASHED}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h) AS rn, count(*) OVER (PARTITION BY label) AS n FROM scores_h)
 SELECT Customer_ID, label, CASE WHEN rn <= (n*80 + 99) // 100 THEN 'train' ELSE 'test' END AS split FROM r""",
)
def stratified_split(spark, sf_dir):
    scores = S.scores(spark, sf_dir).select("Customer_ID", "label")
    return split.stratified_split(scores, "label", split.integer_hash(F.col("Customer_ID")))


@query(
    "smp_stratified_split_loans",
    f"""WITH {V.PANEL}, k AS (SELECT l_orderkey, l_linenumber, l_returnflag AS label, {hash_sql('l_orderkey')} AS h FROM lineitem),
 s AS (SELECT label, h, count(*) AS c FROM k GROUP BY ALL),
 r AS (SELECT label, h, sum(c) OVER (PARTITION BY label ORDER BY h) AS upto, c, sum(c) OVER (PARTITION BY label) AS n FROM s),
 b AS (SELECT label, min(h) AS cut FROM r WHERE upto >= (n*80 + 99) // 100 GROUP BY label)
 SELECT k.label, CASE WHEN h <= cut THEN 'train' ELSE 'test' END AS split, count(*) AS rows FROM k JOIN b ON k.label = b.label GROUP BY ALL""",
)
def stratified_split_orders(spark, sf_dir):
    """All lines of an order stay on one side: rows with equal keys are never parted."""
    lines = S.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_returnflag").alias("label")
    )
    parts = split.stratified_split(lines, "label", split.integer_hash(F.col("l_orderkey")))
    return parts.groupBy("label", "split").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "smp_stratified_folds",
    f"""WITH {V.SCORES}, {_HASHED}
 SELECT Customer_ID, label, cast(ntile(3) OVER (PARTITION BY label ORDER BY h) - 1 as integer) AS fold FROM scores_h""",
)
def stratified_folds(spark, sf_dir):
    scores = S.scores(spark, sf_dir).select("Customer_ID", "label")
    return split.stratified_folds(scores, "label", split.integer_hash(F.col("Customer_ID")))


@query(
    "agg_split_summary",
    f"""WITH {V.SCORES}, {_HASHED}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h) AS rn, count(*) OVER (PARTITION BY label) AS n FROM scores_h)
 SELECT CASE WHEN rn <= (n*80 + 99) // 100 THEN 'train' ELSE 'test' END AS split, count(*) AS rows, round(avg(label), 2) AS mean_label FROM r GROUP BY 1""",
)
def split_summary(spark, sf_dir):
    scores = S.scores(spark, sf_dir)
    parts = split.stratified_split(scores, "label", split.integer_hash(F.col("Customer_ID")))
    return split.split_summary(parts)


@query(
    "smp_class_bootstrap",
    f"""WITH {V.SCORES}, {_HASHED}, n AS (SELECT count(*) AS n, count(*) FILTER (label=1) AS ones FROM scores),
 d AS (SELECT n, ones, least(10000, n) AS total, floor(least(10000, n) * ones / n) AS draw FROM n),
 u AS (SELECT Customer_ID, label, h / 4611686018427387904.0::double AS u,
  least(1.0::double, CASE WHEN label = 1 THEN draw::double / ones ELSE (total - draw)::double / (n - ones) END) AS r FROM scores_h, d),
 p AS (SELECT Customer_ID, label, u, r, exp(-r) AS e FROM u),
 c AS (SELECT Customer_ID, label, """
    + " + ".join(
        "CASE WHEN u >= "
        + " + ".join(f"e*pow(r,{j})/{factorial(j)}" for j in range(k + 1))
        + " THEN 1 ELSE 0 END"
        for k in range(12)
    )
    + """ AS copies FROM p)
 SELECT Customer_ID, label, cast(copies as bigint) AS copies FROM c WHERE copies > 0""",
)
def class_bootstrap(spark, sf_dir):
    drawn = split.class_bootstrap(
        S.scores(spark, sf_dir), "label", split.integer_hash(F.col("Customer_ID"))
    )
    return drawn.groupBy("Customer_ID", "label").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "smp_exact_bootstrap",
    """WITH n AS (SELECT count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS ones FROM lineitem),
 d AS (SELECT size, least(size, n) AS total, least(size, n) * ones // n AS draw, n FROM n, (VALUES (10000), (1000000000)) s(size))
 SELECT size, 1 AS label, draw AS rows, cast(0 as bigint) AS strange FROM d UNION ALL SELECT size, 0, total - draw, 0 FROM d""",
)
def exact_bootstrap(spark, sf_dir):
    """A small draw and one as large as the table: exact sizes by class, and only rows of the table."""
    lines = S.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_returnflag") == "R").cast("int").alias("label")
    )
    out = None
    for size in (10_000, 1_000_000_000):
        drawn = split.exact_bootstrap(lines, "label", split.key_hash("l_orderkey", "l_linenumber"), size)
        known = lines.distinct().withColumn("known", F.lit(True))
        matched = drawn.join(known, lines.columns, "left")
        counts = matched.groupBy(F.lit(size).alias("size"), "label").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("known").isNull()).alias("strange")
        )
        out = counts if out is None else out.unionByName(counts)
    return out
