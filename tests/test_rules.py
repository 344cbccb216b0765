"""Small hand-made frames for the rules that are easy to get wrong."""

import datetime as dt
import math
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import cleaning as C
from tidemark.functions import derived as D
from tidemark.operators import clean, drift, labels, lookups, metrics, ordering, profile, split
from tidemark.operators import calendar as cal
from tidemark.settings import LabelRule, MonitorRule


def values(df, column):
    return [r[column] for r in df.collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, number",
    [("39_", None), ("-500", None), ("4000", None), ("39", 39), ("100", 100), ("", None)],
)
def test_age_must_be_digits_in_range(spark, text, number):
    assert one(spark, C.valid_age(F.lit(text))) == number


def test_age_repair_is_the_other_policy(spark):
    assert one(spark, C.repaired_age(F.lit("39_"))) == 39.0


@pytest.mark.parametrize(
    "text, number",
    [("12.345_", 12.35), ("--5", None), ("1.2.3", None), ("", None), ("_", None), ("-3", -3.0)],
)
def test_scrub(spark, text, number):
    assert one(spark, C.scrub_number(F.lit(text))) == number


def test_masks_pass_the_occupation_pattern_and_nulls_take_the_default(spark):
    assert one(spark, C.valid_occupation(F.lit("_______"))) == "_______"
    assert one(spark, C.valid_ssn(F.lit(None).cast("string"))) == "NA"


def test_names_keep_letters(spark):
    assert one(spark, C.letters_only(F.lit("O'Donnell\"r"))) == "ODonnellr"


def test_zero_due_is_not_an_error(spark):
    assert one(spark, D.installments_missed(F.lit(5).cast("decimal(18,2)"), F.lit(0).cast("decimal(18,2)"))) == 0


def _loan(spark, overdue, due):
    day = dt.date(2023, 9, 1)
    row = ("L", "C", dt.date(2023, 3, 1), 6, overdue, due, day)
    return spark.createDataFrame(
        [row],
        "loan_id string, Customer_ID string, loan_start_date date, installment_num int, "
        "overdue_amt double, due_amt double, snapshot_date date",
    )


def test_exact_amounts_do_not_overshoot(spark):
    loan = _loan(spark, 500.5, 100.1)
    assert values(labels.loan_daily(loan), "installments_missed") == [5]
    assert values(labels.loan_daily(loan, exact=False), "installments_missed") == [6]


def test_overdue_without_due_keeps_dpd_unknown_and_label_zero(spark):
    panel = labels.loan_daily(_loan(spark, 10.0, 0.0))
    assert values(panel, "dpd") == [None]
    assert values(labels.label_store(panel), "label") == [0]


def test_labels_at_equal_the_filtered_panel(spark):
    loans = _loan(spark, 500.5, 100.1)
    gap = loans.withColumn("installment_num", F.lit(None).cast("int"))
    both = loans.unionByName(gap)
    for rule in (LabelRule(30, 6), LabelRule(0, 0)):
        whole = labels.label_store(labels.loan_daily(both), rule).collect()
        assert labels.labels_at(both, rule).collect() == whole and len(whole) == 1


def test_label_by_start_clock(spark):
    panel = labels.loan_daily_by_start(_loan(spark, 10.0, 5.0))
    row = panel.first()
    assert (row["mob"], row["dpd"]) == (6, 184 - 180)
    assert values(labels.label_store(panel, LabelRule(4, 6)), "label_def") == ["4dpd_6mob"]


def test_month_ends(spark):
    start, end = F.lit("2023-01-31").cast("date"), F.lit("2023-06-30").cast("date")
    assert one(spark, D.months_on_book(end, start)) == 5
    missed = D.first_missed_date(F.lit("2023-03-31").cast("date"), F.lit(1))
    assert one(spark, missed) == dt.date(2023, 2, 28)


def test_spines(spark):
    bounds = spark.sql("SELECT DATE'2023-01-15' AS start, DATE'2024-12-01' AS end")
    spine = sorted(values(cal.first_of_month_spine(bounds), "snapshot_date"))
    assert len(spine) == 24 and spine[0] == dt.date(2023, 1, 1)
    ends = spark.sql("SELECT DATE'2023-01-31' AS start, DATE'2023-03-31' AS end")
    assert sorted(values(cal.monthly_spine(ends), "snapshot_date")) == [
        dt.date(2023, 1, 31), dt.date(2023, 2, 28), dt.date(2023, 3, 31)
    ]


def test_model_windows(spark):
    row = spark.range(1).select(*cal.model_windows(F.lit("2024-09-01").cast("date"))).first()
    assert [str(x) for x in row] == ["2023-07-01", "2024-06-30", "2024-07-01", "2024-08-31"]


def test_codes_are_sorted_and_null_is_minus_one(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "i int, v string")
    coded = lookups.with_codes(df, "v", null_code=-1).orderBy("i")
    assert values(coded, "code") == [1, -1, 0]


def test_no_side_is_broadcast_by_hint_and_null_keys_are_spread(spark):
    left = spark.range(5000).select(F.when(F.col("id") < 100, F.col("id")).alias("k"))
    right = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    joined = lookups.join_features([left, right], ["k"])
    assert "strategy=broadcast" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 5000 and joined.where("x = 1").count() == 50
    dealt = lookups._with_part(left, ["k"], True).where("k IS NULL").agg(F.count_distinct("__part")).first()[0]
    assert dealt > 500
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter, .*__part", plan)


def test_running_totals_equal_a_window(spark):
    rows = spark.range(5000).select(
        F.pmod("id", F.lit(3)).alias("g"),
        F.pmod(F.col("id") * 7919, F.lit(10007)).alias("v"),
        (F.col("id") % 5 + 1).alias("n"),
    )
    from pyspark.sql import Window as W

    window = W.partitionBy("g").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    want = rows.withColumn("cum_n", F.sum("n").over(window))
    got = ordering.running_totals(rows, "v", ["n"], ["g"])
    assert got.exceptAll(want.select(got.columns)).isEmpty() and got.count() == 5000


@pytest.mark.parametrize("numbers, median", [([1, 2, 3, 4], 2.5), ([5], 5.0), ([1, 1, 9], 1.0)])
def test_median(spark, numbers, median):
    df = spark.createDataFrame([(float(x),) for x in numbers] + [(None,)], "x double")
    assert values(ordering.exact_medians(df, ["x"]), "median") == [median]


def test_median_is_exact_when_the_sketch_misses(spark):
    df = spark.range(1001).select((F.col("id") * 1.0).alias("x"))
    assert values(ordering.exact_medians(df, ["x"], accuracy=5), "median") == [500.0]
    zone = ordering.middle_zone(600.0, 700.0, 1001, 600, 701)
    assert zone == (float("-inf"), 700.0, 701, 500, 500)


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",), (None,)], "x string")
    assert values(profile.modes(df, ["x"], "string"), "mode") == ["a"]


def test_average_precision_is_the_step_sum(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "label int, score double")
    row = metrics.ranking_metrics(df).first()
    assert math.isclose(row["auc"], 0.75) and math.isclose(row["average_precision"], 5 / 6)
    assert row["gini"] == 0.5


def test_auc_edge_cases(spark):
    schema = "label int, score double, prediction int"
    alone = spark.createDataFrame([(1, 0.3, 1), (1, 0.9, 1)], schema)
    assert metrics.ranking_metrics(alone).first()["auc"] == 0.0
    ties = spark.createDataFrame([(1, 0.5, 0), (0, 0.5, 1)], schema)
    assert metrics.ranking_metrics(ties).first()["auc"] == 0.5
    broken = spark.createDataFrame([(1, None, 1), (0, 0.5, 0), (1, 0.1, 0)], schema)
    row = metrics.ranking_metrics(broken, prediction="prediction").first()
    assert row["auc"] == 0.75


def test_metrics_without_positives_are_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = metrics.threshold_metrics(metrics.confusion(df)).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["accuracy"]) == (0, 0, 0, 0.5)


def _numbers(spark, xs):
    return spark.createDataFrame([(None if x is None else float(x),) for x in xs], "x double")


def test_psi_of_a_frame_with_itself_is_zero(spark):
    df = _numbers(spark, [*range(100), None])
    assert values(drift.psi(df, df), "psi") == [0.0]


def test_psi_edges(spark):
    assert drift.equal_width_edges(5.0, 5.0, 10)[0] == pytest.approx(4.995)
    assert drift.equal_width_edges(5.0, 5.0, 10)[-1] == pytest.approx(5.005)
    assert drift.equal_width_edges(0.0, 100.0, 10)[:2] == [pytest.approx(-0.1), 10.0]


def test_psi_out_of_range(spark):
    reference = _numbers(spark, range(100))
    gone = _numbers(spark, [1000, 2000])
    assert values(drift.psi(reference, gone), "psi") == [0.0]
    assert values(drift.psi(reference, gone, overflow="bucket"), "psi")[0] > 1
    assert values(drift.psi(reference, _numbers(spark, [None])), "psi") == [float("inf")]
    assert values(drift.psi(_numbers(spark, [None]), reference), "psi") == [float("inf")]


def test_mean_shift_counts_absent_columns(spark):
    reference = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "a double, b double")
    current = spark.createDataFrame([(100.0,)], "a double")
    row = drift.mean_shift(reference, current).first()
    assert row["drift_share"] == 0.5 and row["drift_detected"]


def test_warning_raises_no_alert(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 7 + [(None, 1.0)] * 2, "x double, y double")
    rule = MonitorRule()
    row = drift.monitoring_summary(df, df, rule).first()
    assert row["data_quality"]["status"] == "WARNING"
    assert row["status"] == "OK" and row["alerts"] == []


def test_split_keeps_copies_together_and_shares(spark):
    df = spark.range(1000).select(
        (F.when(F.col("id") < 330, 7).otherwise(F.col("id"))).alias("k"),
        (F.col("id") % 4 == 0).cast("int").alias("label"),
    )
    parts = split.stratified_folds(df, "label", split.integer_hash(F.col("k")))
    per_key = parts.groupBy("k", "label").agg(F.count_distinct("fold").alias("folds"))
    assert per_key.where("folds > 1").isEmpty()
    unique = spark.range(1000).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    counts = (
        split.stratified_split(unique, "label", split.key_hash("id"))
        .groupBy("label", "split").count().collect()
    )
    assert {(r["label"], r["split"]): r["count"] for r in counts} == {
        (0, "train"): 600, (0, "test"): 150, (1, "train"): 200, (1, "test"): 50
    }


def test_bootstrap_size_is_capped_and_proportional(spark):
    df = spark.range(40_000).select("id", (F.col("id") % 5 == 0).cast("int").alias("label"))
    drawn = split.class_bootstrap(df, "label", split.key_hash("id"))
    counts = {r["label"]: r["count"] for r in drawn.groupBy("label").count().collect()}
    assert abs(counts[1] - 2000) < 200 and abs(counts[0] - 8000) < 400
    assert drawn.count() > drawn.distinct().count()


def test_exact_bootstrap_sizes_and_shares(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 7 == 0, 1).when(F.col("id") % 7 == 1, None).otherwise(0).alias("label"))
    for rows, ones in ((1000, 143), (1, 0), (10**12, 572)):
        drawn = split.exact_bootstrap(df, "label", split.key_hash("id"), rows).collect()
        assert len(drawn) == min(rows, 4000) and sum(r.label == 1 for r in drawn) == ones
        assert all((r.id % 7 == 0) == (r.label == 1) for r in drawn)
    distinct = len({r.id for r in drawn}) / 4000
    assert abs(distinct - 0.632) < 0.03  # as many draws as rows leave out 1/e of them
    again = split.exact_bootstrap(df.repartition(5), "label", split.key_hash("id"), 10**12).collect()
    assert sorted(r.id for r in again) == sorted(r.id for r in drawn)
    other = split.exact_bootstrap(df, "label", split.key_hash("id"), 10**12, seed=7).collect()
    assert sorted(r.id for r in other) != sorted(r.id for r in drawn)


def test_exact_bootstrap_draws_every_row_alike(spark):
    df = spark.range(64).select("id", F.lit(1).alias("label"))
    seen = [0] * 64
    for seed in range(3):
        for r in split.exact_bootstrap(df, "label", split.key_hash("id"), 64, seed).collect():
            seen[r.id] += 1
    assert sum(seen) == 192 and sum((k - 3) ** 2 / 3 for k in seen) < 110  # chi-square with 63 degrees


def test_exact_bootstrap_of_equal_rows_and_none(spark):
    same = spark.range(3000).select(F.least("id", F.lit(1000)).alias("id"), F.lit(0).alias("label"))
    drawn = split.exact_bootstrap(same, "label", split.key_hash("id"), 3000)
    counts = {r.id: r["count"] for r in drawn.groupBy("id").count().collect()}
    assert sum(counts.values()) == 3000 and abs(counts[1000] - 2000) < 150
    assert split.exact_bootstrap(same.where("false"), "label", split.key_hash("id")).count() == 0
    one = spark.createDataFrame([(5, 1)], "id int, label int")
    assert split.exact_bootstrap(one, "label", split.key_hash("id")).collect() == one.collect()


@pytest.mark.parametrize("entity", sorted(clean.SILVER))
def test_empty_snapshots_keep_their_schema(spark, entity):
    from tidemark.sources import schemas

    empty = spark.createDataFrame([], schemas.RAW[entity])
    cleaned = clean.SILVER[entity](empty)
    assert cleaned.count() == 0 and cleaned.columns == schemas.RAW[entity].fieldNames()
    assert dict(cleaned.dtypes)["snapshot_date"] == "date"


def test_fill_zero_reaches_every_numeric_column(spark):
    df = spark.createDataFrame([(None, None, None)], "a int, b double, c string")
    assert clean.fill_constant(df, numeric=0).first() == (0, 0.0, None)


def test_infinite_reference_values_are_drift(spark):
    ref = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (float("inf"), 3.0)], "x double, y double")
    got = {r.feature: r.psi for r in drift.psi(ref, ref).collect()}
    assert got["x"] == float("inf") and got["y"] < 1e-6


def test_a_column_empty_on_one_side_has_drifted(spark):
    ref = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, t string")
    now = spark.createDataFrame([(None, None)], "x double, t string")
    assert [r.distance for r in drift.ks_distance(ref, now).collect()] == [1.0]
    assert [r.distance for r in drift.js_divergence(ref, now, ["t"]).collect()] == [1.0]
    assert drift.dataset_drift(ref, now).first()["drift_detected"]


def test_rows_without_a_dataset_are_rated(spark):
    rows = [("a", 1, 0.9, 1), ("a", 0, 0.1, 0), (None, 1, 0.2, 0), (None, 0, 0.8, 1)]
    df = spark.createDataFrame(rows, "dataset string, label int, score double, prediction int")
    got = {r.dataset: (r.sample_size, r.accuracy, r.auc) for r in metrics.evaluate(df).collect()}
    assert got == {"a": (2, 1.0, 1.0), None: (2, 0.0, 0.0)}
    whole = metrics.evaluate(df, []).collect()
    assert len(whole) == 1 and (whole[0].sample_size, whole[0].accuracy) == (4, 0.5)


def test_integer_hash_is_one_to_one_uniform_and_64_bit(spark):
    keys = spark.range(0, 1 << 62, (1 << 62) // 50_000).union(spark.range(50_000)).distinct()
    hashed = keys.select("id", split.integer_hash(F.col("id")).alias("h"))
    row = hashed.agg(F.count_distinct("h").alias("u"), F.count(F.lit(1)).alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).first()
    assert row.u == row.n and 0 <= row.lo and (1 << 61) < row.hi < (1 << 62)
    shares = spark.range(50_000).groupBy(F.shiftright(split.integer_hash(F.col("id")), 59).alias("b")).count().collect()
    assert len(shares) == 8 and all(abs(r["count"] - 6250) < 400 for r in shares)


def test_one_scan_for_ranking_metrics(spark, tmp_path):
    """The rows are read once; everything after works on counts per score."""
    path = str(tmp_path / "rows")
    spark.range(2000).select((F.col("id") % 2).alias("label"), (F.col("id") % 97 / 97).alias("score")).write.parquet(path)
    text = metrics.ranking_metrics(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in text
