"""Physical plans: no Python rows, no pairing joins, filters and columns at the scan."""

import pytest

import __spark_entry__ as entry
from tidemark.sources import surrogates as S

QUERIES = entry.queries()
LAZY = [
    "agg_bad_rate_by_mob", "cal_backfill_labels", "cln_silver_attributes", "cln_silver_financials",
    "drv_label_store", "enc_category_codes", "jon_gold_feature_store", "agg_class_distribution",
    "smp_stratified_split_loans", "smp_stratified_folds", "smp_class_bootstrap", "evl_auc_whole_table",
    "evl_dataset_comparison", "mon_psi_loan_amounts", "mon_ks_distance", "mon_mean_shift",
    "imp_simple_fills", "scr_batch", "mdl_class_weights", "mdl_standard_scaling",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_pairing_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_scan_reads_only_what_the_labels_need(spark, sf_dir):
    text = plan(QUERIES["drv_label_store"](spark, sf_dir))
    assert "l_discount" not in text and "o_totalprice" not in text
    assert "EqualTo(l_linenumber,6)" in text


def test_psi_shuffles_counts_only(spark, sf_dir):
    from tidemark.operators import drift

    lines = S.table(spark, sf_dir, "lineitem")
    text = plan(drift.psi(lines, lines, ["l_quantity"]))
    first = text.index("Exchange hashpartitioning(feature")
    assert "partial_count" in text[first:]


def test_whole_groups_are_not_windowed(spark, sf_dir):
    """The only windows over a bare group are over range totals, a bounded handful of rows."""
    text = plan(QUERIES["evl_auc_whole_table"](spark, sf_dir))
    assert "hashpartitioning(__range" in text


def _source_scans(spark, tmp_path, run):
    """How often a query reads its table, seen by an accumulator in a step above the scan."""
    path = str(tmp_path / "t")
    S.table(spark, run.sf_dir, run.table).write.parquet(path)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(path)
    run(df.mapInArrow(seen, df.schema)).collect()
    return read.value / df.count()


@pytest.mark.parametrize("name,most", [("statistics", 3), ("ranking", 1), ("imputer", 1), ("codes", 2)])
def test_scans_per_operator(spark, sf_dir, tmp_path, name, most):
    from tidemark.operators import impute, lookups, metrics, profile

    def run(df):
        if name == "statistics":
            return profile.column_statistics(df, ["l_quantity", "l_extendedprice", "l_discount"])
        if name == "ranking":
            rows = df.selectExpr("cast(l_returnflag = 'R' as int) AS label", "l_discount AS score")
            return metrics.ranking_metrics(rows)
        if name == "imputer":
            return impute.fit_imputer(df, columns=["l_quantity", "l_extendedprice", "l_returnflag"]).to_frame(spark)
        return lookups.with_codes(df.select("l_orderkey", "l_returnflag"), "l_returnflag")

    run.sf_dir, run.table = sf_dir, "lineitem"
    assert _source_scans(spark, tmp_path, run) <= most
