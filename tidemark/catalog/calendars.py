"""Snapshot spines, windows and date filters."""

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog import views as V
from tidemark.operators import calendar as cal
from tidemark.operators import labels, profile, split
from tidemark.plans import datamart
from tidemark.sources import surrogates as S


def _ship_bounds(spark, sf_dir):
    return S.table(spark, sf_dir, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("start"),
        F.max("l_shipdate").cast("date").alias("end"),
    )


@query(
    "cal_first_of_month",
    """WITH b AS (SELECT cast(date_trunc('month', min(l_shipdate)) as date) AS s, cast(max(l_shipdate) as date) AS e FROM lineitem),
 r AS (SELECT s, e, unnest(range(0, 2000)) AS i FROM b)
 SELECT cast(s + to_months(cast(i as integer)) as date) AS snapshot_date FROM r WHERE cast(s + to_months(cast(i as integer)) as date) <= e""",
)
def first_of_month(spark, sf_dir):
    return cal.first_of_month_spine(_ship_bounds(spark, sf_dir))


@query(
    "cal_monthly_steps",
    """WITH b AS (SELECT o_custkey, cast(min(o_orderdate) as date) AS s, cast(max(o_orderdate) as date) AS e FROM orders GROUP BY o_custkey),
 r AS (SELECT s, e, unnest(range(0, 400)) AS i FROM b)
 SELECT cast(s + to_months(cast(i as integer)) as date) AS snapshot_date FROM r WHERE cast(s + to_months(cast(i as integer)) as date) <= e""",
)
def monthly_steps(spark, sf_dir):
    bounds = (
        S.table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.min("o_orderdate").cast("date").alias("start"),
            F.max("o_orderdate").cast("date").alias("end"),
        )
    )
    return cal.monthly_spine(bounds)


@query(
    "cal_model_windows",
    """WITH t AS (SELECT DISTINCT cast(date_trunc('month', l_shipdate) as date) AS train_date FROM lineitem)
 SELECT train_date, cast(train_date - to_months(14) as date) AS train_test_start,
  cast(cast(train_date - to_months(2) as date) - 1 as date) AS train_test_end,
  cast(train_date - to_months(2) as date) AS oot_start, cast(train_date - 1 as date) AS oot_end FROM t""",
)
def model_windows(spark, sf_dir):
    dates = S.table(spark, sf_dir, "lineitem").select(
        F.trunc("l_shipdate", "MM").alias("train_date")
    )
    return dates.distinct().select("train_date", *cal.model_windows(F.col("train_date")))


@query(
    "cal_backfill_labels",
    f"""WITH {V.PANEL} SELECT snapshot_date, count(*) AS loans, cast(sum(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) as bigint) AS bad
 FROM panel WHERE mob = 6 AND snapshot_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-01' GROUP BY snapshot_date""",
)
def backfill_labels(spark, sf_dir):
    """The label stage for 48 snapshots as one job, not one job per snapshot."""
    start, end = "1996-01-01", "1999-12-01"
    spine = datamart.month_spine(spark, start, end)
    loans = cal.on_spine(S.loans(spark, sf_dir, start, end), spine)
    store = labels.labels_at(loans)
    return store.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("label").alias("bad")
    )


@query(
    "fil_snapshot",
    f"WITH {V.LOANS} SELECT loan_id, Customer_ID, snapshot_date FROM loans WHERE snapshot_date = DATE '1998-06-01'",
)
def snapshot_filter(spark, sf_dir):
    loans = cal.at_snapshot(S.loans(spark, sf_dir), "1998-06-01")
    return loans.select("loan_id", "Customer_ID", "snapshot_date")


@query(
    "fil_date_range",
    f"""WITH {V.LOANS} SELECT snapshot_date, count(*) AS row_count FROM loans
 WHERE snapshot_date BETWEEN DATE '1997-07-01' AND DATE '1998-06-30' GROUP BY snapshot_date""",
)
def date_range(spark, sf_dir):
    loans = cal.between_dates(S.loans(spark, sf_dir), "1997-07-01", "1998-06-30")
    return profile.rows_by_snapshot(loans)


@query(
    "fil_months_on_book",
    f"WITH {V.PANEL} SELECT loan_id, mob, dpd FROM panel WHERE mob = 6",
)
def at_mob(spark, sf_dir):
    panel = labels.loan_daily(S.loans(spark, sf_dir))
    return panel.where("mob = 6").select("loan_id", "mob", "dpd")


@query(
    "fil_completed_loans",
    f"""WITH {V.LOANS} SELECT installment_num, count(*) AS loans FROM loans
 WHERE loan_start_date < DATE '1999-01-01' GROUP BY installment_num""",
)
def completed(spark, sf_dir):
    done = labels.completed_loans(S.loans(spark, sf_dir), "1999-01-01")
    return done.groupBy("installment_num").agg(F.count(F.lit(1)).alias("loans"))


@query(
    "fil_final_installment",
    f"""WITH {V.PANEL} SELECT loan_id, Customer_ID, dpd, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS dpd_flag
 FROM panel WHERE installment_num = 7""",
)
def final_installment(spark, sf_dir):
    """Actual bads: loans at their last installment (7 in this panel)."""
    panel = labels.final_installments(labels.loan_daily(S.loans(spark, sf_dir)), 7)
    flag = labels.D.flag_at_least(F.col("dpd"), 30).alias("dpd_flag")
    return panel.select("loan_id", "Customer_ID", "dpd", flag)


@query(
    "smp_out_of_time",
    f"""WITH {V.LOANS}, t AS (SELECT CASE WHEN snapshot_date BETWEEN DATE '1999-07-01' AND DATE '1999-08-31' THEN 'oot'
  WHEN snapshot_date BETWEEN DATE '1998-07-01' AND DATE '1999-06-30' THEN 'train_test' END AS split, snapshot_date FROM loans)
 SELECT split, snapshot_date, count(*) AS loans FROM t WHERE split IS NOT NULL GROUP BY split, snapshot_date""",
)
def out_of_time(spark, sf_dir):
    names = ["train_test_start", "train_test_end", "oot_start", "oot_end"]
    windows = dict(zip(names, cal.model_windows(F.lit("1999-09-01").cast("date"))))
    tagged = split.out_of_time(S.loans(spark, sf_dir), *[windows[n] for n in names])
    return tagged.groupBy("split", "snapshot_date").agg(F.count(F.lit(1)).alias("loans"))
