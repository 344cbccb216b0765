"""Derived features, labels, encodings and joins."""

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog import views as V
from tidemark.functions import derived as D
from tidemark.operators import clean, labels, lookups
from tidemark.operators import features as feat
from tidemark.sources import surrogates as S

def _panel(spark, sf_dir):
    return labels.loan_daily(S.loans(spark, sf_dir))


def _fin(spark, sf_dir):
    return clean.silver_financials(S.financials(spark, sf_dir))


def _att(spark, sf_dir):
    return clean.silver_attributes(S.attributes(spark, sf_dir))


@query("drv_mob", f"WITH {V.PANEL} SELECT loan_id, mob FROM panel")
def mob(spark, sf_dir):
    return _panel(spark, sf_dir).select("loan_id", "mob")


@query(
    "drv_months_between",
    """WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_shipdate as date) AS b, cast(o_orderdate as date) AS a
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
 p AS (SELECT *, (year(b)-year(a))*12 + month(b)-month(a) AS m, day(b)-day(a) AS dd,
  (b = last_day(b) AND a = last_day(a)) AS both_last FROM d)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  cast(CASE WHEN both_last OR dd = 0 THEN m WHEN m > 0 AND dd < 0 THEN m - 1 WHEN m < 0 AND dd > 0 THEN m + 1 ELSE m END as integer) AS mob FROM p""",
)
def months_between(spark, sf_dir):
    lineitem, orders = S.table(spark, sf_dir, "lineitem"), S.table(spark, sf_dir, "orders")
    ship, order = F.col("l_shipdate").cast("date"), F.col("o_orderdate").cast("date")
    return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", D.months_on_book(ship, order).alias("mob")
    )


@query(
    "drv_installments_missed",
    f"WITH {V.PANEL} SELECT loan_id, installments_missed FROM panel",
)
def installments_missed(spark, sf_dir):
    return _panel(spark, sf_dir).select("loan_id", "installments_missed")


@query(
    "drv_installments_missed_float",
    f"""WITH {V.LOANS} SELECT loan_id, CASE WHEN due_amt = 0 THEN 0 ELSE cast(ceil(overdue_amt::float::double / due_amt::float::double) as integer) END AS installments_missed FROM loans""",
)
def installments_missed_float(spark, sf_dir):
    """The single-precision variant, which overshoots on some amounts."""
    panel = labels.loan_daily(S.loans(spark, sf_dir), exact=False)
    return panel.select("loan_id", "installments_missed")


@query(
    "drv_first_missed_date",
    f"WITH {V.PANEL} SELECT loan_id, first_missed_date FROM panel WHERE first_missed_date IS NOT NULL",
)
def first_missed_date(spark, sf_dir):
    return (
        _panel(spark, sf_dir)
        .where(F.col("first_missed_date").isNotNull())
        .select("loan_id", "first_missed_date")
    )


@query("drv_dpd", f"WITH {V.PANEL} SELECT loan_id, dpd FROM panel")
def dpd(spark, sf_dir):
    return _panel(spark, sf_dir).select("loan_id", "dpd")


@query(
    "drv_loan_daily",
    f"WITH {V.PANEL} SELECT loan_id, snapshot_date, mob, installments_missed, dpd FROM panel",
)
def loan_daily(spark, sf_dir):
    return _panel(spark, sf_dir).select(
        "loan_id", "snapshot_date", "mob", "installments_missed", "dpd"
    )


@query(
    "drv_dpd_by_start",
    f"""WITH {V.LOANS} SELECT loan_id, CASE WHEN overdue_amt > 0 THEN cast(date_diff('day', loan_start_date, snapshot_date) - installment_num*30 as integer) ELSE 0 END AS dpd,
 cast(date_diff('month', loan_start_date, snapshot_date) as integer) AS mob FROM loans""",
)
def dpd_by_start(spark, sf_dir):
    return labels.loan_daily_by_start(S.loans(spark, sf_dir)).select("loan_id", "dpd", "mob")


@query(
    "drv_label_store",
    f"""WITH {V.PANEL} SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def, snapshot_date
 FROM panel WHERE mob = 6""",
)
def label_store(spark, sf_dir):
    return labels.labels_at(S.loans(spark, sf_dir))


@query(
    "drv_label_store_by_start",
    f"""WITH {V.LOANS} SELECT loan_id, Customer_ID,
 CASE WHEN overdue_amt > 0 AND date_diff('day', loan_start_date, snapshot_date) - installment_num*30 >= 3 THEN 1 ELSE 0 END AS label,
 '3dpd_5mob' AS label_def, snapshot_date FROM loans WHERE date_diff('month', loan_start_date, snapshot_date) = 5""",
)
def label_store_by_start(spark, sf_dir):
    panel = labels.loan_daily_by_start(S.loans(spark, sf_dir))
    return labels.label_store(panel, labels.LabelRule(dpd=3, mob=5))


@query(
    "drv_ratios",
    f"""WITH {V.SILVER_FINANCIALS} SELECT Customer_ID,
 round(CASE WHEN Annual_Income > 0 THEN Outstanding_Debt/Annual_Income END, 6) AS Debt_to_Income_Ratio,
 round(CASE WHEN Monthly_Inhand_Salary > 0 THEN Total_EMI_per_month/Monthly_Inhand_Salary END, 6) AS EMI_Burden_Ratio FROM silver_fin""",
)
def ratios(spark, sf_dir):
    formulas = feat.derived_features()
    return _fin(spark, sf_dir).select(
        "Customer_ID",
        *[F.round(formulas[f], 6).alias(f) for f in ["Debt_to_Income_Ratio", "EMI_Burden_Ratio"]],
    )


@query(
    "drv_utilisation_trend",
    f"""WITH {V.SILVER_FINANCIALS} SELECT Customer_ID, round((Credit_Utilization_Ratio - CAST(0.3 AS DOUBLE))/CAST(0.7 AS DOUBLE), 5) AS Credit_Utilization_Trend FROM silver_fin""",
)
def utilisation_trend(spark, sf_dir):
    value = feat.derived_features()["Credit_Utilization_Trend"]
    return _fin(spark, sf_dir).select(
        "Customer_ID", F.round(value, 5).alias("Credit_Utilization_Trend")
    )


@query(
    "drv_delinquency_score",
    f"""WITH {V.SILVER_FINANCIALS} SELECT Customer_ID, round(Num_of_Delayed_Payment*CAST(0.4 AS DOUBLE) + Delay_from_due_date*CAST(0.6 AS DOUBLE), 6) AS Delinquency_Score FROM silver_fin""",
)
def delinquency_score(spark, sf_dir):
    value = feat.derived_features()["Delinquency_Score"]
    return _fin(spark, sf_dir).select("Customer_ID", F.round(value, 6).alias("Delinquency_Score"))


@query(
    "drv_row_sum",
    f"WITH {V.CLICKSTREAM} SELECT Customer_ID, snapshot_date, fe_1, fe_2, fe_3, fe_1 + fe_2 + fe_3 AS fe_sum FROM clickstream",
)
def row_sum(spark, sf_dir):
    return feat.with_row_sum(S.clickstream(spark, sf_dir))


_MIX = "CASE Credit_Mix WHEN 'Good' THEN 2 WHEN 'Standard' THEN 1 ELSE 0 END AS Credit_Mix_encoded"


@query("enc_credit_mix", f"WITH {V.SILVER_FINANCIALS} SELECT Customer_ID, {_MIX} FROM silver_fin")
def credit_mix(spark, sf_dir):
    value = feat.derived_features()["Credit_Mix_encoded"]
    return _fin(spark, sf_dir).select("Customer_ID", value.alias("Credit_Mix_encoded"))


_UNMASKED = "CASE WHEN Occupation <> '_______' THEN Occupation END"


@query(
    "enc_category_codes",
    f"""WITH {V.ATTRIBUTES}, a AS (SELECT Customer_ID, {_UNMASKED} AS Occupation FROM attributes),
 c AS (SELECT Occupation, cast(row_number() OVER (ORDER BY Occupation) - 1 as integer) AS code FROM (SELECT DISTINCT Occupation FROM a WHERE Occupation IS NOT NULL))
 SELECT Customer_ID, a.Occupation, coalesce(code, -1) AS Occupation_encoded FROM a LEFT JOIN c ON a.Occupation = c.Occupation""",
)
def category_codes(spark, sf_dir):
    people = clean.unmask_missing(S.attributes(spark, sf_dir)).select("Customer_ID", "Occupation")
    return lookups.with_codes(people, "Occupation", "Occupation_encoded", null_code=-1)


@query(
    "enc_dictionary",
    f"""WITH {V.ATTRIBUTES}, a AS (SELECT Customer_ID, {_UNMASKED} AS Occupation FROM attributes),
 c AS (SELECT Occupation, cast(row_number() OVER (ORDER BY Occupation) - 1 as integer) AS code FROM (SELECT DISTINCT Occupation FROM a WHERE Occupation IS NOT NULL))
 SELECT Customer_ID, a.Occupation, code AS Occupation_encoded FROM a LEFT JOIN c ON a.Occupation = c.Occupation""",
)
def dictionary(spark, sf_dir):
    people = clean.unmask_missing(S.attributes(spark, sf_dir)).select("Customer_ID", "Occupation")
    return lookups.with_codes(people, "Occupation", "Occupation_encoded")


@query(
    "enc_large_dictionary",
    """WITH c AS (SELECT c_name, cast(row_number() OVER (ORDER BY c_name) - 1 as integer) AS code FROM (SELECT DISTINCT c_name FROM customer))
 SELECT c_custkey, code FROM customer JOIN c USING (c_name)""",
)
def large_dictionary(spark, sf_dir):
    """Codes of a column that is nearly unique: ranked by key range, no single sorting task."""
    customers = S.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return lookups.with_codes(customers, "c_name").select("c_custkey", "code")


@query(
    "agg_distinct_values",
    f"WITH {V.ATTRIBUTES} SELECT DISTINCT {_UNMASKED} AS Occupation FROM attributes WHERE {_UNMASKED} IS NOT NULL",
)
def distinct_values(spark, sf_dir):
    return lookups.distinct_values(clean.unmask_missing(S.attributes(spark, sf_dir)), "Occupation")


@query(
    "jon_feature_tables",
    f"""WITH {V.SILVER_FINANCIALS}, {V.SILVER_ATTRIBUTES}, {V.CLICKSTREAM}
 SELECT Customer_ID, snapshot_date, Annual_Income, Credit_Mix, Age, Occupation, fe_1, fe_2 FROM silver_fin
 LEFT JOIN silver_att USING (Customer_ID, snapshot_date) LEFT JOIN clickstream USING (Customer_ID, snapshot_date)""",
)
def feature_tables(spark, sf_dir):
    joined = lookups.join_features(
        [_fin(spark, sf_dir), _att(spark, sf_dir), S.clickstream(spark, sf_dir)]
    )
    return joined.select(
        "Customer_ID", "snapshot_date", "Annual_Income", "Credit_Mix", "Age", "Occupation", "fe_1", "fe_2"
    )


GOLD_SQL = f"""WITH {V.SILVER_FINANCIALS}, {V.SILVER_ATTRIBUTES}
 SELECT Customer_ID, snapshot_date, Annual_Income, Outstanding_Debt, Credit_Utilization_Ratio, Total_EMI_per_month, Num_of_Delayed_Payment,
 round(CASE WHEN Annual_Income > 0 THEN Outstanding_Debt/Annual_Income END, 6) AS Debt_to_Income_Ratio,
 round(CASE WHEN Monthly_Inhand_Salary > 0 THEN Total_EMI_per_month/Monthly_Inhand_Salary END, 6) AS EMI_Burden_Ratio, {_MIX}
 FROM silver_fin LEFT JOIN silver_att USING (Customer_ID, snapshot_date)"""


@query("jon_gold_feature_store", GOLD_SQL)
def gold_feature_store(spark, sf_dir):
    store = feat.feature_store(_fin(spark, sf_dir), _att(spark, sf_dir))
    return store.withColumns(
        {c: F.round(c, 6) for c in ["Debt_to_Income_Ratio", "EMI_Burden_Ratio"]}
    )


_LABELS = """labels_6 AS (SELECT Customer_ID, CASE WHEN count(*) FILTER (dpd >= 30) > 0 THEN 1 ELSE 0 END AS label FROM panel GROUP BY Customer_ID)"""


def _customer_labels(spark, sf_dir):
    """Whether a customer was ever 30 days past due, dated like the attributes."""
    ever = (
        _panel(spark, sf_dir)
        .groupBy("Customer_ID")
        .agg(F.max(D.flag_at_least(F.col("dpd"), 30)).alias("label"))
    )
    dates = S.attributes(spark, sf_dir).select("Customer_ID", "snapshot_date")
    return dates.join(ever, "Customer_ID")


@query(
    "jon_labels_left_features",
    f"""WITH {V.PANEL}, {V.SILVER_FINANCIALS}, {_LABELS}
 SELECT l.Customer_ID, a.snapshot_date, label, fin.Annual_Income FROM labels_6 l JOIN silver_fin a USING (Customer_ID)
 LEFT JOIN (SELECT * FROM silver_fin WHERE Annual_Income > 60000) fin ON fin.Customer_ID = l.Customer_ID AND fin.snapshot_date = a.snapshot_date""",
)
def labels_left_features(spark, sf_dir):
    rich = _fin(spark, sf_dir).where("Annual_Income > 60000")
    return lookups.labelled(
        _customer_labels(spark, sf_dir),
        rich.select("Customer_ID", "snapshot_date", "Annual_Income"),
        "left",
    )


@query(
    "jon_features_inner_labels",
    f"""WITH {V.PANEL}, {V.SILVER_FINANCIALS}, {_LABELS}
 SELECT Customer_ID, snapshot_date, label, Annual_Income FROM labels_6 l JOIN silver_fin a USING (Customer_ID) WHERE Annual_Income > 60000""",
)
def features_inner_labels(spark, sf_dir):
    rich = _fin(spark, sf_dir).where("Annual_Income > 60000")
    return lookups.labelled(
        _customer_labels(spark, sf_dir),
        rich.select("Customer_ID", "snapshot_date", "Annual_Income"),
        "inner",
    )


@query(
    "jon_dictionary_lookup",
    """SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def dictionary_lookup(spark, sf_dir):
    nation = S.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    joined = lookups.join_features([S.table(spark, sf_dir, "customer"), nation], ["c_nationkey"])
    return joined.select("c_custkey", "n_name")
