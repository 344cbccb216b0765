"""Casts, projections and cleaning rules."""

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog import views as V
from tidemark.functions import cleaning as C
from tidemark.operators import clean, project
from tidemark.sources import schemas
from tidemark.sources import surrogates as S


@query(
    "prj_fixed_columns",
    f"WITH {V.PANEL} SELECT loan_id, Customer_ID, installment_num, overdue_amt::double AS overdue_amt, snapshot_date FROM panel",
)
def fixed_columns(spark, sf_dir):
    return S.loans(spark, sf_dir).select(
        "loan_id",
        "Customer_ID",
        "installment_num",
        F.col("overdue_amt").cast("double").alias("overdue_amt"),
        "snapshot_date",
    )


@query(
    "prj_by_prefix",
    f"WITH {V.CLICKSTREAM} SELECT fe_1, fe_2, fe_3 FROM clickstream",
)
def by_prefix(spark, sf_dir):
    clicks = S.clickstream(spark, sf_dir)
    return clicks.select(project.by_prefix(clicks))


@query(
    "prj_by_exclusion",
    f"WITH {V.SCORES} SELECT score, dataset FROM scores",
)
def by_exclusion(spark, sf_dir):
    scores = S.scores(spark, sf_dir)
    return scores.select(project.feature_columns(scores))


@query(
    "prj_common_numeric",
    f"WITH {V.SILVER_FINANCIALS} SELECT Annual_Income, Credit_Utilization_Ratio, Monthly_Inhand_Salary, Outstanding_Debt, Total_EMI_per_month FROM silver_fin",
)
def common_numeric(spark, sf_dir):
    current = clean.silver_financials(S.financials(spark, sf_dir))
    reference = current.select(
        "Customer_ID", "Credit_Mix", "Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt",
        "Credit_Utilization_Ratio", "Total_EMI_per_month",
    )
    return current.select(project.common_numeric(reference, current))


@query(
    "prj_enforce_schema",
    f"""WITH {V.ATTRIBUTES} SELECT Customer_ID, try_cast(Age as integer) AS Age, snapshot_date FROM attributes""",
)
def enforce_schema(spark, sf_dir):
    types = {"Age": schemas.T.IntegerType(), "snapshot_date": schemas.T.DateType()}
    raw = S.attributes(spark, sf_dir).select("Customer_ID", "Age", "snapshot_date")
    return project.enforce_schema(raw, types)


@query(
    "prj_enforce_loan_types",
    f"""WITH {V.LOANS} SELECT loan_id, Customer_ID, loan_start_date, tenure, installment_num,
 due_amt::double AS due_amt, overdue_amt::double AS overdue_amt, snapshot_date FROM loans""",
)
def enforce_loan_types(spark, sf_dir):
    """Loans as text, the way raw files hold them, back to declared types."""
    loans = S.loans(spark, sf_dir)
    text = loans.select([F.col(c).cast("string").alias(c) for c in loans.columns])
    typed = clean.silver_loans(text)
    return typed.withColumns({c: F.col(c).cast("double") for c in ["due_amt", "overdue_amt"]})


@query(
    "prj_align_features",
    f"WITH {V.CLICKSTREAM} SELECT Customer_ID, snapshot_date, fe_2, 0 AS fe_9, fe_1 FROM clickstream",
)
def align_features(spark, sf_dir):
    return project.align_features(
        S.clickstream(spark, sf_dir), ["fe_2", "fe_9", "fe_1"], ["Customer_ID", "snapshot_date"]
    )


@query(
    "prj_lineage_columns",
    f"""WITH {V.PANEL} SELECT loan_id, snapshot_date, '30dpd_6mob' AS label_def, 'credit_model_1999_09_01' AS model_version, CAST(0.7 AS DOUBLE) AS threshold_used FROM panel""",
)
def lineage_columns(spark, sf_dir):
    loans = S.loans(spark, sf_dir).select("loan_id", "snapshot_date")
    return project.with_lineage(
        loans,
        label_def="30dpd_6mob",
        model_version="credit_model_1999_09_01",
        threshold_used=0.7,
    )


@query(
    "cln_name_letters",
    f"WITH {V.SILVER_ATTRIBUTES} SELECT Customer_ID, Name FROM silver_att",
)
def name_letters(spark, sf_dir):
    return S.attributes(spark, sf_dir).select(
        "Customer_ID", C.letters_only(F.col("Name")).alias("Name")
    )


@query(
    "cln_age_valid",
    f"WITH {V.SILVER_ATTRIBUTES} SELECT Customer_ID, Age FROM silver_att",
)
def age_valid(spark, sf_dir):
    return S.attributes(spark, sf_dir).select("Customer_ID", C.valid_age(F.col("Age")).alias("Age"))


@query(
    "cln_ssn_pattern",
    f"WITH {V.SILVER_ATTRIBUTES} SELECT Customer_ID, SSN FROM silver_att",
)
def ssn_pattern(spark, sf_dir):
    return S.attributes(spark, sf_dir).select("Customer_ID", C.valid_ssn(F.col("SSN")).alias("SSN"))


@query(
    "cln_occupation_pattern",
    f"WITH {V.SILVER_ATTRIBUTES} SELECT Customer_ID, Occupation FROM silver_att",
)
def occupation_pattern(spark, sf_dir):
    return S.attributes(spark, sf_dir).select(
        "Customer_ID", C.valid_occupation(F.col("Occupation")).alias("Occupation")
    )


@query(
    "cln_silver_attributes",
    f"WITH {V.SILVER_ATTRIBUTES} SELECT * FROM silver_att",
)
def silver_attributes(spark, sf_dir):
    return clean.silver_attributes(S.attributes(spark, sf_dir))


@query(
    "cln_scrub_numbers",
    f"""WITH {V.FINANCIALS} SELECT Customer_ID, {V.scrubbed('Annual_Income')} AS Annual_Income,
 {V.scrubbed('Total_EMI_per_month')} AS Total_EMI_per_month, {V.scrubbed('Delay_from_due_date')} AS Delay_from_due_date FROM financials""",
)
def scrub_numbers(spark, sf_dir):
    columns = ["Annual_Income", "Total_EMI_per_month", "Delay_from_due_date"]
    return S.financials(spark, sf_dir).select(
        "Customer_ID", *[C.scrub_number(F.col(c)).alias(c) for c in columns]
    )


@query(
    "cln_range_or_null",
    f"""WITH {V.SILVER_FINANCIALS} SELECT Customer_ID, Num_Bank_Accounts, Num_Credit_Card FROM silver_fin""",
)
def range_or_null(spark, sf_dir):
    return S.financials(spark, sf_dir).select(
        "Customer_ID",
        *[clean.financial_number(c).alias(c) for c in ["Num_Bank_Accounts", "Num_Credit_Card"]],
    )


@query(
    "cln_non_negative",
    f"""WITH {V.SILVER_FINANCIALS} SELECT Customer_ID, Delay_from_due_date, Num_of_Delayed_Payment FROM silver_fin""",
)
def non_negative(spark, sf_dir):
    columns = ["Delay_from_due_date", "Num_of_Delayed_Payment"]
    return S.financials(spark, sf_dir).select(
        "Customer_ID", *[clean.financial_number(c).alias(c) for c in columns]
    )


@query(
    "cln_sentinel_to_null",
    f"""WITH {V.SILVER_FINANCIALS} SELECT Customer_ID, Credit_Mix, Payment_Behaviour FROM silver_fin""",
)
def sentinel_to_null(spark, sf_dir):
    return clean.silver_financials(S.financials(spark, sf_dir)).select(
        "Customer_ID", "Credit_Mix", "Payment_Behaviour"
    )


@query(
    "cln_silver_financials",
    f"WITH {V.SILVER_FINANCIALS} SELECT * FROM silver_fin",
)
def silver_financials(spark, sf_dir):
    return clean.silver_financials(S.financials(spark, sf_dir))


# fixed values: the markers of missing values
_MASKS = (
    "'#F%$D@*&8','_______','___','NULL','null','N/A','n/a','',' ','?','-','Unknown','unknown'"
)


@query(
    "cln_unmask_missing",
    f"""WITH {V.ATTRIBUTES} SELECT Customer_ID, snapshot_date, Name,
 try_cast(replace(Age,'_','') as double) AS Age,
 CASE WHEN SSN NOT IN ({_MASKS}) THEN SSN END AS SSN,
 CASE WHEN Occupation NOT IN ({_MASKS}) THEN Occupation END AS Occupation FROM attributes""",
)
def unmask_missing(spark, sf_dir):
    return clean.unmask_missing(S.attributes(spark, sf_dir))


@query(
    "cln_age_repair",
    f"WITH {V.ATTRIBUTES} SELECT Customer_ID, try_cast(replace(Age,'_','') as double) AS Age FROM attributes",
)
def age_repair(spark, sf_dir):
    return S.attributes(spark, sf_dir).select(
        "Customer_ID", C.repaired_age(F.col("Age")).alias("Age")
    )


@query(
    "cln_age_window",
    f"""WITH {V.ATTRIBUTES}, a AS (SELECT Customer_ID, try_cast(replace(Age,'_','') as double) AS Age FROM attributes)
 SELECT Customer_ID, CASE WHEN Age BETWEEN 18 AND 120 THEN Age END AS Age FROM a""",
)
def age_window(spark, sf_dir):
    ages = S.attributes(spark, sf_dir).select(
        "Customer_ID", C.repaired_age(F.col("Age")).alias("Age")
    )
    return clean.unmask_missing(ages)


@query(
    "cln_constant_fill",
    f"""WITH {V.SILVER_FINANCIALS} SELECT Customer_ID, coalesce(Num_Credit_Card, 0) AS Num_Credit_Card,
 coalesce(Total_EMI_per_month, 0) AS Total_EMI_per_month, coalesce(Credit_Mix, 'Unknown') AS Credit_Mix FROM silver_fin""",
)
def constant_fill(spark, sf_dir):
    silver = clean.silver_financials(S.financials(spark, sf_dir)).select(
        "Customer_ID", "Num_Credit_Card", "Total_EMI_per_month", "Credit_Mix"
    )
    return clean.fill_constant(silver, numeric=0, columns={"Credit_Mix": "Unknown"})


@query(
    "cln_distinct_rows",
    f"""WITH {V.LOANS} SELECT DISTINCT Customer_ID, snapshot_date, installment_num FROM loans""",
)
def distinct_rows(spark, sf_dir):
    return clean.without_duplicates(
        S.loans(spark, sf_dir).select("Customer_ID", "snapshot_date", "installment_num")
    )
