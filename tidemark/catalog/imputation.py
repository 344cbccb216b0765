"""Imputation: fitted fills, chained equations, neighbours."""

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog import views as V
from tidemark.operators import clean, impute, profile
from tidemark.session import shared_folder
from tidemark.settings import ImputeRule
from tidemark.sources import surrogates as S

_KEY = "Customer_ID"
_RULE = ImputeRule(
    per_feature={
        "Annual_Income": "mean",
        "Num_Credit_Card": "median",
        "Delay_from_due_date": "most_frequent",
        "Total_EMI_per_month": "constant",
    }
)
_FILLED = [
    "Annual_Income", "Num_Credit_Card", "Delay_from_due_date", "Total_EMI_per_month",
    "Num_of_Delayed_Payment", "Credit_Mix",
]


def _frame(spark, sf_dir):
    """Silver financials with a gappy income and a mostly empty column."""
    silver = clean.silver_financials(S.financials(spark, sf_dir))
    return silver.select(
        _KEY,
        F.when(F.col("Monthly_Inhand_Salary") % 8 != 0, F.col("Annual_Income")).alias("Annual_Income"),
        *_FILLED[1:],
        "Monthly_Inhand_Salary",
        "Outstanding_Debt",
        F.when(F.col("Num_Bank_Accounts") == 1, F.col("Outstanding_Debt")).alias("Sparse"),
    )


_FRAME = (
    V.SILVER_FINANCIALS
    + """, f AS (SELECT Customer_ID, CASE WHEN Monthly_Inhand_Salary % 8 <> 0 THEN Annual_Income END AS Annual_Income, Num_Credit_Card, Delay_from_due_date,
 Total_EMI_per_month, Num_of_Delayed_Payment, Credit_Mix, Monthly_Inhand_Salary, Outstanding_Debt,
 CASE WHEN Num_Bank_Accounts = 1 THEN Outstanding_Debt END AS Sparse FROM silver_fin)"""
)


def _mode(c):
    return f"(SELECT {c} FROM f WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


_FILLS = f"""round(coalesce(Annual_Income, (SELECT avg(Annual_Income) FROM f)), 6) AS Annual_Income,
 coalesce(Num_Credit_Card, (SELECT median(Num_Credit_Card) FROM f)) AS Num_Credit_Card,
 coalesce(Delay_from_due_date, {_mode('Delay_from_due_date')}) AS Delay_from_due_date,
 coalesce(Total_EMI_per_month, 0.0) AS Total_EMI_per_month,
 coalesce(Num_of_Delayed_Payment, (SELECT median(Num_of_Delayed_Payment) FROM f)) AS Num_of_Delayed_Payment,
 coalesce(Credit_Mix, {_mode('Credit_Mix')}) AS Credit_Mix"""


@query("imp_simple_fills", f"WITH {_FRAME} SELECT Customer_ID, {_FILLS} FROM f")
def simple_fills(spark, sf_dir):
    frame = _frame(spark, sf_dir)
    filled = impute.fit_imputer(frame, _RULE, _FILLED).transform(frame)
    return filled.select(_KEY, *_FILLED).withColumn("Annual_Income", F.round("Annual_Income", 6))


@query(
    "imp_drop_sparse",
    f"WITH {_FRAME} SELECT Customer_ID, Outstanding_Debt, coalesce(Num_Credit_Card, (SELECT median(Num_Credit_Card) FROM f)) AS Num_Credit_Card FROM f",
)
def drop_sparse(spark, sf_dir):
    frame = _frame(spark, sf_dir).select(_KEY, "Outstanding_Debt", "Num_Credit_Card", "Sparse")
    return impute.fit_imputer(frame, _RULE).transform(frame)


@query(
    "imp_keep_sparse",
    f"WITH {_FRAME} SELECT Customer_ID, Outstanding_Debt, coalesce(Sparse, 0.0) AS Sparse FROM f",
)
def keep_sparse(spark, sf_dir):
    frame = _frame(spark, sf_dir).select(_KEY, "Outstanding_Debt", "Sparse")
    return impute.fit_imputer(frame, ImputeRule(keep_sparse=True)).transform(frame)


@query(
    "imp_strategies",
    f"""WITH {_FRAME}, s AS ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) < count(*) AS gaps, count({c})*2 < count(*) AS sparse, '{s}' AS rule FROM f"
        for c, s in [
            ("Annual_Income", "mean"), ("Num_Credit_Card", "median"),
            ("Delay_from_due_date", "most_frequent"), ("Total_EMI_per_month", "constant"),
            ("Num_of_Delayed_Payment", "median"), ("Credit_Mix", "most_frequent"),
            ("Monthly_Inhand_Salary", "median"), ("Outstanding_Debt", "median"),
            ("Sparse", "median"), ("Customer_ID", "most_frequent"),
        ]
    )
    + ") SELECT feature, CASE WHEN gaps AND NOT sparse THEN rule END AS strategy, sparse AS dropped FROM s",
)
def strategies(spark, sf_dir):
    fitted = impute.fit_imputer(_frame(spark, sf_dir), _RULE)
    return fitted.to_frame(spark).select("feature", "strategy", "dropped")


@query(
    "imp_statistics",
    f"WITH {_FRAME} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round((count(*) - count({c}))*100.0::double/count(*), 6) AS missing_percentage,
 round(avg({c}), 6) AS mean, round(median({c}), 6) AS median, round(stddev_samp({c}), 6) AS std FROM f"""
        for c in ["Annual_Income", "Num_Credit_Card", "Delay_from_due_date", "Total_EMI_per_month"]
    ),
)
def statistics(spark, sf_dir):
    """The fitted imputer, saved and read back."""
    path = f"{shared_folder(spark)}/imputers/{spark.sql('SELECT uuid()').first()[0]}"
    impute.save_imputer(impute.fit_imputer(_frame(spark, sf_dir), _RULE, _FILLED[:4]), spark, path)
    stats = impute.read_imputer(spark, path).to_frame(spark).select("feature", "missing_percentage", "mean", "median", "std")
    return stats.withColumns({c: F.round(c, 6) for c in stats.columns[1:]})


@query(
    "imp_summary",
    f"""WITH {_FRAME} SELECT strategy, count(*) AS features FROM (
 SELECT 'mean' AS strategy, count(Annual_Income) < count(*) AS gaps FROM f UNION ALL
 SELECT 'median', count(Num_Credit_Card) < count(*) FROM f UNION ALL
 SELECT 'most_frequent', count(Delay_from_due_date) < count(*) FROM f UNION ALL
 SELECT 'constant', count(Total_EMI_per_month) < count(*) FROM f UNION ALL
 SELECT 'median', count(Num_of_Delayed_Payment) < count(*) FROM f UNION ALL
 SELECT 'most_frequent', count(Credit_Mix) < count(*) FROM f) WHERE gaps GROUP BY strategy""",
)
def summary(spark, sf_dir):
    return impute.fit_imputer(_frame(spark, sf_dir), _RULE, _FILLED).summary(spark)


@query(
    "imp_final_fill",
    f"""WITH {_FRAME}, t AS (SELECT * FROM f WHERE Num_Credit_Card IS NOT NULL AND Credit_Mix IS NOT NULL)
 SELECT Customer_ID, coalesce(Num_Credit_Card, (SELECT median(Num_Credit_Card) FROM t)) AS Num_Credit_Card,
 coalesce(Credit_Mix, (SELECT Credit_Mix FROM t GROUP BY Credit_Mix ORDER BY count(*) DESC, Credit_Mix LIMIT 1)) AS Credit_Mix FROM f""",
)
def final_fill(spark, sf_dir):
    """Columns complete at fit time but not at scoring time take the stored median or mode."""
    frame = _frame(spark, sf_dir).select(_KEY, "Num_Credit_Card", "Credit_Mix")
    fitted = impute.fit_imputer(frame.na.drop(), _RULE, ["Num_Credit_Card", "Credit_Mix"])
    return fitted.transform(frame)


@query(
    "imp_batch_fallback",
    f"""WITH {_FRAME} SELECT Customer_ID, coalesce(Num_Credit_Card, (SELECT median(Num_Credit_Card) FROM f)) AS Num_Credit_Card,
 coalesce(Delay_from_due_date, (SELECT median(Delay_from_due_date) FROM f)) AS Delay_from_due_date,
 coalesce(Credit_Mix, {_mode('Credit_Mix')}) AS Credit_Mix FROM f""",
)
def batch_fallback(spark, sf_dir):
    columns = ["Num_Credit_Card", "Delay_from_due_date", "Credit_Mix"]
    return impute.fill_from_batch(_frame(spark, sf_dir).select(_KEY, *columns), columns)


@query(
    "qlt_remaining_missing",
    f"""WITH {_FRAME} SELECT 'before' AS stage, count(*) - count(Annual_Income) + count(*) - count(Num_Credit_Card) AS missing_values FROM f
 UNION ALL SELECT 'one column filled', count(*) - count(Num_Credit_Card) FROM f UNION ALL SELECT 'all filled', 0""",
)
def remaining_missing(spark, sf_dir):
    """Missing cells of two columns before, with one column and with both imputed."""
    columns = ["Annual_Income", "Num_Credit_Card"]
    frame = _frame(spark, sf_dir).select(_KEY, *columns)
    stages = {"before": frame}
    for name, fitted in (("one column filled", columns[:1]), ("all filled", columns)):
        stages[name] = impute.fit_imputer(frame, _RULE, fitted).transform(frame)
    counts = {name: profile.remaining_missing(df) for name, df in stages.items()}
    return profile.tagged_union(counts, "stage").select("stage", "missing_values")


_CHAINED = [
    "Annual_Income", "Num_Credit_Card", "Delay_from_due_date", "Total_EMI_per_month", "Num_of_Delayed_Payment",
    "Monthly_Inhand_Salary", "Outstanding_Debt",
]


@query(
    "imp_chained_equations",
    f"WITH {_FRAME} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS filled, CAST(0 AS BIGINT) AS changed FROM f" for c in _CHAINED
    ),
)
def chained_equations(spark, sf_dir):
    """All columns from each other: values filled, and observed values that changed (none may)."""
    frame = _frame(spark, sf_dir).select(_KEY, *_CHAINED)
    rule = ImputeRule(per_feature={c: "iterative" for c in _CHAINED})
    filled = impute.fit_imputer(frame, rule, _CHAINED).transform(frame)
    both = frame.join(filled.withColumnsRenamed({c: f"new_{c}" for c in _CHAINED}), _KEY)
    parts = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count_if(F.col(c).isNull() & F.col(f"new_{c}").isNotNull()).alias("filled"),
            F.count_if(F.col(c).isNotNull() & (F.coalesce(F.col(c) != F.col(f"new_{c}"), F.lit(True)))).alias("changed"),
        )
        for c in _CHAINED
    ]
    return both.agg(F.array(*parts).alias("all")).select(F.inline("all"))


@query(
    "imp_chained_regression",
    f"""WITH {_FRAME}, r AS (SELECT regr_slope(Annual_Income, Outstanding_Debt) AS a, regr_intercept(Annual_Income, Outstanding_Debt) AS b FROM f)
 SELECT Customer_ID, round(coalesce(Annual_Income, b + a*Outstanding_Debt), 2) AS Annual_Income FROM f, r""",
)
def chained_regression(spark, sf_dir):
    """One gappy column and one predictor: the chain is a plain regression."""
    columns = ["Annual_Income", "Outstanding_Debt"]
    frame = _frame(spark, sf_dir).select(_KEY, *columns)
    rule = ImputeRule(per_feature={"Annual_Income": "iterative"})
    filled = impute.fit_imputer(frame, rule, columns).transform(frame)
    return filled.select(_KEY, F.round("Annual_Income", 2).alias("Annual_Income"))


_KNN = ["Num_Credit_Card", "Delay_from_due_date", "Num_of_Delayed_Payment", "Monthly_Inhand_Salary"]


@query(
    "imp_nearest_neighbours",
    f"""WITH {_FRAME}, d AS (SELECT Delay_from_due_date AS a, Num_of_Delayed_Payment AS b, Monthly_Inhand_Salary AS c, avg(Num_Credit_Card) AS y, count(*) AS n
  FROM f WHERE Num_Credit_Card IS NOT NULL GROUP BY ALL),
 r AS (SELECT Customer_ID, Delay_from_due_date AS a, Num_of_Delayed_Payment AS b, Monthly_Inhand_Salary AS c FROM f WHERE Num_Credit_Card IS NULL),
 p AS (SELECT Customer_ID, y, n, coalesce(power(r.a-d.a,2),0) + coalesce(power(r.b-d.b,2),0) + coalesce(power(r.c-d.c,2),0) AS s,
   (r.a-d.a IS NOT NULL)::int + (r.b-d.b IS NOT NULL)::int + (r.c-d.c IS NOT NULL)::int AS m FROM r, d),
 o AS (SELECT Customer_ID, y, n, sum(n) OVER (PARTITION BY Customer_ID ORDER BY sqrt(s*4/m), y ROWS UNBOUNDED PRECEDING) - n AS before FROM p WHERE m > 0),
 k AS (SELECT Customer_ID, sum(least(n, 5 - before)*y)/5 AS v FROM o WHERE before < 5 GROUP BY Customer_ID)
 SELECT f.Customer_ID, round(coalesce(Num_Credit_Card, v), 6) AS Num_Credit_Card FROM f LEFT JOIN k USING (Customer_ID)""",
)
def nearest_neighbours(spark, sf_dir):
    frame = _frame(spark, sf_dir).select(_KEY, *_KNN)
    rule = ImputeRule(per_feature={"Num_Credit_Card": "knn"})
    filled = impute.fit_imputer(frame, rule, _KNN).transform(frame)
    return filled.select(_KEY, F.round("Num_Credit_Card", 6).alias("Num_Credit_Card"))
