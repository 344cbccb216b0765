"""SQL of the surrogate panels, the twin of ``tidemark.sources.surrogates``."""

LOANS = """loans AS (
 SELECT concat(cast(l_orderkey as varchar),'_',cast(l_linenumber as varchar),'_',cast(l_partkey as varchar),'_',cast(l_suppkey as varchar)) AS loan_id,
  concat('CUS_',cast(o_custkey as varchar)) AS Customer_ID,
  cast(date_trunc('month', l_shipdate) as date) AS snapshot_date,
  cast(cast(date_trunc('month', l_shipdate) as date) - to_months(l_linenumber) as date) AS loan_start_date,
  l_linenumber AS installment_num, 10 AS tenure,
  cast(l_extendedprice as decimal(18,2)) AS due_amt,
  cast(CASE WHEN l_returnflag='R' THEN round(l_extendedprice*(l_partkey % 4),2) ELSE 0.0 END as decimal(18,2)) AS overdue_amt
 FROM lineitem JOIN orders ON l_orderkey=o_orderkey)"""

# amounts in whole cents, so that the quotient is rounded up exactly
PANEL = (
    LOANS
    + """, cents AS (
 SELECT *, cast(overdue_amt*100 as bigint) AS o, cast(due_amt*100 as bigint) AS d FROM loans),
missed AS (
 SELECT *, installment_num AS mob,
  CASE WHEN d = 0 THEN 0 ELSE cast((o + d - 1) // d as integer) END AS installments_missed FROM cents),
firsts AS (
 SELECT *, CASE WHEN installments_missed > 0 THEN cast(snapshot_date - to_months(installments_missed) as date) END AS first_missed_date FROM missed),
panel AS (
 SELECT *, CASE WHEN o > 0 THEN cast(date_diff('day', first_missed_date, snapshot_date) as integer) ELSE 0 END AS dpd FROM firsts)"""
)

_SNAPSHOT = "make_date(CASE WHEN c_custkey % 24 >= 12 THEN 2024 ELSE 2023 END, 1 + c_custkey % 12, 1) AS snapshot_date"

ATTRIBUTES = f"""attributes AS (
 SELECT concat('CUS_',cast(c_custkey as varchar)) AS Customer_ID,
  concat(c_name, CASE WHEN c_custkey % 7 = 0 THEN '"r' ELSE '' END) AS Name,
  CASE WHEN c_custkey % 17 = 0 THEN '-500' WHEN c_custkey % 13 = 0 THEN concat(cast(18 + c_custkey % 60 as varchar),'_')
       WHEN c_custkey % 29 = 0 THEN '4000' ELSE cast(18 + c_custkey % 60 as varchar) END AS Age,
  CASE WHEN c_custkey % 19 = 0 THEN '#F%$D@*&8' ELSE concat(cast(100 + c_custkey % 900 as varchar),'-',cast(10 + c_custkey % 90 as varchar),'-',cast(1000 + c_custkey % 9000 as varchar)) END AS SSN,
  CASE WHEN c_custkey % 16 = 0 THEN '_______' WHEN c_custkey % 23 = 0 THEN 'A1' ELSE c_mktsegment END AS Occupation,
  {_SNAPSHOT}
 FROM customer)"""

FINANCIALS = f"""financials AS (
 SELECT concat('CUS_',cast(c_custkey as varchar)) AS Customer_ID,
  concat(cast(cast(c_acctbal*10+20000 as decimal(18,2)) as varchar), CASE WHEN c_custkey % 11 = 0 THEN '_' ELSE '' END) AS Annual_Income,
  cast(1500 + c_custkey % 6000 as varchar) AS Monthly_Inhand_Salary,
  cast(c_custkey % 7 as varchar) AS Num_Bank_Accounts,
  CASE WHEN c_custkey % 31 = 0 THEN '-1' WHEN c_custkey % 37 = 0 THEN '1500' ELSE cast(c_custkey % 9 as varchar) END AS Num_Credit_Card,
  CASE WHEN c_custkey % 14 = 0 THEN '' ELSE cast(c_custkey % 40 - 3 as varchar) END AS Delay_from_due_date,
  CASE WHEN c_custkey % 10 = 0 THEN '_' ELSE cast(c_custkey % 25 - 2 as varchar) END AS Num_of_Delayed_Payment,
  concat(cast(c_custkey % 50 as varchar), '.', cast(c_custkey % 9 + 1 as varchar)) AS Credit_Utilization_Ratio,
  CASE WHEN c_custkey % 5 = 0 THEN '_' WHEN c_custkey % 3 = 0 THEN 'Good' WHEN c_custkey % 3 = 1 THEN 'Standard' ELSE 'Bad' END AS Credit_Mix,
  CASE WHEN c_custkey % 12 = 0 THEN '!@9#%8' ELSE 'Low_spent_Small_value_payments' END AS Payment_Behaviour,
  cast(cast(abs(c_acctbal) as decimal(18,2)) as varchar) AS Outstanding_Debt,
  CASE WHEN c_custkey % 41 = 0 THEN '--5' ELSE cast(c_custkey % 450 as varchar) END AS Total_EMI_per_month,
  {_SNAPSHOT}
 FROM customer)"""


def scrubbed(column: str) -> str:
    return f"round(try_cast(nullif(regexp_replace({column},'[^0-9.-]','','g'),'') as double),2)"


_FINANCIAL_NUMBERS = [
    "Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
]

SILVER_FINANCIALS = (
    FINANCIALS
    + ", scrub AS (SELECT Customer_ID, snapshot_date, Credit_Mix, Payment_Behaviour, "
    + ", ".join(
        f"{scrubbed(c)} AS {c}"
        for c in [
            *_FINANCIAL_NUMBERS, "Num_Bank_Accounts", "Num_Credit_Card", "Delay_from_due_date",
            "Num_of_Delayed_Payment",
        ]
    )
    + """ FROM financials),
silver_fin AS (SELECT Customer_ID, snapshot_date, """
    + ", ".join(_FINANCIAL_NUMBERS)
    + """,
  CASE WHEN Num_Bank_Accounts BETWEEN 0 AND 100 THEN Num_Bank_Accounts END AS Num_Bank_Accounts,
  CASE WHEN Num_Credit_Card BETWEEN 0 AND 100 THEN Num_Credit_Card END AS Num_Credit_Card,
  CASE WHEN Delay_from_due_date >= 0 THEN Delay_from_due_date END AS Delay_from_due_date,
  CASE WHEN Num_of_Delayed_Payment >= 0 THEN Num_of_Delayed_Payment END AS Num_of_Delayed_Payment,
  nullif(Credit_Mix, '_') AS Credit_Mix, nullif(Payment_Behaviour, '!@9#%8') AS Payment_Behaviour
 FROM scrub)"""
)

SILVER_ATTRIBUTES = (
    ATTRIBUTES
    + r""", silver_att AS (SELECT Customer_ID, snapshot_date,
  regexp_replace(Name,'[^a-zA-Z\s]','','g') AS Name,
  CASE WHEN regexp_full_match(Age,'\d+') AND try_cast(Age as integer) BETWEEN 0 AND 100 THEN try_cast(Age as integer) END AS Age,
  CASE WHEN regexp_full_match(SSN,'\d{3}-\d{2}-\d{4}') THEN SSN ELSE 'NA' END AS SSN,
  CASE WHEN regexp_full_match(Occupation,'[a-zA-Z_]+') THEN Occupation ELSE 'NA' END AS Occupation
 FROM attributes)"""
)

CLICKSTREAM = """clickstream AS (
 SELECT concat('CUS_',cast(user_id as varchar)) AS Customer_ID, cast(date_trunc('week', ts) as date) AS snapshot_date,
  count(*) FILTER (event_type='click') AS fe_1, count(*) FILTER (event_type='view') AS fe_2,
  count(*) FILTER (event_type='purchase') AS fe_3 FROM events GROUP BY ALL)"""

CUSTOMER_CLICKS = f"""clicks AS (
 SELECT concat('CUS_',cast(user_id as varchar)) AS Customer_ID,
  {_SNAPSHOT.replace("c_custkey", "user_id")},
  count(*) FILTER (event_type='click') AS fe_1, count(*) FILTER (event_type='view') AS fe_2,
  count(*) FILTER (event_type='purchase') AS fe_3 FROM events GROUP BY user_id)"""

SCORES = """scores AS (
 SELECT l.doc_id AS Customer_ID, l.quality AS label, cast(d.n_chars % 1000 as double)/1000 AS score,
  CASE WHEN l.doc_id % 5 = 0 THEN 'OOT2' WHEN l.doc_id % 5 = 1 THEN 'OOT1' ELSE 'Training' END AS dataset
 FROM labels l JOIN documents d ON l.doc_id=d.doc_id)"""

DECIDED = SCORES + ", decided AS (SELECT *, CASE WHEN score >= 0.7 THEN 1 ELSE 0 END AS prediction FROM scores)"
