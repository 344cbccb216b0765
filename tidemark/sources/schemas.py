"""Declared schemas. Raw files are read as text; types are applied in the silver stage."""

from __future__ import annotations

from pyspark.sql import types as T


def all_strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


# fixed values: column names, and below the types, of the raw files
LOANS = all_strings(
    [
        "loan_id", "Customer_ID", "loan_start_date", "tenure", "installment_num", "loan_amt",
        "due_amt", "paid_amt", "overdue_amt", "balance", "snapshot_date",
    ]
)
ATTRIBUTES = all_strings(["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"])
FINANCIALS = all_strings(
    [
        "Customer_ID", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts",
        "Num_Credit_Card", "Interest_Rate", "Num_of_Loan", "Type_of_Loan", "Delay_from_due_date",
        "Num_of_Delayed_Payment", "Changed_Credit_Limit", "Num_Credit_Inquiries", "Credit_Mix",
        "Outstanding_Debt", "Credit_Utilization_Ratio", "Credit_History_Age",
        "Payment_of_Min_Amount", "Total_EMI_per_month", "Amount_invested_monthly",
        "Payment_Behaviour", "Monthly_Balance", "snapshot_date",
    ]
)
CLICKSTREAM = all_strings([f"fe_{i}" for i in range(1, 21)] + ["Customer_ID", "snapshot_date"])

RAW = {
    "loans": LOANS,
    "attributes": ATTRIBUTES,
    "financials": FINANCIALS,
    "clickstream": CLICKSTREAM,
}

# Money is decimal so that overdue / due is exact; see derived.installments_missed.
MONEY = T.DecimalType(18, 2)

LOAN_TYPES: dict[str, T.DataType] = {
    "loan_id": T.StringType(),
    "Customer_ID": T.StringType(),
    "loan_start_date": T.DateType(),
    "tenure": T.IntegerType(),
    "installment_num": T.IntegerType(),
    "loan_amt": MONEY,
    "due_amt": MONEY,
    "paid_amt": MONEY,
    "overdue_amt": MONEY,
    "balance": MONEY,
    "snapshot_date": T.DateType(),
}
