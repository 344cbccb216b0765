"""Loan performance, label stores and vintage curves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import derived as D
from tidemark.settings import LabelRule

LABEL_COLUMNS = ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]


def loan_daily(loans: DataFrame, exact: bool = True) -> DataFrame:
    """Months on book, installments missed, first missed date and days past due of each row.

    ``exact=False`` computes on single-precision amounts.
    """
    money = "decimal(18,2)" if exact else "float"
    overdue, due = F.col("overdue_amt").cast(money), F.col("due_amt").cast(money)
    panel = loans.na.fill(0).withColumns(
        {
            "mob": F.col("installment_num").cast("int"),
            "installments_missed": D.installments_missed(overdue, due),
        }
    )
    panel = panel.withColumn(
        "first_missed_date",
        D.first_missed_date(F.col("snapshot_date"), F.col("installments_missed")),
    )
    return panel.withColumn(
        "dpd",
        D.days_past_due(
            F.col("overdue_amt"), F.col("snapshot_date"), F.col("first_missed_date")
        ).cast("int"),
    )


def loan_daily_by_start(loans: DataFrame) -> DataFrame:
    """The alternative clock: months and days counted from the loan start date."""
    return loans.withColumns(
        {
            "mob": D.months_on_book(F.col("snapshot_date"), F.col("loan_start_date")),
            "dpd": D.days_past_due_by_start(
                F.col("overdue_amt"),
                F.col("snapshot_date"),
                F.col("loan_start_date"),
                F.col("installment_num"),
            ),
        }
    )


def label_store(panel: DataFrame, rule: LabelRule = LabelRule()) -> DataFrame:
    """Default label of every loan at the rule's months on book."""
    return (
        panel.where(F.col("mob") == rule.mob)
        .withColumns(
            {
                "label": D.flag_at_least(F.col("dpd"), rule.dpd),
                "label_def": F.lit(rule.name),
            }
        )
        .select(*LABEL_COLUMNS)
    )


def labels_at(loans: DataFrame, rule: LabelRule = LabelRule()) -> DataFrame:
    """Label store straight from loans, reading only rows at the rule's months on book.

    Filling nulls with 0 hides the installment number from the scan, so the filter goes first; a
    filled null can only ever match month 0.
    """
    if rule.mob != 0:
        loans = loans.where(F.col("installment_num") == rule.mob)
    return label_store(loan_daily(loans), rule)


def completed_loans(panel: DataFrame, started_before) -> DataFrame:
    return panel.where(F.col("loan_start_date") < F.lit(started_before).cast("date"))


def final_installments(panel: DataFrame, installment: int = 10) -> DataFrame:
    return panel.where(F.col("installment_num") == installment)


def bad_rate_curve(panel: DataFrame, dpd: int = 30) -> DataFrame:
    """Share of rows at least ``dpd`` days past due, by months on book."""
    return (
        panel.select("mob", D.flag_at_least(F.col("dpd"), dpd).alias("dpd_flag"))
        .groupBy("mob")
        .agg(F.avg("dpd_flag").alias("bad_rate"), F.count(F.lit(1)).alias("loans"))
        .orderBy("mob")
    )
