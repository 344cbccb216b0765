"""Gold feature stores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import derived as D
from tidemark.operators.clean import fill_constant, without_duplicates
from tidemark.operators.lookups import join_features, with_codes
from tidemark.operators.project import by_prefix
from tidemark.settings import CREDIT_MIX_CODES, GOLD_FEATURES, KEYS


def derived_features() -> dict[str, Column]:
    """Formulas of every derived feature, by output name."""
    return {
        "Debt_to_Income_Ratio": D.ratio(F.col("Outstanding_Debt"), F.col("Annual_Income")),
        "EMI_Burden_Ratio": D.ratio(
            F.col("Total_EMI_per_month"), F.col("Monthly_Inhand_Salary")
        ),
        "Credit_Utilization_Trend": D.utilisation_trend(F.col("Credit_Utilization_Ratio")),
        "Delinquency_Score": D.delinquency_score(
            F.col("Num_of_Delayed_Payment"), F.col("Delay_from_due_date")
        ),
        "Credit_Mix_encoded": D.ordinal(F.col("Credit_Mix"), CREDIT_MIX_CODES),
    }


def feature_store(
    financials: DataFrame, attributes: DataFrame | None = None, features=tuple(GOLD_FEATURES)
) -> DataFrame:
    """Panel key plus the chosen features; financials decide the rows.

    Attributes are joined only where a wanted feature comes from them: a left join on a unique key
    that adds no column adds nothing.
    """
    plain = [f for f in features if f not in derived_features()]
    tables = [financials]
    if attributes is not None and not set(plain) <= set(financials.columns):
        tables.append(attributes)
    return choose_features(join_features(tables), features)


def choose_features(joined: DataFrame, features=tuple(GOLD_FEATURES)) -> DataFrame:
    """Panel key plus the chosen features of rows that are joined already."""
    derived = derived_features()
    return joined.select(
        *KEYS, *[derived[f].alias(f) if f in derived else F.col(f) for f in features]
    )


def customer_table(
    clickstream: DataFrame,
    tables: Sequence[DataFrame],
    codes: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Wide table led by the clickstream: copies removed, gaps filled, tables joined, codes added.

    Numeric gaps become 0 and a missing occupation ``Unknown``; ``fe_sum`` adds up the clickstream
    columns. ``Occupation_code`` is the code that the dictionary gives an occupation which ``codes`` returns for
    the table's rows; without ``codes`` it numbers the occupations in sorted order.
    """
    joined = join_features([without_duplicates(clickstream), *tables])
    texts = {"Occupation": "Unknown"} if "Occupation" in joined.columns else None
    filled = with_row_sum(fill_constant(joined, 0, texts))
    if not texts:
        return filled
    dictionary = codes(filled) if codes else None
    return with_codes(filled, "Occupation", "Occupation_code", -1, dictionary)


def with_row_sum(df: DataFrame, prefix: str = "fe_", name: str = "fe_sum") -> DataFrame:
    """Add the sum of the prefixed columns where the first two of them exist."""
    columns = by_prefix(df, prefix)
    if not {f"{prefix}1", f"{prefix}2"} <= set(columns):
        return df
    return df.withColumn(name, D.row_sum(columns))
