"""Silver-stage cleaning: one projection per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.functions import cleaning as C
from tidemark.operators.project import (
    enforce_schema,
    numeric_columns,
    replace_columns,
    string_columns,
)
from tidemark.sources import schemas


def silver_loans(raw: DataFrame, types=schemas.LOAN_TYPES) -> DataFrame:
    return enforce_schema(raw, types)


def silver_attributes(raw: DataFrame) -> DataFrame:
    return replace_columns(
        raw,
        {
            "Name": C.letters_only(F.col("Name")),
            "Age": C.valid_age(F.col("Age")),
            "SSN": C.valid_ssn(F.col("SSN")),
            "Occupation": C.valid_occupation(F.col("Occupation")),
            "snapshot_date": F.col("snapshot_date").try_cast("date"),
        },
    )


def financial_number(name: str):
    """The whole cleaning rule of one financial column as a single expression."""
    value = C.scrub_number(F.col(name))
    if name in S.FINANCIAL_0_TO_100:
        value = C.within(value, 0, 100)
    if name in S.FINANCIAL_NON_NEGATIVE:
        value = C.non_negative(value)
    return value


def silver_financials(raw: DataFrame) -> DataFrame:
    new = {name: financial_number(name) for name in S.FINANCIAL_NUMERIC}
    new["Credit_Mix"] = C.unless_equal(F.col("Credit_Mix"), S.CREDIT_MIX_MASK)
    new["Payment_Behaviour"] = C.unless_equal(
        F.col("Payment_Behaviour"), S.PAYMENT_BEHAVIOUR_MASK
    )
    new["snapshot_date"] = F.col("snapshot_date").try_cast("date")
    return replace_columns(raw, new)


def silver_clickstream(raw: DataFrame) -> DataFrame:
    new = {
        "Customer_ID": F.col("Customer_ID").cast("string"),
        "snapshot_date": F.col("snapshot_date").try_cast("date"),
    }
    # counters read as text become numbers; typed input is left alone
    texts = string_columns(raw)
    new.update(
        {c: F.col(c).try_cast("double") for c in texts if c.startswith("fe_")}
    )
    return replace_columns(raw, new)


SILVER = {
    "loans": silver_loans,
    "attributes": silver_attributes,
    "financials": silver_financials,
    "clickstream": silver_clickstream,
}


def unmask_missing(df: DataFrame, masks: Sequence[str] = tuple(S.MASKED_VALUES)) -> DataFrame:
    """Turn disguised missing values into nulls ahead of imputation.

    Text columns lose whole-value masks, a text Age becomes a number, and numeric columns lose
    impossible values. A text Age is repaired but not range-checked in the same pass.
    """
    new = {c: C.unmask(F.col(c), masks) for c in string_columns(df)}
    if "Age" in new:
        new["Age"] = C.repaired_age(new["Age"])
    for c in numeric_columns(df):
        value = F.col(c)
        if c in S.IMPUTER_NON_NEGATIVE:
            value = C.non_negative(value)
        if c == "Age":
            value = C.plausible_age(value)
        if c in S.IMPUTER_NON_NEGATIVE:
            new[c] = value
    return replace_columns(df, new)


def fill_constant(df: DataFrame, numeric=None, columns: Mapping[str, object] | None = None):
    """Replace nulls by a constant in every numeric column and/or in the named columns."""
    if numeric is not None:
        df = df.na.fill(numeric)
    if columns:
        df = df.na.fill(dict(columns))
    return df


def without_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row duplicates removed; partial aggregation collapses hot copies before the shuffle."""
    return df.dropDuplicates()
