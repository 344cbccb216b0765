"""Column -> Column feature, date and label formulas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- loan performance ----------------------------------------------------------


def months_on_book(snapshot: Column, start: Column) -> Column:
    """Whole months between two dates, truncated towards zero."""
    return F.months_between(snapshot, start).cast("int")


def installments_missed(overdue: Column, due: Column) -> Column:
    """Installments covered by the overdue amount, rounded up; 0 when due is 0 or unknown.

    Give decimals: single-precision amounts can push the quotient just over an integer and
    with it the first missed date back by a month.
    """
    return F.coalesce(F.ceil(F.try_divide(overdue, due)).cast("int"), F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(overdue: Column, snapshot: Column, first_missed: Column) -> Column:
    """Days since the first missed installment; null when money is overdue but none is due."""
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))


def days_past_due_by_start(
    overdue: Column, snapshot: Column, start: Column, installment: Column
) -> Column:
    """Alternative clock: days since start less 30 for every installment fallen due."""
    late = F.datediff(snapshot, start) - installment * 30
    return F.when(overdue > 0, late).otherwise(F.lit(0))


def flag_at_least(value: Column, threshold: float) -> Column:
    """1 when value >= threshold, else 0; a null value gives 0."""
    return F.when(value >= threshold, F.lit(1)).otherwise(F.lit(0))


# --- ratios and scores ----------------------------------------------------------


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient where the denominator is positive, else null."""
    return F.when(denominator > 0, numerator / denominator)


def utilisation_trend(utilisation: Column) -> Column:
    """Distance from the ideal 30 % utilisation, scaled by the remaining 70 %."""
    return (utilisation - F.lit(0.3)) / F.lit(0.7)


def delinquency_score(delayed_payments: Column, delay_days: Column) -> Column:
    return delayed_payments * F.lit(0.4) + delay_days * F.lit(0.6)


def row_sum(columns: Sequence[str]) -> Column:
    """Row-wise sum that counts nulls as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns])


def ordinal(c: Column, codes: Mapping[str, int], default: int = 0) -> Column:
    """Integer code of a category; unknown and null take the default."""
    value = F.lit(default)
    for name, code in codes.items():
        if code != default:
            value = F.when(c == name, F.lit(code)).otherwise(value)
    return value
