"""Column -> Column cleaning rules. All JVM-side, ANSI-safe and null-tolerant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.settings import MASKED_VALUES


def letters_only(c: Column) -> Column:
    """Keep ASCII letters and white space."""
    return F.regexp_replace(c, r"[^a-zA-Z\s]", "")


def int_in_range(c: Column, low: int, high: int) -> Column:
    """Integer value of a digits-only text inside [low, high], else null."""
    number = c.try_cast("int")
    return F.when(c.rlike(r"^\d+$") & number.between(low, high), number)


def matching_or(c: Column, pattern: str, default: str) -> Column:
    """The text if it matches ``pattern``, else ``default`` (a null takes the default too)."""
    return F.when(c.rlike(pattern), c).otherwise(F.lit(default))


def valid_age(c: Column) -> Column:
    return int_in_range(c, 0, 100)


def valid_ssn(c: Column) -> Column:
    return matching_or(c, r"^\d{3}-\d{2}-\d{4}$", "NA")


def valid_occupation(c: Column) -> Column:
    # an all-underscore mask matches on purpose: masks are the imputer's business
    return matching_or(c, r"^[a-zA-Z_]+$", "NA")


def scrub_number(c: Column, digits: int = 2) -> Column:
    """Number left after dropping everything but digits, dot and minus; null when unparsable."""
    text = F.regexp_replace(c, r"[^0-9.-]", "")
    return F.round(F.nullif(text, F.lit("")).try_cast("double"), digits)


def within(c: Column, low: float, high: float) -> Column:
    return F.when(c.between(low, high), c)


def non_negative(c: Column) -> Column:
    return F.when(c >= 0, c)


def unless_equal(c: Column, sentinel: str) -> Column:
    return F.nullif(c, F.lit(sentinel))


def unmask(c: Column, masks: Sequence[str] = tuple(MASKED_VALUES)) -> Column:
    """Null for whole-value missing markers."""
    return F.when(~c.isin(list(masks)), c)


def repaired_age(c: Column) -> Column:
    """Number left after dropping underscores ('39_' is 39), else null."""
    return F.replace(c, F.lit("_"), F.lit("")).try_cast("double")


def plausible_age(c: Column) -> Column:
    return within(c, 18, 120)
