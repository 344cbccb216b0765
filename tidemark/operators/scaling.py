"""Standard scaling: fit once, then a row-local projection with literals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.profile import known


@dataclass(frozen=True)
class Scaler:
    """Mean and population standard deviation per column; a zero deviation scales by 1."""

    mean: dict[str, float]
    std: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: (F.col(c).cast("double") - F.lit(self.mean[c])) / F.lit(self.std[c])
                for c in self.mean
            }
        )


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    """One aggregation over ``df``; two numbers per column reach the driver."""
    row = df.agg(
        *[F.avg(known(df, c).cast("double")).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(known(df, c).cast("double")).alias(f"s_{c}") for c in columns],
    ).first()
    return Scaler(
        {c: row[f"m_{c}"] if row[f"m_{c}"] is not None else 0.0 for c in columns},
        {c: row[f"s_{c}"] or 1.0 for c in columns},
    )
