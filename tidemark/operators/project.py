"""Projections, casts and alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.settings import NON_FEATURES


def enforce_schema(df: DataFrame, column_types: Mapping[str, T.DataType]) -> DataFrame:
    """Cast the named columns in one projection; values that do not parse become null."""
    return df.select(
        *[
            F.col(c).try_cast(column_types[c]).alias(c) if c in column_types else F.col(c)
            for c in df.columns
        ]
    )


def replace_columns(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Rewrite those of the named columns that exist; order and the rest stay."""
    present = {name: value for name, value in new.items() if name in df.columns}
    return df.withColumns(present) if present else df


def by_prefix(df: DataFrame, prefix: str = "fe_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def feature_columns(
    df: DataFrame,
    excluded: Sequence[str] = tuple(NON_FEATURES),
    excluded_prefixes: Sequence[str] = ("label", "target"),
) -> list[str]:
    """Columns left after removing keys, targets and any ``label*`` / ``target*`` name."""
    prefixes = tuple(p.lower() for p in excluded_prefixes)
    return [c for c in df.columns if c not in excluded and not c.lower().startswith(prefixes)]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def common_numeric(reference: DataFrame, current: DataFrame) -> list[str]:
    """Columns numeric in the reference and present in the current frame, sorted by name."""
    return sorted(set(numeric_columns(reference)) & set(current.columns))


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``features`` in that order: absent ones are 0, extras are dropped."""
    present = set(df.columns)
    return df.select(
        *keep, *[F.col(c) if c in present else F.lit(0).alias(c) for c in features]
    )


def with_lineage(df: DataFrame, **values) -> DataFrame:
    """Add constant columns such as model name, version or threshold."""
    return df.withColumns(
        {name: v if isinstance(v, Column) else F.lit(v) for name, v in values.items()}
    )
