"""Row filters and the rows they refuse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.functions import quoted


def require_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(all_present(columns))


def all_present(columns: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"{quoted(name)} IS NOT NULL" for name in columns))


def require(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows where ``predicate`` is true (false and NULL both go)."""
    return df.filter(predicate)


def with_value(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows where ``column`` equals ``value``; the test reaches a parquet scan."""
    return df.filter(F.col(quoted(column)) == F.lit(value))
