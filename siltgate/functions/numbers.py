"""Validity of numeric columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltgate.functions.text import quoted


def not_negative(column: str, finite: bool = False) -> Column:
    """Present and at least zero.

    Spark sorts NaN above every number, so NaN and infinity pass unless ``finite``
    asks for them to be refused.
    """
    value = quoted(column)
    rule = f"{value} IS NOT NULL AND {value} >= 0"
    if finite:
        rule += f" AND NOT isnan({value}) AND {value} < double('Infinity')"
    return F.expr(rule)
