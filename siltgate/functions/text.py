"""Text normalisation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(column: str) -> str:
    """A column name as it has to be written in SQL text."""
    return "`" + column.replace("`", "``") + "`"


def unused(name: str, *taken: Iterable[str]) -> str:
    """``name`` with as many underscores in front as it takes to be none of ``taken``."""
    names = {column.lower() for columns in taken for column in columns}
    while name.lower() in names:
        name = "_" + name
    return name


def title_case(column: str) -> Column:
    """First letter of every space-separated word in capitals, outer blanks gone."""
    return F.expr(f"initcap(trim({quoted(column)}))")


def lower_trimmed(column: str) -> Column:
    return F.expr(f"lower(trim({quoted(column)}))")


def blank_out(column: str, tokens: Sequence[str]) -> Column:
    """NULL where the whole cell is one of ``tokens`` (such as the word ``NULL``)."""
    text = F.col(quoted(column))
    return F.when(~text.isin(*tokens), text) if tokens else text
