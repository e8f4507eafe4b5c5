"""Date columns built from Spark's own expressions.

The functions of this package take a column name and give one SQL expression: a
single call to the JVM, where a chain of Column calls is dozens.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltgate.functions.text import quoted

# The date layouts an extract may use.
DATE_FORMATS = ("dd-MM-yyyy", "yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy")

_FIELD = re.compile(r"yyyy|MM|dd")


def parse_date(column: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """DATE of the first format that reads the whole text, NULL if none does.

    Formats made of ``yyyy``, ``MM`` and ``dd`` never reach a date formatter: one
    pattern test picks the layout and the parts are put in ISO order for a cast.
    A failed formatter call raises and swallows a Java exception for every row,
    which costs several times as much as the rest of the scan.
    """
    tries = ", ".join(_read_as(quoted(column), layout) for layout in formats)
    return F.expr(f"coalesce({tries})")


def _read_as(text: str, layout: str) -> str:
    fields = _FIELD.findall(layout)
    around = _FIELD.sub("", layout)
    if sorted(fields) != ["MM", "dd", "yyyy"] or not re.fullmatch(r"[-/. :]*", around):
        escaped = layout.replace("\\", "\\\\").replace("'", "\\'")
        return f"try_to_date({text}, '{escaped}')"

    shape = _FIELD.sub(
        lambda field: rf"\d{{{len(field.group())}}}", layout.replace(".", "[.]")
    )

    def part(field: str) -> str:
        return f"substring({text}, {layout.index(field) + 1}, {len(field)})"

    iso = f"concat_ws('-', {part('yyyy')}, {part('MM')}, {part('dd')})"
    # \A and \z rather than ^ and $: "$" would let a final line break through.
    return rf"CASE WHEN {text} RLIKE r'\A{shape}\z' THEN try_cast({iso} AS DATE) END"


def month_bucket(column: str) -> Column:
    """``yyyy-MM`` of a date."""
    return F.expr(f"date_format({quoted(column)}, 'yyyy-MM')")


def days_before(as_of: dt.date | Column | None, days: int) -> Column:
    """The date ``days`` before ``as_of``; today if no date is given."""
    if as_of is None:
        as_of = F.current_date()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    return F.date_sub(as_of, days)
