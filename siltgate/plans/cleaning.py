"""Run a table's cleaning steps, and account for the rows they refuse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.functions import parse_date, quoted
from siltgate.operators.dedup import keep_first, repeated_rows
from siltgate.operators.filters import all_present, require
from siltgate.operators.skew import HotRoutes, hot_routes
from siltgate.spec import (
    KeepFirst,
    Normalise,
    ParseDate,
    RequirePresent,
    RequireRule,
    TableSpec,
)

REFUSED = "refused"


def raw_name(column: str) -> str:
    return f"raw_{column}"


def clean(
    raw: DataFrame, spec: TableSpec, arrival: Sequence[str], keep_raw: bool = False
) -> DataFrame:
    """Apply the steps of ``spec`` in their order.

    ``arrival`` orders the rows of a key (see ``with_arrival`` for files).  The
    result has the columns of the spec in their clean types (a value that does not fit
    becomes NULL), plus, if ``keep_raw``, ``raw_<column>`` for every date: the original
    text where no format could read it, else NULL.
    """
    extra = _unread(spec) if keep_raw else []
    rows = _apply(raw, spec, arrival, mark=False)
    return rows.selectExpr(*_own(rows, spec), *extra)


def clean_tagged(raw: DataFrame, spec: TableSpec, arrival: Sequence[str]) -> DataFrame:
    """Like ``clean`` with ``keep_raw``, but rows refused after keep-first stay, with
    the name of the rule in ``refused``.  Such a row has used up its key, which a
    later batch of the same table needs to know."""
    rows = _apply(raw, spec, arrival, mark=True)
    return rows.selectExpr(*_own(rows, spec), *_unread(spec), REFUSED)


def _own(rows: DataFrame, spec: TableSpec) -> list[str]:
    has = {f.name: f.dataType for f in rows.schema.fields}
    return [
        quoted(f.name)
        if has.get(f.name) == f.clean
        else f"try_cast({quoted(f.name)} AS {f.clean.simpleString()}) AS {quoted(f.name)}"
        for f in spec.fields
    ]


def _unread(spec: TableSpec) -> list[str]:
    return [
        f"CASE WHEN {quoted(c)} IS NULL THEN {quoted(raw_name(c))} END AS {quoted(raw_name(c))}"
        for c in spec.date_columns
    ]


def _apply(raw: DataFrame, spec: TableSpec, arrival: Sequence[str], mark: bool) -> DataFrame:
    df = raw
    first_kept = marked = False
    for step in spec.steps:
        match step:
            case RequirePresent(columns):
                rule, reason = all_present(columns), "missing_" + "_".join(columns)
            case RequireRule(name, predicate):
                rule, reason = predicate(), f"invalid_{name}"
            case KeepFirst(keys):
                df = keep_first(df, keys, arrival)
                first_kept = True
                continue
            case ParseDate(column, formats):
                df = df.withColumns(
                    {raw_name(column): F.col(column), column: parse_date(column, formats)}
                )
                continue
            case Normalise(column, using):
                df = df.withColumn(column, using(column))
                continue
        if not (mark and first_kept):
            df = require(df, rule)
        else:
            earlier = F.col(REFUSED) if marked else F.lit(None)
            holds = F.coalesce(rule, F.lit(False))
            df = df.withColumn(REFUSED, F.coalesce(earlier, F.when(~holds, F.lit(reason))))
            marked = True
    if mark and not marked:
        df = df.selectExpr("*", f"CAST(NULL AS STRING) AS {REFUSED}")
    return df


def refused_rows(
    raw: DataFrame,
    spec: TableSpec,
    arrival: Sequence[str],
    hot: HotRoutes | None = None,
) -> DataFrame:
    """The raw rows cleaning leaves out, with the reason: ``missing_<column>``,
    ``duplicate`` or ``invalid_<rule>``.  Orphans are not among them; they are
    quarantined."""
    parts = []
    df = raw
    for step in spec.steps:
        match step:
            case RequirePresent(columns):
                rule, reason = all_present(columns), "missing_" + "_".join(columns)
            case RequireRule(name, predicate):
                rule, reason = predicate(), f"invalid_{name}"
            case KeepFirst(keys):
                repeats = repeated_rows(df, keys, arrival, hot or hot_routes(raw, keys))
                parts.append(repeats.withColumn("reason", F.lit("duplicate")))
                df = keep_first(df, keys, arrival)
                continue
            case _:
                continue
        holds = F.coalesce(rule, F.lit(False))
        parts.append(df.filter(~holds).withColumn("reason", F.lit(reason)))
        df = df.filter(holds)
    if not parts:  # a spec without rules refuses nothing
        parts = [raw.filter("false").withColumn("reason", F.lit(None).cast("string"))]
    refused = parts[0]
    for part in parts[1:]:
        refused = refused.unionByName(part)
    return refused.select(*map(quoted, spec.columns), "reason")


def unreadable_dates(
    cleaned: DataFrame, spec: TableSpec, context: Sequence[str] = ()
) -> DataFrame:
    """``(table_name, row_key, column_name, original)`` of dates no format could
    read, and the ``context`` columns of their rows.  Takes the output of
    ``clean(..., keep_raw=True)``; a table without dates has none."""
    if not spec.date_columns:
        return cleaned.filter("false").selectExpr(
            f"'{spec.name}' AS table_name",
            f"{quoted(spec.key)} AS row_key",
            *map(quoted, context),
            "CAST(NULL AS STRING) AS column_name",
            "CAST(NULL AS STRING) AS original",
        )
    lines = ", ".join(
        f"named_struct('column_name', '{c}', 'original', {quoted(raw_name(c))})"
        for c in spec.date_columns
    )
    return cleaned.selectExpr(
        f"'{spec.name}' AS table_name",
        f"{quoted(spec.key)} AS row_key",
        *map(quoted, context),
        f"inline(array({lines}))",
    ).filter("original IS NOT NULL")


def row_counts(raw: DataFrame, tagged: DataFrame, spec: TableSpec) -> DataFrame:
    """``(table_name, stage, n)`` of one table from two aggregates.

    ``tagged`` is ``clean_tagged`` output, with a boolean ``has_parent`` if the
    table has a foreign key.  ``unparsed`` and ``missing`` count dates of the rows
    that passed the rules, orphans included.
    """
    stages = count_stages(spec)
    counted = tagged.selectExpr(*[f"count_if({rule}) AS {s}" for s, rule in stages.items()])
    lines = ", ".join(f"named_struct('stage', '{s}', 'n', {s})" for s in stages)
    whole = raw.selectExpr("count(1) AS n").selectExpr("'raw' AS stage", "n")
    return whole.unionByName(counted.selectExpr(f"inline(array({lines}))")).selectExpr(
        f"'{spec.name}' AS table_name", "stage", "n"
    )


def count_stages(spec: TableSpec) -> dict[str, str]:
    """Which rows of ``clean_tagged`` output, with ``has_parent``, each stage counts."""
    passed = f"{REFUSED} IS NULL"
    parted = "has_parent" if spec.foreign_key else "true"
    dates = [(quoted(c), quoted(raw_name(c))) for c in spec.date_columns]
    unparsed = " OR ".join(f"{raw_text} IS NOT NULL" for _, raw_text in dates)
    missing = " OR ".join(f"({date} IS NULL AND {raw_text} IS NULL)" for date, raw_text in dates)
    return {
        "kept_first": "true",
        "passed_rules": passed,
        "orphan": f"{passed} AND NOT {parted}",
        "clean": f"{passed} AND {parted}",
        "unparsed": f"{passed} AND ({unparsed or 'false'})",
        "missing": f"{passed} AND ({missing or 'false'})",
    }
