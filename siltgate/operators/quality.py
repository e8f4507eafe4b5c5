"""Reports about the data: rules, unreadable values, row counts."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.functions import quoted


def expectation_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, passed, failed)`` for all rules from one aggregate over the rows.

    A rule passes where it is true; false and NULL fail.
    """
    numbers = [F.count(F.lit(1)).alias("_all")]
    for place, rule in enumerate(rules.values()):
        numbers.append(F.count_if(rule).alias(f"_{place}"))
    lines = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"_{place}").alias("passed"),
            (F.col("_all") - F.col(f"_{place}")).alias("failed"),
        )
        for place, name in enumerate(rules)
    ]
    return df.agg(*numbers).select(F.inline(F.array(*lines)))


def expect(df: DataFrame, rules: Mapping[str, Column], action: str = "warn") -> DataFrame:
    """Apply rules to the rows.

    ``warn`` adds ``failed_rules`` (an array, empty for good rows), ``drop`` leaves
    out rows that fail any rule, ``fail`` makes the job fail at the first such row.
    """
    broken = {name: ~F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    if action == "warn":
        names = [F.when(failed, F.lit(name)) for name, failed in broken.items()]
        return df.withColumn("failed_rules", F.array_compact(F.array(*names)))
    if action == "drop":
        for failed in broken.values():
            df = df.filter(~failed)
        return df
    if action == "fail":
        for name, failed in broken.items():
            error = F.raise_error(F.lit(f"row violates rule {name}")).cast("boolean")
            df = df.filter(F.when(failed, error).otherwise(F.lit(True)))
        return df
    raise ValueError(f"unknown action {action!r}")


# --- rules about a whole table ----------------------------------------------------

# Sketches of fixed size, whatever the table's: 4,096 registers, 200 items a level, 16,384
# hashes.  With them the errors below hold in about 99 of 100 cases.
_LG_DISTINCT, _KLL, _LG_THETA = 12, 200, 14
DISTINCT_ERROR = 3 * 1.04 / math.sqrt(2**_LG_DISTINCT)
RANK_ERROR = 0.0165
COVERAGE_ERROR = 3 / math.sqrt(2**_LG_THETA)


@dataclass(frozen=True)
class Rows:
    """The number of rows lies between ``least`` and ``most``; exact."""

    least: float = 0
    most: float = math.inf


@dataclass(frozen=True)
class Distinct:
    """The number of different values, NULL not counted; ``DISTINCT_ERROR`` either way."""

    column: str
    least: float = 0
    most: float = math.inf


@dataclass(frozen=True)
class Quantile:
    """The value below which ``share`` of the non-NULL numbers lie; off by ``RANK_ERROR`` of
    the rows at most, which says between which values it is."""

    column: str
    share: float
    least: float = -math.inf
    most: float = math.inf


@dataclass(frozen=True)
class Covered:
    """The share of the different non-NULL values that ``parent`` has as ``parent_key``;
    ``COVERAGE_ERROR`` either way.  1 if there is no value."""

    column: str
    parent: DataFrame
    parent_key: str
    least: float = 1.0
    most: float = 1.0


TableRule = Rows | Distinct | Quantile | Covered


def table_report(df: DataFrame, rules: Mapping[str, TableRule]) -> DataFrame:
    """``(rule, estimate, low, high, verdict)`` for all rules from one pass over the rows.

    Every rule is a sketch that tasks build apart and merge, a few kilobytes each, so no
    column is shuffled or sorted; a parent is sketched in a pass of its own.  ``low`` and
    ``high`` say where the exact value is.  The verdict is ``passed`` or ``failed`` where
    both are on one side of the limits, ``unsure`` where only an exact count could tell.
    A quantile of no values is NULL and passes.
    """
    sketches, parents = [], {}
    for k, rule in enumerate(rules.values()):
        sketches += _sketch(rule, k)
        if isinstance(rule, Covered):
            parents[k] = rule.parent.agg(
                F.expr(f"theta_sketch_agg({quoted(rule.parent_key)}, {_LG_THETA})")
            )
    whole = df.agg(*sketches)
    for k, parent in parents.items():
        whole = whole.withColumn(f"p{k}", parent.scalar())  # one sketch
    lines = []
    for k, (name, rule) in enumerate(rules.items()):
        value, low, high = (f"CAST({x} AS DOUBLE)" for x in _estimate(rule, k))
        lines.append(
            F.struct(
                F.lit(name).alias("rule"), F.expr(value).alias("estimate"),
                F.expr(low).alias("low"), F.expr(high).alias("high"),
                F.expr(_verdict(low, high, rule.least, rule.most)).alias("verdict"),
            )
        )
    return whole.select(F.inline(F.array(*lines)))


def _sketch(rule: TableRule, k: int) -> list[Column]:
    match rule:
        case Rows():
            made = ["count(1)"]
        case Distinct(column):
            made = [f"hll_sketch_agg({quoted(column)}, {_LG_DISTINCT})"]
        case Quantile(column):
            value = f"CAST({quoted(column)} AS DOUBLE)"
            made = [f"kll_sketch_agg_double({value}, {_KLL})", f"count({value})"]
        case Covered(column):
            made = [f"theta_sketch_agg({quoted(column)}, {_LG_THETA})"]
    return [F.expr(m).alias(f"s{k}" + "n" * place) for place, m in enumerate(made)]


def _estimate(rule: TableRule, k: int) -> tuple[str, str, str]:
    """SQL for the estimate and its bounds."""
    s = f"s{k}"
    match rule:
        case Rows():
            return s, s, s
        case Distinct():
            n = f"hll_sketch_estimate({s})"
            return n, f"{n} * {1 - DISTINCT_ERROR}D", f"{n} * {1 + DISTINCT_ERROR}D"
        case Quantile(_, share):
            ranks = share, max(0.0, share - RANK_ERROR), min(1.0, share + RANK_ERROR)
            at = [f"IF({s}n = 0, NULL, kll_sketch_get_quantile_double({s}, {r}D))" for r in ranks]
            return at[0], at[1], at[2]
        case Covered():
            own = f"theta_sketch_estimate({s})"
            share = f"theta_sketch_estimate(theta_intersection({s}, p{k})) / {own}"
            # Below as many values as a sketch holds both numbers are exact.
            wide = f"IF({own} < {2 ** (_LG_THETA - 1)}, 0D, {COVERAGE_ERROR}D)"
            value = f"IF({own} = 0, 1D, {share})"
            return value, f"greatest(0D, {value} - {wide})", f"least(1D, {value} + {wide})"


def _verdict(low: str, high: str, least: float, most: float) -> str:
    def number(x: float) -> str:
        return f"CAST('{x}' AS DOUBLE)" if math.isinf(x) else f"{float(x)!r}D"

    return f"""CASE WHEN {low} IS NULL OR ({low} >= {number(least)} AND {high} <= {number(most)})
        THEN 'passed' WHEN {high} < {number(least)} OR {low} > {number(most)} THEN 'failed'
        ELSE 'unsure' END"""
