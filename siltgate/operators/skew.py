"""Joins that hold when one key has a third of all rows.

A shuffle join sends all rows of a key to one task.  ``hot_routes`` looks at the keys
first, in one narrow pass that ends in a few thousand numbers at most: a frequent-items
sketch per task, merged in two levels.  Where no key is hot ``salted_join`` is the
plain join, with the plain join's single sort key.  Where some are, it cuts their rows
into lanes of bounded size and gives every lane its own copy of the one parent row.

Both sides are brought to one type first, the one their keys are compared in, and the
route of a key is a hash of that value; equal keys therefore have equal routes, whatever
they look like as text.  Types with no common one (a text and a number, say) are refused.
No hash of Spark's follows a collation.  Keys that only ignore case (UTF8_LCASE) are routed
by the hash of what that collation compares, their lower case with one form of the Greek
sigma; keys with any other collation are left to adaptive skew handling.

A key is hot by its rows, not by its share.  The sketch follows 65,536 keys, so it names
every key with more than about one row in 50,000, up to 8,192 of them; a key below that
share is left to adaptive skew handling, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from siltgate.functions import quoted, unused

HOT_ROWS = 1_000_000
LANE_ROWS = 1_000_000
_MOST_KEYS = 8192
_SKETCH_ITEMS = 65_536
_MERGE_LANES = 64


@dataclass(frozen=True)
class HotRoutes:
    """Hot keys as pairs of route (a hash of the key columns, NULLs included) and
    number of lanes, with the types in which the keys were hashed and the limits."""

    lanes: tuple[tuple[int, int], ...]
    types: tuple[str, ...] = ()
    min_rows: int = HOT_ROWS
    lane_rows: int = LANE_ROWS


NO_HOT_KEYS = HotRoutes(())


def _types(df: DataFrame, keys: Sequence[str]) -> list[DataType]:
    return [df.select(quoted(k)).schema.fields[0].dataType for k in keys]


def _common_type(a: DataType, b: DataType) -> DataType:
    """The type in which values of two types are compared."""
    if a == b:
        return a
    if isinstance(a, StringType) and isinstance(b, StringType):
        if a.collationId == b.collationId:
            return StringType(a.collation)  # char and varchar against string
    elif isinstance(a, NumericType) and isinstance(b, NumericType):
        return _wider(a, b)
    elif {type(a), type(b)} <= {DateType, TimestampType, TimestampNTZType}:
        return _wider(a, b)
    raise ValueError(
        f"keys of type {a.simpleString()} and {b.simpleString()} have no common type; cast one"
    )


def _unroutable(sql_type: str) -> bool:
    return "collate" in sql_type and not _ignores_case(sql_type)


def _ignores_case(sql_type: str) -> bool:
    return sql_type.split("collate ")[-1].upper() == "UTF8_LCASE"


def hashed_value(key: str, sql_type: str) -> str | None:
    """What to hash so that keys that compare as equal hash alike; None if nothing will do."""
    return None if _unroutable(sql_type) else _routed(key, sql_type)


def _routed(key: str, sql_type: str) -> str:
    value = f"CAST({quoted(key)} AS {sql_type})"
    if _ignores_case(sql_type):
        return f"translate(lower(CAST({value} AS STRING COLLATE UTF8_BINARY)), 'ς', 'σ')"
    return value


def _wider(a: DataType, b: DataType) -> DataType:
    from pyspark.sql import SparkSession

    spark = SparkSession.active()
    pair = " UNION ALL ".join(f"SELECT CAST(NULL AS {t.simpleString()}) AS k" for t in (a, b))
    return spark.sql(pair).schema.fields[0].dataType


def _route(keys: Sequence[str], types: Sequence[str]) -> str:
    # The hash of a value, not of its text: 0.0 and -0.0, and all NaNs, hash alike, as
    # they compare alike.
    values = [_routed(k, t) for k, t in zip(keys, types, strict=True)]
    return f"xxhash64({', '.join(values)})"


def hot_routes(
    df: DataFrame,
    keys: Sequence[str],
    min_rows: int = HOT_ROWS,
    lane_rows: int = LANE_ROWS,
    types: Sequence[str] | None = None,
) -> HotRoutes:
    """Keys with at least ``min_rows`` rows.

    Runs one job that reads only the key columns.  Give it the source table rather
    than a cleaned one, so that nothing has to be computed twice.  ``types`` are those
    of the comparison to come, if they differ from the columns' own.
    """
    types = tuple(types or (t.simpleString() for t in _types(df, keys)))
    if any(map(_unroutable, types)):
        return NO_HOT_KEYS
    sketches = (
        df.selectExpr(
            f"{_route(keys, types)} AS route",
            f"pmod(spark_partition_id(), {_MERGE_LANES}) AS lane",
        )
        .groupBy("lane")
        .agg(F.expr(f"approx_top_k_accumulate(route, {_SKETCH_ITEMS}) AS sketch"))
    )
    # Grouped by a constant that the optimizer does not see through: without a group,
    # a task that gets no sketch would fail to write its empty one.
    merged = (
        sketches.selectExpr("pmod(lane, 1) AS all", "sketch")
        .groupBy("all")
        .agg(F.expr(f"approx_top_k_combine(sketch, {_SKETCH_ITEMS}) AS sketch"))
    )
    hot = (
        merged.selectExpr(f"inline(approx_top_k_estimate(sketch, {_MOST_KEYS}))")
        .filter(f"count >= {min_rows}")
        .selectExpr("item", f"CAST(ceil(count / {lane_rows}) AS INT) AS lanes")
    )
    lanes = tuple((row.item, row.lanes) for row in hot.take(_MOST_KEYS))
    return HotRoutes(lanes, types, min_rows, lane_rows) if lanes else NO_HOT_KEYS


def salted_join(
    child: DataFrame,
    parent: DataFrame,
    on: Sequence[str],
    how: str,
    *,
    spread_by: Sequence[str],
    hot: HotRoutes,
    null_safe: bool = False,
) -> DataFrame:
    """Join many ``child`` rows to a ``parent`` that has one row per key.

    ``how`` is inner, left, left_semi or left_anti.  ``spread_by`` names child
    columns that tell its rows apart; lanes come from their hash, so a task that
    runs twice sends its rows the same way.  NULL is a key that can be hot like any
    other, though it matches nothing unless ``null_safe``.  ``hot`` that was found in
    another type than that of the comparison is looked for again, in one job.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    common = [
        _common_type(a, b)
        for a, b in zip(_types(child, on), _types(parent, on), strict=True)
    ]
    types = tuple(t.simpleString() for t in common)
    if any(map(_unroutable, types)):
        hot = NO_HOT_KEYS
    if hot.lanes and hot.types != types:
        hot = hot_routes(child, on, hot.min_rows, hot.lane_rows, types)
    child_columns = [quoted(c) for c in child.columns]
    values = [quoted(c) for c in parent.columns if c not in on]
    taken = [child.columns, parent.columns]
    parent_key = {}
    for k in on:
        parent_key[k] = quoted(unused(f"_p_{k}", *taken, parent_key.values()))
    lane, parent_lane = (unused(name, *taken) for name in ("_lane", "_p_lane"))
    renamed = [
        f"CAST({quoted(k)} AS {t}) AS {parent_key[k]}" for k, t in zip(on, types, strict=True)
    ]
    equal = "<=>" if null_safe else "="
    # The keys come before the lane: a merge join sorts in this order, and a sort
    # that starts with the lane, 0 for most rows, would compare nearly all in full.
    matched = [
        f"CAST({quoted(k)} AS {t}) {equal} {parent_key[k]}"
        for k, t in zip(on, types, strict=True)
    ]

    if not hot.lanes:
        right = parent.selectExpr(*renamed, *values)
    else:
        child = with_lane(child, on, types, hot, spread_by, lane)
        lanes = unused("_lanes", *taken)
        right = _with_lanes(parent, on, types, hot, lanes).selectExpr(
            *renamed, *values, f"explode(sequence(0, coalesce({lanes}, 1) - 1)) AS {parent_lane}"
        )
        matched.append(f"{lane} = {parent_lane}")

    joined = child.join(right, F.expr(" AND ".join(matched)), how)
    return joined.selectExpr(
        *child_columns, *([] if how in ("left_semi", "left_anti") else values)
    )


def with_lane(
    df: DataFrame,
    keys: Sequence[str],
    types: Sequence[str],
    hot: HotRoutes,
    spread_by: Sequence[str],
    name: str,
) -> DataFrame:
    """Add the lane of each row as ``name``, 0 for the rows of ordinary keys."""
    lanes = unused("_lanes", df.columns)
    spread = f"xxhash64({', '.join(quoted(c) for c in spread_by)})"
    return _with_lanes(df, keys, types, hot, lanes).selectExpr(
        *map(quoted, df.columns),
        f"CAST(pmod({spread}, coalesce({lanes}, 1)) AS INT) AS {quoted(name)}",
    )


def _with_lanes(
    df: DataFrame, keys: Sequence[str], types: Sequence[str], hot: HotRoutes, name: str
) -> DataFrame:
    """Add the number of lanes, NULL for ordinary keys; at most ``_MOST_KEYS`` are hot."""
    route = unused("_route", df.columns)
    routes = df.sparkSession.createDataFrame(list(hot.lanes), f"{route} long, {name} int")
    return df.selectExpr("*", f"{_route(keys, types)} AS {route}").join(
        F.broadcast(routes), route, "left"
    )
