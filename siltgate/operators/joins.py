"""Equi-joins of a parent table (one row per key) with its children (many)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

from siltgate.functions import quoted, unused
from siltgate.operators.skew import HotRoutes, hot_routes, salted_join

BROADCAST_BYTES = 64 * 1024 * 1024
_UNKNOWN_BYTES = 1 << 62
#: How much more than may be broadcast is read to find out.
READ_FACTOR = 4


def join_parent(
    child: DataFrame, parent: DataFrame, key: str, child_key: str, hot: HotRoutes | None = None
) -> DataFrame:
    """Inner join: every child row with the columns of its parent."""
    hot = hot or hot_routes(child, [key])
    return salted_join(child, parent, [key], "inner", spread_by=[child_key], hot=hot)


def left_join_children(
    parent: DataFrame, child: DataFrame, key: str, child_key: str, hot: HotRoutes | None = None
) -> DataFrame:
    """Left join: every parent row with each of its children, or with NULLs.

    Without hot keys it is the plain join.  With some, the many side is on the right,
    where neither salting nor a runtime split of skewed partitions can cut it.  So the
    matches come from the salted inner join and the childless parents from an anti join
    against the distinct child keys.
    """
    hot = hot or hot_routes(child, [key])
    if not hot.lanes:
        columns = [c for c in child.columns if c != key]
        name = unused("_child_key", parent.columns, child.columns)
        found = child.select(F.col(quoted(key)).alias(name), *map(quoted, columns))
        return parent.join(
            found, F.expr(f"{quoted(key)} = {name}"), "left"
        ).select(*map(quoted, parent.columns), *map(quoted, columns))
    matched = join_parent(child, parent, key, child_key, hot)
    extra = [c for c in child.columns if c != key]
    columns = [*parent.columns, *extra]
    childless = without_children(parent, child, key)
    types = {f.name: f.dataType for f in child.schema.fields}
    padded = childless.select(
        *parent.columns, *[F.lit(None).cast(types[c]).alias(c) for c in extra]
    )
    return matched.select(*columns).unionByName(padded)


def _keys_of(child: DataFrame, key: str) -> DataFrame:
    # distinct() collapses a hot key inside each task; a bare semi join would send
    # every one of its rows to one task.  The join reuses the distinct's shuffle.
    return child.select(key).filter(f"{quoted(key)} IS NOT NULL").distinct()


def with_children(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """EXISTS: parents with at least one child."""
    return parent.join(_keys_of(child, key), key, "left_semi").select(*parent.columns)


def without_children(
    parent: DataFrame, child: DataFrame, key: str, null_aware: bool = False
) -> DataFrame:
    """NOT EXISTS: parents with no child (a NULL parent key has none).

    ``null_aware`` gives SQL's NOT IN: nothing if a child key is NULL, and a NULL
    parent key passes only if there are no children at all.  Spark would broadcast
    every child key for NOT IN whatever their number; here two single numbers
    settle the NULL cases and the join is an ordinary anti join.
    """
    rest = parent.join(_keys_of(child, key), key, "left_anti").select(*parent.columns)
    if not null_aware:
        return rest
    facts = child.selectExpr("count(1) AS n", f"count_if({quoted(key)} IS NULL) AS nulls")
    return rest.filter(
        (facts.select("nulls").scalar() == 0)
        & (F.col(key).isNotNull() | (facts.select("n").scalar() == 0))
    )


def input_bytes(df: DataFrame) -> int:
    """Bytes of the tables and files that ``df`` reads, as Spark knows them without a job.

    Inputs whose size Spark does not know, such as rows made by the driver, count nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    return sum(size for size in sizes if size < _UNKNOWN_BYTES)


def measures_at_most(df: DataFrame, max_bytes: int) -> bool:
    """Whether ``df`` is known to be no wider than ``max_bytes``, to be broadcast.

    What it reads is looked at first: beyond ``READ_FACTOR * max_bytes`` nothing is read
    and the answer is no, also for the rare plan that would leave little of it.  Otherwise
    one job adds up the widths, so that looking never costs more than that much reading.
    """
    return input_bytes(df) <= READ_FACTOR * max_bytes and measured_bytes(df) <= max_bytes


def measured_bytes(df: DataFrame) -> int:
    """The width of all values of ``df`` together; runs one job over all of it."""
    widths = []
    for field in df.schema.fields:
        widths.append("16L")
        if not isinstance(field.dataType, (NumericType, DatetimeType, BooleanType)):
            widths.append(f"coalesce(octet_length(CAST({quoted(field.name)} AS STRING)), 0)")
    return df.selectExpr(f"coalesce(sum({' + '.join(widths)}), 0L)").first()[0]


def join_small_parent(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    child_key: str,
    max_bytes: int = BROADCAST_BYTES,
    hot: HotRoutes | None = None,
) -> DataFrame:
    """Inner join that broadcasts the parent if it measures at most ``max_bytes``.

    Measuring runs one job over a parent that can be that small.  A larger parent is not
    read for it and takes the salted shuffle join, so growth changes the plan and not the
    outcome.
    """
    if not measures_at_most(parent, max_bytes):
        return join_parent(child, parent, key, child_key, hot)
    return child.join(F.broadcast(parent), key, "inner").select(
        *child.columns, *[c for c in parent.columns if c != key]
    )


def rows_with_keys(
    big: DataFrame, column: str, keys: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``big`` whose ``column`` is among the one-column ``keys``; NULL is a key.

    For a small set looked up in a large table: the keys are measured (one job) and
    up to ``max_bytes`` broadcast, so that ``big`` is scanned and not shuffled.
    """
    name = unused("_key", big.columns)
    keys = keys.toDF(name).distinct()
    if measures_at_most(keys, max_bytes):
        keys = F.broadcast(keys)
    return big.join(keys, F.expr(f"{quoted(column)} <=> {name}"), "left_semi")
