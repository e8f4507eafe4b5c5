"""Foreign keys: which child rows have a parent, and which are quarantined."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame

from siltgate.functions import quoted
from siltgate.operators.skew import HotRoutes, hot_routes, salted_join
from siltgate.spec import KeepFirst, TableSpec


class Split(NamedTuple):
    valid: DataFrame
    orphans: DataFrame


def _parent_keys(parent: DataFrame, spec: TableSpec) -> DataFrame:
    fk = spec.foreign_key
    return parent.selectExpr(f"{quoted(fk.parent_key)} AS {quoted(fk.column)}")


def _match(
    child: DataFrame, parent: DataFrame, spec: TableSpec, how: str, hot: HotRoutes | None
) -> DataFrame:
    if spec.foreign_key is None:
        raise ValueError(f"{spec.name} has no foreign key")
    column = spec.foreign_key.column
    hot = hot or hot_routes(child, [column])
    return salted_join(
        child, _parent_keys(parent, spec), [column], how, spread_by=[spec.key], hot=hot
    )


def with_parent(
    child: DataFrame, parent: DataFrame, spec: TableSpec, hot: HotRoutes | None = None
) -> DataFrame:
    """Child rows whose foreign key is found in ``parent``.

    A semi join, so a parent key that occurs twice does not double its children.
    """
    return _match(child, parent, spec, "left_semi", hot)


def without_parent(
    child: DataFrame, parent: DataFrame, spec: TableSpec, hot: HotRoutes | None = None
) -> DataFrame:
    """Child rows to quarantine; a NULL foreign key has no parent."""
    return _match(child, parent, spec, "left_anti", hot)


def split_by_parent(
    child: DataFrame, parent: DataFrame, spec: TableSpec, hot: HotRoutes | None = None
) -> Split:
    """Both sides.  For large tables write ``tag_parent`` once instead: a caller that
    reads both sides of a split computes the child twice."""
    return Split(
        with_parent(child, parent, spec, hot), without_parent(child, parent, spec, hot)
    )


def tag_parent(
    child: DataFrame,
    parent: DataFrame,
    spec: TableSpec,
    flag: str = "has_parent",
    hot: HotRoutes | None = None,
) -> DataFrame:
    """All child rows plus a boolean: one shuffle of the child gives both sides.

    ``parent`` must be unique on its key.  A cleaned table is if its spec keeps the
    first row of that key, which ``require_unique_parents`` checks.
    """
    column = spec.foreign_key.column
    hot = hot or hot_routes(child, [column])
    found = f"{quoted(column)} IS NOT NULL AS {flag}"
    keys = _parent_keys(parent, spec).selectExpr("*", found)
    tagged = salted_join(child, keys, [column], "left", spread_by=[spec.key], hot=hot)
    return tagged.selectExpr(*map(quoted, child.columns), f"coalesce({flag}, false) AS {flag}")


def require_unique_parents(specs: Mapping[str, TableSpec]) -> None:
    """Refuse specs whose parent tables may repeat the key their children point at."""
    for spec in specs.values():
        fk = spec.foreign_key
        if fk is None:
            continue
        steps = specs[fk.parent].steps
        if not any(isinstance(s, KeepFirst) and s.keys == (fk.parent_key,) for s in steps):
            raise ValueError(
                f"{fk.parent} is the parent of {spec.name} and needs KeepFirst(({fk.parent_key!r},))"
            )


def with_reason(
    orphans: DataFrame,
    raw_parent: DataFrame,
    spec: TableSpec,
    hot: HotRoutes | None = None,
) -> DataFrame:
    """Say why a row is quarantined: ``parent_rejected`` if the parent was in the
    input and cleaning refused it, ``missing_parent`` if it was never there."""
    seen = _parent_keys(raw_parent, spec).distinct()
    tagged = tag_parent(orphans, seen, spec, flag="_seen", hot=hot)
    return tagged.selectExpr(
        *map(quoted, orphans.columns),
        "CASE WHEN _seen THEN 'parent_rejected' ELSE 'missing_parent' END AS reason",
    )
