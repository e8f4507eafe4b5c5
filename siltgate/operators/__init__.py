from siltgate.operators.dedup import keep_first, repeated_rows, with_arrival
from siltgate.operators.filters import require, require_present, with_value
from siltgate.operators.joins import (
    join_parent,
    join_small_parent,
    left_join_children,
    rows_with_keys,
    with_children,
    without_children,
)
from siltgate.operators.quality import (
    Covered,
    Distinct,
    Quantile,
    Rows,
    expect,
    expectation_report,
    table_report,
)
from siltgate.operators.referential import (
    Split,
    require_unique_parents,
    split_by_parent,
    tag_parent,
    with_parent,
    with_reason,
    without_parent,
)
from siltgate.operators.skew import NO_HOT_KEYS, HotRoutes, hot_routes, salted_join
from siltgate.operators.upsert import read_keyed, upsert, upsert_into, write_keyed

__all__ = [
    "NO_HOT_KEYS",
    "Covered",
    "Distinct",
    "HotRoutes",
    "Quantile",
    "Rows",
    "Split",
    "expect",
    "expectation_report",
    "hot_routes",
    "join_parent",
    "join_small_parent",
    "keep_first",
    "left_join_children",
    "read_keyed",
    "repeated_rows",
    "require",
    "require_present",
    "require_unique_parents",
    "rows_with_keys",
    "salted_join",
    "split_by_parent",
    "table_report",
    "tag_parent",
    "upsert",
    "upsert_into",
    "with_arrival",
    "with_children",
    "with_parent",
    "with_reason",
    "with_value",
    "without_children",
    "without_parent",
    "write_keyed",
]
