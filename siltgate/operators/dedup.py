"""Keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltgate.functions import quoted, unused
from siltgate.operators.skew import HotRoutes, hot_routes, with_lane


def keep_first(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], by_hash: bool = False
) -> DataFrame:
    """The first row of every key; rows whose key is NULL are one group.

    ``order_by`` holds SQL sort terms (``"seq"``, ``"version DESC"``) that have to
    order the rows of a key completely, else which row is "first" is left to
    chance.  The filter sits right on the row number, so Spark keeps one row per
    key and task before the shuffle: a key with a third of all rows sends one row
    per task, not the rows.

    ``by_hash`` is for long keys such as whole texts: rows are sorted by a hash first,
    and the keys themselves are compared only where hashes are equal.
    """
    if not order_by:
        raise ValueError("keep_first needs an order; see with_arrival for files")
    by = ", ".join(quoted(key) for key in keys)
    if by_hash:
        by = f"xxhash64({by}), {by}"
    place = unused("_place", df.columns)
    number = f"row_number() OVER (PARTITION BY {by} ORDER BY {', '.join(order_by)}) AS {place}"
    return df.selectExpr("*", number).filter(f"{place} = 1").drop(place)


def with_arrival(df: DataFrame, name: str = "_arrival") -> DataFrame:
    """Add the place of a row in its files: time, file, block, then row within the task.

    For inputs with no arrival column of their own.  Has to be called on the file
    scan itself.  Files come in the order they were last changed, files of the same
    moment in name order, as in a stream of the same folder.
    """
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_modification_time").alias("time"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def repeated_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    hot: HotRoutes | None = None,
) -> DataFrame:
    """The rows ``keep_first`` leaves out; ``order_by`` are plain column names.

    All rows are shuffled once, by key, and numbered there.  Numbering would put a hot key
    into one task, so its rows are numbered lane by lane: what is not first in its lane is
    a repeat, and the firsts of the lanes, a few rows a key, are numbered once more.  Of
    rows that tie with the first all but one are returned.
    """
    hot = hot or hot_routes(df, keys)
    types = tuple(df.select(*map(quoted, keys)).schema[k].dataType.simpleString() for k in keys)
    if hot.lanes and hot.types != types:
        hot = hot_routes(df, keys, hot.min_rows, hot.lane_rows, types)
    by = ", ".join(quoted(key) for key in keys)
    order = ", ".join(quoted(c) for c in order_by)
    place, lane = unused("_place", df.columns), unused("_lane", df.columns)
    number = f"row_number() OVER (PARTITION BY {{}} ORDER BY {order}) AS {place}"
    if not hot.lanes:
        return df.selectExpr("*", number.format(by)).filter(f"{place} > 1").drop(place)
    # Rows that tie in the order must come in one order in both branches below.
    tied = ", ".join(
        quoted(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()
    )
    number = number.replace(f"ORDER BY {order}", f"ORDER BY {order}, xxhash64({tied})")
    numbered = with_lane(df, keys, types, hot, order_by, lane).selectExpr(
        "*", number.format(f"{by}, {lane}")
    )
    firsts = numbered.filter(f"{place} = 1").select(*map(quoted, df.columns))
    later = numbered.filter(f"{place} > 1").select(*map(quoted, df.columns))
    also = firsts.selectExpr("*", number.format(by)).filter(f"{place} > 1").drop(place)
    return later.unionByName(also)
