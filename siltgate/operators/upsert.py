"""Keyed upsert, as a plan over a table and into a written one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.functions import quoted, unused
from siltgate.operators.dedup import keep_first
from siltgate.operators.joins import BROADCAST_BYTES, measures_at_most
from siltgate.operators.skew import hashed_value
from siltgate.sources.staging import staging_dir, written

_BUCKET = "_bucket_of_"
#: Folders of a keyed table; a table of 1,000 times a good file's size asks for 1,000.
BUCKETS = 64


def upsert(
    base: DataFrame,
    changes: DataFrame,
    key: str,
    latest_first: Sequence[str],
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``base`` with every changed key replaced and every new key added.

    Of several changes to a key the first by ``latest_first`` wins.  NULL is a key like
    any other: a change with a NULL key replaces the rows of the base without one, so
    the same changes applied twice give what they gave once.  The winning changes are
    computed once and written; if their keys measure no more than ``max_bytes`` they are
    broadcast and the base is not shuffled.
    """
    winners = _winners(changes, key, latest_first, base.columns)
    return _merged(base, winners, key, max_bytes)


def _winners(
    changes: DataFrame, key: str, latest_first: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    winners = keep_first(changes, [key], latest_first).select(*map(quoted, columns))
    return written(winners, staging_dir(changes.sparkSession, "changes"))


def _merged(base: DataFrame, winners: DataFrame, key: str, max_bytes: int) -> DataFrame:
    changed = unused("_changed", base.columns)
    keys = winners.select(F.col(quoted(key)).alias(changed))
    if measures_at_most(keys, max_bytes):
        keys = F.broadcast(keys)
    untouched = base.join(keys, F.expr(f"{quoted(key)} <=> {changed}"), "left_anti")
    return untouched.unionByName(winners)


# --- written tables -----------------------------------------------------------


def write_keyed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Write ``df`` as a table that ``upsert_into`` can change: folders by a hash of the key.

    The number of folders is part of their name, so a table says itself how it is laid out.
    """
    name = f"{_BUCKET}{buckets}"
    dealt = df.withColumn(name, _bucket(df, key, buckets)).hint("rebalance", name)
    dealt.write.mode("overwrite").partitionBy(name).parquet(path)


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table of ``write_keyed``."""
    stored = spark.read.parquet(path)
    return stored.drop(_bucket_column(stored))


def upsert_into(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    key: str,
    latest_first: Sequence[str],
    max_bytes: int = BROADCAST_BYTES,
) -> None:
    """``upsert`` into the table at ``path``; only folders that hold a changed key are
    read and replaced, all other files stay as they are.

    The new content of those folders is written aside first and then takes their place, so
    the table is never read and replaced in one job, and a run that failed is mended by
    running it again: the same changes applied twice give what they gave once.
    """
    stored = spark.read.parquet(path)
    name = _bucket_column(stored)
    buckets = int(name.removeprefix(_BUCKET))
    columns = [c for c in stored.columns if c != name]
    winners = _winners(changes, key, latest_first, columns)
    winners = winners.withColumn(name, _bucket(stored, key, buckets))
    hit = [row[0] for row in winners.select(name).distinct().take(buckets)]
    if not hit:
        return
    touched = stored.filter(F.col(name).isin(hit))
    merged = written(_merged(touched, winners, key, max_bytes), staging_dir(spark, "upsert"))
    merged.hint("rebalance", name).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(name).parquet(path)


def _bucket_column(stored: DataFrame) -> str:
    for name in stored.columns:
        if name.startswith(_BUCKET):
            return name
    raise ValueError("not a table of write_keyed: it has no folders by key")


def _bucket(table: DataFrame, key: str, buckets: int) -> Column:
    """Folder of a key, hashed in the type the table has it in."""
    own = table.select(quoted(key)).schema.fields[0].dataType.simpleString()
    value = hashed_value(key, own)
    if value is None:
        raise ValueError(f"{key} has a collation no hash follows; cast it first")
    return F.expr(f"CAST(pmod(xxhash64({value}), {buckets}) AS INT)")
