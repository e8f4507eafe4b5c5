"""Catalog tables and table layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegralType,
    NumericType,
    StringType,
    TimestampType,
)

from siltgate.functions import quoted, unused
from siltgate.spec import TableSpec

# Formats whose own overwrite either happens as a whole or not at all.
_ATOMIC_FORMATS = ("delta", "iceberg", "hudi")


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{place}")


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def table_ddl(spec: TableSpec, table: str, fmt: str = "parquet") -> str:
    columns = ",\n    ".join(
        f"{f.name} {f.clean.simpleString().upper()}{' NOT NULL' if f.required else ''}"
        for f in spec.fields
    )
    return f"CREATE TABLE {table} (\n    {columns}\n) USING {fmt}"


def create_table(spark: SparkSession, spec: TableSpec, table: str, fmt: str = "parquet") -> None:
    """Drop and declare ``table``.  Parquet does not enforce NOT NULL; check it with
    ``null_violations``."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(table_ddl(spec, table, fmt))


def register_table(
    spark: SparkSession, spec: TableSpec, table: str, path: str, fmt: str = "parquet"
) -> None:
    """Name files that are already written; no copy is made.

    A table that was registered before, with the same columns and format, is pointed at the
    new files in one step, so readers find the old rows or the new ones and never none.  Any
    other table of that name is dropped first.
    """
    if _can_be_moved(spark, spec, table, fmt):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.sql(f"REFRESH TABLE {table}")
        return
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"{table_ddl(spec, table, fmt)} LOCATION '{path}'")


def _can_be_moved(spark: SparkSession, spec: TableSpec, table: str, fmt: str) -> bool:
    if not spark.catalog.tableExists(table) or fmt in _ATOMIC_FORMATS:
        return False
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").take(1000)}
    same = [(f.name, f.clean.simpleString()) for f in spec.fields] == [
        (f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields
    ]
    return same and facts.get("Type") == "EXTERNAL" and facts.get("Provider") == fmt


def null_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``(column, nulls)`` for every NOT NULL column, in one aggregate."""
    required = [f.name for f in spec.fields if f.required]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in required]
            )
        )
    )


def save_table(
    df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace a managed table, schema included.

    For plain file formats the new table is written beside the old one and takes
    its name only when complete; until then the old one is there, at the last moment
    as ``<table>__previous``.  A failed write changes nothing, and the old table may
    be read by the very query that replaces it.
    """
    spark = df.sparkSession
    atomic = fmt in _ATOMIC_FORMATS
    target, previous = (table if atomic else f"{table}__incoming"), f"{table}__previous"
    if not atomic:
        spark.sql(f"DROP TABLE IF EXISTS {target}")
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(target)
    if atomic:
        return
    if spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE IF EXISTS {previous}")
        spark.sql(f"ALTER TABLE {table} RENAME TO {previous}")
    spark.sql(f"ALTER TABLE {target} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {previous}")


def load_table(df: DataFrame, table: str) -> None:
    """Overwrite the rows of a declared table, columns matched by name."""
    columns = df.sparkSession.table(table).columns
    df.select(*columns).write.insertInto(table, overwrite=True)


def by_month(df: DataFrame, date: str) -> DataFrame:
    """Add ``year`` and ``month`` of a date and gather the rows of each month.

    The rebalance gives a month as many tasks (and files) as its size asks for: one
    file for a small month, a split for a month with a third of all rows.
    """
    dated = df.withColumn("year", F.year(date)).withColumn("month", F.month(date))
    return dated.hint("rebalance", F.col("year"), F.col("month"))


def write_by_month(df: DataFrame, path: str, date: str) -> None:
    by_month(df, date).write.mode("overwrite").partitionBy("year", "month").parquet(path)


def read_month(spark: SparkSession, path: str, year: int, month: int) -> DataFrame:
    """One month of ``write_by_month``; the other months' folders are not opened."""
    return spark.read.parquet(path).filter((F.col("year") == year) & (F.col("month") == month))


def clustered(df: DataFrame, key: str, unique: str) -> DataFrame:
    """Range-partition and sort by ``key`` so that a filter on it skips files.

    ``unique`` is the second range column: it lets a hot key spread over tasks.
    """
    return df.repartitionByRange(key, unique).sortWithinPartitions(key, unique)


# --- several columns ------------------------------------------------------------

_CURVE_BITS = 6


def clustered_by(
    df: DataFrame, columns: Sequence[str], unique: str, files: int | None = None
) -> DataFrame:
    """Lay rows out along a space-filling curve, so that a filter on any of ``columns`` skips files.

    Every column is cut into 64 ranges of about equal rows (one job finds the limits with a
    sketch, some kilobytes), so skewed values still spread; the bits of the ranges are woven
    into one number, and rows are range-partitioned and sorted by it.  ``unique`` is the last
    range column: it lets rows that agree on all others spread over tasks.  Texts are ranged
    by their first seven bytes.  NULL is the lowest range.  With more columns each skips less.
    """
    values = [_rankable(df, c) for c in columns]
    shares = ", ".join(f"{k / 2**_CURVE_BITS}D" for k in range(1, 2**_CURVE_BITS))
    limits = df.selectExpr(
        *[f"percentile_approx({v}, array({shares}), 1000) AS c{k}" for k, v in enumerate(values)]
    ).first()
    bits = []
    for k, value in enumerate(values):
        # A value that is many limits at once (a hot one) takes the lowest of its ranges.
        cuts = sorted(set(limits[k] or []))
        if not cuts:
            continue
        ranges = ", ".join(f"{c!r}D" if isinstance(c, float) else f"{c}L" for c in cuts)
        rank = f"coalesce(size(filter(array({ranges}), c -> c < {value})), 0)"
        for bit in range(_CURVE_BITS):
            place = bit * len(columns) + k
            bits.append(f"shiftleft(CAST(shiftright({rank}, {bit}) & 1 AS BIGINT), {place})")
    curve = unused("_curve", df.columns)
    placed = df.withColumn(curve, F.expr(" + ".join(bits) if bits else "0L"))
    by = [F.col(curve), F.col(quoted(unique))]
    dealt = placed.repartitionByRange(files, *by) if files else placed.repartitionByRange(*by)
    return dealt.sortWithinPartitions(*by).drop(curve)


def _rankable(df: DataFrame, column: str) -> str:
    """SQL for a number in the order of the column's values."""
    name, kind = quoted(column), df.select(quoted(column)).schema.fields[0].dataType
    if isinstance(kind, StringType):
        return f"CAST(conv(rpad(hex(substring(CAST({name} AS BINARY), 1, 7)), 14, '0'), 16, 10) AS BIGINT)"
    if isinstance(kind, DateType):
        return f"CAST(unix_date({name}) AS BIGINT)"
    if isinstance(kind, TimestampType):
        return f"unix_micros({name})"
    if isinstance(kind, IntegralType | BooleanType):
        return f"CAST({name} AS BIGINT)"
    if isinstance(kind, NumericType):
        return f"CAST({name} AS DOUBLE)"
    raise ValueError(f"{column} has no order to lay files out by")
