"""Typed CSV scans and the quarantine sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siltgate.functions import blank_out, quoted
from siltgate.spec import TableSpec

MODES = ("PERMISSIVE", "DROPMALFORMED", "FAILFAST")


def csv_options(
    spec: TableSpec,
    header: bool = True,
    mode: str = "PERMISSIVE",
    check_header: bool = False,
    corrupt_column: str | None = None,
    multi_line: bool = False,
) -> tuple[StructType, dict[str, str]]:
    """Schema and reader options, the same for a batch scan and a file stream."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    schema = spec.raw_schema()
    options = {"header": str(header).lower(), "mode": mode, "escape": '"'}
    if multi_line:
        options["multiLine"] = "true"
    if check_header:
        # By default columns bind by position and a reordered file shifts silently.
        options["enforceSchema"] = "false"
    if corrupt_column:
        schema = StructType([*schema.fields, StructField(corrupt_column, StringType(), True)])
        options["columnNameOfCorruptRecord"] = corrupt_column
    return schema, options


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    spec: TableSpec,
    *,
    header: bool = True,
    mode: str = "PERMISSIVE",
    check_header: bool = False,
    corrupt_column: str | None = None,
    null_tokens: Sequence[str] = (),
    multi_line: bool = False,
    skip_unreadable_files: bool = False,
) -> DataFrame:
    """Read CSV under the declared schema; no inference pass over the files.

    ``mode`` decides about cells that do not fit: PERMISSIVE makes them NULL (and
    keeps the line in ``corrupt_column`` if one is named), DROPMALFORMED leaves the
    row out, FAILFAST stops the job.  Empty cells are NULL; ``null_tokens`` are
    words to be read as NULL too.  ``multi_line`` reads quoted cells with line breaks
    whole; each file is then one task, so it is an option and not the rule.  A file that
    cannot be read stops the job; with ``skip_unreadable_files`` the files are read through
    first and those that fail are left out as a whole, with a warning (``scan_readable``
    names them with their reasons).
    """
    if skip_unreadable_files:
        from siltgate.sources.files import scan_readable

        return scan_readable(
            spark, path, spec, header=header, mode=mode, check_header=check_header,
            corrupt_column=corrupt_column, null_tokens=null_tokens, multi_line=multi_line,
        ).rows
    schema, options = csv_options(spec, header, mode, check_header, corrupt_column, multi_line)
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.schema(schema).options(**options).csv(paths)
    if corrupt_column or mode != "PERMISSIVE":
        df = read_every_cell(df, spec)
    if not null_tokens:
        return df
    texts = {f.name for f in spec.fields if isinstance(f.raw, StringType)}
    return df.select(
        *[
            blank_out(c, null_tokens).alias(c) if c in texts else F.col(c)
            for c in df.columns
        ]
    )


def read_every_cell(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keep Spark from skipping cells a query does not use.

    A skipped cell is not checked, so which rows are malformed would depend on the
    columns that are read.  The filter is always true and needs all of them.
    """
    return df.filter(f"(xxhash64({', '.join(map(quoted, spec.columns))}) | 1L) != 0L")


def malformed(df: DataFrame, corrupt_column: str) -> DataFrame:
    """Rows whose line did not fit the schema."""
    return df.filter(F.col(corrupt_column).isNotNull())


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with CSV files.

    With ``scan_csv(..., multi_line=True)`` they read back to the same values, line
    breaks included, but for empty text, which CSV does not tell from NULL: it comes back
    as NULL.  Without that option a cell with a line break is cut in two rows.

    Written even if there are no rows, so that an earlier run's quarantine does
    not survive a clean one.  Blanks at the ends of a cell are kept.
    """
    df.write.mode("overwrite").options(
        header="true",
        escape='"',
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)
