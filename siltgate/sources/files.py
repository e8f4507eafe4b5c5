"""Which input files can be read, and why the others cannot.

Spark can skip files it fails to read, but says so in a log only, and a file that breaks off
in the middle is skipped after its first rows were taken.  Here the files are read once as
plain lines before they are used.  If that works, nothing is skipped and no file is looked
at for itself.  If not, the list is halved again and again until the broken files stand
alone: one job for each half, so a few broken files among many cost a few jobs more.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from siltgate.sources.csv import scan_csv
from siltgate.spec import TableSpec

_STRICT = {"ignoreCorruptFiles": "false", "ignoreMissingFiles": "false"}
_SKIPPED = "file string, bytes long, reason string"


@dataclass(frozen=True)
class ReadableFiles:
    """``rows`` of the files that can be read; ``skipped`` names the others, one row each."""

    rows: DataFrame
    skipped: DataFrame


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file, bytes`` of all input files under ``path``, in folders below too; none is opened.
    Files without a byte are not listed."""
    paths = [path] if isinstance(path, str) else list(path)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return listed.selectExpr("path AS file", "length AS bytes")


def unreadable_files(
    spark: SparkSession, path: str | Sequence[str], files: Sequence[str] | None = None
) -> DataFrame:
    """``file, bytes, reason`` of the files under ``path`` that cannot be read to their end.

    ``files`` are names from an earlier listing: those that are gone since then are reported
    too, with no size.
    """
    there = _names(list_files(spark, path))
    broken = _broken(spark, there)
    gone = [(name, "the file is not there any more") for name in set(files or ()) - set(there)]
    found = spark.createDataFrame(sorted(broken + gone), "file string, reason string")
    sizes = list_files(spark, path)
    return found.join(sizes, "file", "left").select("file", "bytes", "reason")


def scan_readable(
    spark: SparkSession,
    path: str | Sequence[str],
    spec: TableSpec,
    files: Sequence[str] | None = None,
    **options,
) -> ReadableFiles:
    """``scan_csv`` over the files that can be read as a whole, and a report of the others.

    A file is taken whole or not at all.  One pass over the files comes before the scan.
    Without a readable file there are no rows.
    """
    skipped = unreadable_files(spark, path, files)
    left_out = set(_names(skipped))
    good = [name for name in _names(list_files(spark, path)) if name not in left_out]
    if left_out:
        warnings.warn(
            f"{len(left_out)} of {len(good) + len(left_out)} files of {path} are skipped, "
            f"such as {min(left_out)}",
            stacklevel=2,
        )
    if good:
        return ReadableFiles(scan_csv(spark, good, spec, **options), skipped)
    return ReadableFiles(spark.createDataFrame([], spec.raw_schema()), skipped)


def _names(listed: DataFrame) -> list[str]:
    """File names on the driver, where Spark's own listing of an input has them as well."""
    return sorted(row["file"] for row in listed.select("file").toLocalIterator())


def _broken(spark: SparkSession, files: list[str]) -> list[tuple[str, str]]:
    if not files:
        return []
    reason = _failure(spark, files)
    if reason is None:
        return []
    if len(files) == 1:
        return [(files[0], reason)]
    half = len(files) // 2
    return _broken(spark, files[:half]) + _broken(spark, files[half:])


def _failure(spark: SparkSession, files: list[str]) -> str | None:
    """Why reading these files fails; None if it does not."""
    try:
        lines = spark.read.options(**_STRICT).option("recursiveFileLookup", "true").text(files)
        lines.write.format("noop").mode("overwrite").save()
    except (PySparkException, Py4JJavaError) as error:
        return _root_cause(error)
    return None


def _root_cause(error: Exception) -> str:
    """The innermost Java exception in one line, without the stack."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    if cause is None:
        return str(error).splitlines()[0]
    while cause.getCause() is not None:
        cause = cause.getCause()
    return str(cause.toString()).splitlines()[0]
