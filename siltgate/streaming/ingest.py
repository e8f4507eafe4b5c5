"""Incremental ingest: read the files that are new, once each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltgate.functions import quoted, unused
from siltgate.operators.joins import BROADCAST_BYTES, measures_at_most, rows_with_keys
from siltgate.operators.referential import tag_parent, with_parent, without_parent
from siltgate.operators.skew import hot_routes
from siltgate.plans.batch import OUTCOME
from siltgate.plans.cleaning import clean_tagged
from siltgate.sources.csv import csv_options, read_every_cell
from siltgate.sources.staging import staging_dir, written
from siltgate.spec import TableSpec
from siltgate.streaming.history import UsedKeys

# Inside the target: a target and the record of what it has seen belong together.
# Names with a leading underscore are not read as data.
_CHECKPOINT = "_checkpoint"


def scan_csv_stream(
    spark: SparkSession,
    directory: str,
    spec: TableSpec,
    *,
    header: bool = True,
    mode: str = "PERMISSIVE",
    max_files: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Stream of a growing folder of CSV files, ``max_files`` per micro-batch."""
    schema, options = csv_options(spec, header, mode, multi_line=multi_line)
    reader = spark.readStream.schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.csv(directory)
    return stream if mode == "PERMISSIVE" else read_every_cell(stream, spec)


def ingest_new_files(stream: DataFrame, target: str, timeout: int | None = None) -> None:
    """Append what has arrived since the last call to parquet files, then stop."""
    _finish(
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", f"{target}/{_CHECKPOINT}")
        .trigger(availableNow=True)
        .start(),
        timeout,
    )


def clean_new_files(
    stream: DataFrame,
    spec: TableSpec,
    target: str,
    *,
    parent: DataFrame | None = None,
    arrival: Sequence[str] | None = None,
    timeout: int | None = None,
) -> None:
    """Clean what has arrived since the last call, as if all files were one table.

    A batch drops the repeats inside it and the keys an earlier batch has used,
    whether that row was clean, an orphan or refused.  Rows land in
    ``target/batch_id=N/outcome=...``; a batch that is run again overwrites its own
    folder and ignores it when looking for used keys.  ``arrival`` orders the rows
    of a key in a batch; by default the time a file was last changed, its path and the
    place in it.  Files come to batches in order of that time too, so where the batches
    are cut makes no difference.

    An order that arrives before its customer is an orphan and keeps its key.  Whoever
    reads the result can have orphans looked up again, see ``read_cleaned``.

    History and parent grow and a batch does not.  A batch's keys are tested against a
    Bloom filter of those used before, and only buckets that may hold one of them are
    opened (see ``UsedKeys``); in the parent they are looked up by broadcast where they
    measure small, so that it is only scanned.
    """
    spark = stream.sparkSession
    order = list(arrival or ["_time", "_file", "_block", "_row"])
    if arrival is None:
        stream = stream.select(
            "*",
            F.col("_metadata.file_modification_time").alias("_time"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
        )

    def add(batch: DataFrame, batch_id: int) -> None:
        if arrival is None:
            batch = batch.withColumn("_row", F.monotonically_increasing_id())
        # Written, as it is read several times and must outlive lost executors.
        firsts = written(clean_tagged(batch, spec, order), staging_dir(spark, "micro-batch"))
        used = UsedKeys(spark, target, spec.key, spec.clean_schema()[spec.key].dataType)
        rows = used.unseen(firsts, batch_id)
        if spec.foreign_key:
            fk = spec.foreign_key
            wanted = rows_with_keys(parent, fk.parent_key, firsts.select(fk.column))
            hot = hot_routes(firsts, [fk.column])
            rows = tag_parent(rows, wanted, spec, hot=hot)
        else:
            rows = rows.selectExpr("*", "true AS has_parent")
        path = f"{target}/batch_id={batch_id}"
        rows.selectExpr("*", OUTCOME).write.mode("overwrite").partitionBy("outcome").parquet(path)
        used.add(spark.read.schema(rows.schema).parquet(path), batch_id)

    if spec.foreign_key and parent is None:
        raise ValueError(f"{spec.name} needs its parent table")
    _finish(
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", f"{target}/{_CHECKPOINT}")
        .trigger(availableNow=True)
        .start(),
        timeout,
    )
    spark.catalog.refreshByPath(target)


def read_cleaned(
    spark: SparkSession,
    spec: TableSpec,
    target: str,
    which: str,
    parent: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``clean_new_files`` with the outcome ``clean``, ``orphan`` or ``refused``.

    Orphans that ``settle_orphans`` has moved are among the clean rows, without a join.
    With ``parent``, the parent table of now, orphans whose parent has come since the last
    settling count as clean too.  Only the orphans are looked up again.
    """
    stored = spark.read.schema(_stored_schema(spec)).parquet(target)
    if which == "refused":
        return stored.filter("outcome = 'refused'").select(*spec.columns)
    settled = _last_settling(spark, target)
    rows = _settled(spark, spec, target, which, stored, settled)
    if parent is None or spec.foreign_key is None:
        return rows
    orphans = _settled(spark, spec, target, "orphan", stored, settled)
    if which == "orphan":
        return without_parent(orphans, parent, spec)
    return rows.unionByName(with_parent(orphans, parent, spec))


def settle_orphans(
    spark: SparkSession, spec: TableSpec, target: str, new_parents: DataFrame
) -> None:
    """Move stored orphans whose parent is among ``new_parents`` to the clean rows, for good.

    ``new_parents`` are the parent rows that came since the last time (``cleaned_since`` of
    the parent's own target); more do no harm.  The open orphans are joined with them once
    and written anew: found ones to a folder of this settling, the others to the one of two
    slots that is not being read.  The settling counts when its line in the log is written,
    last, so one that fails changes nothing and may be run again.  Settle between batches,
    not while one is running.
    """
    fk = spec.foreign_key
    if fk is None:
        raise ValueError(f"{spec.name} has no foreign key")
    last = _last_settling(spark, target)
    stored = spark.read.schema(_stored_schema(spec)).parquet(target)
    orphans = _settled(spark, spec, target, "orphan", stored, last)
    upto = stored.agg(F.max("batch_id")).first()[0]
    if upto is None:
        return
    parents = new_parents.select(quoted(fk.parent_key)).distinct()
    if measures_at_most(parents, BROADCAST_BYTES):
        parent_key, found = (unused(n, orphans.columns) for n in ("_parent_key", "has_parent"))
        right = parents.toDF(parent_key).selectExpr("*", f"true AS {found}")
        tagged = orphans.join(
            F.broadcast(right), F.expr(f"{quoted(fk.column)} = {parent_key}"), "left"
        ).selectExpr(*map(quoted, spec.columns), f"coalesce({found}, false) AS {found}")
    else:
        found = unused("has_parent", orphans.columns)
        tagged = tag_parent(orphans, parents, spec, flag=found)
    tagged = written(tagged, staging_dir(spark, "settling"))
    gen = 0 if last is None else last["gen"] + 1
    for rule, path in ((found, _moved(target, gen)), (f"NOT {found}", _open(target, gen))):
        tagged.filter(rule).select(*map(quoted, spec.columns)).write.mode("overwrite").parquet(path)
    line = spark.createDataFrame([(gen, upto)], _LOG)
    line.coalesce(1).write.mode("overwrite").parquet(f"{target}/_settled/log/line={gen}")


def cleaned_since(spark: SparkSession, spec: TableSpec, target: str, batch_id: int) -> DataFrame:
    """Clean rows of the batches after ``batch_id``; earlier batches' folders are not opened."""
    stored = spark.read.schema(_stored_schema(spec)).parquet(target)
    return stored.filter((F.col("batch_id") > batch_id) & (F.col("outcome") == "clean")).select(
        *map(quoted, spec.columns)
    )


_LOG = "gen long, upto long"


def _moved(target: str, gen: int) -> str:
    return f"{target}/_settled/moved/gen={gen}"


def _open(target: str, gen: int) -> str:
    return f"{target}/_settled/open/slot={gen % 2}"


def _last_settling(spark: SparkSession, target: str):
    """``gen, upto``: the last settling and the batch up to which it has seen orphans."""
    try:
        log = spark.read.schema(_LOG).parquet(f"{target}/_settled/log")
        return log.orderBy(F.desc("gen")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _stored_schema(spec: TableSpec) -> StructType:
    return StructType([*spec.clean_schema().fields]).add("outcome", "string").add(
        "batch_id", "long"
    )


def _settled(
    spark: SparkSession, spec: TableSpec, target: str, which: str, stored: DataFrame, settled
) -> DataFrame:
    """Clean rows or open orphans of the batches and of all settlings, by folders alone."""
    rows = stored.filter(F.col("outcome") == which)
    if settled is None:
        return rows.select(*map(quoted, spec.columns))
    if which == "orphan":
        rows = rows.filter(F.col("batch_id") > settled["upto"])
        also = spark.read.schema(spec.clean_schema()).parquet(_open(target, settled["gen"]))
    else:
        schema = StructType([*spec.clean_schema().fields]).add("gen", "long")
        also = spark.read.schema(schema).parquet(f"{target}/_settled/moved")
        also = also.filter(F.col("gen") <= settled["gen"])
    columns = [quoted(c) for c in spec.columns]
    return rows.select(*columns).unionByName(also.select(*columns))


def _finish(query, timeout: int | None) -> None:
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the stream did not finish within {timeout} s")
