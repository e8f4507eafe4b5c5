"""The whole job: raw tables in, clean tables, quarantine and reports out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltgate.operators.referential import (
    Split,
    require_unique_parents,
    split_by_parent,
    tag_parent,
    with_reason,
)
from siltgate.operators.skew import hot_routes
from siltgate.plans import reports
from siltgate.plans.cleaning import (
    REFUSED,
    clean,
    clean_tagged,
    count_stages,
    raw_name,
    row_counts,
    unreadable_dates,
)
from siltgate.sources.csv import write_csv
from siltgate.sources.staging import staging_dir, written
from siltgate.sources.tables import create_schema, register_table
from siltgate.spec import TableSpec

# Needs the columns ``refused`` and ``has_parent``.
OUTCOME = f"""CASE WHEN {REFUSED} IS NOT NULL THEN 'refused'
    WHEN has_parent THEN 'clean' ELSE 'orphan' END AS outcome"""

Arrival = Mapping[str, Sequence[str]]


# --- lazy form -----------------------------------------------------------------


def clean_all(
    raw: Mapping[str, DataFrame],
    specs: Mapping[str, TableSpec],
    arrival: Arrival,
    upto: str | None = None,
) -> dict[str, Split]:
    """Valid and orphaned rows of every table, or of those up to ``upto``, as plans.
    Only the look at the foreign keys of each child runs now, one job over one column.
    ``specs`` names a parent before its children.

    Children are checked against the cleaned parent, so an order of a refused
    customer is an orphan, and so is a payment of a refused or orphaned order.
    """
    require_unique_parents(specs)
    done: dict[str, Split] = {}
    for name, spec in specs.items():
        kept = clean(raw[name], spec, arrival[name])
        if spec.foreign_key is None:
            done[name] = Split(kept, kept.filter("false"))
        else:
            hot = hot_routes(raw[name], [spec.foreign_key.column])
            parent = done[spec.foreign_key.parent].valid
            done[name] = split_by_parent(kept, parent, spec, hot)
        if name == upto:
            break
    return done


def quarantine_reasons(
    raw: Mapping[str, DataFrame],
    specs: Mapping[str, TableSpec],
    arrival: Arrival,
    table: str,
) -> DataFrame:
    """Quarantined rows with the reason they have no parent."""
    spec = specs[table]
    orphans = clean_all(raw, specs, arrival, table)[table].orphans
    hot = hot_routes(raw[table], [spec.foreign_key.column])
    return with_reason(orphans, raw[spec.foreign_key.parent], spec, hot)


# --- written form --------------------------------------------------------------


@dataclass(frozen=True)
class BatchResult:
    tables: dict[str, DataFrame]
    quarantine: dict[str, DataFrame]
    unreadable: DataFrame
    counts: DataFrame
    as_of: dt.date | None

    def reports(self) -> dict[str, DataFrame]:
        return all_reports(self.tables, self.as_of)


def run_batch(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    specs: Mapping[str, TableSpec],
    arrival: Arrival,
    *,
    out_dir: str | None = None,
    schema: str | None = None,
    as_of: dt.date | None = None,
    quarantine_csv: bool = True,
    keep_raw: bool = False,
) -> BatchResult:
    """Clean every table once, write it, and build everything else on what is written.

    The raw input is read once per table and written as it is to ``out_dir/raw``, from
    where the look at the foreign keys, the cleaning and the raw count read what they
    need: text files would be parsed three times.  Then one job cleans each table:
    keep-first and the foreign key are its only shuffles, and the rows land in folders ``outcome=clean|orphan|refused`` under ``out_dir`` (by
    default a fresh folder under ``spark.checkpoint.dir``).  Children, quarantine,
    counts and reports read those folders, so nothing is computed twice and a lost
    executor never sends a later stage back to the raw files.  Counts are observed by the
    jobs that write, in their last stage, where Spark takes each task's numbers once; they
    are held against the number of rows in the files' footers, and only if those differ
    are the files counted.

    With ``schema`` the clean folders are registered as catalog tables in place, after
    all of them are written: a run that fails leaves the tables of the last one.  For
    that, let every run have its own ``out_dir``.  ``keep_raw`` adds the text of
    unreadable dates to the quarantine.
    """
    require_unique_parents(specs)
    out = out_dir or staging_dir(spark, "batch")
    counts: list[DataFrame] = []
    arrived: dict[str, int | None] = {}
    for name in specs:
        seen = Observation()
        whole = raw[name].observe(seen, F.count(F.lit(1)).alias("n"))
        raw = {**raw, name: written(whole, f"{out}/raw/{name}")}
        arrived[name] = _agreed(seen, raw[name], "n")
    staged: dict[str, DataFrame] = {}
    tables: dict[str, DataFrame] = {}
    quarantine: dict[str, DataFrame] = {}
    for name, spec in specs.items():
        rows = clean_tagged(raw[name], spec, arrival[name])
        if spec.foreign_key:
            hot = hot_routes(raw[name], [spec.foreign_key.column])
            rows = tag_parent(rows, tables[spec.foreign_key.parent], spec, hot=hot)
        else:
            rows = rows.selectExpr("*", "true AS has_parent")
        rows = rows.selectExpr("*", OUTCOME)
        path = f"{out}/{name}"
        seen, stages = Observation(), count_stages(spec)
        rows.observe(
            seen, *[F.expr(f"count_if({rule})").alias(s) for s, rule in stages.items()]
        ).write.mode("overwrite").partitionBy("outcome").parquet(path)

        staged[name] = spark.read.schema(rows.schema).parquet(path)
        if arrived[name] is None or _agreed(seen, staged[name], "kept_first") is None:
            counts.append(row_counts(raw[name], staged[name], spec))
        else:
            lines = [(name, "raw", arrived[name])] + [(name, s, seen.get[s]) for s in stages]
            counts.append(spark.createDataFrame(lines, _COUNTS))
        tables[name] = staged[name].filter("outcome = 'clean'").select(*spec.columns)
        if spec.foreign_key:
            extra = [raw_name(c) for c in spec.date_columns] if keep_raw else []
            orphans = staged[name].filter("outcome = 'orphan'").select(*spec.columns, *extra)
            quarantine[name] = orphans
            if quarantine_csv:
                write_csv(orphans, f"{out}/quarantine/{name}")

    if schema:
        create_schema(spark, schema)
        for name, spec in specs.items():
            register_table(
                spark, spec, f"{schema}.{name}", f"{out}/{name}/outcome=clean"
            )

    return BatchResult(
        tables=tables,
        quarantine=quarantine,
        unreadable=_union(
            unreadable_dates(staged[n].filter("outcome != 'refused'"), specs[n])
            for n in specs
        ),
        counts=_union(counts),
        as_of=as_of,
    )


_COUNTS = "table_name string, stage string, n long"


def _agreed(seen: Observation, stored: DataFrame, metric: str) -> int | None:
    """What was observed, if the files' footers say the same; None if they do not."""
    n = seen.get.get(metric)
    return n if n == stored.count() else None


def all_reports(
    tables: Mapping[str, DataFrame], as_of: dt.date | None = None
) -> dict[str, DataFrame]:
    customers, orders, payments = (
        tables[name] for name in ("customers", "orders", "payments")
    )
    return {
        "revenue_per_customer": reports.revenue_per_customer(customers, orders),
        "monthly_revenue": reports.monthly_revenue(orders),
        "unpaid_customers": reports.unpaid_customers(customers, orders, payments),
        "top_customers": reports.top_customers(customers, orders),
        "inactive_customers": reports.inactive_customers(customers, orders, as_of=as_of),
    }


def _union(frames) -> DataFrame:
    whole = None
    for frame in frames:
        whole = frame if whole is None else whole.unionByName(frame)
    return whole
