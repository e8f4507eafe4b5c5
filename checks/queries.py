"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from checks.inputs import ARRIVAL, AS_OF, NATIVE_COMPLETED, SPECS
from siltgate import sources
from siltgate.functions import lower_trimmed, month_bucket, not_negative, parse_date, title_case
from siltgate.operators import (
    Covered,
    Distinct,
    Quantile,
    Rows,
    expect,
    expectation_report,
    hot_routes,
    join_parent,
    join_small_parent,
    keep_first,
    left_join_children,
    read_keyed,
    require,
    require_present,
    table_report,
    upsert,
    upsert_into,
    with_children,
    with_value,
    without_children,
    write_keyed,
)
from siltgate.plans import (
    clean,
    clean_all,
    increments,
    quarantine_reasons,
    refused_rows,
    reports,
    run_batch,
    unreadable_dates,
)
from siltgate.sources.csv import malformed
from siltgate.spec import retail_specs
from siltgate.streaming import (
    clean_new_files,
    ingest_new_files,
    read_cleaned,
    scan_csv_stream,
    settle_orphans,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _splits(spark: SparkSession, sf_dir: str, upto: str):
    return clean_all(inputs.raw_tables(spark, sf_dir, upto), SPECS, ARRIVAL, upto)


def _valid(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _splits(spark, sf_dir, name)[name].valid


def _orphans(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _splits(spark, sf_dir, name)[name].orphans


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return inputs.RAW[name](spark, sf_dir)


# --- reports on the adapters -------------------------------------------------------


@query
def q1_revenue_per_customer(spark, sf_dir):
    return reports.revenue_per_customer(
        inputs.customers(spark, sf_dir), inputs.native_orders(spark, sf_dir), NATIVE_COMPLETED
    )


@query
def q2_monthly_revenue(spark, sf_dir):
    return reports.monthly_revenue(inputs.native_orders(spark, sf_dir), NATIVE_COMPLETED)


@query
def q3_unpaid_customers(spark, sf_dir):
    return reports.unpaid_customers(
        inputs.customers(spark, sf_dir),
        inputs.native_orders(spark, sf_dir),
        inputs.payments(spark, sf_dir),
    )


@query
def q4_top_customers(spark, sf_dir):
    return reports.top_customers(
        inputs.customers(spark, sf_dir),
        inputs.native_orders(spark, sf_dir),
        status=NATIVE_COMPLETED,
    )


@query
def q5_inactive_customers(spark, sf_dir):
    return reports.inactive_customers(
        inputs.customers(spark, sf_dir), inputs.native_orders(spark, sf_dir), as_of=AS_OF
    )


# --- reports on cleaned raw tables ---------------------------------------------------


def _cleaned(spark: SparkSession, sf_dir: str, upto: str) -> list[DataFrame]:
    """Clean and checked tables, as a user of the reports has them."""
    return [split.valid for split in _splits(spark, sf_dir, upto).values()]


@query
def q1_clean(spark, sf_dir):
    return reports.revenue_per_customer(*_cleaned(spark, sf_dir, "orders"))


@query
def q2_clean(spark, sf_dir):
    return reports.monthly_revenue(_valid("orders", spark, sf_dir))


@query
def q3_clean(spark, sf_dir):
    return reports.unpaid_customers(*_cleaned(spark, sf_dir, "payments"))


@query
def q4_clean(spark, sf_dir):
    return reports.top_customers(*_cleaned(spark, sf_dir, "orders"))


@query
def q5_clean(spark, sf_dir):
    return reports.inactive_customers(*_cleaned(spark, sf_dir, "orders"), as_of=AS_OF)


# --- scans -----------------------------------------------------------------------


def _csv_round_trip(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sources.staging_dir(spark, f"csv-{name}")
    sources.write_csv(_raw(spark, sf_dir, name).select(*SPECS[name].columns), path)
    return sources.scan_csv(spark, path, SPECS[name], check_header=True)


for name in SPECS:
    QUERIES[f"scan_csv_{name}"] = partial(_csv_round_trip, name)


@query
def scan_csv_by_position(spark, sf_dir):
    """INT keys, columns bound by position under a header with other names."""
    path = sources.staging_dir(spark, "csv-position")
    columns = retail_specs()["orders"].columns
    rows = inputs.raw_orders(spark, sf_dir).select(*columns)
    sources.write_csv(rows.toDF(*[f"c{k}" for k in range(len(columns))]), path)
    return sources.scan_csv(spark, path, retail_specs()["orders"])


@query
def malformed_rows(spark, sf_dir):
    """Order lines as text, some with a word for an amount or a cell too many."""
    path = _messy_lines(spark, sf_dir)
    read = sources.scan_csv(
        spark, path, SPECS["orders"], header=False, corrupt_column="bad_line"
    )
    return malformed(read, "bad_line").select("order_id", "customer_id", "amount", "bad_line")


@query
def wellformed_rows(spark, sf_dir):
    """The same lines without those that do not fit."""
    path = _messy_lines(spark, sf_dir)
    read = sources.scan_csv(spark, path, SPECS["orders"], header=False, mode="DROPMALFORMED")
    return read.select("order_id", "customer_id", "amount", "status")


def _messy_lines(spark: SparkSession, sf_dir: str) -> str:
    order = F.col("order_id")
    price = F.col("amount").cast("decimal(15,2)").cast("string")
    amount = F.when(order % 50 == 7, F.lit("abc")).otherwise(price)
    tail = F.when(order % 50 == 8, F.lit(",extra")).otherwise(F.lit(""))
    line = F.concat(
        F.concat_ws(
            ",", order.cast("string"), F.col("customer_id").cast("string"), F.lit("2024-01-15"),
            amount, F.col("status"),
        ),
        tail,
    )
    path = sources.staging_dir(spark, "malformed")
    inputs.native_orders(spark, sf_dir).select(line.alias("value")).write.text(path)
    return path


# --- sinks -----------------------------------------------------------------------


@query
def quarantine_text_csv(spark, sf_dir):
    """Cells with line breaks, quotes, commas and blanks, written and read back."""
    path = sources.staging_dir(spark, "text-csv")
    messy = inputs.raw_customers(spark, sf_dir).withColumn(
        "name",
        F.expr(
            """CASE customer_id % 6 WHEN 0 THEN name || chr(10) || 'b'
            WHEN 1 THEN name || chr(13) || chr(10) || 'c' WHEN 2 THEN name || ',"q"'
            WHEN 3 THEN '' WHEN 4 THEN ' ' || name || ' ' ELSE name END"""
        ),
    )
    sources.write_csv(messy.select(*SPECS["customers"].columns), path)
    return sources.scan_csv(spark, path, SPECS["customers"], multi_line=True)


def _quarantine_csv(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sources.staging_dir(spark, f"quarantine-{name}")
    orphans = _orphans(name, spark, sf_dir)
    sources.write_csv(orphans, path)
    return spark.read.schema(orphans.schema).csv(path, header=True, multiLine=True)


for name in ("orders", "payments"):
    QUERIES[f"quarantine_{name}_csv"] = partial(_quarantine_csv, name)


def _fresh_schema(spark: SparkSession) -> str:
    location = sources.staging_dir(spark, "schema")
    schema = "s" + location.rsplit("-", 1)[1]
    sources.create_schema(spark, schema, location)
    return schema


def _table_round_trip(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{_fresh_schema(spark)}.{name}"
    rows = clean(_raw(spark, sf_dir, name), SPECS[name], ARRIVAL[name])
    sources.save_table(rows, table)
    return sources.read_table(spark, table)


for name in SPECS:
    QUERIES[f"table_roundtrip_{name}"] = partial(_table_round_trip, name)


@query
def ddl_create_tables(spark, sf_dir):
    """Declare the order table, load it, read it; extra columns must not slip in."""
    table = f"{_fresh_schema(spark)}.orders"
    sources.create_table(spark, SPECS["orders"], table)
    sources.load_table(inputs.orders(spark, sf_dir), table)
    return sources.read_table(spark, table)


@query
def ddl_replace_tables(spark, sf_dir):
    """All three tables declared, loaded, dropped and declared anew, loaded again."""
    schema = _fresh_schema(spark)
    found = None
    for name, source in (
        ("customers", inputs.customers),
        ("orders", inputs.orders),
        ("payments", inputs.payments),
    ):
        table, spec = f"{schema}.{name}", SPECS[name]
        rows = source(spark, sf_dir)
        missing = [c for c in spec.columns if c not in rows.columns]
        rows = rows.select(
            "*", *[F.lit(None).cast(spec.clean_schema()[c].dataType).alias(c) for c in missing]
        )
        for _ in range(2):
            sources.create_table(spark, spec, table)
            sources.load_table(rows, table)
        part = sources.read_table(spark, table).select(
            F.lit(name).alias("table_name"), F.col(spec.key).alias("row_key")
        )
        found = part if found is None else found.unionByName(part)
    return found


@query
def partitioned_orders_month(spark, sf_dir):
    """One month out of the table that is laid out by month."""
    path = sources.staging_dir(spark, "by-month")
    sources.write_by_month(inputs.orders(spark, sf_dir), path, "order_date")
    return sources.read_month(spark, path, 1995, 3).select(
        *SPECS["orders"].columns, "year", "month"
    )


@query
def partitioned_orders(spark, sf_dir):
    path = sources.staging_dir(spark, "by-month")
    sources.write_by_month(inputs.orders(spark, sf_dir), path, "order_date")
    return spark.read.parquet(path)


@query
def clustered_orders(spark, sf_dir):
    laid_out = sources.clustered(inputs.orders(spark, sf_dir), "customer_id", "order_id")
    return sources.written(laid_out, sources.staging_dir(spark, "clustered"))


@query
def clustered_orders_two_columns(spark, sf_dir):
    """Laid out by customer and date at once, read back for some of each."""
    laid_out = sources.clustered_by(
        inputs.orders(spark, sf_dir), ["customer_id", "order_date"], "order_id", files=32
    )
    stored = sources.written(laid_out, sources.staging_dir(spark, "curve"))
    return stored.filter("customer_id < 500 OR order_date < DATE '1993-01-01'")


@query
def upsert_orders(spark, sf_dir):
    """The repeats of the raw orders, and orders under new keys, go into the table."""
    raw = inputs.raw_orders(spark, sf_dir)
    repeats = raw.filter("seq = 1")
    new = repeats.withColumn("order_id", F.col("order_id") + 1_000_000_000)
    return upsert(
        raw.filter("seq = 0"), repeats.unionByName(new), "order_id", ["seq DESC"]
    ).drop("seq")


@query
def upsert_table_orders(spark, sf_dir):
    """The same changes into a written table, applied twice."""
    raw = inputs.raw_orders(spark, sf_dir)
    repeats = raw.filter("seq = 1")
    new = repeats.withColumn("order_id", F.col("order_id") + 1_000_000_000)
    path = sources.staging_dir(spark, "keyed")
    write_keyed(raw.filter("seq = 0").drop("seq"), path, "order_id")
    for _ in range(2):
        upsert_into(spark, path, repeats.unionByName(new), "order_id", ["seq DESC"])
    return read_keyed(spark, path)


# --- input files ---------------------------------------------------------------------


def _orders_with_broken_files(spark: SparkSession, sf_dir: str):
    """Compressed files of orders by status; those with status P came uncompressed under a
    name that says otherwise."""
    path = sources.staging_dir(spark, "files")
    rows = inputs.native_orders(spark, sf_dir)
    packed = rows.filter("status != 'P'").select(*SPECS["orders"].columns)
    packed.write.options(header="true", compression="gzip").csv(path)
    plain = f"{path}-plain"
    rows.filter("status = 'P'").select(*SPECS["orders"].columns).write.option(
        "header", "true"
    ).csv(plain)
    java = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for k, row in enumerate(sources.list_files(spark, plain).toLocalIterator()):
        source, target = java.Path(row["file"]), java.Path(f"{path}/broken-{k}.csv.gz")
        files = source.getFileSystem(conf)
        java.FileUtil.copy(files, source, files, target, False, conf)
    return sources.scan_readable(spark, path, SPECS["orders"])


@query
def readable_files_orders(spark, sf_dir):
    return _orders_with_broken_files(spark, sf_dir).rows


@query
def skipped_files_orders(spark, sf_dir):
    """Which files could not be read, why, and the statuses that are missing with them."""
    found = _orders_with_broken_files(spark, sf_dir)
    statuses = inputs.native_orders(spark, sf_dir).select("status").distinct()
    missing = statuses.join(found.rows.select("status").distinct(), "status", "left_anti")
    named = found.skipped.selectExpr(
        "regexp_replace(element_at(split(file, '/'), -1), '[0-9]+', 'N') AS file",
        "contains(lower(reason), 'gzip') OR contains(lower(reason), 'header') AS names_the_reason",
    ).distinct()
    gone = missing.agg(F.collect_list("status")).scalar()  # three statuses at most
    return named.withColumn("missing_status", F.explode(gone))


# --- filters and scalar functions ----------------------------------------------------


@query
def drop_null_name(spark, sf_dir):
    return require_present(inputs.raw_customers(spark, sf_dir), ["name"])


@query
def drop_invalid_amount(spark, sf_dir):
    return require(inputs.raw_orders(spark, sf_dir), not_negative("amount"))


@query
def filter_completed(spark, sf_dir):
    return with_value(inputs.native_orders(spark, sf_dir), "status", NATIVE_COMPLETED)


@query
def unparsed_dates(spark, sf_dir):
    raw = inputs.raw_tables(spark, sf_dir)
    report = None
    for name, spec in SPECS.items():
        rows = clean(raw[name], spec, ARRIVAL[name], keep_raw=True)
        part = unreadable_dates(rows, spec)
        report = part if report is None else report.unionByName(part)
    return report


@query
def unparsed_customer_dates(spark, sf_dir):
    """Unreadable dates with the name that tells whose they are."""
    spec = SPECS["customers"]
    rows = clean(inputs.raw_customers(spark, sf_dir), spec, ARRIVAL["customers"], keep_raw=True)
    return unreadable_dates(rows, spec, context=["name"])


def _parse_dates(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SPECS[name]
    column = spec.date_columns[0]
    return _raw(spark, sf_dir, name).select(
        spec.key, F.col(column).alias("original"), parse_date(column).alias("parsed")
    )


for name in SPECS:
    QUERIES[f"parse_dates_{name}"] = partial(_parse_dates, name)


@query
def normalise_country(spark, sf_dir):
    return inputs.raw_customers(spark, sf_dir).select(
        "customer_id", title_case("country").alias("country")
    )


@query
def normalise_order_status(spark, sf_dir):
    return inputs.raw_orders(spark, sf_dir).select(
        "order_id", lower_trimmed("status").alias("status")
    )


@query
def normalise_payment_status(spark, sf_dir):
    return inputs.raw_payments(spark, sf_dir).select(
        "payment_id", lower_trimmed("payment_status").alias("payment_status")
    )


def _month_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.native_orders(spark, sf_dir).select(
        "order_id", month_bucket("order_date").alias("month")
    )


QUERIES["month_bucket"] = _month_of_orders


# --- deduplication -----------------------------------------------------------------


def _dedup(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SPECS[name]
    return keep_first(_raw(spark, sf_dir, name), [spec.key], ARRIVAL[name]).select(*spec.columns)


for name in SPECS:
    QUERIES[f"dedup_{name}"] = partial(_dedup, name)


@query
def dedup_documents(spark, sf_dir):
    return keep_first(
        inputs.table(spark, sf_dir, "documents").select("doc_id", "text"),
        ["text"],
        ["doc_id"],
        by_hash=True,
    )


# --- joins -----------------------------------------------------------------------


for name in ("orders", "payments"):
    QUERIES[f"fk_valid_{name}"] = partial(_valid, name)
    QUERIES[f"fk_orphan_{name}"] = partial(_orphans, name)


def _reasons(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_reasons(inputs.raw_tables(spark, sf_dir, name), SPECS, ARRIVAL, name)


for name in ("orders", "payments"):
    QUERIES[f"quarantine_reasons_{name}"] = partial(_reasons, name)


@query
def join_inner(spark, sf_dir):
    return join_parent(
        inputs.native_orders(spark, sf_dir),
        inputs.customers(spark, sf_dir),
        "customer_id",
        "order_id",
    )


@query
def join_left(spark, sf_dir):
    return left_join_children(
        inputs.customers(spark, sf_dir),
        inputs.native_orders(spark, sf_dir),
        "customer_id",
        "order_id",
    )


@query
def exists_orders(spark, sf_dir):
    return with_children(
        inputs.customers(spark, sf_dir), inputs.native_orders(spark, sf_dir), "customer_id"
    )


def _paid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = with_value(inputs.payments(spark, sf_dir), "payment_status", "success")
    return with_children(inputs.native_orders(spark, sf_dir), paid, "order_id")


@query
def distinct_paid_customers(spark, sf_dir):
    return _paid_orders(spark, sf_dir).select("customer_id").distinct()


@query
def not_in_paid(spark, sf_dir):
    return without_children(
        inputs.customers(spark, sf_dir), _paid_orders(spark, sf_dir), "customer_id"
    )


@query
def not_in_paid_null_aware(spark, sf_dir):
    """SQL's NOT IN, against raw orders some of which have lost their customer."""
    orders = inputs.raw_orders(spark, sf_dir)
    known = orders.withColumn(
        "customer_id", F.when(F.col("amount").isNotNull(), F.col("customer_id"))
    )
    return without_children(
        inputs.customers(spark, sf_dir), known, "customer_id", null_aware=True
    )


@query
def broadcast_join(spark, sf_dir):
    return join_small_parent(
        inputs.native_orders(spark, sf_dir),
        inputs.customers(spark, sf_dir),
        "customer_id",
        "order_id",
    )


@query
def hot_key_join(spark, sf_dir):
    """Payments to their status: two keys hold all rows, so both are joined in lanes."""
    lines = inputs.payments(spark, sf_dir)
    states = lines.select("payment_status").distinct().withColumn(
        "settled", F.col("payment_status") == "success"
    )
    hot = hot_routes(lines, ["payment_status"], min_rows=1, lane_rows=1000)
    return join_parent(lines, states, "payment_status", "payment_id", hot)


@query
def hot_key_join_mixed_types(spark, sf_dir):
    """Order amounts in cents as DECIMAL to a parent with INT keys, hot keys in lanes."""
    orders = inputs.native_orders(spark, sf_dir).selectExpr(
        "order_id", "CAST(IF(order_id % 3 = 0, 7, customer_id % 50) AS DECIMAL(12,2)) AS grp"
    )
    groups = spark.range(40).selectExpr("CAST(id AS INT) AS grp", "concat('g', id) AS name")
    hot = hot_routes(orders, ["grp"], min_rows=100, lane_rows=50)
    return join_parent(orders, groups, "grp", "order_id", hot).selectExpr(
        "order_id", "CAST(grp AS INT) AS grp", "name"
    )


# --- cleaning and reports about it -----------------------------------------------------


for name in SPECS:
    QUERIES[f"clean_{name}"] = partial(_valid, name)


def _refused(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return refused_rows(_raw(spark, sf_dir, name), SPECS[name], ARRIVAL[name])


for name in SPECS:
    QUERIES[f"refused_{name}"] = partial(_refused, name)


@query
def row_counts(spark, sf_dir):
    return run_batch(
        spark, inputs.raw_tables(spark, sf_dir), SPECS, ARRIVAL, quarantine_csv=False
    ).counts


@query
def whole_run_revenue(spark, sf_dir):
    """Raw tables through the whole job to the revenue report."""
    result = run_batch(spark, inputs.raw_tables(spark, sf_dir), SPECS, ARRIVAL, as_of=AS_OF)
    return result.reports()["revenue_per_customer"]


@query
def whole_run_top_customers(spark, sf_dir):
    """Raw tables to a registered schema, then the top report from that schema."""
    schema = _fresh_schema(spark)
    run_batch(spark, inputs.raw_tables(spark, sf_dir), SPECS, ARRIVAL, schema=schema)
    tables = {name: sources.read_table(spark, f"{schema}.{name}") for name in SPECS}
    return reports.top_customers(tables["customers"], tables["orders"])


def _whole_run(spark: SparkSession, sf_dir: str, report: str) -> DataFrame:
    result = run_batch(spark, inputs.raw_tables(spark, sf_dir), SPECS, ARRIVAL, as_of=AS_OF)
    return result.reports()[report]


@query
def whole_run_unpaid_customers(spark, sf_dir):
    return _whole_run(spark, sf_dir, "unpaid_customers")


@query
def whole_run_inactive_customers(spark, sf_dir):
    return _whole_run(spark, sf_dir, "inactive_customers")


def _order_rules() -> dict:
    return {
        "amount_valid": not_negative("amount"),
        "date_readable": parse_date("order_date").isNotNull(),
        "status_known": lower_trimmed("status").isin("completed", "pending", "cancelled"),
    }


@query
def expectations_warned(spark, sf_dir):
    """Every order with the names of the rules it breaks."""
    return expect(inputs.raw_orders(spark, sf_dir), _order_rules()).select(
        "order_id", "seq", F.array_join("failed_rules", ",").alias("failed_rules")
    )


@query
def expectations_that_stop(spark, sf_dir):
    """Which rules stop a job over all orders."""
    orders, found = inputs.raw_orders(spark, sf_dir), None
    for name, rule in {**_order_rules(), "has_a_key": F.col("order_id").isNotNull()}.items():
        broken = orders.filter(~F.coalesce(rule, F.lit(False))).limit(1).count()
        try:
            expect(orders, {name: rule}, "fail").write.format("noop").mode("overwrite").save()
            stopped = F.lit(False)
        except Exception as error:
            if name not in str(error):
                raise
            stopped = F.lit(True)
        part = orders.agg(
            F.lit(name).alias("rule"), stopped.alias("stops"),
            (F.count(F.lit(1)) > 0).alias("has_rows"), F.lit(broken).cast("long").alias("broken"),
        )
        found = part if found is None else found.unionByName(part)
    return found


@query
def csv_modes_orders(spark, sf_dir):
    """Rows that each reading mode gives of lines some of which do not fit; NULL if it stops."""
    path, found = _messy_lines(spark, sf_dir), None
    for mode in ("PERMISSIVE", "DROPMALFORMED", "FAILFAST"):
        lines = sources.scan_csv(spark, path, SPECS["orders"], header=False, mode=mode)
        try:
            part = sources.written(lines, sources.staging_dir(spark, "mode"))
            part = part.agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n"))
        except Exception as error:
            if "MALFORMED" not in str(error).upper():
                raise
            part = part.select(F.lit(mode).alias("mode"), F.lit(None).cast("long").alias("n"))
        found = part if found is None else found.unionByName(part)
    return found


@query
def inactive_today(spark, sf_dir):
    """The inactivity report with its default day, today."""
    return reports.inactive_customers(
        inputs.customers(spark, sf_dir), inputs.native_orders(spark, sf_dir)
    )


def _incremental(spark: SparkSession, sf_dir: str, report: str) -> DataFrame:
    """Clean orders and payments in two batches, the second twice, then the report."""
    customers, orders, payments = (
        sources.written(t, sources.staging_dir(spark, "whole"))
        for t in _cleaned(spark, sf_dir, "payments")
    )
    target = sources.staging_dir(spark, "increments")
    for batch in (0, 1, 1):
        part = orders.filter(f"order_id % 3 {'=' if batch else '!='} 0")
        increments.add_orders(part, target, batch)
        arrived = orders if batch else part
        later = payments.join(part.select("order_id"), "order_id", "left_semi")
        increments.add_payments(later, arrived, target, batch)
    return increments.current_reports(spark, customers, target, AS_OF)[report]


for report in (
    "revenue_per_customer", "monthly_revenue", "unpaid_customers", "top_customers", "inactive_customers"
):
    QUERIES[f"incremental_{report}"] = partial(_incremental, report=report)


@query
def quality_expectations(spark, sf_dir):
    return expectation_report(inputs.raw_orders(spark, sf_dir), _order_rules())


@query
def expectations_dropped(spark, sf_dir):
    return expect(inputs.raw_orders(spark, sf_dir), _order_rules(), "drop")


@query
def table_rules_orders(spark, sf_dir):
    """Rules about the whole order table from sketches, beside the exact values: whether the
    exact value lies within the bounds of the estimate, and the verdict."""
    orders = inputs.raw_orders(spark, sf_dir)
    customers = inputs.raw_customers(spark, sf_dir)
    report = table_report(
        orders,
        {
            "rows": Rows(least=10),
            "no_rows": Rows(most=10),
            "orders": Distinct("order_id", least=10),
            "customers": Distinct("customer_id", least=10),
            "median_amount": Quantile("amount", 0.5, least=0.0),
            "low_amount": Quantile("amount", 0.001, least=1e12),
            "known_customers": Covered("customer_id", customers, "customer_id", least=0.5),
        },
    )
    known = orders.select("customer_id").distinct().join(
        customers.select("customer_id").distinct().withColumn("k", F.lit(1)), "customer_id", "left"
    )
    exact = orders.selectExpr(
        """inline(array(
            named_struct('rule', 'rows', 'exact', CAST(count(1) AS DOUBLE)),
            named_struct('rule', 'no_rows', 'exact', CAST(count(1) AS DOUBLE)),
            named_struct('rule', 'orders', 'exact', CAST(count(DISTINCT order_id) AS DOUBLE)),
            named_struct('rule', 'customers', 'exact', CAST(count(DISTINCT customer_id) AS DOUBLE)),
            named_struct('rule', 'median_amount', 'exact', percentile(amount, 0.5D)),
            named_struct('rule', 'low_amount', 'exact', percentile(amount, 0.001D))))"""
    ).unionByName(known.selectExpr("'known_customers' AS rule", "count(k) / count(1) AS exact"))
    return report.join(exact, "rule").selectExpr(
        "rule", "verdict", "exact BETWEEN low AND high AS exact_within_bounds"
    )


@query
def not_null_violations(spark, sf_dir):
    return sources.null_violations(inputs.raw_customers(spark, sf_dir), SPECS["customers"])


# --- streams ---------------------------------------------------------------------


def _drop_files(spark: SparkSession, sf_dir: str, path: str, seq: int) -> None:
    part = inputs.raw_orders(spark, sf_dir).filter(F.col("seq") == seq)
    part.select(*SPECS["orders"].columns).write.mode("append").options(
        header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)


@query
def stream_ingest_orders(spark, sf_dir):
    landing, target = (sources.staging_dir(spark, p) for p in ("landing", "ingested"))
    for seq in (0, 1):
        _drop_files(spark, sf_dir, landing, seq)
    ingest_new_files(scan_csv_stream(spark, landing, SPECS["orders"]), target)
    return spark.read.schema(SPECS["orders"].raw_schema()).parquet(target)


@query
def stream_rerun_idempotent(spark, sf_dir):
    """Files, run, more files, run, no files, run: every row is there once."""
    landing, target = (sources.staging_dir(spark, p) for p in ("landing", "ingested"))
    for seq in (0, 1, None):
        if seq is not None:
            _drop_files(spark, sf_dir, landing, seq)
        ingest_new_files(scan_csv_stream(spark, landing, SPECS["orders"]), target)
    return spark.read.schema(SPECS["orders"].raw_schema()).parquet(target)


@query
def stream_clean_orders(spark, sf_dir):
    """The clean order table, built from two arrivals of files."""
    landing, target = (sources.staging_dir(spark, p) for p in ("landing", "cleaned"))
    parent = sources.written(
        _valid("customers", spark, sf_dir), sources.staging_dir(spark, "parent")
    )
    for seq in (0, 1):
        _drop_files(spark, sf_dir, landing, seq)
        clean_new_files(
            scan_csv_stream(spark, landing, SPECS["orders"]),
            SPECS["orders"],
            target,
            parent=parent,
        )
    return read_cleaned(spark, SPECS["orders"], target, "clean")


@query
def stream_late_parent(spark, sf_dir):
    """Orders that came before half of the customers, read when all customers are there."""
    landing, target = (sources.staging_dir(spark, p) for p in ("landing", "cleaned"))
    customers = sources.written(
        _valid("customers", spark, sf_dir), sources.staging_dir(spark, "parent")
    )
    for seq in (0, 1):
        _drop_files(spark, sf_dir, landing, seq)
    clean_new_files(
        scan_csv_stream(spark, landing, SPECS["orders"]),
        SPECS["orders"],
        target,
        parent=customers.filter("customer_id % 2 = 0"),
    )
    return read_cleaned(spark, SPECS["orders"], target, "clean", parent=customers)


def _settled(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    """Orders before their customers; the customers come in two parts and settle orphans."""
    landing, target = (sources.staging_dir(spark, p) for p in ("landing", "cleaned"))
    customers = sources.written(
        _valid("customers", spark, sf_dir), sources.staging_dir(spark, "parent")
    )
    parts = [customers.filter(f"customer_id % 3 = {k}") for k in range(3)]
    for seq in (0, 1):
        _drop_files(spark, sf_dir, landing, seq)
        clean_new_files(
            scan_csv_stream(spark, landing, SPECS["orders"]),
            SPECS["orders"],
            target,
            parent=parts[0],
        )
        settle_orphans(spark, SPECS["orders"], target, parts[1 + seq])
    settle_orphans(spark, SPECS["orders"], target, customers)
    return read_cleaned(spark, SPECS["orders"], target, which)


@query
def stream_settled_orders(spark, sf_dir):
    return _settled(spark, sf_dir, "clean")


@query
def stream_settled_orphans(spark, sf_dir):
    return _settled(spark, sf_dir, "orphan")
