"""The whole job on the shop extract."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltgate import retail_specs
from siltgate.operators import with_arrival
from siltgate.plans import clean_all, quarantine_reasons, refused_rows, run_batch
from siltgate.sources import scan_csv
from tests import shop
from tests.conftest import rows

SPECS = retail_specs()
ARRIVAL = dict.fromkeys(SPECS, ["_arrival"])


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    paths = shop.write(tmp_path_factory.mktemp("shop"))
    return {name: with_arrival(scan_csv(spark, paths[name], SPECS[name])) for name in SPECS}


@pytest.fixture(scope="module")
def batch(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return run_batch(
        spark, raw, SPECS, ARRIVAL, out_dir=out, schema="shop", as_of=dt.date(2024, 6, 1)
    ), out


def test_published_row_counts(raw, batch):
    assert {n: df.count() for n, df in raw.items()} == {
        "customers": 22, "orders": 51, "payments": 40,
    }
    result, _ = batch
    assert {n: df.count() for n, df in result.tables.items()} == {
        "customers": 20, "orders": 45, "payments": 35,
    }
    assert {n: df.count() for n, df in result.quarantine.items()} == {"orders": 5, "payments": 5}


def test_lazy_and_written_forms_agree(raw, batch):
    lazy = clean_all(raw, SPECS, ARRIVAL)
    for name in SPECS:
        assert rows(lazy[name].valid) == rows(batch[0].tables[name])
    for name in ("orders", "payments"):
        assert rows(lazy[name].orphans) == rows(batch[0].quarantine[name])


def test_count_report(batch):
    counts = {(r.table_name, r.stage): r.n for r in batch[0].counts.collect()}
    assert counts["customers", "raw"] == 22
    assert counts["customers", "clean"] == 20
    assert counts["customers", "unparsed"] == 1
    assert counts["customers", "missing"] == 0
    assert counts["orders", "kept_first"] == 50
    assert counts["orders", "orphan"] == 5
    assert counts["payments", "orphan"] == 5
    for name in SPECS:
        assert counts[name, "clean"] + counts[name, "orphan"] == counts[name, "passed_rules"]


def test_first_rows_are_kept(batch):
    names = {r.customer_id: r.name for r in batch[0].tables["customers"].collect()}
    assert names[5] == "Customer 5" and 21 not in names
    amounts = {r.order_id: r.amount for r in batch[0].tables["orders"].collect()}
    assert amounts[11] == 11.5


def test_types_and_text(batch):
    customers = batch[0].tables["customers"]
    assert customers.dtypes == [
        ("customer_id", "int"), ("name", "string"), ("signup_date", "date"), ("country", "string"),
    ]
    assert {r[0] for r in customers.select("country").distinct().collect()} == {
        "India", "Usa", "Guinea-bissau", "New Zealand",
    }
    wrong = customers.filter(
        (F.col("customer_id") != 3) & (F.dayofmonth("signup_date") != F.col("customer_id"))
    )
    assert wrong.count() == 0
    states = batch[0].tables["payments"].select("payment_status").distinct()
    assert rows(states) == [("failed",), ("success",)]


def test_unreadable_dates_keep_their_text(batch):
    assert rows(batch[0].unreadable) == [("customers", 3, "signup_date", "not_a_date")]


def test_quarantine_files(spark, batch):
    result, out = batch
    read = spark.read.schema(result.quarantine["orders"].schema).csv(
        f"{out}/quarantine/orders", header=True
    )
    assert rows(read) == rows(result.quarantine["orders"])


def test_catalog_tables_are_the_written_files(spark, batch):
    for name in SPECS:
        table = spark.table(f"shop.{name}")
        assert table.columns == SPECS[name].columns
        assert rows(table) == rows(batch[0].tables[name])


def test_reference_queries_as_sql_text(spark, batch):
    """A user's own SQL over the tables gives what the reports give."""
    reports = batch[0].reports()
    revenue = spark.sql("""
        SELECT c.customer_id, c.name, round(sum(o.amount), 2) AS total_revenue
        FROM shop.customers c JOIN shop.orders o ON c.customer_id = o.customer_id
        WHERE o.status = 'completed' GROUP BY ALL""")
    assert rows(revenue) == rows(reports["revenue_per_customer"])
    unpaid = spark.sql("""
        SELECT c.customer_id, c.name FROM shop.customers c
        WHERE EXISTS (SELECT 1 FROM shop.orders o WHERE o.customer_id = c.customer_id)
        AND c.customer_id NOT IN (SELECT o.customer_id FROM shop.orders o
            JOIN shop.payments p ON o.order_id = p.order_id WHERE p.payment_status = 'success')""")
    assert rows(unpaid) == rows(reports["unpaid_customers"])
    assert reports["inactive_customers"].count() == 20
    assert reports["monthly_revenue"].collect()[0].month == "2024-02"
    top = [r.customer_id for r in reports["top_customers"].collect()]
    assert top == [r.customer_id for r in reports["revenue_per_customer"].collect()][:5]


def test_reasons(raw):
    by_order = {
        r.customer_id: r.reason for r in quarantine_reasons(raw, SPECS, ARRIVAL, "orders").collect()
    }
    assert by_order == {21: "parent_rejected", 22: "missing_parent"}
    by_payment = {
        r.order_id: r.reason for r in quarantine_reasons(raw, SPECS, ARRIVAL, "payments").collect()
    }
    assert by_payment == {
        55: "missing_parent", **dict.fromkeys((10, 20, 40, 50), "parent_rejected"),
    }


def test_refused_rows_and_kept_rows_make_the_whole(raw):
    for name, spec in SPECS.items():
        refused = refused_rows(raw[name], spec, ["_arrival"])
        kept = clean_all(raw, SPECS, ARRIVAL, name)[name]
        assert refused.count() + kept.valid.count() + kept.orphans.count() == raw[name].count()
    reasons = refused_rows(raw["customers"], SPECS["customers"], ["_arrival"])
    assert rows(reasons.select("customer_id", "reason")) == [
        (21, "missing_name"), (5, "duplicate"),
    ]


def test_the_quarantine_may_keep_unreadable_dates(spark, raw):
    late = raw["orders"].withColumn("order_date", F.lit("some day"))
    result = run_batch(
        spark, {**raw, "orders": late}, SPECS, ARRIVAL, keep_raw=True, quarantine_csv=False
    )
    kept = result.quarantine["orders"].select("order_date", "raw_order_date").distinct()
    assert rows(kept) == [(None, "some day")]


def test_a_second_run_replaces_the_first(spark, raw, batch, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):
        again = run_batch(spark, raw, SPECS, ARRIVAL, out_dir=out)
    assert again.tables["orders"].count() == 45
    clean_raw = {**raw, "orders": raw["orders"].filter("customer_id < 21")}
    again = run_batch(spark, clean_raw, SPECS, ARRIVAL, out_dir=out)
    left = spark.read.schema(again.quarantine["orders"].schema).csv(
        f"{out}/quarantine/orders", header=True
    )
    assert left.count() == 0  # no stale quarantine
