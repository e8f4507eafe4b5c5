from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType

from siltgate import retail_specs
from siltgate.operators import keep_first, repeated_rows
from siltgate.plans import clean, clean_tagged, refused_rows, row_counts, unreadable_dates
from siltgate.spec import Normalise, RequireRule
from tests.conftest import rows

SPECS = retail_specs()
CUSTOMER = "customer_id int, name string, signup_date string, country string, seq int"
ORDER = "order_id int, customer_id int, order_date string, amount double, status string, seq int"


def test_a_nameless_first_row_does_not_hide_a_named_second(spark):
    raw = spark.createDataFrame(
        [(1, None, "2024-01-01", "x", 0), (1, "Ann", "2024-01-02", "y", 1)], CUSTOMER
    )
    got = clean(raw, SPECS["customers"], ["seq"])
    assert rows(got) == [(1, "Ann", dt.date(2024, 1, 2), "Y")]


def test_a_bad_first_amount_takes_its_key_along(spark):
    raw = spark.createDataFrame(
        [(1, 1, "2024-01-01", -5.0, "x", 0), (1, 1, "2024-01-01", 5.0, "x", 1),
         (2, 1, "2024-01-01", None, "x", 0), (3, 1, "2024-01-01", 0.0, "x", 0)], ORDER
    )
    assert [r.order_id for r in clean(raw, SPECS["orders"], ["seq"]).collect()] == [3]
    tagged = clean_tagged(raw, SPECS["orders"], ["seq"])
    assert rows(tagged.select("order_id", "refused")) == [
        (1, "invalid_amount"), (2, "invalid_amount"), (3, None),
    ]
    refused = refused_rows(raw, SPECS["orders"], ["seq"]).select("order_id", "amount", "reason")
    assert rows(refused) == [
        (1, -5.0, "invalid_amount"), (1, 5.0, "duplicate"), (2, None, "invalid_amount"),
    ]


def test_blank_and_spelled_out_names_stay(spark):
    raw = spark.createDataFrame(
        [(1, "  ", None, None, 0), (2, "NULL", None, None, 0), (3, "", None, None, 0)], CUSTOMER
    )
    assert clean(raw, SPECS["customers"], ["seq"]).count() == 3


def test_null_keys_are_one_group(spark):
    raw = spark.createDataFrame(
        [(None, "b", None, None, 1), (None, "a", None, None, 0), (1, "c", None, None, 0)], CUSTOMER
    )
    got = clean(raw, SPECS["customers"], ["seq"])
    assert rows(got.select("customer_id", "name")) == [(1, "c"), (None, "a")]
    strict = retail_specs(require_keys=True)["customers"]
    assert rows(clean(raw, strict, ["seq"]).select("name")) == [("c",)]
    assert rows(repeated_rows(raw, ["customer_id"], ["seq"]).select("name")) == [("b",)]


def test_amounts_that_are_no_numbers(spark):
    raw = spark.createDataFrame(
        [(1, 1, None, float("nan"), "x", 0), (2, 1, None, float("inf"), "x", 0)], ORDER
    )
    assert clean(raw, SPECS["orders"], ["seq"]).count() == 2
    assert clean(raw, retail_specs(finite_amounts=True)["orders"], ["seq"]).count() == 0


def test_unparsed_and_missing_are_told_apart(spark):
    raw = spark.createDataFrame(
        [(1, "a", "13/02/2024", None, 0), (2, "b", None, None, 0), (3, "c", "2024/02/13", None, 0)],
        CUSTOMER,
    )
    spec = SPECS["customers"]
    tagged = clean_tagged(raw, spec, ["seq"])
    counts = {r.stage: r.n for r in row_counts(raw, tagged, spec).collect()}
    assert (counts["unparsed"], counts["missing"], counts["clean"]) == (1, 1, 3)
    kept = clean(raw, spec, ["seq"], keep_raw=True)
    assert rows(unreadable_dates(kept, spec)) == [("customers", 1, "signup_date", "13/02/2024")]


def test_a_normalised_column_may_be_normalised_again(spark):
    spec = SPECS["customers"]
    spec = spec.with_steps(*spec.steps, Normalise("country", F.upper))
    raw = spark.createDataFrame([(1, "a", None, " uk", 0)], CUSTOMER)
    assert clean(raw, spec, ["seq"]).first().country == "UK"


def test_the_first_rule_broken_is_named(spark):
    spec = SPECS["orders"]
    spec = spec.with_steps(*spec.steps, RequireRule("status", lambda: F.col("status") != "x"))
    raw = spark.createDataFrame(
        [(1, 1, None, -1.0, "x", 0), (2, 1, None, 1.0, "x", 0), (3, 1, None, 1.0, None, 0),
         (4, 1, None, 1.0, "y", 0)], ORDER
    )
    tagged = clean_tagged(raw, spec, ["seq"]).select("order_id", "refused")
    assert rows(tagged) == [
        (1, "invalid_amount"), (2, "invalid_status"), (3, "invalid_status"), (4, None),
    ]
    assert rows(clean(raw, spec, ["seq"]).select("order_id")) == [(4,)]


def test_wide_keys_and_decimal_money(spark):
    spec = retail_specs(key_type=LongType(), money_type=DecimalType(18, 2))["orders"]
    assert spec.raw_schema()["order_id"].dataType == LongType()
    assert spec.clean_schema()["amount"].dataType == DecimalType(18, 2)
    raw = spark.createDataFrame(
        [(3_000_000_000, 1, "2024-01-01", None, "x", 0)],
        ORDER.replace("order_id int", "order_id long").replace("double", "decimal(18,2)"),
    )
    assert clean(raw, spec, ["seq"]).count() == 0


def test_keep_first_sends_one_row_per_key_and_task(spark, plan):
    df = spark.range(1000).selectExpr("id % 10 AS k", "id AS seq")
    text = plan(keep_first(df, ["k"], ["seq"]))
    partial, exchange, final = (
        text.index("Partial"), text.index("Exchange"), text.index("Final"),
    )
    assert final < exchange < partial  # the plan is printed from the top
    assert "Python" not in text and "UDF" not in text
    assert rows(keep_first(df, ["k"], ["seq DESC"])) == [(k, 990 + k) for k in range(10)]


def test_keep_first_on_random_rows(spark):
    df = spark.range(2000).selectExpr(
        "pmod(hash(id), 37) AS a", "pmod(hash(id, 1), 3) AS b", "id AS seq"
    )
    want = {}
    for r in df.orderBy("seq").collect():
        want.setdefault((r.a, r.b), r.seq)
    got = keep_first(df, ["a", "b"], ["seq"])
    assert {(r.a, r.b): r.seq for r in got.collect()} == want
    later = repeated_rows(df, ["a", "b"], ["seq"])
    assert later.count() + got.count() == 2000
    assert later.join(got, "seq").count() == 0
