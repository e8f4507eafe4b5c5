from __future__ import annotations

import datetime as dt

import pytest

from siltgate.operators import with_children, without_children
from siltgate.plans import reports
from tests.conftest import rows

D = dt.date


@pytest.fixture
def customers(spark):
    people = [(i, f"c{i}") for i in range(1, 9)]
    return spark.createDataFrame(people, "customer_id int, name string")


ORDER = "order_id int, customer_id int, order_date date, amount double, status string"


def test_top_settles_ties_by_customer(spark, customers):
    orders = spark.createDataFrame(
        [(i, i, D(2024, 1, 1), 10.0, "completed") for i in range(8, 0, -1)], ORDER
    )
    top = reports.top_customers(customers, orders)
    assert [r.customer_id for r in top.collect()] == [1, 2, 3, 4, 5]
    assert reports.top_customers(customers, orders, k=2).count() == 2


def test_revenue_counts_completed_orders_of_known_customers(spark, customers):
    orders = spark.createDataFrame(
        [(1, 1, None, 0.1, "completed"), (2, 1, None, 0.2, "completed"),
         (3, 1, None, 9.0, "pending"), (4, 2, None, 9.0, "cancelled"),
         (5, 99, None, 9.0, "completed"), (6, None, None, 9.0, "completed")], ORDER
    )
    got = reports.revenue_per_customer(customers, orders)
    assert [tuple(r) for r in got.collect()] == [(1, "c1", 0.3)]


def test_undated_orders_form_the_first_month(spark):
    orders = spark.createDataFrame(
        [(1, 1, D(2024, 2, 29), 1.0, "completed"), (2, 1, None, 2.0, "completed"),
         (3, 1, D(2024, 2, 1), 3.25, "completed"), (4, 1, D(2023, 12, 31), 4.0, "completed")], ORDER
    )
    got = [tuple(r) for r in reports.monthly_revenue(orders).collect()]
    assert got == [(None, 2.0), ("2023-12", 4.0), ("2024-02", 4.25)]


def test_inactive_boundary(spark, customers):
    as_of = D(2024, 6, 1)
    days = {1: 89, 2: 90, 3: 91, 4: 400}
    orders = [(i, i, as_of - dt.timedelta(d), 1.0, "pending") for i, d in days.items()]
    orders += [(5, 5, None, 1.0, "completed"), (6, 3, D(2020, 1, 1), 1.0, "x")]
    got = reports.inactive_customers(
        customers, spark.createDataFrame(orders, ORDER), as_of=as_of
    ).collect()
    assert [r.customer_id for r in got] == [5, 6, 7, 8, 4, 3]
    assert got[-1].last_order_date == as_of - dt.timedelta(91)


def test_inactive_from_today(spark, customers):
    today = dt.datetime.now(dt.UTC).date()
    orders = spark.createDataFrame([(1, 1, today, 1.0, "x")], ORDER)
    assert reports.inactive_customers(customers, orders).count() == 7


PAYMENT = "payment_id int, order_id int, payment_date date, payment_status string"


def test_unpaid(spark, customers):
    orders = spark.createDataFrame(
        [(1, 1, None, 1.0, "x"), (2, 1, None, 1.0, "x"), (3, 2, None, 1.0, "x"),
         (4, 3, None, 1.0, "x"), (5, None, None, 1.0, "x"), (None, 4, None, 1.0, "x")], ORDER
    )
    payments = spark.createDataFrame(
        [(1, 1, None, "failed"), (2, 2, None, "success"), (3, 3, None, "failed"),
         (4, 3, None, "failed"), (5, None, None, "success"), (6, 5, None, "success"),
         (7, 99, None, "success")], PAYMENT
    )
    got = reports.unpaid_customers(customers, orders, payments)
    assert [r.customer_id for r in got.collect()] == [2, 3, 4]


def test_exists_and_not_in(spark, customers):
    parents = customers.unionByName(
        spark.createDataFrame([(None, "nobody")], "customer_id int, name string")
    )
    parents.createOrReplaceTempView("parents")
    for values in ([1, 1, 2], [1, None], [None], []):
        child = spark.createDataFrame([(v,) for v in values], "customer_id int")
        child.createOrReplaceTempView("child")
        exists = spark.sql("SELECT * FROM parents p WHERE EXISTS "
                           "(SELECT 1 FROM child c WHERE c.customer_id = p.customer_id)")
        assert rows(with_children(parents, child, "customer_id")) == rows(exists)
        absent = spark.sql("SELECT * FROM parents p WHERE NOT EXISTS "
                           "(SELECT 1 FROM child c WHERE c.customer_id = p.customer_id)")
        assert rows(without_children(parents, child, "customer_id")) == rows(absent)
        strict = spark.sql("SELECT * FROM parents WHERE customer_id NOT IN (SELECT * FROM child)")
        assert rows(without_children(parents, child, "customer_id", True)) == rows(strict), values


def test_plans(spark, customers, plan):
    orders = spark.createDataFrame([(1, 1, D(2024, 1, 1), 1.0, "completed")], ORDER)
    payments = spark.createDataFrame([(1, 1, None, "success")], PAYMENT)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unpaid = plan(reports.unpaid_customers(customers, orders, payments))
        strict = plan(without_children(customers, orders, "customer_id", null_aware=True))
        revenue = plan(reports.revenue_per_customer(customers, orders))
        top = plan(reports.top_customers(customers, orders))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in (unpaid, strict):
        assert "Broadcast" not in text and "Nested" not in text
    # Summed inside the tasks, then joined without another shuffle of the sums.
    assert revenue.index("SortMergeJoin") < revenue.index("partial_sum")
    assert revenue.count("hashpartitioning") == 2
    assert "TakeOrderedAndProject" in top
    for text in (unpaid, revenue, top):
        assert "Python" not in text
