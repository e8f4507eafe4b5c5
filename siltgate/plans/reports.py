"""The five customer, order and payment reports.

Each aggregates before it joins: sums and latest dates are combined inside the
tasks, so a customer with a third of all orders arrives at the join as one row, and
the join reuses the aggregate's partitioning.  Every sort ends on the customer id,
which settles ties and lets a range sort split a run of equal values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltgate.functions import days_before, month_bucket

COMPLETED = "completed"
SUCCESS = "success"


def _completed_revenue(customers: DataFrame, orders: DataFrame, status: str) -> DataFrame:
    per_customer = (
        orders.filter(F.col("status") == status)
        .groupBy("customer_id")
        .agg(F.sum("amount").alias("revenue"))
    )
    return customers.join(per_customer, "customer_id", "inner").select(
        "customer_id", "name", F.round("revenue", 2).alias("total_revenue")
    )


def revenue_per_customer(
    customers: DataFrame, orders: DataFrame, status: str = COMPLETED
) -> DataFrame:
    """Revenue of completed orders; customers without one are absent."""
    return _completed_revenue(customers, orders, status).orderBy(
        F.desc("total_revenue"), "customer_id"
    )


def monthly_revenue(orders: DataFrame, status: str = COMPLETED) -> DataFrame:
    """Revenue of completed orders by month; undated orders form a NULL month.

    Groups by the first day of the month, a four-byte key, and writes the text of
    a month once per group instead of once per order.
    """
    return (
        orders.filter(F.col("status") == status)
        .groupBy(F.trunc("order_date", "month").alias("_month"))
        .agg(F.sum("amount").alias("revenue"))
        .select(
            month_bucket("_month").alias("month"),
            F.round("revenue", 2).alias("monthly_revenue"),
        )
        .orderBy(F.asc_nulls_first("month"))
    )


def unpaid_customers(
    customers: DataFrame, orders: DataFrame, payments: DataFrame, status: str = SUCCESS
) -> DataFrame:
    """Customers who ordered and never had a successful payment on any order.

    One pass over the orders says both whether a customer ordered and whether any
    order was paid.
    """
    paid_orders = (
        payments.filter((F.col("payment_status") == status) & F.col("order_id").isNotNull())
        .select("order_id")
        .distinct()
        .withColumn("_paid", F.lit(True))
    )
    ordered = (
        orders.filter(F.col("customer_id").isNotNull())
        .select("customer_id", "order_id")
        .join(paid_orders, "order_id", "left")
        .groupBy("customer_id")
        .agg(F.max(F.coalesce("_paid", F.lit(False))).alias("_paid"))
        .filter(~F.col("_paid"))
    )
    return (
        customers.select("customer_id", "name")
        .join(ordered, "customer_id", "left_semi")
        .orderBy("customer_id")
    )


def top_customers(
    customers: DataFrame, orders: DataFrame, k: int = 5, status: str = COMPLETED
) -> DataFrame:
    """The ``k`` customers with the most revenue, equal revenue by customer id."""
    return revenue_per_customer(customers, orders, status).limit(k)


def inactive_customers(
    customers: DataFrame,
    orders: DataFrame,
    days: int = 90,
    as_of: dt.date | Column | None = None,
) -> DataFrame:
    """Customers whose last order, of any status, is more than ``days`` before
    ``as_of`` (today if not given), and those with no dated order."""
    last = orders.groupBy("customer_id").agg(F.max("order_date").alias("last_order_date"))
    return (
        customers.select("customer_id", "name")
        .join(last, "customer_id", "left")
        .filter(
            F.col("last_order_date").isNull()
            | (F.col("last_order_date") < days_before(as_of, days))
        )
        .orderBy(F.asc_nulls_first("last_order_date"), "customer_id")
    )
