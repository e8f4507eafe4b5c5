"""The five reports kept up to date by batches, without reading old orders again.

A batch of clean orders leaves a row for each customer, month and status: the sum of its
amounts and its latest date.  Sums and maxima of such rows are those of the orders, so the
reports run on them as they are; a year of orders of a customer is a few dozen rows.  A
batch of clean payments leaves the customers it has shown to be payers, which takes a look
at the orders of that batch's payments only.

A batch that comes again replaces its own folder, so a repeated batch changes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.functions import quoted
from siltgate.operators.joins import rows_with_keys
from siltgate.plans import reports
from siltgate.sources.staging import staging_dir, written


def compact_orders(orders: DataFrame) -> DataFrame:
    """Orders summed up by customer, month and status, under the names of order columns.

    Dates that are missing make a group of their own.  ``orders`` counts the rows.
    """
    return (
        orders.groupBy("customer_id", F.trunc("order_date", "month").alias("_month"), "status")
        .agg(
            F.max("order_date").alias("order_date"),
            F.sum("amount").alias("amount"),
            F.count(F.lit(1)).alias("orders"),
        )
        .drop("_month")
    )


def add_orders(orders: DataFrame, target: str, batch_id: int) -> None:
    """Sum up a batch of clean orders (or of orphans that were settled, as a batch of its own)."""
    compact_orders(orders).write.mode("overwrite").parquet(f"{target}/orders/batch_id={batch_id}")


def add_payments(
    payments: DataFrame,
    orders: DataFrame,
    target: str,
    batch_id: int,
    status: str = reports.SUCCESS,
) -> None:
    """Record who paid in a batch of clean payments.

    ``orders`` are all clean orders so far; they are scanned for the orders of this batch's
    successful payments, by broadcast where those measure small.
    """
    paid = payments.filter(
        (F.col("payment_status") == status) & F.col("order_id").isNotNull()
    ).select("order_id").distinct()
    paid = written(paid, staging_dir(payments.sparkSession, "paid"))
    found = rows_with_keys(orders, "order_id", paid).filter("customer_id IS NOT NULL")
    found.select("customer_id").distinct().write.mode("overwrite").parquet(
        f"{target}/paid/batch_id={batch_id}"
    )


def merge_batches(spark: SparkSession, target: str, into: str) -> None:
    """Write the batches so far as one batch 0 of a new target: as many rows as one batch of
    everything would have, however many there were."""
    month = F.trunc("order_date", "month").alias("_month")
    summed = _orders(spark, target).groupBy("customer_id", month, "status").agg(
        F.max("order_date").alias("order_date"),
        F.sum("amount").alias("amount"),
        F.sum("orders").alias("orders"),
    )
    summed.drop("_month").write.mode("overwrite").parquet(f"{into}/orders/batch_id=0")
    _paid(spark, target).distinct().write.mode("overwrite").parquet(f"{into}/paid/batch_id=0")


def _orders(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/orders").drop("batch_id")


def _paid(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(f"{target}/paid").select("customer_id")


def current_reports(
    spark: SparkSession, customers: DataFrame, target: str, as_of: dt.date | None = None
) -> dict[str, DataFrame]:
    """The reports over all batches so far; ``customers`` are those of now."""
    orders = _orders(spark, target)
    ordered = orders.filter("customer_id IS NOT NULL").select("customer_id").distinct()
    unpaid = ordered.join(_paid(spark, target).distinct(), "customer_id", "left_anti")
    return {
        "revenue_per_customer": reports.revenue_per_customer(customers, orders),
        "monthly_revenue": reports.monthly_revenue(orders),
        "unpaid_customers": customers.select(*map(quoted, ("customer_id", "name")))
        .join(unpaid, "customer_id", "left_semi")
        .orderBy("customer_id"),
        "top_customers": reports.top_customers(customers, orders),
        "inactive_customers": reports.inactive_customers(customers, orders, as_of=as_of),
    }
