"""Customer, order and payment tables derived from the driver's parquet files.

Two sets: clean adapters, and raw tables with the faults a real extract has.  Both
cover every row of the tables they come from.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from siltgate import retail_specs

# Keys are BIGINT: payment ids outgrow INT at the larger scale factors.
SPECS = retail_specs(key_type=LongType())
AS_OF = dt.date(2001, 8, 1)
ARRIVAL = {"customers": ["seq"], "orders": ["seq"], "payments": ["seq"]}
# Fixed value: how the driver's orders spell "completed".
NATIVE_COMPLETED = "F"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- clean adapters --------------------------------------------------------------


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id", "c_name AS name"
    )


def native_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the status as stored, so that a test on it reaches the scan."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS DATE) AS order_date",
        "o_totalprice AS amount",
        "o_orderstatus AS status",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return native_orders(spark, sf_dir).withColumn(
        "status",
        F.expr(
            "CASE status WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END"
        ),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS payment_id",
        "l_orderkey AS order_id",
        "CAST(l_shipdate AS DATE) AS payment_date",
        """CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 'success'
            ELSE 'failed' END AS payment_status""",
    )


# --- raw tables ------------------------------------------------------------------


def _written(date: str, key: str) -> str:
    """A date as text, in a layout that changes with the key."""
    return f"""CASE ({key}) % 6
        WHEN 0 THEN date_format({date}, 'dd-MM-yyyy')
        WHEN 2 THEN date_format({date}, 'yyyy/MM/dd')
        WHEN 3 THEN date_format({date}, 'MM/dd/yyyy')
        WHEN 4 THEN 'not_a_date'
        ELSE date_format({date}, 'yyyy-MM-dd') END"""


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    signup = "date_add(DATE '2023-01-01', CAST(c_custkey % 700 AS INT))"
    first = source.join(nations, F.expr("c_nationkey = n_nationkey")).selectExpr(
        "c_custkey AS customer_id",
        "CASE WHEN c_custkey % 50 != 21 THEN c_name END AS name",
        f"{_written(signup, 'c_custkey')} AS signup_date",
        """CASE c_custkey % 3 WHEN 0 THEN upper(n_name) WHEN 1 THEN '  ' || lower(n_name)
            ELSE n_name || ' ' END AS country""",
        "0 AS seq",
    )
    again = source.filter("c_custkey % 40 = 5").selectExpr(
        "c_custkey AS customer_id",
        "c_name || ' dup' AS name",
        f"{_written("DATE '2024-01-01'", 'c_custkey')} AS signup_date",
        "'dup' AS country",
        "1 AS seq",
    )
    return first.unionByName(again)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "orders")
    date = f"{_written('CAST(o_orderdate AS DATE)', 'o_orderkey')} AS order_date"
    first = source.selectExpr(
        "o_orderkey AS order_id",
        """CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 10000000
            ELSE o_custkey END AS customer_id""",
        date,
        """CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN -o_totalprice
            ELSE o_totalprice END AS amount""",
        """CASE o_orderstatus WHEN 'F' THEN ' Completed ' WHEN 'O' THEN 'PENDING'
            ELSE 'cancelled' END AS status""",
        "0 AS seq",
    )
    again = source.filter("o_orderkey % 200 = 11").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        date,
        "o_totalprice + 1 AS amount",
        "'completed' AS status",
        "1 AS seq",
    )
    return first.unionByName(again)


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with natural repeats.  ``seq`` is the tuple that orders them, not a
    number: numbering the repeats would cost a shuffle the real input never needs."""
    key = "l_orderkey * 10 + l_linenumber"
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{key} AS payment_id",
        """CASE WHEN l_orderkey % 211 = 0 THEN l_orderkey + 100000000
            ELSE l_orderkey END AS order_id""",
        f"{_written('CAST(l_shipdate AS DATE)', key)} AS payment_date",
        """CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN ' SUCCESS'
            ELSE 'Failed ' END AS payment_status""",
        "struct(l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS seq",
    )


RAW = {"customers": raw_customers, "orders": raw_orders, "payments": raw_payments}


def raw_tables(spark: SparkSession, sf_dir: str, upto: str = "payments") -> dict[str, DataFrame]:
    """``upto`` and the tables it depends on."""
    names = list(RAW)[: list(RAW).index(upto) + 1]
    return {name: RAW[name](spark, sf_dir) for name in names}
