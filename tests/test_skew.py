"""Joins with a hot key: right results, and the hot key is really cut."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from siltgate.operators import (
    NO_HOT_KEYS,
    hot_routes,
    join_parent,
    left_join_children,
    repeated_rows,
    salted_join,
    split_by_parent,
    tag_parent,
)
from siltgate.spec import retail_specs
from tests.conftest import rows


@pytest.fixture(scope="module")
def child(spark):
    # A third of the rows have key 7, a third of them NULL, the rest spread out.
    return spark.range(0, 30_000, 1, 6).selectExpr(
        "id",
        "CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN NULL ELSE CAST(id % 500 AS INT) END AS k",
    ).cache()


@pytest.fixture(scope="module")
def parent(spark):
    return spark.range(0, 400).selectExpr("id AS k", "concat('p', id) AS name").cache()


@pytest.fixture(scope="module")
def hot(child):
    return hot_routes(child, ["k"], min_rows=1000, lane_rows=500)


def test_hot_keys_are_found_and_few(child, hot):
    assert len(hot.lanes) == 2  # key 7 and NULL
    assert sorted(lanes for _, lanes in hot.lanes) == [20, 21]


def test_ordinary_keys_are_not_hot(spark):
    even = spark.range(0, 50_000).selectExpr("id % 5000 AS k")
    assert hot_routes(even, ["k"], min_rows=100) == NO_HOT_KEYS


def test_no_rows_have_no_hot_keys(spark):
    empty = spark.range(10).filter("id > rand() + 10").selectExpr("id AS k")
    assert hot_routes(empty, ["k"], min_rows=1) == NO_HOT_KEYS
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert hot_routes(empty, ["k"], min_rows=1) == NO_HOT_KEYS
        one = spark.range(1).selectExpr("id AS k")
        assert len(hot_routes(one, ["k"], min_rows=1).lanes) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_small_groups_are_left_alone(child):
    assert hot_routes(child, ["k"]) == NO_HOT_KEYS


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("salted", [True, False])
def test_same_rows_as_the_plain_join(child, parent, hot, how, salted):
    got = salted_join(
        child, parent, ["k"], how, spread_by=["id"], hot=hot if salted else NO_HOT_KEYS
    )
    want = child.join(parent, "k", how).select(*got.columns)
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_null_safe_join(child, spark, hot):
    named = [(7, "seven"), (None, "none"), (8, "eight")]
    parent = spark.createDataFrame(named, "k int, name string")
    got = salted_join(child, parent, ["k"], "inner", spread_by=["id"], hot=hot, null_safe=True)
    want = child.join(
        parent.withColumnRenamed("k", "pk"), F.col("k").eqNullSafe(F.col("pk"))
    ).drop("pk")
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_a_hot_key_and_null_land_in_many_tasks(child, parent, hot, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        def largest_task(how, keys):
            joined = salted_join(child, parent, ["k"], how, spread_by=["id"], hot=keys)
            sizes = joined.groupBy(F.spark_partition_id()).count()
            return sizes.agg(F.max("count")).first()[0]

        assert largest_task("left", NO_HOT_KEYS) > 10_000
        assert largest_task("left", hot) < 4000
        assert largest_task("left_anti", hot) < 2500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_keys_are_broadcast_and_nothing_else(child, parent, hot, spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(salted_join(child, parent, ["k"], "inner", spread_by=["id"], hot=hot))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 2
    assert text.count("SortMergeJoin") == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_without_hot_keys_it_is_the_plain_join(child, parent, spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(
            salted_join(child, parent, ["k"], "left", spread_by=["id"], hot=NO_HOT_KEYS)
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 1 and text.count("Exchange") == 2
    assert "lane" not in text and "Broadcast" not in text


def test_join_operators_with_a_hot_key(child, parent, hot):
    inner = join_parent(child, parent, "k", "id", hot)
    assert inner.count() == child.join(parent, "k").count()
    left = left_join_children(parent, child, "k", "id", hot)
    want = parent.join(child, "k", "left").select(*left.columns)
    assert left.exceptAll(want).count() == 0
    assert want.exceptAll(left).count() == 0


def test_split_and_tag_with_a_hot_foreign_key(spark):
    spec = retail_specs()["orders"]
    orders = spark.range(3000).selectExpr(
        "CAST(id AS INT) AS order_id",
        "CASE id % 3 WHEN 0 THEN 1 WHEN 1 THEN 99 ELSE NULL END AS customer_id",
        "CAST(NULL AS DATE) AS order_date", "1D AS amount", "'x' AS status",
    )
    customers = spark.createDataFrame([(1,), (2,)], "customer_id int")
    hot = hot_routes(orders, ["customer_id"], min_rows=1, lane_rows=100)
    valid, orphans = split_by_parent(orders, customers, spec, hot)
    assert (valid.count(), orphans.count()) == (1000, 2000)
    assert valid.columns == orders.columns
    tagged = tag_parent(orders, customers, spec, hot=hot)
    assert rows(tagged.groupBy("has_parent").count()) == [(False, 2000), (True, 1000)]


def test_unknown_join_type(child, parent, hot):
    with pytest.raises(ValueError, match="unsupported"):
        salted_join(child, parent, ["k"], "full", spread_by=["id"], hot=hot)


def test_repeats_of_a_hot_key(spark):
    # A third of the rows are copies under key 7, a third have no key.
    df = spark.range(6000).selectExpr(
        "CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN NULL ELSE id END AS k", "id AS seq", "'x' AS same"
    )
    hot = hot_routes(df, ["k"], min_rows=1000, lane_rows=100)
    assert len(hot.lanes) == 2
    later = repeated_rows(df, ["k"], ["seq"], hot)
    assert rows(later.groupBy("k").count()) == [(7, 1999), (None, 1999)]
    assert later.filter("seq < 2").count() == 0 and later.columns == df.columns


PAIRS = {
    "decimal and int": ("CAST(k AS DECIMAL(10,2))", "CAST(k AS INT)"),
    "double and int": ("CAST(k AS DOUBLE)", "CAST(k AS INT)"),
    "date and timestamp": (
        "date_add(DATE '2024-01-01', k)",
        "CAST(date_add(DATE '2024-01-01', k) AS TIMESTAMP)",
    ),
    "zero and minus zero": ("IF(k = 7, 0.0D, k + 1D)", "IF(k = 7, -0.0D, k + 1D)"),
    "collated text": (
        "concat('A', k) COLLATE UTF8_LCASE",
        "concat('a', k) COLLATE UTF8_LCASE",
    ),
    "text with sigmas": ("concat('ΑΣ', k, 'Σ') COLLATE UTF8_LCASE", "concat('ας', k, 'σ') COLLATE UTF8_LCASE"),
    "another collation": ("concat('A', k) COLLATE UNICODE_CI", "concat('a', k) COLLATE UNICODE_CI"),
    "bigint and double": ("CAST(k AS BIGINT)", "CAST(k AS DOUBLE)"),
}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("pair", PAIRS)
def test_keys_that_look_different_as_text(spark, pair, how):
    """Equal keys meet in lanes too, whatever their types."""
    child_key, parent_key = PAIRS[pair]
    numbers = spark.range(0, 4000).selectExpr("id", "CAST(IF(id % 2 = 0, 7, id % 50) AS INT) AS k")
    child = numbers.selectExpr("id", f"{child_key} AS k")
    parent = spark.range(0, 40).selectExpr("CAST(id AS INT) AS k", "id AS name").selectExpr(
        f"{parent_key} AS k", "name"
    )
    own = hot_routes(child, ["k"], min_rows=1000, lane_rows=50)
    assert len(own.lanes) == (pair != "another collation")
    types = tuple(
        f.dataType.simpleString()
        for f in child.select("k").unionByName(parent.select("k")).schema.fields
    )
    hot = hot_routes(child, ["k"], min_rows=1000, lane_rows=50, types=types)
    got = salted_join(child, parent, ["k"], how, spread_by=["id"], hot=hot)
    want = salted_join(child, parent, ["k"], how, spread_by=["id"], hot=NO_HOT_KEYS)
    plain = child.alias("c").join(parent.alias("p"), F.expr("c.k = p.k"), how)
    assert got.count() == plain.count() == want.count()
    assert got.exceptAll(want).count() == 0
    if how == "inner":
        assert got.count() > 3000


def test_keys_without_a_common_type_are_refused(spark):
    child = spark.range(10).selectExpr("id", "CAST(id AS STRING) AS k")
    parent = spark.range(10).selectExpr("id AS k")
    with pytest.raises(ValueError, match="common type"):
        salted_join(child, parent, ["k"], "inner", spread_by=["id"], hot=NO_HOT_KEYS)


def test_a_key_with_half_a_percent_is_cut(spark):
    """What counts is how many rows a key has, not which share of the table."""
    child = spark.range(0, 100_000, 1, 8).selectExpr("id", "IF(id % 200 = 0, -1, id) AS k")
    hot = hot_routes(child, ["k"], min_rows=400, lane_rows=100)
    assert [lanes for _, lanes in hot.lanes] == [5]
