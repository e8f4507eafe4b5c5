"""Rules about whole tables, specs of any shape, and names that must not clash."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType

from siltgate.operators import (
    Covered,
    Distinct,
    Quantile,
    Rows,
    hot_routes,
    keep_first,
    left_join_children,
    repeated_rows,
    salted_join,
    table_report,
)
from siltgate.plans import clean, refused_rows, run_batch, unreadable_dates
from siltgate.spec import Field, ForeignKey, KeepFirst, Normalise, RequirePresent, TableSpec
from siltgate.functions import lower_trimmed
from tests.conftest import rows


def verdicts(df, **rules):
    return {r["rule"]: r for r in table_report(df, rules).collect()}


@pytest.mark.parametrize("n", [0, 1, 50, 200_000])
def test_exact_values_lie_within_the_bounds(spark, n):
    df = spark.range(n).selectExpr("id", "id % 1000 AS k", "pow(id, 1.5) AS x", "IF(id % 2 = 0, id, NULL) AS half")
    parent = spark.range(0, 700).selectExpr("id AS p")
    got = verdicts(
        df, rows=Rows(least=n, most=n), ids=Distinct("id"), keys=Distinct("k"), half=Distinct("half"),
        median=Quantile("x", 0.5), top=Quantile("x", 1.0), covered=Covered("k", parent, "p"),
    )
    keys = min(n, 1000)
    exact = {
        "rows": n, "ids": n, "keys": keys, "half": (n + 1) // 2,
        "median": df.selectExpr("percentile(x, 0.5)").first()[0],
        "top": df.agg(F.max("x")).first()[0],
        "covered": min(keys, 700) / keys if keys else 1.0,
    }
    for rule, value in exact.items():
        if value is None:
            assert got[rule]["low"] is None and got[rule]["verdict"] == "passed"
        else:
            assert got[rule]["low"] <= value <= got[rule]["high"], rule


def test_verdicts(spark):
    df = spark.range(100_000).selectExpr("id", "id % 10 AS k")
    parent = spark.range(5).selectExpr("id AS p")
    got = verdicts(
        df, enough=Rows(least=10), few=Rows(most=10), at_the_limit=Distinct("id", least=100_000),
        half=Covered("k", parent, "p", least=0.4), all=Covered("k", parent, "p"),
    )
    states = {rule: r["verdict"] for rule, r in got.items()}
    assert states == {"enough": "passed", "few": "failed", "at_the_limit": "unsure", "half": "passed", "all": "failed"}


def test_one_pass_and_no_shuffle_of_rows(spark, plan, tmp_path):
    spark.range(1000).selectExpr("id", "id % 3 AS k").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    text = plan(table_report(df, {"a": Rows(), "b": Distinct("id"), "c": Quantile("k", 0.5)}))
    assert text.count("FileScan") == 1 and "hashpartitioning" not in text


# --- specs of any shape -----------------------------------------------------------

WORD = Field("word", StringType(), StringType())
BARE = TableSpec("bare", (Field("id", IntegerType(), IntegerType()), WORD), "id", ())
UNDATED = TableSpec(
    "undated", BARE.fields, "id", (RequirePresent(("word",)), KeepFirst(("id",)), Normalise("word", lower_trimmed))
)
CHILD = TableSpec(
    "child", (Field("n", IntegerType(), LongType()), Field("id", IntegerType(), IntegerType())), "n",
    (KeepFirst(("n",)),), ForeignKey("id", "undated", "id"),
)


def test_a_spec_without_rules_refuses_nothing(spark):
    raw = spark.createDataFrame([(1, " A ", 0), (1, None, 1)], "id int, word string, seq int")
    refused = refused_rows(raw, BARE, ["seq"])
    assert refused.columns == ["id", "word", "reason"] and refused.count() == 0
    assert dict(refused.dtypes)["reason"] == "string"
    assert clean(raw, BARE, ["seq"]).count() == 2


def test_a_whole_run_without_dates(spark, tmp_path):
    parents = spark.createDataFrame(
        [(1, " A ", 0), (1, "b", 1), (2, None, 2), (3, "C", 3)], "id int, word string, seq int"
    )
    children = spark.createDataFrame([(1, 1, 0), (2, 2, 1), (2, 3, 2), (3, None, 3)], "n int, id int, seq int")
    assert unreadable_dates(clean(parents, UNDATED, ["seq"], keep_raw=True), UNDATED, ["word"]).columns == [
        "table_name", "row_key", "word", "column_name", "original"
    ]
    got = run_batch(
        spark, {"undated": parents, "child": children}, {"undated": UNDATED, "child": CHILD},
        {"undated": ["seq"], "child": ["seq"]}, out_dir=str(tmp_path / "out"),
    )
    assert rows(got.tables["undated"]) == [(1, "a"), (3, "c")]
    assert rows(got.tables["child"]) == [(1, 1)] and rows(got.quarantine["child"]) == [(2, 2), (3, None)]
    assert got.unreadable.count() == 0
    counts = {(r.table_name, r.stage): r.n for r in got.counts.collect()}
    assert counts["undated", "raw"] == 4 and counts["undated", "kept_first"] == 2
    assert counts["child", "orphan"] == 2 and counts["child", "unparsed"] == counts["child", "missing"] == 0


def test_counts_are_observed_and_fall_back_to_the_files(spark, tmp_path, monkeypatch):
    from siltgate.plans import batch

    parents = spark.createDataFrame([(k, "w", k) for k in range(30)], "id int, word string, seq int")
    found = []
    for n, agreed in enumerate([batch._agreed, lambda *_: None]):
        counted = []
        monkeypatch.setattr(batch, "_agreed", agreed)
        monkeypatch.setattr(batch, "row_counts", lambda *a: counted.append(a) or real(*a))
        real = batch.__dict__["row_counts"] if n == 9 else __import__("siltgate.plans.cleaning", fromlist=["x"]).row_counts
        got = run_batch(spark, {"undated": parents}, {"undated": UNDATED}, {"undated": ["seq"]}, out_dir=str(tmp_path / str(n)))
        found.append(rows(got.counts))
        assert len(counted) == n
    assert found[0] == found[1]


def test_empty_tables_are_counted(spark, tmp_path):
    parents = spark.createDataFrame([], "id int, word string, seq int")
    got = run_batch(spark, {"undated": parents}, {"undated": UNDATED}, {"undated": ["seq"]}, out_dir=str(tmp_path / "o"))
    assert {r.n for r in got.counts.collect()} == {0} and got.counts.count() == 7


# --- names and repeats ------------------------------------------------------------


def test_columns_named_like_those_used_inside(spark):
    names = ["_route", "_lanes", "_lane", "_p_k", "_p_lane", "_place", "_child_key"]
    child = spark.range(0, 3000).selectExpr("id", "IF(id % 3 = 0, 7, id % 90) AS k", *[f"id AS `{n}`" for n in names])
    parent = spark.range(0, 60).selectExpr("id AS k", "concat('p', id) AS name")
    hot = hot_routes(child, ["k"], min_rows=500, lane_rows=100)
    assert hot.lanes
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = salted_join(child, parent, ["k"], how, spread_by=["id"], hot=hot)
        plain = child.join(parent, "k", how).select(*got.columns)
        assert got.exceptAll(plain).count() == 0 and got.count() == plain.count()
    assert keep_first(child, ["k"], ["id"]).columns == child.columns
    again = repeated_rows(child, ["k"], ["id"], hot)
    assert again.columns == child.columns
    assert again.count() == 3000 - child.select("k").distinct().count()
    joined = left_join_children(parent, child.drop("name"), "k", "id")
    assert joined.count() == 60 - child.select("k").distinct().join(parent, "k").count() + child.join(parent, "k").count()


def test_repeats_are_all_rows_but_the_first(spark, plan, tmp_path):
    draw = random.Random(3)
    lines = [(draw.choice([1, 1, 1, 2, None, draw.randint(3, 99)]), draw.randint(0, 400), k) for k in range(2000)]
    spark.createDataFrame(lines, "k int, seq int, tag int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    firsts = {k: min((s, t) for x, s, t in lines if x == k) for k in {x for x, _, _ in lines}}
    want = sorted(((k, s, t) for k, s, t in lines if firsts[k] != (s, t)), key=repr)
    hot = hot_routes(df, ["k"], min_rows=200, lane_rows=50)
    assert hot.lanes
    plain = repeated_rows(df, ["k"], ["seq", "tag"])
    cut = repeated_rows(df, ["k"], ["seq", "tag"], hot)
    assert plan(plain).count("hashpartitioning") == 1
    assert rows(plain) == rows(cut) == want
