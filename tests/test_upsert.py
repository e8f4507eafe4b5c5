"""Upserts into a written table, and joins that measure before they broadcast."""

from __future__ import annotations

from pathlib import Path

import pytest

from siltgate.operators import joins, read_keyed, upsert, upsert_into, write_keyed
from tests.conftest import rows


def files_of(path):
    return {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}


@pytest.fixture
def base(spark):
    return spark.range(0, 2000).selectExpr(
        "IF(id = 5, NULL, id) AS k", "concat('v', id) AS v", "id % 7 AS _changed"
    )


def changes(spark, *lines):
    return spark.createDataFrame(lines, "k long, v string, _changed long, at int")


def test_only_folders_with_changed_keys_are_replaced(spark, base, tmp_path):
    path = str(tmp_path / "t")
    write_keyed(base, path, "k", buckets=16)
    assert rows(read_keyed(spark, path)) == rows(base)
    before = files_of(path)
    new = changes(spark, (3, "old", 1, 1), (3, "new", 1, 2), (10_000, "added", 0, 1), (None, "none", 0, 1))
    upsert_into(spark, path, new, "k", ["at DESC"])
    once = rows(read_keyed(spark, path))
    assert once == rows(upsert(base, new, "k", ["at DESC"]))
    assert ("3", "new") in {(str(r[0]), r[1]) for r in once}
    after = files_of(path)
    kept = before.keys() & after.keys()
    assert all(before[f] == after[f] for f in kept)
    touched = {Path(f).parent.name for f in after.keys() - before.keys()}
    assert len(touched) <= 3 and {Path(f).parent.name for f in kept}.isdisjoint(touched)
    upsert_into(spark, path, new, "k", ["at DESC"])
    assert rows(read_keyed(spark, path)) == once


def test_no_changes_and_wrong_tables(spark, base, tmp_path):
    path = str(tmp_path / "t")
    write_keyed(base, path, "k")
    before = files_of(path)
    upsert_into(spark, path, changes(spark, (1, "a", 0, 0)).filter("false"), "k", ["at"])
    assert files_of(path) == before
    base.write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="write_keyed"):
        upsert_into(spark, str(tmp_path / "plain"), changes(spark, (1, "a", 0, 0)), "k", ["at"])


def test_changes_in_another_type_reach_the_same_folder(spark, base, tmp_path):
    path = str(tmp_path / "t")
    write_keyed(base, path, "k")
    narrow = changes(spark, (7, "seven", 0, 0)).selectExpr("CAST(k AS INT) AS k", "v", "_changed", "at")
    upsert_into(spark, path, narrow, "k", ["at"])
    assert [r["v"] for r in read_keyed(spark, path).filter("k = 7").collect()] == ["seven"]


def test_a_large_parent_is_not_read_to_be_measured(spark, tmp_path, monkeypatch, plan):
    path = str(tmp_path / "parent")
    spark.range(0, 50_000).selectExpr("id AS k", "sha2(string(id), 256) AS name").write.parquet(path)
    parent = spark.read.parquet(path)
    child = spark.range(0, 100).selectExpr("id AS c", "id * 3 AS k")
    size = joins.input_bytes(parent)
    assert size > 1_000_000
    measured = []
    monkeypatch.setattr(joins, "measured_bytes", lambda df: measured.append(df) or 10)
    joined = joins.join_small_parent(child, parent, "k", "c", max_bytes=size // 10)
    assert not measured and joined.count() == 100
    joined = joins.join_small_parent(child, parent, "k", "c", max_bytes=size)
    assert len(measured) == 1 and "BroadcastHashJoin" in plan(joined) and joined.count() == 100
