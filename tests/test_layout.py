"""Files laid out by several columns, tables that move, and reports kept up by batches."""

from __future__ import annotations

import datetime as dt

import pytest

from siltgate import retail_specs, sources
from siltgate.operators import with_arrival
from siltgate.plans import clean_all, increments, run_batch
from siltgate.plans.batch import all_reports
from siltgate.sources import clustered, clustered_by, scan_csv
from tests import shop
from tests.conftest import rows

SPECS = retail_specs()


def files_to_open(spark, path, column, low, high):
    """Files whose own range of a column meets a filter, by the statistics a scan goes by."""
    files = len(spark.read.parquet(path).inputFiles())
    stats = spark.read.parquet(path).selectExpr("_metadata.file_path AS f", column)
    hit = stats.groupBy("f").agg({column: "min"}).join(stats.groupBy("f").agg({column: "max"}), "f")
    return hit.filter(f"`min({column})` <= {high} AND `max({column})` >= {low}").count(), files


@pytest.fixture(scope="module")
def points(spark):
    return spark.range(0, 40_000).selectExpr(
        "id", "CAST(pmod(xxhash64(id), 1000) AS INT) AS a", "pow(pmod(xxhash64(id, 7), 1000), 2) AS b",
        "IF(id % 3 = 0, 'hot', concat('k', id)) AS t", "date_add(DATE '2020-01-01', CAST(id % 900 AS INT)) AS d",
    )


def test_a_filter_on_either_column_skips_files(spark, points, tmp_path):
    both, one = str(tmp_path / "both"), str(tmp_path / "one")
    clustered_by(points, ["a", "b"], "id", files=64).write.parquet(both)
    clustered(points, "a", "id").write.parquet(one)
    assert rows(spark.read.parquet(both).groupBy("a").count()) == rows(points.groupBy("a").count())
    for column, low, high in (("a", 100, 110), ("b", 40_000, 44_000)):
        opened, files = files_to_open(spark, both, column, low, high)
        assert files == 64 and opened <= files / 3
    opened, files = files_to_open(spark, one, "b", 40_000, 44_000)
    assert opened == files


def test_hot_values_null_and_other_types(spark, points, tmp_path):
    odd = points.selectExpr("*", "CAST(NULL AS INT) AS nothing", "IF(id % 2 = 0, NULL, a) AS half", "id AS _curve", "id % 2 = 0 AS even")
    path = str(tmp_path / "t")
    laid = clustered_by(odd, ["t", "d", "nothing", "half", "even"], "id", files=16)
    assert laid.columns == odd.columns
    laid.write.parquet(path)
    sizes = spark.read.parquet(path).groupBy("_metadata.file_path").count()
    assert sizes.agg({"count": "max"}).first()[0] < 3 * 40_000 / 16  # a third is one text
    assert clustered_by(points.limit(0), ["a"], "id", files=2).count() == 0
    with pytest.raises(ValueError, match="no order"):
        clustered_by(points.selectExpr("id", "array(a) AS x"), ["x"], "id")


def test_a_registered_table_moves_without_a_gap(spark, tmp_path, monkeypatch):
    spec = SPECS["customers"]
    spark.sql("CREATE SCHEMA IF NOT EXISTS moves")
    for k in range(2):
        spark.createDataFrame([(k, f"n{k}", None, "x")], spec.clean_schema()).write.parquet(str(tmp_path / str(k)))
    sources.register_table(spark, spec, "moves.customers", str(tmp_path / "0"))
    said, plain = [], spark.sql
    monkeypatch.setattr(spark, "sql", lambda text, *a, **b: said.append(text) or plain(text, *a, **b))
    sources.register_table(spark, spec, "moves.customers", str(tmp_path / "1"))
    assert not any("DROP" in s for s in said)
    assert [r.name for r in spark.table("moves.customers").collect()] == ["n1"]
    # Other columns: the table is made anew.
    sources.register_table(spark, SPECS["orders"], "moves.customers", str(tmp_path / "1"))
    assert any("DROP" in s for s in said) and "order_id" in spark.table("moves.customers").columns


def test_reports_by_batches_are_those_of_everything(spark, tmp_path):
    paths = shop.write(tmp_path)
    raw = {n: with_arrival(scan_csv(spark, paths[n], SPECS[n])) for n in SPECS}
    done = clean_all(raw, SPECS, dict.fromkeys(SPECS, ["_arrival"]))
    tables = {n: sources.written(s.valid, str(tmp_path / "clean" / n)) for n, s in done.items()}
    target, as_of = str(tmp_path / "t"), dt.date(2024, 6, 1)
    orders, payments = tables["orders"], tables["payments"]
    for batch in (0, 1, 2, 1):  # the second comes twice
        part = orders.filter(f"order_id % 3 = {batch}")
        increments.add_orders(part, target, batch)
        increments.add_payments(
            payments.join(part.select("order_id"), "order_id", "left_semi"), orders, target, batch
        )
    merged = str(tmp_path / "merged")
    increments.merge_batches(spark, target, merged)
    want = all_reports(tables, as_of)
    for place in (target, merged):
        got = increments.current_reports(spark, tables["customers"], place, as_of)
        assert got.keys() == want.keys()
        for name in want:
            assert [tuple(r) for r in got[name].collect()] == [tuple(r) for r in want[name].collect()], name
    assert increments._orders(spark, merged).agg({"orders": "sum"}).first()[0] == orders.count()


def test_a_repeated_run_moves_its_tables(spark, tmp_path):
    paths = shop.write(tmp_path)
    raw = {n: with_arrival(scan_csv(spark, paths[n], SPECS[n])) for n in SPECS}
    arrival = dict.fromkeys(SPECS, ["_arrival"])
    for k in range(2):
        run_batch(spark, raw, SPECS, arrival, out_dir=str(tmp_path / f"run{k}"), schema="moved_shop")
    assert spark.table("moved_shop.orders").count() == 45
    files = spark.table("moved_shop.orders").inputFiles()
    assert files and all("/run1/" in f for f in files)
