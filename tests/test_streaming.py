from __future__ import annotations

import pytest

from siltgate import retail_specs
from siltgate.operators import split_by_parent, with_arrival
from siltgate.plans import clean, clean_all
from siltgate.sources import scan_csv
from siltgate.streaming import (
    clean_new_files,
    ingest_new_files,
    read_cleaned,
    scan_csv_stream,
)
from tests import shop
from tests.conftest import rows

SPECS = retail_specs()
ORDERS = SPECS["orders"]


def drop(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([shop.orders()[0], *lines]) + "\n")


def test_files_are_read_once(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "out")
    lines = shop.orders()[1:]
    drop(landing, "a.csv", lines[:20])
    for n in (20, 20):  # the second run finds nothing new
        ingest_new_files(scan_csv_stream(spark, str(landing), ORDERS), target, timeout=120)
        assert spark.read.parquet(target).count() == n
    drop(landing, "b.csv", lines[20:])
    ingest_new_files(scan_csv_stream(spark, str(landing), ORDERS, max_files=1), target)
    read = spark.read.parquet(target)
    assert rows(read) == rows(scan_csv(spark, str(landing), ORDERS))


@pytest.fixture
def customers(spark):
    return spark.range(1, 21).selectExpr("CAST(id AS INT) AS customer_id")


@pytest.mark.parametrize("cuts", [[], [10, 30], [1, 2, 49]])
def test_cleaning_in_pieces_is_cleaning_at_once(spark, tmp_path, customers, cuts):
    lines = shop.orders()[1:]
    lines += ["60,1,2024-01-01,-1,completed", "60,1,2024-01-01,1,completed", "10,1,,1,completed"]
    landing, target = tmp_path / "in", str(tmp_path / "out")
    for n, (lo, hi) in enumerate(zip([0, *cuts], [*cuts, len(lines)], strict=True)):
        drop(landing, f"{n:02d}.csv", lines[lo:hi])
        clean_new_files(
            scan_csv_stream(spark, str(landing), ORDERS), ORDERS, target, parent=customers
        )
    raw = with_arrival(scan_csv(spark, str(landing), ORDERS))
    want = split_by_parent(clean(raw, ORDERS, ["_arrival"]), customers, ORDERS)
    assert rows(read_cleaned(spark, ORDERS, target, "clean")) == rows(want.valid)
    # Order 10 came first without a known customer: its key stays used.
    assert rows(read_cleaned(spark, ORDERS, target, "orphan")) == rows(want.orphans)
    refused = read_cleaned(spark, ORDERS, target, "refused")
    assert [r.order_id for r in refused.collect()] == [60]


def test_many_batches_in_one_run(spark, tmp_path, customers):
    lines = shop.orders()[1:]
    landing, target = tmp_path / "in", str(tmp_path / "out")
    for n in range(3):
        drop(landing, f"{n}.csv", lines[n * 17 : (n + 1) * 17])
    stream = scan_csv_stream(spark, str(landing), ORDERS, max_files=1)
    clean_new_files(stream, ORDERS, target, parent=customers, timeout=300)
    assert read_cleaned(spark, ORDERS, target, "clean").count() == 45
    assert spark.read.parquet(target).select("batch_id").distinct().count() == 3


def test_table_without_parent(spark, tmp_path):
    paths = shop.write(tmp_path)
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "c.csv").write_text(open(paths["customers"]).read())
    spec, target = SPECS["customers"], str(tmp_path / "out")
    clean_new_files(scan_csv_stream(spark, str(landing), spec), spec, target)
    raw = {"customers": with_arrival(scan_csv(spark, paths["customers"], spec))}
    want = clean_all(raw, SPECS, {"customers": ["_arrival"]}, "customers")["customers"].valid
    assert rows(read_cleaned(spark, spec, target, "clean")) == rows(want)
    with pytest.raises(ValueError, match="parent"):
        clean_new_files(scan_csv_stream(spark, str(landing), ORDERS), ORDERS, target)
