"""Input files that cannot be read are named, and taken whole or not at all."""

from __future__ import annotations

import gzip

import pytest

from siltgate import retail_specs, sources
from tests import shop
from tests.conftest import rows

ORDERS = retail_specs()["orders"]


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "in"
    (folder / "day 1").mkdir(parents=True)
    head, *lines = shop.orders()
    for k in range(5):
        text = "\n".join([head, *lines[k * 10 : (k + 1) * 10]]) + "\n"
        (folder / "day 1" / f"{k}.csv.gz").write_bytes(gzip.compress(text.encode()))
    (folder / "plain.csv").write_text(head + "\n900,1,2024-01-01,5,completed\n")
    (folder / "header only.csv").write_text(head + "\n")
    (folder / "empty.csv").write_text("")
    return folder


def break_off(path):
    """A packed file that ends in the middle, after rows that can be read."""
    lines = [shop.orders()[0], *(f"{k},1,2024-01-01,{k},completed" for k in range(10_000))]
    whole = gzip.compress("\n".join(lines).encode())
    path.write_bytes(whole[: len(whole) // 2])


def test_all_files_read(spark, landing):
    """A file without a single byte is not listed: it has nothing to lose."""
    got = sources.scan_readable(spark, str(landing), ORDERS)
    assert got.rows.count() == 51 and got.skipped.count() == 0
    assert sources.list_files(spark, str(landing)).count() == 7


def test_broken_files_are_named_and_left_out_whole(spark, landing):
    break_off(landing / "day 1" / "2.csv.gz")
    (landing / "no.csv.gz").write_text("this is no packed file at all\n" * 9)
    with pytest.warns(UserWarning, match="2 of 8 files"):
        got = sources.scan_readable(spark, str(landing), ORDERS)
    assert got.rows.count() == 41
    assert got.rows.filter("order_id = 9999").count() == 0
    named = {r["file"].rsplit("/", 1)[1]: r for r in got.skipped.collect()}
    assert named.keys() == {"2.csv.gz", "no.csv.gz"}
    assert all(r["bytes"] > 0 and "Exception" in r["reason"] for r in named.values())
    with pytest.warns(UserWarning):
        again = sources.scan_csv(spark, str(landing), ORDERS, skip_unreadable_files=True)
    assert rows(again) == rows(got.rows)


def test_files_that_are_gone(spark, landing):
    before = [r["file"] for r in sources.list_files(spark, str(landing)).collect()]
    (landing / "plain.csv").unlink()
    found = sources.unreadable_files(spark, str(landing), before).collect()
    assert [(r["file"].rsplit("/", 1)[1], r["bytes"]) for r in found] == [("plain.csv", None)]
    assert "not there" in found[0]["reason"]


def test_no_file_can_be_read(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_text("nothing packed here, only a long line of text\n" * 5)
    with pytest.warns(UserWarning, match="1 of 1"):
        got = sources.scan_readable(spark, str(tmp_path), ORDERS)
    assert got.rows.columns == ORDERS.columns and got.rows.count() == 0
