"""Cases that a small green query does not see."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from pyspark.sql.types import DateType, IntegerType, StringType

from checks.inputs import ARRIVAL, SPECS, raw_tables
from siltgate import sources
from siltgate.operators import (
    left_join_children,
    repeated_rows,
    upsert,
    with_arrival,
    with_value,
)
from siltgate.operators.skew import NO_HOT_KEYS
from siltgate.plans import clean, run_batch
from siltgate.spec import Field, KeepFirst, TableSpec, retail_specs
from siltgate.streaming import clean_new_files, read_cleaned, scan_csv_stream
from tests.conftest import rows


def test_upsert_twice_is_upsert_once(spark):
    base = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    changes = spark.createDataFrame([(None, "n"), (2, "c")], "id int, v string")
    once = upsert(base, changes, "id", ["v"])
    twice = upsert(once, changes, "id", ["v"])
    assert rows(once) == rows(twice) == [(1, "a"), (2, "c"), (None, "n")]


def test_a_parent_may_not_repeat_its_key(spark):
    specs = dict(SPECS)
    steps = [s for s in specs["customers"].steps if not isinstance(s, KeepFirst)]
    specs["customers"] = replace(specs["customers"], steps=tuple(steps))
    with pytest.raises(ValueError, match="needs KeepFirst"):
        run_batch(spark, raw_tables(spark, "/root/testdata/sf0.001"), specs, ARRIVAL)


def test_clean_types_are_applied(spark):
    spec = TableSpec(
        name="t",
        fields=(
            Field("id", StringType(), IntegerType(), required=True),
            Field("day", StringType(), DateType()),
        ),
        key="id",
        steps=(KeepFirst(("id",)),),
    )
    raw = spark.createDataFrame(
        [("1", "2024-01-05", 0), ("x", None, 1)], "id string, day string, seq int"
    )
    cleaned = clean(raw, spec, ["seq"])
    assert [f.dataType for f in cleaned.schema.fields] == [IntegerType(), DateType()]
    assert sorted((r.id is None, str(r.day)) for r in cleaned.collect()) == [
        (False, "2024-01-05"),
        (True, "None"),
    ]


def test_rows_that_tie_with_the_first_are_reported(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 0, "a"), (2, 0, "b")], "k int, seq int, v string")
    assert rows(repeated_rows(df, ["k"], ["seq"], NO_HOT_KEYS)) == [(1, 0, "a")]


def test_raw_files_are_read_once(spark, tmp_path):
    """After the run nothing goes back to the raw files: they are gone."""
    specs = retail_specs()
    raw = {}
    for name, df in raw_tables(spark, "/root/testdata/sf0.001").items():
        path = str(tmp_path / name)
        sources.write_csv(df.select(*specs[name].columns), path)
        raw[name] = with_arrival(sources.scan_csv(spark, path, specs[name]))
    result = run_batch(spark, raw, specs, dict.fromkeys(specs, ["_arrival"]))
    for name in specs:
        for part in (tmp_path / name).iterdir():
            part.write_bytes(b"")
    counted = {(r.table_name, r.stage): r.n for r in result.counts.collect()}
    assert counted["orders", "raw"] == 1508
    assert counted["orders", "clean"] + counted["orders", "orphan"] == 1471
    assert result.unreadable.count() > 0


def _order_file(folder, name, amount, when):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text(f"order_id,customer_id,order_date,amount,status\n1,1,2024-01-01,{amount},x\n")
    os.utime(path, (when, when))


@pytest.mark.parametrize("per_batch", [1, 10])
def test_the_older_file_wins_however_batches_are_cut(spark, tmp_path, per_batch):
    landing = tmp_path / "landing"
    _order_file(landing, "z.csv", 10, 1_700_000_000)
    _order_file(landing, "a.csv", 20, 1_700_000_100)
    spec = retail_specs()["orders"]
    parent = spark.createDataFrame([(1,)], "customer_id int")
    target = str(tmp_path / "target")
    stream = scan_csv_stream(spark, str(landing), spec, max_files=per_batch)
    clean_new_files(stream, spec, target, parent=parent)
    assert [r.amount for r in read_cleaned(spark, spec, target, "clean").collect()] == [10.0]


def test_an_orphan_is_clean_once_its_parent_has_come(spark, tmp_path):
    landing = tmp_path / "landing"
    _order_file(landing, "a.csv", 10, 1_700_000_000)
    spec = retail_specs()["orders"]
    none, one = (spark.createDataFrame(d, "customer_id int") for d in ([(2,)], [(1,)]))
    target = str(tmp_path / "target")
    clean_new_files(scan_csv_stream(spark, str(landing), spec), spec, target, parent=none)
    assert read_cleaned(spark, spec, target, "clean").count() == 0
    assert read_cleaned(spark, spec, target, "clean", parent=one).count() == 1
    assert read_cleaned(spark, spec, target, "orphan", parent=one).count() == 0


def test_line_breaks_survive_the_stream(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text(
        'customer_id,name,signup_date,country\n1,"a\nb",2024-01-01,x\n', newline=""
    )
    spec = retail_specs()["customers"]
    target = str(tmp_path / "target")
    clean_new_files(
        scan_csv_stream(spark, str(landing), spec, multi_line=True), spec, target
    )
    assert [r.name for r in read_cleaned(spark, spec, target, "clean").collect()] == ["a\nb"]


def test_unreadable_files_stop_the_job_or_are_skipped(spark, tmp_path):
    import gzip

    spec = retail_specs()["customers"]
    good = "customer_id,name,signup_date,country\n1,a,2024-01-01,x\n"
    (tmp_path / "a.csv").write_text(good)
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress(good.encode() * 2000)[:60])
    with pytest.raises(Exception, match=r"(?i)b\.csv\.gz|gzip|unexpected end|EOF"):
        sources.scan_csv(spark, str(tmp_path), spec).collect()
    read = sources.scan_csv(spark, str(tmp_path), spec, skip_unreadable_files=True)
    assert read.filter("customer_id = 1 AND name = 'a'").count() >= 1


def test_a_column_with_a_dot(spark):
    df = spark.createDataFrame([(1,), (2,)], "`a.b` int")
    assert with_value(df, "a.b", 2).count() == 1


def test_a_left_join_without_hot_keys_is_one_join(spark, plan):
    parent = spark.range(5).selectExpr("id AS k", "id AS name")
    child = spark.range(20).selectExpr("id % 3 AS k", "id AS c")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left_join_children(parent, child, "k", "c", NO_HOT_KEYS)
        text = plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 1 and text.count("Exchange hash") == 2
    assert joined.count() == 22 and joined.columns == ["k", "name", "c"]
