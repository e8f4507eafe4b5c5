from __future__ import annotations

import re
from pathlib import Path

import __spark_entry__ as driver
from checks.queries import QUERIES
from checks.sql import SQL

ROOT = Path(driver.__file__).parent


def test_every_query_has_its_sql():
    assert QUERIES.keys() == SQL.keys()
    assert driver.queries().keys() >= QUERIES.keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()
    assert all(callable(q) for q in driver.queries().values())


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["customer_id", "name", "total_revenue"]
    assert result.count() == 141


def test_the_library_collects_nothing_and_has_no_udf():
    for path in (ROOT / "siltgate").rglob("*.py"):
        if "llm" in path.parts:
            continue  # models are fitted on bounded samples there
        text = path.read_text()
        assert not re.search(r"\.collect\(|\.toPandas|\budf\(|\.rdd\b|localCheckpoint", text), path
        assert "crossJoin" not in text, path
