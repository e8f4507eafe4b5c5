from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltgate.functions import (
    DATE_FORMATS,
    blank_out,
    days_before,
    lower_trimmed,
    month_bucket,
    not_negative,
    parse_date,
    title_case,
)

D = dt.date

READ = {
    "2024-01-15": D(2024, 1, 15),
    "22-02-2024": D(2024, 2, 22),
    "2024/02/01": D(2024, 2, 1),
    "02/01/2024": D(2024, 2, 1),
    "29-02-2024": D(2024, 2, 29),
    "0024-01-01": D(24, 1, 1),
    "13/02/2024": None,
    "not_a_date": None,
    "2024-1-5": None,
    "5-1-2024": None,
    " 2024-01-01": None,
    "2024-01-15 ": None,
    "2024-01-15\n": None,
    "2024-01-01 10:00:00": None,
    "31-02-2024": None,
    "29-02-2023": None,
    "24-01-01": None,
    "٢٠٢٤-٠١-٠١": None,
    "": None,
    None: None,
}


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def column(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_dates(spark):
    assert column(texts(spark, READ), parse_date("t")) == list(READ.values())


def formatter(formats):
    return F.coalesce(*[F.try_to_date("t", f) for f in formats])


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.from_regex(r"[0-9]{1,4}[-/ ][0-9]{1,2}[-/ ][0-9]{1,4}", fullmatch=True),
                min_size=40, max_size=60))
def test_dates_agree_with_the_formatter(spark, values):
    df = texts(spark, values)
    got = df.select(parse_date("t").alias("a"), formatter(DATE_FORMATS).alias("b"), "t")
    assert got.filter("NOT (a <=> b)").select("t").collect() == []


def test_every_day_of_some_years_agrees(spark):
    days = spark.sql(
        "SELECT explode(sequence(DATE'1899-12-30', DATE'1901-01-02')) d UNION ALL "
        "SELECT explode(sequence(DATE'2023-01-01', DATE'2025-01-01'))"
    )
    for layout in DATE_FORMATS:
        wrong = days.select("d", F.date_format("d", layout).alias("t")).filter(
            parse_date("t").isNull() | (parse_date("t") != F.col("d"))
        )
        assert wrong.count() == 0


def test_formats_of_the_caller(spark):
    values = ["3 Feb 2024", "2024.02.03", "2024x02x03", "20240203"]
    got = column(texts(spark, values), parse_date("t", ["d MMM yyyy", "yyyy.MM.dd", "yyyyMMdd"]))
    assert got == [D(2024, 2, 3), D(2024, 2, 3), None, D(2024, 2, 3)]


def test_first_of_two_formats_of_one_shape_wins(spark):
    got = column(texts(spark, ["02/03/2024", "13/02/2024"]),
                 parse_date("t", ["MM/dd/yyyy", "dd/MM/yyyy"]))
    assert got == [D(2024, 2, 3), D(2024, 2, 13)]


def test_odd_column_names(spark):
    df = texts(spark, ["2024-01-15"]).withColumnRenamed("t", "my `date")
    assert column(df, parse_date("my `date")) == [D(2024, 1, 15)]


@pytest.mark.parametrize(
    ("text", "title", "lower"),
    [
        ("  iNDIA ", "India", "india"),
        ("UK", "Uk", "uk"),
        ("guinea-bissau", "Guinea-bissau", "guinea-bissau"),
        ("new  zealand", "New  Zealand", "new  zealand"),
        ("\tPeru", "\tperu", "\tperu"),
        ("", "", ""),
        (None, None, None),
    ],
)
def test_text(spark, text, title, lower):
    df = texts(spark, [text])
    assert column(df, title_case("t")) == [title]
    assert column(df, lower_trimmed("t")) == [lower]


def test_normalising_twice_changes_nothing(spark):
    df = texts(spark, ["  a bC ", "Ünited  x", "o'neil", "A-B c"])
    for function in (title_case, lower_trimmed):
        once = df.select("i", function("t").alias("t"))
        assert column(once, function("t")) == column(once, F.col("t"))


def test_blank_out(spark):
    df = texts(spark, ["NULL", "null", "x", "", None])
    assert column(df, blank_out("t", ["NULL", ""])) == [None, "null", "x", None, None]
    assert column(df, blank_out("t", [])) == ["NULL", "null", "x", "", None]


def test_not_negative(spark):
    values = [0.0, 1.5, -0.01, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    kept = [r.i for r in df.filter(not_negative("v")).orderBy("i").collect()]
    assert kept == [0, 1, 3, 4]
    kept = [r.i for r in df.filter(not_negative("v", finite=True)).orderBy("i").collect()]
    assert kept == [0, 1]


def test_month_and_days(spark):
    df = spark.createDataFrame([(0, D(2024, 3, 9)), (1, None)], "i int, d date")
    assert column(df, month_bucket("d")) == ["2024-03", None]
    one = spark.range(1)
    assert one.select(days_before(D(2024, 3, 1), 90)).first()[0] == D(2023, 12, 2)
    assert one.select(days_before(None, 0) == F.current_date()).first()[0]
