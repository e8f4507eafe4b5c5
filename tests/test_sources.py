from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltgate import retail_specs
from siltgate import sources
from siltgate.operators import keep_first, with_arrival
from siltgate.sources.csv import malformed
from tests.conftest import rows

SPECS = retail_specs()
ORDERS = SPECS["orders"]


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


HEAD = "order_id,customer_id,order_date,amount,status"


def test_what_cells_become(spark, tmp_path):
    path = put(
        tmp_path, "o.csv", HEAD, "1,2,2024-01-01,5.5,ok", "x9,2,,NaN,", '3,,"",1e400,"a,b"',
        "4,5,,,  padded  ", "5,6,,-5,NULL",
    )
    got = sources.scan_csv(spark, path, ORDERS)
    assert rows(got.selectExpr("* EXCEPT (amount)", "string(amount)")) == sorted(
        [(1, 2, "2024-01-01", "ok", "5.5"), (4, 5, None, "  padded  ", None),
         (5, 6, None, "NULL", "-5.0"), (3, None, None, "a,b", "Infinity"),
         (None, 2, None, None, "NaN")], key=repr,
    )
    tokens = sources.scan_csv(spark, path, ORDERS, null_tokens=["NULL"])
    assert tokens.filter("order_id = 5").first().status is None
    assert tokens.schema == ORDERS.raw_schema()


def test_malformed_rows_whatever_is_read(spark, tmp_path):
    path = put(tmp_path, "o.csv", HEAD, "1,2,2024-01-01,5.5,ok", "2,2,2024-01-01,abc,ok",
               "3,2,2024-01-01,1,ok,extra", "4,2,2024-01-01,1,5,ok")
    read = sources.scan_csv(spark, path, ORDERS, corrupt_column="bad")
    bad = malformed(read, "bad")
    assert rows(bad.select("order_id")) == [(2,), (3,), (4,)]
    assert bad.select("bad").filter("order_id = 3").first().bad == "3,2,2024-01-01,1,ok,extra"
    dropped = sources.scan_csv(spark, path, ORDERS, mode="DROPMALFORMED")
    assert dropped.count() == 1 and rows(dropped.select("order_id")) == [(1,)]
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        sources.scan_csv(spark, path, ORDERS, mode="FAILFAST").select("order_id").collect()
    with pytest.raises(ValueError, match="mode"):
        sources.scan_csv(spark, path, ORDERS, mode="LAX")


def test_a_reordered_header_is_noticed_on_request(spark, tmp_path):
    path = put(tmp_path, "o.csv", "customer_id,order_id,order_date,amount,status", "1,2,,,")
    assert sources.scan_csv(spark, path, ORDERS).first().order_id == 1  # bound by position
    with pytest.raises(Exception, match="header does not conform"):
        sources.scan_csv(spark, path, ORDERS, check_header=True).collect()


def test_arrival_follows_files_and_lines(spark, tmp_path):
    path = put(tmp_path, "a.csv", HEAD, "1,1,,1,first", "2,1,,1,first", "2,1,,1,second")
    put(tmp_path, "b.csv", HEAD, "1,1,,1,second", "3,1,,1,first")
    raw = with_arrival(sources.scan_csv(spark, path, ORDERS))
    kept = keep_first(raw, ["order_id"], ["_arrival"])
    assert rows(kept.select("order_id", "status")) == [(i, "first") for i in (1, 2, 3)]
    with pytest.raises(ValueError, match="order"):
        keep_first(raw, ["order_id"], [])


def test_csv_sink_keeps_blanks_and_quotes(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 2, "d", 0.5, ' a "b", c '), (2, None, None, None, "x")], ORDERS.raw_schema()
    )
    path = str(tmp_path / "q")
    sources.write_csv(df, path)
    assert rows(sources.scan_csv(spark, path, ORDERS)) == rows(df)
    sources.write_csv(df.filter("false"), path)
    assert sources.scan_csv(spark, path, ORDERS).count() == 0


@pytest.fixture
def schema(spark):
    name = "s" + sources.staging_dir(spark, "x").rsplit("-", 1)[1]
    sources.create_schema(spark, name, sources.staging_dir(spark, "schema"))
    return name


def test_declared_table(spark, schema):
    table = f"{schema}.orders"
    ddl = sources.table_ddl(ORDERS, table, "delta")
    assert "order_id INT NOT NULL" in ddl and "order_date DATE," in ddl and "USING delta" in ddl
    sources.create_table(spark, ORDERS, table)
    assert [f.dataType for f in spark.table(table).schema] == [
        f.dataType for f in ORDERS.clean_schema()
    ]
    df = spark.createDataFrame([("s", 1.0, dt.date(2024, 1, 1), 7, 8)],
                               "status string, amount double, order_date date, "
                               "order_id int, customer_id int")
    sources.load_table(df, table)
    sources.load_table(df, table)
    assert rows(spark.table(table)) == [(7, 8, dt.date(2024, 1, 1), 1.0, "s")]


def test_replacing_a_table(spark, schema):
    table = f"{schema}.t"
    sources.save_table(spark.range(3), table)
    # New schema, and the query reads the table it replaces.
    sources.save_table(sources.read_table(spark, table).selectExpr("id", "id * 2 AS twice"), table)
    assert rows(spark.table(table)) == [(0, 0), (1, 2), (2, 4)]
    broken = spark.table(table).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(PySparkException):
        sources.save_table(broken, table)
    assert spark.table(table).count() == 3  # a failed write leaves the old table
    sources.save_table(spark.range(5), table)
    assert spark.table(table).count() == 5


def test_not_null_is_checked(spark):
    df = spark.createDataFrame([(None, None, None, None, "x"), (1, 2, None, None, None)],
                               ORDERS.raw_schema())
    assert rows(sources.null_violations(df, ORDERS)) == [
        ("amount", 2), ("customer_id", 1), ("order_id", 1), ("status", 1),
    ]


def test_months_are_pruned_and_hot_months_split(spark, tmp_path, plan):
    df = spark.range(40_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN DATE'2024-02-01' "
        "ELSE date_add(DATE'2023-01-01', CAST(id % 365 AS INT)) END AS d", "uuid() AS pad",
    )
    path = str(tmp_path / "m")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    spark.conf.set("spark.sql.shuffle.partitions", "512")
    try:
        sources.write_by_month(df, path, "d")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    back = spark.read.parquet(path)
    assert back.count() == 40_000 and back.filter("year IS NULL").count() == 13_334
    one = back.filter("year = 2024 AND month = 2")
    assert "PartitionFilters: [isnotnull" in plan(one)
    files = {}
    for name in back.inputFiles():
        month = name.rsplit("/", 1)[0]
        files[month] = files.get(month, 0) + 1
    assert len(files) == 14
    assert {n for m, n in files.items() if "year=2023" in m} == {1}
    assert all(n > 1 for m, n in files.items() if "year=2023" not in m)


def test_clustering_splits_a_hot_key_and_sorts(spark, tmp_path):
    df = spark.range(0, 9000, 1, 3).selectExpr("id", "IF(id % 3 = 0, 5, id % 100) AS k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid_out = sources.clustered(df, "k", "id")
        sizes = laid_out.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")
        ).orderBy("p").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(r.n for r in sizes) < 3000
    assert all(a.hi <= b.lo for a, b in zip(sizes, sizes[1:], strict=False))


def test_staging_is_under_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = (sources.staging_dir(spark, "x") for _ in range(2))
    assert first.startswith(f"{root}/siltgate/x-") and first != second


class Settings:
    """Just the settings of a session."""

    def __init__(self, **values):
        self.values = {k.replace("_", "."): v for k, v in values.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_a_cluster_has_to_name_a_shared_folder():
    with pytest.raises(ValueError, match="checkpoint"):
        sources.staging_dir(Settings(spark_master="yarn"), "x")
    assert "siltgate" in sources.staging_dir(Settings(spark_master="local[2]"), "x")


def test_written(spark):
    df = spark.range(10).selectExpr("id", "id % 2 = 0 AS even")
    back = sources.written(df, sources.staging_dir(spark, "w"))
    assert rows(back) == rows(df)
