"""What the pipeline's steps shuffle, write and work out: each row no more often than needed."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tillroll.functions.naming import plain_path
from tillroll.functions.parsing import parse_exact_price, parse_price, revenue
from tillroll.operators import bronze as layers
from tillroll.operators import silver
from tillroll.schemas import SOURCE_FILE
from tillroll.sources import landing
from tillroll.sources.fixture import sales_lines

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _files(path: str, kind: str) -> list[str]:
    return glob.glob(f"{path.removeprefix('file:')}/**/*.{kind}", recursive=True)


def test_bronze_is_written_where_it_is_read(spark, workdir):
    """No shuffle gathers a file's rows again: as many files as splits were read."""
    rows = sales_lines(spark, SF).withColumn(SOURCE_FILE, F.lit("sales_2011_01.csv"))
    rows.drop(SOURCE_FILE).repartition(4).write.options(header="true").csv(f"{workdir}/landing/sales_2011_01.csv")
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task reads one file
    try:
        raw = landing.read_csv(spark, landing.landing_glob(f"{workdir}/landing"))
        layers.write_layer(layers.to_bronze(raw), f"{workdir}/bronze")
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)
    assert len(_files(f"{workdir}/bronze", "parquet")) == 4
    assert layers.read_bronze(spark, f"{workdir}/bronze").count() == rows.count()


def test_settings_come_back_after_a_write(spark, workdir):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    layers.write_layer(layers.to_bronze(sales_lines(spark, SF).limit(3).withColumn("_corrupt", F.lit(None).cast("string"))), f"{workdir}/b")
    assert spark.conf.get(name) == before


def test_split_files_are_compressed_and_read_back(spark, workdir):
    lines = sales_lines(spark, SF)
    landing.write_csv(lines, f"{workdir}/landing")
    parts = [f for f in _files(f"{workdir}/landing", "*") if "/part-" in f]
    assert parts and all(f.endswith(".csv.gz") for f in parts)
    back = landing.read_csv(spark, landing.landing_glob(f"{workdir}/landing"))
    want = lines.select(*back.drop("_corrupt").columns)
    assert back.drop("_corrupt").exceptAll(want).isEmpty() and want.exceptAll(back.drop("_corrupt")).isEmpty()


def test_revenue_is_worked_out_once(spark, workdir):
    raw = sales_lines(spark, SF).withColumn("_corrupt", F.lit(None).cast("string"))
    layers.write_layer(layers.to_bronze(raw), f"{workdir}/bronze")
    p = plan(silver.clean(layers.read_bronze(spark, f"{workdir}/bronze")))
    assert p.count("as decimal(20,0)") == 1


def test_lines_are_shuffled_without_the_columns_of_their_rules(spark):
    p = plan(sales_lines(spark, SF))
    lineitem = next(line for line in p.splitlines() if "Project" in line and "l_returnflag" in line)
    assert "AS cancelled" in lineitem and "AS no_stock" in lineitem
    assert p.count("l_suppkey#") == p[p.index(lineitem.strip()):].count("l_suppkey#")  # only at the scan


def test_plain_path_with_and_without_escapes(spark):
    rows = [("file:/a/b%20c/x+y.csv",), ("file:/a/x+y.csv",), (None,), ("a%25",)]
    got = [r[0] for r in spark.createDataFrame(rows, "u string").select(plain_path("u")).collect()]
    assert got == ["file:/a/b c/x+y.csv", "file:/a/x+y.csv", None, "a%"]


def test_what_an_order_decides_is_worked_out_per_order(spark):
    """Dates are rendered before the lines are joined, and the orders are joined last."""
    p = plan(sales_lines(spark, SF))
    rendered = [line for line in p.splitlines() if "date_format" in line]
    assert rendered and not any("l_orderkey" in line for line in rendered)


def test_timestamps_of_the_layers_are_longs(spark, workdir):
    rows = sales_lines(spark, SF).limit(3).withColumn("_corrupt", F.lit(None).cast("string"))
    layers.write_layer(layers.to_bronze(rows), f"{workdir}/bronze")
    schema = pq.ParquetFile(_files(f"{workdir}/bronze", "parquet")[0]).schema
    assert schema.column(schema.names.index("_ingested_at_utc")).physical_type == "INT64"


def test_prices_of_whole_cents_take_the_short_product(spark):
    rows = [("12.34", 3), ("0.5", 7), (" 1E1 ", 2), ("9999999999.99", 2147483647), ("10000000000.00", 2), ("0.125", 2), ("-1.25", 4), ("1e25", 1)]
    raw = spark.createDataFrame(rows, "p string, q int").select("q", parse_price("p").alias("p"), parse_exact_price("p").alias("e"))
    got = raw.select(revenue("q", "p", "e").alias("r"))
    want = ["37.02", "3.50", "20.00", "21474836469978525163.53", "20000000000.00", "0.25", "-5.00", "10000000000000000000000000.00"]
    assert [str(r[0]) for r in got.collect()] == want
    assert "decimal(12,2)" in plan(got)
