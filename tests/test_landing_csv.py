"""Landing discovery and CSV fidelity."""

from __future__ import annotations

import os

import pytest

from tillroll.plans import pipeline
from tillroll.plans.pipeline import Layout
from tillroll.sources import landing

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def write_file(path, lines):
    path = path.removeprefix("file:")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(HEADER + "".join(lines))


def test_quotes_commas_short_and_long_lines(spark, workdir):
    root = f"{workdir}/landing"
    write_file(f"{root}/sales_2010_12.csv", [
        '536365,85123A,"HOLDER ""WHITE"", HANGING",6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom\n',
        "536366,22633,SHORT LINE,6\n",
        "536367,84879,LONG,6,2010-12-01 08:34:00,1.69,13047.0,United Kingdom,EXTRA\n",
        "536368,  padded  ,D,1,2010-12-01 08:34:00,1.00,,Spain  \n",
    ])
    rows = {r.InvoiceNo: r for r in landing.read_csv(spark, landing.landing_glob(root)).collect()}
    assert rows["536365"].Description == 'HOLDER "WHITE", HANGING'
    assert rows["536365"]._corrupt is None
    assert rows["536366"].InvoiceDate is None and rows["536366"]._corrupt is not None
    assert rows["536367"].Country == "United Kingdom" and rows["536367"]._corrupt is not None
    assert rows["536368"].StockCode == "  padded  " and rows["536368"].Country == "Spain  "
    assert rows["536368"].CustomerID is None
    assert {r._source_file for r in rows.values()} == {"sales_2010_12.csv"}


def test_discovery_ignores_other_names_and_reads_both_layouts(spark, workdir):
    root = f"{workdir}/landing"
    write_file(f"{root}/sales_2011_01.csv", ["1,A,a,1,2011-01-03 10:00:00,1.00,1.0,X\n"])
    write_file(f"{root}/other.csv", ["2,B,b,1,2011-01-03 10:00:00,1.00,1.0,X\n"])
    write_file(f"{root}/file=sales_2011_02.csv/part-00000.csv", ["3,C,c,1,2011-02-03 10:00:00,1.00,1.0,X\n"])
    write_file(f"{root}/file=sales_2011_02.csv/part-00001.csv", ["4,C,c,1,2011-02-04 10:00:00,1.00,1.0,X\n"])
    names = sorted(r.source_file for r in landing.list_landing(spark, root).collect())
    assert names == ["sales_2011_01.csv", "sales_2011_02.csv"]
    labels = sorted((r._source_file, r.InvoiceNo) for r in landing.read_csv(spark, landing.landing_glob(root)).collect())
    assert labels == [("sales_2011_01.csv", "1"), ("sales_2011_02.csv", "3"), ("sales_2011_02.csv", "4")]


def test_empty_landing_is_fine_missing_landing_is_an_error(spark, workdir):
    os.makedirs(f"{workdir}/empty".removeprefix("file:"), exist_ok=True)
    assert landing.list_landing(spark, f"{workdir}/empty").count() == 0
    with pytest.raises(FileNotFoundError):
        pipeline.ingest_bronze(spark, Layout(f"{workdir}/nothing-here"))


def test_csv_round_trip_keeps_text(spark, workdir):
    from helpers import row
    from pyspark.sql import functions as F
    from tillroll.schemas import RAW_SCHEMA, SOURCE_FILE

    rows = [row(Description=' a "quoted", text ', Country="  Spain  "), row(Description="")]
    df = spark.createDataFrame(rows, RAW_SCHEMA).withColumn(SOURCE_FILE, F.lit("sales_2010_12.csv"))
    landing.write_csv(df, f"{workdir}/landing")
    back = landing.read_csv(spark, landing.landing_glob(f"{workdir}/landing"))
    got = {r.Description: r.Country for r in back.collect()}
    # Cell whitespace, inner quotes and commas survive; an empty cell reads
    # back as NULL, as in the reference's CSV round trip.
    assert got == {' a "quoted", text ': "  Spain  ", None: "United Kingdom"}
