"""Incremental runs, idempotence, ledgers, split and preview."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from helpers import row
from tillroll.operators import bronze as layers
from tillroll.operators import gold, ledger
from tillroll.plans import catalog, pipeline
from tillroll.plans.pipeline import Layout
from tillroll.schemas import RAW_SCHEMA, SOURCE_FILE
from tillroll.sources import landing
from tillroll.sources.fixture import sales_lines

SF = "/root/testdata/sf0.001"
HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def write_file(path, lines):
    path = path.removeprefix("file:")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(HEADER + "".join(lines))


def gold_rows(spark, layout):
    return sorted(map(tuple, gold.long_form(pipeline.read_gold(spark, layout)).collect()))


def counts(spark, layout):
    b = layers.read_bronze(spark, layout.bronze).groupBy(SOURCE_FILE).count()
    s = layers.read_silver(spark, layout.silver).groupBy(SOURCE_FILE).count()
    return sorted(map(tuple, b.collect())), sorted(map(tuple, s.collect()))


def test_incremental_equals_all_at_once_and_rerun_is_noop(spark, workdir):
    once = Layout(f"{workdir}/once")
    landing.write_csv(sales_lines(spark, SF), once.landing)
    pipeline.run_increment(spark, once)

    stepwise = catalog.arrival_scenario(spark, SF)  # two arrivals
    assert gold_rows(spark, once) == gold_rows(spark, stepwise)
    assert counts(spark, once) == counts(spark, stepwise)

    # in-memory gold (no files at all) agrees too
    mem = gold.long_form(gold.gold_tables(gold.totals(catalog._silver(spark, SF))))
    assert sorted(map(tuple, mem.collect())) == gold_rows(spark, once)

    before = counts(spark, once)
    metrics = pipeline.run_increment(spark, once)
    assert metrics["bronze"]["files"] == 0 and metrics["silver"]["files"] == 0
    assert counts(spark, once) == before


def test_crash_between_data_and_ledger_then_retry(spark, workdir, monkeypatch):
    layout = Layout(f"{workdir}/crash")
    landing.write_csv(sales_lines(spark, SF), layout.landing)
    real_record = ledger.record_names
    calls = {"n": 0}

    def failing_record(*args, **kwargs):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("driver lost before the ledger write")
        return real_record(*args, **kwargs)

    monkeypatch.setattr(ledger, "record_names", failing_record)
    with pytest.raises(RuntimeError):
        pipeline.ingest_bronze(spark, layout)
    assert layers.read_bronze(spark, layout.bronze).count() > 0  # data written
    assert ledger.read_ledger(spark, layout.bronze_ledger).count() == 0  # ledger not
    pipeline.ingest_bronze(spark, layout)  # retry
    monkeypatch.setattr(ledger, "record_names", real_record)
    assert layers.read_bronze(spark, layout.bronze).count() == sales_lines(spark, SF).count()


def test_edge_files(spark, workdir):
    layout = Layout(f"{workdir}/edges")
    write_file(f"{layout.landing}/sales_2010_12.csv", ["536365,85123A,H,6,2010-12-01 08:26:00,2.55,17850.0,UK\n"])
    write_file(f"{layout.landing}/sales_2011_01.csv", [])  # header only
    write_file(f"{layout.landing}/sales_2011_02.csv", ["C1,85123A,H,6,2011-02-01 08:26:00,2.55,1.0,UK\n"])  # all rejected
    write_file(f"{layout.landing}/other.csv", ["1,X,H,6,2011-02-01 08:26:00,2.55,1.0,UK\n"])  # ignored
    pipeline.run_increment(spark, layout)
    bronze_files = sorted(r.source_file for r in ledger.read_ledger(spark, layout.bronze_ledger).collect())
    silver_files = sorted(r.source_file for r in ledger.read_ledger(spark, layout.silver_ledger).collect())
    assert bronze_files == ["sales_2010_12.csv", "sales_2011_01.csv", "sales_2011_02.csv"]
    # An empty file never reaches silver; a file whose rows are all rejected does.
    assert silver_files == ["sales_2010_12.csv", "sales_2011_02.csv"]
    assert layers.read_silver(spark, layout.silver).count() == 1

    # A processed name with new content is not read again (the ledger key is the name).
    write_file(f"{layout.landing}/sales_2010_12.csv", ["9,9,H,6,2010-12-01 08:26:00,2.55,1.0,UK\n"] * 3)
    pipeline.run_increment(spark, layout)
    assert layers.read_bronze(spark, layout.bronze).count() == 2


def test_many_files_are_taken_in_rounds(spark, workdir):
    layout = Layout(f"{workdir}/rounds")
    landing.write_csv(sales_lines(spark, SF), layout.landing)
    b = pipeline.ingest_bronze(spark, layout, max_files=7)
    s = pipeline.transform_silver(spark, layout, max_files=9)
    assert b["files"] == 80 and b["rows"] == 6000
    assert s["files"] == 80 and s["rows_in"] == 6000 and s["rows_out"] == 4650


def test_preview_writes_nothing(spark, workdir):
    layout = Layout(f"{workdir}/preview")
    landing.write_csv(sales_lines(spark, SF), layout.landing)
    got = dict(map(tuple, pipeline.preview(spark, layout).collect()))
    assert got["new_files"] == 80 and got["bronze_rows"] == 6000 and got["silver_rows"] == 4650
    assert layers.read_bronze(spark, layout.bronze, empty_if_missing=True).count() == 0
    pipeline.run_increment(spark, layout)
    after = dict(map(tuple, pipeline.preview(spark, layout).collect()))
    assert after["new_files"] == 0 and after["weekly_rows"] == got["weekly_rows"]


def test_split_refuses_bad_dates(spark, workdir):
    bad = spark.createDataFrame([row(), row(InvoiceDate="unknown")], RAW_SCHEMA)
    with pytest.raises(ValueError, match="1 rows"):
        pipeline.split_monthly(spark, bad, f"{workdir}/archive-bad")


def test_split_one_entry_per_month(spark, workdir):
    rows = [row(InvoiceDate="12/1/2010 8:26"), row(InvoiceDate="2011-01-04 10:00:00"), row(InvoiceDate="2011-01-31 23:59:59")]
    root = f"{workdir}/archive"
    assert pipeline.split_monthly(spark, spark.createDataFrame(rows, RAW_SCHEMA), root) == 3
    names = sorted(r.source_file for r in landing.list_landing(spark, root).collect())
    assert names == ["sales_2010_12.csv", "sales_2011_01.csv"]
    back = landing.read_csv(spark, landing.landing_glob(root)).groupBy(SOURCE_FILE).count()
    assert sorted(map(tuple, back.collect())) == [("sales_2010_12.csv", 1), ("sales_2011_01.csv", 2)]
    # original text is kept (the slash date stays a slash date)
    dates = {r.InvoiceDate for r in landing.read_csv(spark, landing.landing_glob(root)).collect()}
    assert "12/1/2010 8:26" in dates


def test_date_gate_counts(spark):
    df = spark.createDataFrame([row(), row(InvoiceDate="x"), row(InvoiceDate=None)], RAW_SCHEMA)
    r = pipeline.date_gate(df).first()
    assert (r.rows, r.bad_dates) == (3, 2)


def test_new_rows_exact_beyond_the_literal_bound(spark, workdir):
    layout = Layout(f"{workdir}/bound")
    landing.write_csv(sales_lines(spark, SF), layout.landing)
    few = pipeline.new_landing_rows(spark, layout).count()
    many = pipeline.new_landing_rows(spark, layout, max_names=3).count()  # semi-join path
    assert few == many == 6000
    pipeline.ingest_bronze(spark, layout)
    a = pipeline.unprocessed_bronze_rows(spark, layout).count()
    b = pipeline.unprocessed_bronze_rows(spark, layout, max_names=3).count()
    assert a == b == 6000


def test_views_by_published_name(spark, workdir):
    layout = Layout(f"{workdir}/views")
    landing.write_csv(sales_lines(spark, SF), layout.landing)
    pipeline.run_increment(spark, layout)
    names = pipeline.register_views(spark, layout, prefix="t_")
    assert len(names) == 8
    n = spark.sql("SELECT COUNT(*) AS n FROM t_silver_online_retail").first().n
    assert n == 4650
    weeks = spark.sql("SELECT WeekStartDate FROM t_gold_weekly_revenue ORDER BY WeekStartDate").count()
    assert weeks == 341


def test_gold_from_partials_equals_full_recompute(spark, workdir):
    layout = catalog.arrival_scenario(spark, SF)  # gold built from per-file partials
    from_partials = gold_rows(spark, layout)
    pipeline.build_gold(spark, layout, from_partials=False)  # one pass over all silver
    assert gold_rows(spark, layout) == from_partials
    assert len(from_partials) > 300


def test_preview_of_an_empty_landing(spark, workdir):
    layout = Layout(f"{workdir}/empty")
    os.makedirs(layout.landing.removeprefix("file:"), exist_ok=True)
    got = dict(map(tuple, pipeline.preview(spark, layout).collect()))
    assert got["new_files"] == 0 and got["bronze_rows"] == 0 and got["weekly_rows"] == 0
