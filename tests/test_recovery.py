"""Increments that add nothing, odd names, missing layers, repeated steps, session settings."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from helpers import row
from tillroll.functions.naming import base_name, landing_label, plain_path
from tillroll.operators import bronze as layers
from tillroll.operators import gold, ledger, silver
from tillroll.plans import pipeline
from tillroll.plans.pipeline import Layout
from tillroll.schemas import GOLD_DDL, RAW_SCHEMA, SOURCE_FILE
from tillroll.sources import landing
from tillroll.streaming import stream

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
GOOD = "536365,85123A,H,6,2010-12-01 08:26:00,2.55,17850.0,UK\n"
NEXT = "536366,85123A,H,2,2011-01-05 08:26:00,1.00,17850.0,UK\n"
CANCELLED = "C1,85123A,H,6,2011-02-01 08:26:00,2.55,1.0,UK\n"


def write_file(path, lines, age_s=0):
    path = path.removeprefix("file:")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(HEADER + "".join(lines))
    if age_s:
        os.utime(path, (time.time() - age_s,) * 2)


def names(spark, path):
    return sorted(r.source_file for r in ledger.read_ledger(spark, path).collect())


def state(spark, layout):
    return (
        sorted(map(tuple, layers.read_silver(spark, layout.silver).select("InvoiceNo", "Quantity", "Revenue", SOURCE_FILE).collect())),
        sorted(map(tuple, gold.long_form(pipeline.read_gold(spark, layout)).collect())),
        names(spark, layout.bronze_ledger),
        names(spark, layout.silver_ledger),
    )


def files_under(base):
    base = base.removeprefix("file:")
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(base) for f in fs if "landing" not in d)


def test_increments_without_a_surviving_row(spark, workdir):
    layout = Layout(f"{workdir}/p")
    write_file(f"{layout.landing}/sales_2010_12.csv", [GOOD])
    assert pipeline.run_increment(spark, layout)["silver"]["rows_out"] == 1
    before = state(spark, layout)[1]
    write_file(f"{layout.landing}/sales_2011_01.csv", [])  # header only
    got = pipeline.run_increment(spark, layout)
    assert got["bronze"] == {"files": 1, "rows": 0, "corrupt_rows": 0} and got["silver"]["files"] == 0
    write_file(f"{layout.landing}/sales_2011_02.csv", [CANCELLED])
    got = pipeline.run_increment(spark, layout)
    assert got["silver"] == {"files": 1, "rows_in": 1, "rows_out": 0}
    assert state(spark, layout)[1] == before
    write_file(f"{layout.landing}/sales_2011_03.csv", [NEXT])  # and on it goes
    assert pipeline.run_increment(spark, layout)["silver"]["rows_out"] == 1
    assert names(spark, layout.silver_ledger) == ["sales_2010_12.csv", "sales_2011_02.csv", "sales_2011_03.csv"]


def test_a_pipeline_without_any_row(spark, workdir):
    layout = Layout(f"{workdir}/none")
    assert {k: df.count() for k, df in pipeline.read_gold(spark, layout).items()} == dict.fromkeys(GOLD_DDL, 0)
    os.makedirs(layout.landing.removeprefix("file:"))
    pipeline.run_increment(spark, layout)  # empty landing zone
    write_file(f"{layout.landing}/sales_2011_02.csv", [CANCELLED])
    pipeline.run_increment(spark, layout)
    tables = pipeline.read_gold(spark, layout)
    assert all(df.count() == 0 for df in tables.values())
    assert [f"{f.name} {f.dataType.simpleString()}" for f in tables["weekly_revenue"].schema] == ["WeekStartDate date", "WeeklyRevenue double"]


def test_a_line_too_large_is_rejected(spark, ansi, workdir):
    rows = [
        row(InvoiceNo="1", Quantity="2000000000", UnitPrice="1E30"),
        row(InvoiceNo="2", Quantity="2000000000", UnitPrice="99999999999999"),
        row(InvoiceNo="3"),
    ]
    from helpers import bronze_df

    got = {r.InvoiceNo: (r.reject_reason, r.Revenue) for r in silver.with_reject_reason(bronze_df(spark, rows)).collect()}
    assert got["1"] == ("bad_revenue", None) and got["2"][0] is None and got["3"][0] is None
    assert sorted(r.InvoiceNo for r in silver.clean(bronze_df(spark, rows)).collect()) == ["2", "3"]


def test_price_text_is_kept(spark, ansi):
    from helpers import bronze_df

    rows = [row(InvoiceNo="1", Quantity="1000", UnitPrice="0.00004"), row(InvoiceNo="2", Quantity="1000", UnitPrice="2.55555")]
    got = {r.InvoiceNo: float(r.Revenue) for r in silver.clean(bronze_df(spark, rows)).collect()}
    assert got == {"1": 0.04, "2": 2555.55}


# Price text, quantity, revenue: as great and as small as a double's, exact to the cent.
EXTREMES = [
    ("1E18", "6", "6000000000000000000.00"),
    ("123456789012345678", "3", "370370367037037034.00"),
    ("99999999999999999999", "2000000000", "199999999999999999998000000000.00"),
    ("0.00000000004", "1000000000", "0.04"),
    ("0.12345678949", "1000000000", "123456789.49"),
    ("0.000000000000000005", "1000000000", "0.00"),
    ("4e-20", "1", "0.00"),
    ("2.005", "1", "2.01"),
    ("1E25", "2", "20000000000000000000000000.00"),
    ("1.5d", "2", "3.00"),
]


@pytest.mark.parametrize(("price", "quantity", "want"), EXTREMES)
def test_any_price_of_a_double(spark, ansi, price, quantity, want):
    from helpers import bronze_df

    got = silver.with_reject_reason(bronze_df(spark, [row(Quantity=quantity, UnitPrice=price)])).first()
    assert got.reject_reason is None and str(got.Revenue) == want and got.UnitPrice == float(price.rstrip("d"))


@pytest.mark.parametrize(("price", "reason"), [("1E300", "bad_revenue"), ("Infinity", "bad_price"), ("-Infinity", "bad_price"), ("1E400", "bad_price"), ("1e-400", "bad_price")])
def test_prices_that_no_total_can_hold(spark, ansi, price, reason):
    from helpers import bronze_df

    assert silver.with_reject_reason(bronze_df(spark, [row(UnitPrice=price)])).first().reject_reason == reason


def test_missing_layers_are_errors(spark, workdir):
    layout = Layout(f"{workdir}/typo")
    for step in (pipeline.transform_silver, pipeline.build_gold, pipeline.ingest_bronze, pipeline.preview):
        with pytest.raises(FileNotFoundError):
            step(spark, layout)
    for read in (layers.read_bronze, layers.read_silver):
        with pytest.raises(FileNotFoundError):
            read(spark, layout.bronze)
    assert not os.path.exists(layout.base.removeprefix("file:"))


def test_names_with_blanks_and_signs(spark, workdir):
    layout = Layout(f"{workdir}/names")
    odd = ["sales_2010 12.csv", "sales_a+b,c%20d{e}.csv", "sales_2011_01.csv"]
    for n in odd:
        write_file(f"{layout.landing}/{n}", [GOOD, NEXT])
    listed = sorted(r.source_file for r in landing.list_landing(spark, layout.landing).collect())
    assert listed == sorted(odd)
    for limit in (1000, 1):  # by name, and by join
        assert pipeline.new_landing_rows(spark, layout, limit).groupBy(SOURCE_FILE).count().collect().__len__() == 3
    pipeline.ingest_bronze(spark, layout)
    few, many = (pipeline.unprocessed_bronze_rows(spark, layout, limit).count() for limit in (1000, 1))
    assert few == many == 6
    assert pipeline.transform_silver(spark, layout) == {"files": 3, "rows_in": 6, "rows_out": 6}
    assert names(spark, layout.bronze_ledger) == names(spark, layout.silver_ledger) == sorted(odd)
    pipeline.build_gold(spark, layout)
    assert pipeline.run_increment(spark, layout)["silver"]["files"] == 0


def test_labels(spark):
    paths = ["file:/x/sales_2011_01.csv", "/x/file=sales_2011_01.csv/part-0.csv", "/x/sales_2011_01.csv/part-0", "sales_1.csv"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(landing_label("p")).collect()] == ["sales_2011_01.csv"] * 3 + ["sales_1.csv"]
    assert [r[0] for r in df.select(base_name("p")).collect()] == ["sales_2011_01.csv", "part-0.csv", "part-0", "sales_1.csv"]
    assert spark.range(1).select(plain_path(F.lit("file:/a%20b+c"))).first()[0] == "file:/a b+c"


def test_split_twice_is_split_once(spark, workdir):
    root = f"{workdir}/archive"
    history = spark.createDataFrame([row(), row(InvoiceDate="1/4/2011 8:26")], RAW_SCHEMA)
    assert pipeline.split_monthly(spark, history, root) == pipeline.split_monthly(spark, history, root) == 2
    assert landing.read_csv(spark, landing.landing_glob(root)).count() == 2
    with pytest.raises(ValueError, match="1 rows"):
        pipeline.split_monthly(spark, history.unionByName(spark.createDataFrame([row(InvoiceDate="x")], RAW_SCHEMA)), root)
    assert landing.read_csv(spark, landing.landing_glob(root)).count() == 2
    assert pipeline.split_monthly(spark, history.where("false"), root) == 0


def test_preview_is_what_the_run_does(spark, workdir):
    layout = Layout(f"{workdir}/preview")
    write_file(f"{layout.landing}/sales_2010_12.csv", [GOOD, CANCELLED])
    untouched = files_under(layout.base)
    first = dict(map(tuple, pipeline.preview(spark, layout).collect()))
    assert files_under(layout.base) == untouched == []
    assert (first["bronze_rows"], first["silver_rows"], first["weekly_rows"]) == (2, 1, 1)
    pipeline.ingest_bronze(spark, layout)  # one file waits in bronze
    write_file(f"{layout.landing}/sales_2011_01.csv", [NEXT])
    before = files_under(layout.base)
    got = dict(map(tuple, pipeline.preview(spark, layout).collect()))
    assert files_under(layout.base) == before
    done = pipeline.run_increment(spark, layout)
    assert (got["new_files"], got["bronze_rows"]) == (done["bronze"]["files"], done["bronze"]["rows"]) == (1, 1)
    assert got["silver_rows"] == done["silver"]["rows_out"] == 2
    rows = {k: df.count() for k, df in pipeline.read_gold(spark, layout).items()}
    assert [got[k] for k in ("weekly_rows", "top_products_rows", "top_customers_rows", "country_rows")] == [
        rows[k] for k in ("weekly_revenue", "top_products", "top_customers", "revenue_by_country")
    ]


def test_preview_scans_new_files_once(spark, workdir):
    layout = Layout(f"{workdir}/scan")
    write_file(f"{layout.landing}/sales_2010_12.csv", [GOOD])
    plan = pipeline.preview(spark, layout)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1


def test_stream_takes_old_files_and_shares_state_with_batch(spark, workdir):
    by_stream, by_batch = Layout(f"{workdir}/s"), Layout(f"{workdir}/b")
    ck = f"{workdir}/ck"
    month = 86_400 * 30
    arrivals = [("sales_2011_02.csv", [NEXT], 0), ("sales_2010_12.csv", [GOOD], month), ("sales_2011_03.csv", [CANCELLED], 0)]
    for name, lines, age in arrivals[:2]:
        write_file(f"{by_stream.landing}/{name}", lines, age)
        stream.run_to_end(stream.start_bronze(spark, by_stream, f"{ck}/b"))
    assert names(spark, by_stream.bronze_ledger) == ["sales_2010_12.csv", "sales_2011_02.csv"]
    stream.run_to_end(stream.start_silver(spark, by_stream, f"{ck}/s"))
    name, lines, age = arrivals[2]
    write_file(f"{by_stream.landing}/{name}", lines, age)
    pipeline.run_increment(spark, by_stream)  # batch goes on where the stream stopped
    stream.run_to_end(stream.start_bronze(spark, by_stream, f"{ck}/b"))  # and the stream where batch did
    for name, lines, age in arrivals:
        write_file(f"{by_batch.landing}/{name}", lines, age)
    pipeline.run_increment(spark, by_batch)
    assert state(spark, by_stream) == state(spark, by_batch)


def test_run_to_end_says_when_time_is_up(spark, workdir):
    slow = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", f"{workdir}/ck").start()
    with pytest.raises(TimeoutError):
        stream.run_to_end(slow, 1)


def test_session_settings_stay(spark, workdir):
    layout = Layout(f"{workdir}/zone")
    write_file(f"{layout.landing}/sales_2010_12.csv", [GOOD])
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        pipeline.run_increment(spark, layout)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert str(pipeline.read_gold(spark, layout)["weekly_revenue"].first().WeekStartDate) == "2010-11-29"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    at = layers.read_silver(spark, layout.silver).select(F.col("InvoiceTimestamp").cast("string")).first()[0]
    assert at == "2010-12-01 08:26:00"


def test_one_ledger_file_for_each_round_and_no_needless_gold(spark, workdir):
    layout = Layout(f"{workdir}/small")
    for n in ("sales_2010_12.csv", "sales_2011_01.csv"):
        write_file(f"{layout.landing}/{n}", [GOOD])
        pipeline.run_increment(spark, layout)
    parts = [f for f in files_under(layout.bronze_ledger) if f.endswith(".parquet")]
    assert len(parts) <= 3  # one a round, and the empty table
    built = [f for f in files_under(layout.gold) if f.endswith(".parquet")]
    pipeline.run_increment(spark, layout)
    assert [f for f in files_under(layout.gold) if f.endswith(".parquet")] == built


def test_an_increment_lists_its_own_partitions(spark, workdir):
    layout = Layout(f"{workdir}/list")
    for m in range(1, 6):
        write_file(f"{layout.landing}/sales_2011_{m:02d}.csv", [GOOD])
    pipeline.run_increment(spark, layout)
    rows = pipeline.incremental_bronze(spark, layout, ["sales_2011_03.csv"])
    assert len(rows.inputFiles()) == 1 and rows.count() == 1
    assert layers.present(spark, layout.bronze, ["sales_2011_03.csv", "sales_1999_01.csv"]) == ["sales_2011_03.csv"]


def test_published_tables_in_a_catalog(spark, workdir):
    layout = Layout(f"{workdir}/catalog")
    write_file(f"{layout.landing}/sales_2010_12.csv", [GOOD, CANCELLED])
    pipeline.run_increment(spark, layout)
    try:
        tables = pipeline.publish_tables(spark, layout, "retail_test")
        counts = {t: spark.table(t).count() for t in tables}
        assert counts["`retail_test`.`bronze_online_retail`"] == 2 and counts["`retail_test`.`silver_online_retail`"] == 1
        assert counts["`retail_test`.`gold_weekly_revenue`"] == 1 and len(counts) == 8
        assert pipeline.publish_tables(spark, layout, "retail_test") == tables  # if absent
    finally:
        spark.sql("DROP DATABASE IF EXISTS retail_test CASCADE")
