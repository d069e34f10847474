"""Streaming form: stream == batch, reruns read nothing, late weeks."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tillroll.operators import bronze as layers
from tillroll.operators import gold, ledger
from tillroll.plans import catalog, pipeline
from tillroll.plans.pipeline import Layout
from tillroll.schemas import REVENUE_TYPE
from tillroll.sources import landing
from tillroll.sources.fixture import sales_lines
from tillroll.streaming import closed_weeks, stream

SF = "/root/testdata/sf0.001"
HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def _bag(df):
    return sorted(map(tuple, df.collect()))


def test_stream_equals_batch_and_rerun_reads_nothing(spark, workdir):
    layout = Layout(f"{workdir}/s")
    root = layout.landing
    first = F.col("_source_file") <= "sales_1997_12.csv"
    landing.write_csv(sales_lines(spark, SF).where(first), root)
    ck = f"{workdir}/ck"

    def run_all():
        stream.run_to_end(stream.start_bronze(spark, layout, f"{ck}/b", max_files_per_trigger=40))
        stream.run_to_end(stream.start_silver(spark, layout, f"{ck}/s"))
        stream.run_to_end(stream.start_weekly(spark, layout, f"{ck}/w"))

    run_all()
    n1 = layers.read_bronze(spark, layout.bronze).count()
    run_all()  # same checkpoint, no new files: nothing is added
    assert layers.read_bronze(spark, layout.bronze).count() == n1

    landing.write_csv(sales_lines(spark, SF).where(~first), root)  # later arrival
    run_all()
    batch_silver = catalog._silver(spark, SF)
    cols = ["InvoiceNo", "StockCode", "Quantity", "Revenue", "_source_file"]
    assert _bag(layers.read_silver(spark, layout.silver).select(cols)) == _bag(batch_silver.select(cols))
    weekly = pipeline.read_gold(spark, layout)["weekly_revenue"]
    assert _bag(weekly.select("WeekStartDate", "WeeklyRevenue")) == _bag(gold.weekly_revenue(batch_silver))


def _weeks(spark, out):
    return {str(r.WeekStartDate): (r.WeeklyRevenue, r.revision) for r in closed_weeks.read_closed_weeks(spark, out).collect()}


def _land(layout, name, lines):
    path = f"{layout.landing}/{name}".removeprefix("file:")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(HEADER + "".join(lines))


def test_closed_weeks_and_their_corrections(spark, workdir):
    layout, out, ck = Layout(f"{workdir}/s"), f"{workdir}/weekly", f"{workdir}/ck"

    def run():
        stream.run_to_end(stream.start_bronze(spark, layout, f"{ck}/b"))
        stream.run_to_end(stream.start_silver(spark, layout, f"{ck}/s"))
        stream.run_to_end(closed_weeks.start_closed_weeks(spark, layout, out, f"{ck}/w", late_delay="1 day"))
        return _weeks(spark, out)

    _land(layout, "sales_2011_01.csv", [
        "1,A,a,1,2011-01-03 10:00:00,1.00,1.0,X\n",   # week of 2011-01-03
        "2,A,a,2,2011-01-05 10:00:00,1.00,1.0,X\n",
        "3,A,a,4,2011-01-12 10:00:00,1.00,1.0,X\n",   # week of 2011-01-10
        "4,A,a,8,2011-01-26 10:00:00,1.00,1.0,X\n",   # week of 2011-01-24
    ])
    # Event time less one day has passed the first two weeks only.
    first = {"2011-01-03": (3.0, 0), "2011-01-10": (4.0, 0)}
    assert run() == first
    opened = closed_weeks.read_closed_weeks(spark, out)
    assert run() == first  # nothing new
    # A late line for a closed week, one for a week that had none, one that closes another.
    _land(layout, "sales_2011_02.csv", [
        "5,A,a,1,2011-01-04 10:00:00,0.50,1.0,X\n",
        "6,A,a,1,2011-01-19 10:00:00,2.00,1.0,X\n",
        "7,A,a,1,2011-02-20 10:00:00,2.00,1.0,X\n",
    ])
    second = first | {"2011-01-03": (3.5, 1), "2011-01-17": (2.0, 0), "2011-01-24": (8.0, 0)}
    assert run() == second
    assert {str(r.WeekStartDate) for r in opened.collect()} == set(first)  # a reader keeps its version
    # The first file is completed again with other lines: its share is replaced, not added.
    name = ["sales_2011_01.csv"]
    rows = layers.read_named(spark, layout.silver, layers.SILVER_SCHEMA, name).where("InvoiceNo <> '3'")
    again = rows.withColumn("Revenue", F.when(F.col("InvoiceNo") == "4", F.lit(9)).otherwise(F.col("Revenue")).cast(REVENUE_TYPE))
    kept = [tuple(r) for r in again.collect()]
    layers.write_layer(spark.createDataFrame(kept, again.schema), layout.silver)
    pipeline.write_partials(spark, layout, name)
    ledger.record_names(spark, name, layout.silver_ledger)
    third = second | {"2011-01-10": (0.0, 1), "2011-01-24": (9.0, 1)}
    assert run() == third
    # A retried micro-batch changes nothing.
    closed_weeks.take(spark, layout, out, name, "1 day")
    assert _weeks(spark, out) == third
