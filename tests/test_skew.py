"""A hot source file (most of the rows) is written by several tasks."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from tillroll.operators import bronze as layers
from tillroll.schemas import SOURCE_FILE
from tillroll.sources import landing
from tillroll.sources.fixture import sales_lines

SF = "/root/testdata/sf0.01"


def test_hot_file_is_split_across_writers(spark, workdir):
    lines = sales_lines(spark, SF)
    landing.write_csv(lines, f"{workdir}/landing")
    raw = landing.read_csv(spark, landing.landing_glob(f"{workdir}/landing"))
    # Every line of 1995-1999 is labelled with one file: it holds most rows.
    hot = F.when(F.col(SOURCE_FILE) < "sales_2000", F.lit("sales_hot.csv")).otherwise(F.col(SOURCE_FILE))
    rows = layers.to_bronze(raw.withColumn(SOURCE_FILE, hot))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        layers.write_layer(rows, f"{workdir}/bronze")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot_dir = f"{workdir}/bronze/{SOURCE_FILE}=sales_hot.csv".removeprefix("file:")
    parts = [f for f in os.listdir(hot_dir) if f.endswith(".parquet")]
    assert len(parts) > 1
    back = layers.read_bronze(spark, f"{workdir}/bronze")
    assert back.count() == lines.count()
