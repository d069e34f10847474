"""Benchmark: headline queries and the pipeline stages at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries",
"sf", ...}.  Every query is fully computed (a ``noop`` write for row-level
results, ``collect`` for small ones); each pipeline stage writes real files
into a fresh folder under the shared checkpoint directory.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.session import fresh_dir, local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = local_session("tillroll-bench", cores=cpus, shuffle_partitions=int(cpus))

    from tillroll.operators import gold, silver
    from tillroll.plans import catalog, pipeline
    from tillroll.plans.pipeline import Layout
    from tillroll.sources import landing
    from tillroll.sources.fixture import sales_lines
    from tillroll.streaming import stream

    def noop(df):
        df.write.mode("overwrite").format("noop").save()

    timings: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t0, 3)

    # Warm the JVM (class loading, codegen caches) on the smallest input.
    noop(catalog._silver(spark, "/root/testdata/sf0.001"))

    # In-memory queries over the adapter (source join -> silver -> gold).
    timed("adapter_lines", lambda: noop(sales_lines(spark, sf_dir)))
    timed("silver_clean", lambda: noop(catalog.q_silver_clean(spark, sf_dir)))
    timed("reject_reasons", lambda: catalog.q_reject_reasons(spark, sf_dir).collect())
    timed("weekly_revenue", lambda: catalog.q_weekly_revenue(spark, sf_dir).collect())
    timed("product_revenue", lambda: noop(catalog.q_product_revenue(spark, sf_dir)))
    timed("top_products", lambda: catalog.q_top_products(spark, sf_dir).collect())
    timed("top_customers", lambda: catalog.q_top_customers(spark, sf_dir).collect())
    timed("revenue_by_country", lambda: catalog.q_revenue_by_country(spark, sf_dir).collect())
    timed("gold_all_one_pass", lambda: catalog.q_gold_all(spark, sf_dir).collect())

    # The file pipeline, stage by stage, on a fresh layout.
    layout = Layout(fresh_dir(spark, "bench"))
    timed("landing_write", lambda: landing.write_csv(sales_lines(spark, sf_dir), layout.landing))
    timed("preview", lambda: pipeline.preview(spark, layout).collect())
    timed("bronze_ingest", lambda: pipeline.ingest_bronze(spark, layout))
    timed("silver_transform", lambda: pipeline.transform_silver(spark, layout))
    timed("gold_build", lambda: pipeline.build_gold(spark, layout))
    timed("rerun_noop", lambda: pipeline.run_increment(spark, layout))
    timed("serve_weekly", lambda: catalog.serve(spark, "weekly_revenue", pipeline.read_gold(spark, layout)).collect())

    # The same data as chained streams (availableNow).
    slayout = Layout(fresh_dir(spark, "bench-stream"), layout.landing)
    ck = f"{slayout.base}/_checkpoints"
    timed("stream_bronze", lambda: stream.run_to_end(stream.start_bronze(spark, slayout, f"{ck}/bronze")))
    timed("stream_silver", lambda: stream.run_to_end(stream.start_silver(spark, slayout, f"{ck}/silver")))
    timed("stream_weekly", lambda: stream.run_to_end(stream.start_weekly(spark, slayout, f"{ck}/weekly")))

    rows = spark.read.parquet(layout.silver).count()
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf,
        "cpus": int(cpus),
        "silver_rows": rows,
    }))


if __name__ == "__main__":
    main()
