"""The pipeline as chained Structured Streaming queries.

landing (file listing)  -> bronze + bronze ledger
bronze ledger (Parquet) -> silver + silver ledger
silver ledger (Parquet) -> weekly revenue, from the per-file totals
silver ledger (Parquet) -> weekly revenue of closed weeks, with corrections (``closed_weeks``)

All of them carry names of source files, and each micro-batch runs the
batch step on them (``foreachBatch``).  So stream and batch share one state, the
layers and their ledgers: either may go on where the other stopped, and a retried
micro-batch replaces a file's partition instead of adding to it.  A ledger gets a
file's name after its data, which makes it a change feed of complete files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.functions.naming import landing_label
from tillroll.operators import gold
from tillroll.operators.bronze import SILVER_SCHEMA
from tillroll.operators.ledger import NESTED
from tillroll.plans import pipeline
from tillroll.plans.pipeline import Layout
from tillroll.schemas import LEDGER_SCHEMA, SILVER_COLUMNS
from tillroll.session import pinned
from tillroll.sources.landing import LISTING_SCHEMA, landing_glob
from tillroll.sources.tables import read_files

# A week window aligned on Mondays: the epoch (1970-01-01) is a Thursday.
WEEK = "7 days"
MONDAY_OFFSET = "4 days"

# The file sources pass over files older than this (against the newest file seen);
# Spark's default of a week would lose backfills and preserved file times.
NO_AGE_LIMIT = {"maxFileAge": "100000d"}

_DRAIN = {"availableNow": True}


def _file_stream(spark: SparkSession, max_files_per_trigger: int | None = None):
    reader = spark.readStream.options(**NO_AGE_LIMIT)
    return reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else reader


def landing_stream(spark: SparkSession, landing_root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Names of landing entries as their files appear (listing only, content not read)."""
    files = _file_stream(spark, max_files_per_trigger).format("binaryFile").schema(LISTING_SCHEMA).load(landing_glob(landing_root))
    return files.select(landing_label("path").alias("source_file"))


def ledger_stream(spark: SparkSession, ledger_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Names of source files as a layer completes them."""
    return _file_stream(spark, max_files_per_trigger).options(**NESTED).schema(LEDGER_SCHEMA).parquet(ledger_path).select("source_file")


def start_steps(df: DataFrame, checkpoint: str, step, trigger: dict | None) -> StreamingQuery:
    """A query that runs ``step`` on each micro-batch of names."""
    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step).trigger(**(trigger or _DRAIN)).start()


def start_bronze(spark: SparkSession, layout: Layout, checkpoint: str, max_files_per_trigger: int | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Ingest landing entries as they appear.

    An entry is read whole when its first file is seen, as in the batch step.
    """

    def step(batch: DataFrame, _epoch: int) -> None:
        # At most maxFilesPerTrigger names, or the listing of one trigger.
        names = [r[0] for r in batch.distinct().collect()]
        for at in range(0, len(names), pipeline.MAX_FILES_PER_ROUND):
            pipeline.ingest_files(batch.sparkSession, layout, names[at : at + pipeline.MAX_FILES_PER_ROUND])

    with pinned(spark):
        pipeline.init_layout(spark, layout)
        return start_steps(landing_stream(spark, layout.landing, max_files_per_trigger), checkpoint, step, trigger)


def start_silver(spark: SparkSession, layout: Layout, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Clean source files as bronze completes them."""

    def step(batch: DataFrame, _epoch: int) -> None:
        if not batch.isEmpty():
            pipeline.transform_silver(batch.sparkSession, layout)

    with pinned(spark):
        return start_steps(ledger_stream(spark, layout.bronze_ledger), checkpoint, step, trigger)


def start_weekly(spark: SparkSession, layout: Layout, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the weekly table current as silver completes files.

    Added up from the per-file totals, so a file counts once however often a
    round was retried.
    """

    def step(batch: DataFrame, _epoch: int) -> None:
        if not batch.isEmpty():
            partials = read_files(batch.sparkSession, pipeline.PARTIALS_SCHEMA, layout.gold_partials)
            weekly = gold.gold_table(gold.merge_totals(partials.where("grain = 'weekly'")), "weekly_revenue")
            pipeline.publish_gold_table(batch.sparkSession, layout, "weekly_revenue", weekly)

    with pinned(spark):
        return start_steps(ledger_stream(spark, layout.silver_ledger), checkpoint, step, trigger)


def silver_stream(spark: SparkSession, silver_path: str) -> DataFrame:
    """Silver rows as their files appear.

    A partition that a retried round replaces appears again; sums over this stream
    count it again, which is why the weekly streams here do not use it.
    """
    return _file_stream(spark).schema(SILVER_SCHEMA).parquet(silver_path).select(*SILVER_COLUMNS)


def weekly_revenue_stream(silver_rows: DataFrame, late_delay: str | None = None) -> DataFrame:
    """Weekly revenue over event time (Monday-aligned tumbling windows).

    With ``late_delay`` a watermark bounds the state: a week is final (and
    emitted in append mode) once event time has passed its end by the delay;
    rows for a finalised week are dropped as late.
    """
    rows = silver_rows
    if late_delay:
        rows = rows.withWatermark("InvoiceTimestamp", late_delay)
    return rows.groupBy(F.window("InvoiceTimestamp", WEEK, WEEK, MONDAY_OFFSET).alias("week")).agg(
        F.sum("Revenue").alias("revenue")
    ).select(
        F.to_date(F.col("week.start")).alias("WeekStartDate"),
        F.round(F.col("revenue"), 2).cast("double").alias("WeeklyRevenue"),
    )


def run_to_end(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query to drain its input; re-raise failures.

    If the time is up before, the query is stopped and TimeoutError raised: what
    is there is not the whole input.
    """
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError(f"the stream had not drained its input after {timeout_s} s")
    err = query.exception()
    if err is not None:
        raise RuntimeError(str(err))
