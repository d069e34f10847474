"""Weekly revenue of closed weeks, corrected when more of a week arrives.

A week is closed once the event time seen so far has passed its end by a delay.  It is
published then; what arrives for it later, late or instead of what was there, changes
its row and counts up its ``revision``.

The stream carries names of files that silver has completed.  Its state is a table
keyed by file and week, so a file that is completed again replaces its own share, and
a retried micro-batch changes nothing.  State and result are published together as one
version (``operators.versions``): readers never see half a micro-batch.  A batch reads
the partial totals of its own files and the state, never silver's older rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillroll.operators import bronze as layers
from tillroll.operators import versions
from tillroll.plans import pipeline
from tillroll.plans.pipeline import Layout
from tillroll.schemas import SOURCE_FILE
from tillroll.session import pinned
from tillroll.sources.tables import read_files

WEEKS_SCHEMA = "WeekStartDate DATE, WeeklyRevenue DOUBLE, revision INT"
SHARES_SCHEMA = "source_file STRING, WeekStartDate DATE, revenue DECIMAL(38,2)"
SEEN_SCHEMA = "seen TIMESTAMP"


def _table(spark: SparkSession, base: versions.Published | None, name: str, schema: str) -> DataFrame:
    return read_files(spark, schema, base.tables[name]) if base else spark.createDataFrame([], schema)


def read_closed_weeks(spark: SparkSession, out_path: str) -> DataFrame:
    """The closed weeks as last published: WEEKS_SCHEMA, one row a week."""
    return _table(spark, versions.current(spark, out_path), "weeks", WEEKS_SCHEMA)


def _corrected(totals: DataFrame, before: DataFrame) -> DataFrame:
    """Closed weeks by key: new ones, and those whose revenue changed, with their revision."""
    now = totals.select(F.col("WeekStartDate").alias("week"), F.round("revenue", 2).cast("double").alias("now"))
    both = now.join(before, F.col("week") == F.col("WeekStartDate"), "full_outer")
    value = F.coalesce("now", F.lit(0.0))  # a week can lose all its lines
    revision = F.when(F.col("revision").isNull(), 0).otherwise(F.col("revision") + (value != F.col("WeeklyRevenue")).cast("int"))
    return both.select(F.coalesce("week", "WeekStartDate").alias("WeekStartDate"), value.alias("WeeklyRevenue"), revision.cast("int").alias("revision"))


def take(spark: SparkSession, layout: Layout, out_path: str, names: list[str], late_delay: str) -> None:
    """Let some files' shares replace those they had, and publish the closed weeks anew."""
    base = versions.current(spark, out_path)
    folder = versions.new_folder(out_path)
    tables = {name: f"{folder}/{name}" for name in ("shares", "seen", "weeks")}
    partials = layers.read_named(spark, layout.gold_partials, pipeline.PARTIALS_SCHEMA, names).where("grain = 'weekly'")
    shares = _table(spark, base, "shares", SHARES_SCHEMA).where(~F.col("source_file").isin(names)).unionByName(
        partials.select(F.col(SOURCE_FILE).alias("source_file"), "WeekStartDate", "revenue")
    )
    # The state is light (a row per file and week): few files of it.
    shares.coalesce(8).write.parquet(tables["shares"])
    times = layers.read_named(spark, layout.silver, layers.SILVER_SCHEMA, names).select(F.col("InvoiceTimestamp").alias("seen"))
    _table(spark, base, "seen", SEEN_SCHEMA).unionByName(times).agg(F.max("seen").alias("seen")).write.parquet(tables["seen"])
    seen = F.lit(read_files(spark, SEEN_SCHEMA, tables["seen"]).first()[0]).cast("timestamp")
    kept = read_files(spark, SHARES_SCHEMA, tables["shares"])
    closed = F.col("WeekStartDate").cast("timestamp") + F.expr("INTERVAL 7 DAYS") + F.expr(f"INTERVAL {late_delay}") <= seen
    totals = kept.groupBy("WeekStartDate").agg(F.sum("revenue").alias("revenue")).where(closed)
    _corrected(totals, _table(spark, base, "weeks", WEEKS_SCHEMA)).coalesce(1).write.parquet(tables["weeks"])
    files = kept.select("source_file").distinct().count()
    versions.publish(spark, out_path, tables, (max(files, base.source[0] if base else 0), 0), base)
    versions.retire(spark, out_path)


def start_closed_weeks(spark: SparkSession, layout: Layout, out_path: str, checkpoint: str, late_delay: str, trigger: dict | None = None) -> StreamingQuery:
    """Publish each week below ``out_path`` once event time has passed its end by
    ``late_delay`` (an interval such as "1 day"), and again when it is corrected."""
    from tillroll.streaming.stream import ledger_stream, start_steps

    def step(batch: DataFrame, _epoch: int) -> None:
        names = [r[0] for r in batch.distinct().collect()]  # names of one trigger
        for at in range(0, len(names), pipeline.MAX_FILES_PER_ROUND):
            with pinned(batch.sparkSession):
                take(batch.sparkSession, layout, out_path, names[at : at + pipeline.MAX_FILES_PER_ROUND], late_delay)

    with pinned(spark):
        return start_steps(ledger_stream(spark, layout.silver_ledger), checkpoint, step, trigger)
