"""Landing files that changed after they were taken: found by content, and taken again.

An increment knows files by name, so a corrected file under a known name would go
unnoticed.  Here its content is compared with what bronze holds of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import bronze as layers
from tillroll.operators import ledger, silver
from tillroll.operators.claims import claimed
from tillroll.plans import pipeline
from tillroll.plans.pipeline import Layout
from tillroll.schemas import CORRUPT_COLUMN, RAW_COLUMNS, SOURCE_FILE
from tillroll.session import pinned
from tillroll.sources import landing, storage

# A file is compared if it changed later than this before it was recorded: it may have
# changed while it was read.
SLACK = "1 day"

_RESULT = "source_file STRING, landing_rows BIGINT, bronze_rows BIGINT"


def fingerprints(rows: DataFrame) -> DataFrame:
    """``source_file``, ``rows`` and ``digest`` of raw rows: their content in any order."""
    content = F.xxhash64(*RAW_COLUMNS, *[F.col(c).isNull() for c in RAW_COLUMNS], F.col(CORRUPT_COLUMN).isNotNull())
    # Two sums of 64-bit hashes; equal rows add up, they don't cancel out.
    total = lambda h: F.sum(h.cast("decimal(20,0)"))
    return rows.groupBy(F.col(SOURCE_FILE).alias("source_file")).agg(
        F.count(F.lit(1)).alias("rows"), F.struct(total(content), total(F.xxhash64(content, F.lit(1)))).alias("digest")
    )


def _candidates(spark: SparkSession, layout: Layout, slack: str) -> DataFrame:
    """Known landing entries whose files changed about when they were recorded, or later."""
    known = ledger.read_ledger(spark, layout.bronze_ledger).groupBy("source_file").agg(F.max("processed_at").alias("recorded"))
    return landing.list_landing(spark, layout.landing).join(known, "source_file").where(
        F.col("modified") >= F.col("recorded") - F.expr(f"INTERVAL {slack}")
    )


def changed_files(spark: SparkSession, layout: Layout, slack: str = SLACK, max_names: int = pipeline.MAX_FILES_PER_ROUND) -> DataFrame:
    """``source_file``, ``landing_rows``, ``bronze_rows`` of known files with other content.

    Of all files only the listing is read; the content of those whose time says that
    they may have changed.  A file written anew with the same rows is not reported.
    """
    with pinned(spark):
        out = spark.createDataFrame([], _RESULT)
        for names in pipeline._rounds(_candidates(spark, layout, slack), max_names):
            here = landing.read_csv(spark, [landing.entry_path(layout.landing, n) for n in names])
            now = fingerprints(here).withColumnsRenamed({"rows": "landing_rows", "digest": "now"})
            was = fingerprints(pipeline.incremental_bronze(spark, layout, names)).withColumnsRenamed({"rows": "bronze_rows", "digest": "was"})
            both = now.join(was, "source_file", "full_outer").where(~F.col("now").eqNullSafe(F.col("was")))
            zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("landing_rows", "bronze_rows")]
            out = out.unionByName(both.select("source_file", *zero))
        return out


def reload_changed(spark: SparkSession, layout: Layout, slack: str = SLACK) -> list[str]:
    """Take changed files again: their rows replace the old ones in every layer and in gold.

    Bronze is replaced last.  Until then the file counts as changed, so a reload that
    broke off is found and done again.  The ledgers get the names once more, which
    tells the streams.  Returns the names.
    """
    with pinned(spark):
        names = sorted(r[0] for r in changed_files(spark, layout, slack).select("source_file").collect())
        if not names:
            return []
        with claimed(spark, layout.claims("bronze"), names) as own, claimed(spark, layout.claims("silver"), own) as both:
            for at in range(0, len(both), pipeline.MAX_FILES_PER_ROUND):
                _reload(spark, layout, both[at : at + pipeline.MAX_FILES_PER_ROUND])
        return both


def _reload(spark: SparkSession, layout: Layout, names: list[str]) -> None:
    def drop(*paths: str) -> None:
        for path in paths:
            for name in names:
                storage.remove(spark, layers.partition_path(path, name))

    rows = layers.to_bronze(landing.read_csv(spark, [landing.entry_path(layout.landing, n) for n in names]))
    # A file can lose all its rows or all that are kept: its partitions go first.
    drop(layout.silver, layout.gold_partials)
    layers.write_layer(silver.clean(rows), layout.silver)
    pipeline.write_partials(spark, layout, names)
    ledger.record_names(spark, names, layout.silver_ledger)
    pipeline.build_gold(spark, layout)
    drop(layout.bronze)
    layers.write_layer(rows, layout.bronze)
    ledger.record_names(spark, names, layout.bronze_ledger)
