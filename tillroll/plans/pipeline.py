"""The incremental pipeline: landing -> bronze -> silver -> gold.

Each step is a Spark job over the new input only; gold is added up from small
per-file totals.  Only metadata reaches the driver: names of new source files, in
rounds of ``max_files``, and row counts of what was written, read back from the
written partitions (so an empty or wholly rejected file counts as 0).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.naming import month_file_name
from tillroll.functions.parsing import parse_invoice_timestamp
from tillroll.operators import bronze as layers
from tillroll.operators import gold, ledger, silver, versions
from tillroll.operators.claims import claimed
from tillroll.operators.joins import is_small, join_small
from tillroll.plans.serving import GOLD_TABLE_NAMES
from tillroll.schemas import CORRUPT_COLUMN, GOLD_DDL, RAW_READ_SCHEMA, SOURCE_FILE, TOP_K
from tillroll.session import pinned
from tillroll.sources import landing, storage
from tillroll.sources.tables import read_files

# Source files handled per round; a larger backlog takes several rounds.
MAX_FILES_PER_ROUND = 1000


@dataclass(frozen=True)
class Layout:
    """Folders of one pipeline instance under a base path.

    ``landing_root`` names a landing zone elsewhere.
    """

    base: str
    landing_root: str | None = None

    def _p(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    @property
    def landing(self) -> str:
        return self.landing_root or self._p("landing")

    @property
    def bronze(self) -> str:
        return self._p("bronze")

    @property
    def silver(self) -> str:
        return self._p("silver")

    @property
    def gold(self) -> str:
        return self._p("gold")

    @property
    def gold_partials(self) -> str:
        return self._p("gold_partials")

    @property
    def bronze_ledger(self) -> str:
        return self._p("ledger/bronze_processed_files")

    @property
    def silver_ledger(self) -> str:
        return self._p("ledger/silver_processed_files")

    def claims(self, step: str) -> str:
        return self._p(f"claims/{step}")


TOTALS_SCHEMA = (
    "WeekStartDate DATE, StockCode STRING, Description STRING, CustomerID STRING, "
    "Country STRING, revenue DECIMAL(38,2), quantity BIGINT, grain STRING"
)
PARTIALS_SCHEMA = f"{TOTALS_SCHEMA}, {SOURCE_FILE} STRING"


def init_layout(spark: SparkSession, layout: Layout) -> None:
    """Create empty bronze, silver, totals and ledger tables where there are none.

    Looks first, which costs no job; of several runs that start a base one creates it.
    """
    tables = (
        (layers.BRONZE_SCHEMA, layout.bronze, True),
        (layers.SILVER_SCHEMA, layout.silver, True),
        (PARTIALS_SCHEMA, layout.gold_partials, True),
        (ledger.LEDGER_SCHEMA, layout.bronze_ledger, False),
        (ledger.LEDGER_SCHEMA, layout.silver_ledger, False),
    )

    def absent() -> list[tuple]:
        return [t for t in tables if not storage.listed(spark, t[1])]

    if not absent():
        return
    with claimed(spark, layout.claims("init"), ["init"]) as own:
        for schema, path, partitioned in absent() if own else ():
            writer = spark.createDataFrame([], schema).coalesce(1).write.mode("ignore")
            if partitioned:
                writer = writer.partitionBy(SOURCE_FILE)
            writer.parquet(path)


def _names(df: DataFrame, col: str, limit: int) -> list[str]:
    """The first ``limit`` names (sorted) of a small metadata DataFrame."""
    return [r[0] for r in df.select(col).orderBy(col).limit(limit).collect()]


def _rounds(df: DataFrame, size: int) -> Iterator[list[str]]:
    """All names of a metadata DataFrame, sorted, ``size`` at a time.

    The set is computed once; a large backlog is walked through, not listed
    anew for each round.
    """
    names: list[str] = []
    for row in df.select("source_file").orderBy("source_file").toLocalIterator():
        names.append(row[0])
        if len(names) == size:
            yield names
            names = []
    if names:
        yield names


def new_landing_files(spark: SparkSession, layout: Layout) -> DataFrame:
    """Landing entries not yet in the bronze ledger."""
    entries = landing.list_landing(spark, layout.landing)
    return ledger.unprocessed(entries, ledger.read_ledger(spark, layout.bronze_ledger))


def _ingest(spark: SparkSession, layout: Layout, names: list[str]) -> dict:
    """Write the named landing entries to bronze, then record them."""
    rows = landing.read_csv(spark, [landing.entry_path(layout.landing, n) for n in names])
    layers.write_layer(layers.to_bronze(rows), layout.bronze)
    written = layers.read_named(spark, layout.bronze, layers.BRONZE_SCHEMA, names).agg(
        F.count(F.lit(1)).alias("rows"), F.count(CORRUPT_COLUMN).alias("corrupt_rows")
    ).first()
    ledger.record_names(spark, names, layout.bronze_ledger)
    return {"files": len(names), "rows": written["rows"], "corrupt_rows": written["corrupt_rows"]}


def _still_new(spark: SparkSession, names: list[str], ledger_path: str) -> list[str]:
    """Those of a few names that the ledger does not hold by now."""
    rows = ledger.read_ledger(spark, ledger_path).where(F.col("source_file").isin(names)).select("source_file").distinct()
    done = {r[0] for r in rows.collect()} if names else set()
    return [n for n in names if n not in done]


def _ingest_claimed(spark: SparkSession, layout: Layout, names: list[str]) -> dict:
    """Ingest those of the names that no other run takes or has taken."""
    with claimed(spark, layout.claims("bronze"), names) as own:
        new = _still_new(spark, own, layout.bronze_ledger)
        return _ingest(spark, layout, new) if new else {"files": 0, "rows": 0, "corrupt_rows": 0}


def _add(totals: dict, more: dict) -> None:
    for key, value in more.items():
        totals[key] += value


def ingest_bronze(spark: SparkSession, layout: Layout, max_files: int = MAX_FILES_PER_ROUND) -> dict:
    """Append every new landing file to bronze, then record it in the ledger.

    The only step that starts a pipeline: it creates the tables of a fresh base.
    """
    totals = {"files": 0, "rows": 0, "corrupt_rows": 0}
    with pinned(spark):
        new = new_landing_files(spark, layout)  # a missing landing zone is an error
        init_layout(spark, layout)
        for names in _rounds(new, max_files):
            _add(totals, _ingest_claimed(spark, layout, names))
    return totals


def ingest_files(spark: SparkSession, layout: Layout, names: list[str]) -> dict:
    """Ingest those of the named landing entries that bronze has not seen yet."""
    with pinned(spark):
        init_layout(spark, layout)
        return _ingest_claimed(spark, layout, sorted(n for n in set(names) if n is not None))


def unprocessed_bronze_files(spark: SparkSession, layout: Layout) -> DataFrame:
    """Source files in the bronze ledger that are not in the silver ledger.

    A landing file without rows is one of them until it has rows: it has no
    partition, so silver passes over it, as in the reference.
    """
    read_files(spark, layers.BRONZE_SCHEMA, layout.bronze)  # missing bronze is an error
    done = ledger.read_ledger(spark, layout.bronze_ledger).select("source_file").distinct()
    return ledger.unprocessed(done, ledger.read_ledger(spark, layout.silver_ledger))


def incremental_bronze(spark: SparkSession, layout: Layout, names: list[str]) -> DataFrame:
    """Bronze rows of the named files; only their partitions are listed."""
    return layers.read_named(spark, layout.bronze, layers.BRONZE_SCHEMA, names).select(*layers.BRONZE_COLUMNS)


def unprocessed_bronze_rows(spark: SparkSession, layout: Layout, max_names: int = MAX_FILES_PER_ROUND) -> DataFrame:
    """All bronze rows silver has not seen yet.

    Up to ``max_names`` files: only their partitions are listed and read.
    Beyond: a semi join with the file set (exact; the file set is broadcast only
    if its size check passes).
    """
    files = unprocessed_bronze_files(spark, layout)
    if is_small(files, max_names):
        return incremental_bronze(spark, layout, _names(files, "source_file", max_names))
    bronze = layers.read_bronze(spark, layout.bronze)
    return join_small(bronze, files.withColumnRenamed("source_file", SOURCE_FILE), SOURCE_FILE, "left_semi")


def new_landing_rows(spark: SparkSession, layout: Layout, max_names: int = MAX_FILES_PER_ROUND) -> DataFrame:
    """Raw rows of every landing entry not yet in the bronze ledger.

    Up to ``max_names`` entries only their files are read; beyond, the whole
    landing glob is read and semi-joined with the new entries (exact).
    """
    new = new_landing_files(spark, layout).select("source_file")
    if is_small(new, max_names):
        names = _names(new, "source_file", max_names)
        if not names:
            return spark.createDataFrame([], RAW_READ_SCHEMA).withColumn(
                SOURCE_FILE, F.lit(None).cast("string")
            )
        return landing.read_csv(spark, [landing.entry_path(layout.landing, n) for n in names])
    rows = landing.read_csv(spark, landing.landing_glob(layout.landing))
    return join_small(rows, new.withColumnRenamed("source_file", SOURCE_FILE), SOURCE_FILE, "left_semi")


def transform_silver(spark: SparkSession, layout: Layout, max_files: int = MAX_FILES_PER_ROUND) -> dict:
    """Clean the bronze rows of files silver has not seen yet.

    A file that another run is cleaning is left to it.
    """
    totals = {"files": 0, "rows_in": 0, "rows_out": 0}
    with pinned(spark):
        for candidates in _rounds(unprocessed_bronze_files(spark, layout), max_files):
            with claimed(spark, layout.claims("silver"), layers.present(spark, layout.bronze, candidates)) as own:
                names = _still_new(spark, own, layout.silver_ledger)
                if not names:
                    continue
                rows = incremental_bronze(spark, layout, names)
                layers.write_layer(silver.clean(rows), layout.silver)
                written = write_partials(spark, layout, names)
                ledger.record_names(spark, names, layout.silver_ledger)
                _add(totals, {"files": len(names), "rows_in": rows.count(), "rows_out": written})
    return totals


def write_partials(spark: SparkSession, layout: Layout, names: list[str]) -> int:
    """Per-source-file grain totals of the named silver files; returns their rows.

    Written like the layers (dynamic overwrite of the files' partitions), so
    a retried round replaces them.  Lists and reads only the named partitions.
    """
    rows = layers.read_named(spark, layout.silver, layers.SILVER_SCHEMA, names)
    layers.write_layer(gold.totals(rows, per=(SOURCE_FILE,)).hint("rebalance", SOURCE_FILE), layout.gold_partials)
    return rows.count()


def build_gold(spark: SparkSession, layout: Layout, k: int = TOP_K, from_partials: bool = True) -> None:
    """Build the four gold tables anew (empty ones if silver has no row) and publish them.

    ``from_partials`` (default): add up the per-file partial totals that each
    silver round leaves behind -- work grows with the number of files and
    keys, not with all of silver.  Otherwise: one GROUPING SETS pass over all
    of silver.  Both give identical (exact) results.

    The grain totals are written first (partitioned by grain): that cuts the
    lineage, and each published table then reads only its own partition.

    Readers keep the version before until all four tables are there; a build that
    breaks off changes nothing.  With the tables goes what they were built from.
    """
    with pinned(spark):
        rows = layers.read_silver(spark, layout.silver)  # missing silver is an error
        source = _silver_state(spark, layout)  # before the totals are listed: never more than they hold
        base = versions.current(spark, layout.gold)
        folder = versions.new_folder(layout.gold)
        if from_partials:
            whole = gold.merge_totals(read_files(spark, PARTIALS_SCHEMA, layout.gold_partials))
        else:
            whole = gold.totals(rows)
        whole.write.partitionBy("grain").parquet(f"{folder}/_totals")
        saved = read_files(spark, TOTALS_SCHEMA, f"{folder}/_totals")
        tables = {}
        for key, df in gold.gold_tables(saved, k).items():
            tables[key] = f"{folder}/{GOLD_TABLE_NAMES[key]}"
            df.write.parquet(tables[key])
        versions.publish(spark, layout.gold, tables, source, base)
        versions.retire(spark, layout.gold)


def publish_gold_table(spark: SparkSession, layout: Layout, key: str, df: DataFrame) -> None:
    """Publish one gold table in a new version beside the present others.

    The version still counts as built from what the others were.
    """
    where = f"{versions.new_folder(layout.gold)}/{GOLD_TABLE_NAMES[key]}"
    df.write.parquet(where)
    base = versions.current(spark, layout.gold)
    versions.publish(spark, layout.gold, {key: where}, base.source if base else (-1, 0), base)
    versions.retire(spark, layout.gold)


def _silver_state(spark: SparkSession, layout: Layout) -> tuple:
    """The silver ledger as a set of names, in two numbers: how many, and their hashes' sum."""
    names = ledger.read_ledger(spark, layout.silver_ledger).select("source_file").distinct()
    digest = F.coalesce(F.sum(F.xxhash64("source_file").cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")
    files, hashes = names.agg(F.count(F.lit(1)), digest).first()
    return files, int(hashes)


def read_gold(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The four published tables of one version; empty before the first build.

    What is published later does not show in them: read again.
    """
    now = versions.current(spark, layout.gold)
    tables = now.tables if now else {}
    return {
        key: read_files(spark, ddl, tables[key]) if key in tables else spark.createDataFrame([], ddl)
        for key, ddl in GOLD_DDL.items()
    }


def _gold_built(spark: SparkSession, layout: Layout) -> bool:
    """Whether all gold tables are there and hold exactly the files of the silver ledger."""
    now = versions.current(spark, layout.gold)
    return now is not None and set(GOLD_DDL) <= set(now.tables) and now.source == _silver_state(spark, layout)


def run_increment(spark: SparkSession, layout: Layout) -> dict:
    """One increment end to end in one session: bronze, silver, gold.

    Gold is not rebuilt if the silver ledger names the files it was built from.
    """
    b = ingest_bronze(spark, layout)
    s = transform_silver(spark, layout)
    if not _gold_built(spark, layout):
        build_gold(spark, layout)
    return {"bronze": b, "silver": s}


def preview(spark: SparkSession, layout: Layout) -> DataFrame:
    """What ``run_increment`` would do, computed without writing anything.

    Returns ``(metric, value)`` rows: new files, bronze rows they hold, rows that
    will reach silver (from these files and from those waiting in bronze), and the
    row count of each gold table after the run.  One pass over the new rows; the
    current state comes from the per-file gold totals, not from silver.
    """
    with pinned(spark):
        new_files = new_landing_files(spark, layout).agg(F.count(F.lit(1)).alias("new_files"))
        arriving = layers.to_bronze(new_landing_rows(spark, layout)).withColumn("is_new", F.lit(True))
        try:
            waiting = unprocessed_bronze_rows(spark, layout)
        except FileNotFoundError:  # nothing ingested yet
            waiting = spark.createDataFrame([], layers.BRONZE_SCHEMA)
        rows = arriving.unionByName(waiting.withColumn("is_new", F.lit(False)))
        known = read_files(spark, PARTIALS_SCHEMA, layout.gold_partials, empty_if_missing=True)
        counts = gold.stage_counts(silver.with_reject_reason(rows), known).drop("rows").withColumnRenamed("new_rows", "bronze_rows")
        long = [p.unpivot([], p.columns, "metric", "value") for p in (new_files, counts)]
        return long[0].unionByName(long[1])


def date_gate(df: DataFrame) -> DataFrame:
    """One row: ``rows`` and ``bad_dates`` (InvoiceDate in no known layout)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(parse_invoice_timestamp("InvoiceDate").isNull()).alias("bad_dates"),
    )


_REFUSED = "no known layout for an InvoiceDate"


def split_monthly(spark: SparkSession, history: DataFrame, landing_root: str) -> int:
    """Split a full sales history into one landing entry per calendar month.

    Refuses (ValueError) when any InvoiceDate cannot be parsed: the writing pass
    itself fails at such a row, and nothing is committed.  A month that is already
    there is replaced, so a repeated split changes nothing.  Returns the number
    of rows.
    """
    with pinned(spark):
        if history.isEmpty():
            return 0
        when = parse_invoice_timestamp("InvoiceDate")
        label = F.when(when.isNull(), F.raise_error(F.lit(_REFUSED))).otherwise(month_file_name(when))
        seen = Observation("split")
        rows = history.withColumn(SOURCE_FILE, label).observe(seen, F.count(F.lit(1)).alias("rows"))
        try:
            landing.write_csv(rows, landing_root, replace=True)
        except PySparkException as err:
            if _REFUSED not in str(err):
                raise
            bad = date_gate(history).first()["bad_dates"]
            raise ValueError(f"{bad:,} rows have an InvoiceDate in no known layout; nothing was split") from err
        return seen.get["rows"]


def published_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """All eight tables of a pipeline under their published names."""
    tables = {
        "bronze_online_retail": layers.read_bronze(spark, layout.bronze),
        "silver_online_retail": layers.read_silver(spark, layout.silver),
        "bronze_processed_files": ledger.read_ledger(spark, layout.bronze_ledger),
        "silver_processed_files": ledger.read_ledger(spark, layout.silver_ledger),
    }
    for key, df in read_gold(spark, layout).items():
        tables[GOLD_TABLE_NAMES[key]] = df
    return tables


def register_views(spark: SparkSession, layout: Layout, prefix: str = "") -> list[str]:
    """Register the eight tables as temporary views (``prefix`` + name) so
    that dashboard SQL can address them by name.  Returns the view names."""
    names = []
    for name, df in published_tables(spark, layout).items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def publish_tables(spark: SparkSession, layout: Layout, database: str) -> list[str]:
    """Create the database and its eight tables in the session's catalog, or bring them up to date.

    The tables are external.  Publishing again adds new bronze and silver partitions,
    points the gold tables at the current version, and replaces the entry (never the
    data) of a table whose columns have changed.  Returns the qualified names.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    now = versions.current(spark, layout.gold)
    current = now.tables if now else {}
    paths = {
        "bronze_online_retail": (layout.bronze, layers.BRONZE_SCHEMA, True),
        "silver_online_retail": (layout.silver, layers.SILVER_SCHEMA, True),
        "bronze_processed_files": (layout.bronze_ledger, ledger.LEDGER_SCHEMA, False),
        "silver_processed_files": (layout.silver_ledger, ledger.LEDGER_SCHEMA, False),
    } | {name: (current.get(key, f"{layout.gold}/none/{name}"), GOLD_DDL[key], False) for key, name in GOLD_TABLE_NAMES.items()}
    names = []
    for table, (path, schema, partitioned) in paths.items():
        name = f"`{database}`.`{table}`"
        columns = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f" PARTITIONED BY (`{SOURCE_FILE}`)" if partitioned else ""
        nested = "" if partitioned else " OPTIONS (recursiveFileLookup 'true')"
        location = path.replace("'", "\\'")
        if spark.catalog.tableExists(name):
            want = {f.name: f.dataType for f in spark.createDataFrame([], schema).schema}
            if {f.name: f.dataType for f in spark.table(name).schema} != want:
                spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{nested}{by} LOCATION '{location}'")
        if table in GOLD_TABLE_NAMES.values():
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        if partitioned:
            spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
        names.append(name)
    return names
