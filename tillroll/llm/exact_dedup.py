"""Operator 8, exact dedup: group by a 128-bit content hash, compare bytes inside groups.

Main path: DataFrame functions only.

1. Every text is normalised (characters of [\\x20\\x09-\\x0D] deleted) and hashed
   (MD5, 128 bits).  Hashes are counted; only counts are shuffled.
2. Rows whose hash occurs more than once carry their normalised text to the
   hash's partition.  The text of the row with the smallest id represents the
   hash; every other text is compared with it byte by byte.  A text that differs
   (a hash collision) keys a class of its own bytes, so classes are exact.
3. Inside a class, the row with the most code points, then the smallest id stays.

A hash that a third of all rows share is counted map-side; the joins that bring
rows to it have one small row on the other side, and AQE splits them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import WHITESPACE, settle

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def normalised(text: Column) -> Column:
    """``text`` without the characters of [\\x20\\x09-\\x0D]; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITESPACE, "")


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id",
        F.char_length(F.coalesce("text", F.lit(""))).alias("points"),
        normalised(F.col("text")).alias("norm"),
    ).withColumn("hash", F.unhex(F.md5("norm")))


def _decide(docs: DataFrame) -> DataFrame:
    """One row per input row: COLUMNS and ``points`` of its text."""
    counts = settle(
        _hashed(docs).groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "op8-counts"
    )
    repeated = F.col("n").isNotNull()
    rows = settle(
        _hashed(docs)
        .join(counts, "hash", "left")
        .select(
            "doc_id",
            "points",
            "hash",
            F.sha2("norm", 256).alias("text_sha256"),
            repeated.alias("repeated"),
            F.when(repeated, F.col("norm")).alias("norm"),
        ),
        "op8-rows",
    )
    single = rows.where("NOT repeated").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
        "points",
    )

    many = rows.where("repeated")
    first = settle(
        many.groupBy("hash").agg(F.min(F.struct("doc_id", "norm")).alias("r")).select("hash", F.col("r.norm").alias("first")),
        "op8-first",
    )
    # Null: the bytes are those of the hash's first text.
    other = F.when(F.col("norm") != F.col("first"), F.col("norm"))
    # Rows that agree in everything count once here and are dealt out again below.
    compared = settle(
        many.join(first, "hash").select(
            "hash", F.struct(other.alias("text")).alias("other"), "doc_id", "points", "text_sha256"
        ),
        "op8-compared",
    )
    cells = settle(
        compared.groupBy("hash", "other", "doc_id", "points", "text_sha256").agg(
            F.count(F.lit(1)).alias("copies")
        ),
        "op8-cells",
    )
    order = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("u"), F.col("doc_id").alias("i"))
    classes = settle(
        cells.groupBy("hash", "other").agg(F.sum("copies").alias("group_size"), F.min(order).alias("best")),
        "op8-classes",
    )
    best = F.col("doc_id").eqNullSafe(F.col("best.i")) & (F.col("points") == -F.col("best.p"))
    grouped = (
        cells.join(classes, ["hash", "other"])  # structs with a null inside are equal
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select(
            "doc_id",
            F.col("best.i").alias("keep_id"),
            "group_size",
            (best & (F.col("copy") == 1)).alias("kept"),
            "text_sha256",
            "points",
        )
    )
    return single.unionByName(grouped)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (columns ``doc_id``, ``text``; others are ignored).

    Returns ``doc_id``, ``keep_id`` (id of the row of its class that stays),
    ``group_size``, ``kept`` and ``text_sha256`` (of the normalised text).

    Defined cases: a null text equals an empty one, and both equal a text of
    white space only.  A null id comes after all others; such a row can stay
    (``keep_id`` null) only in a class where it has more code points than the
    rest or no row has an id.  Of rows equal in id and text exactly one is kept.
    An empty table gives an empty result.
    """
    return _decide(docs).select(*COLUMNS)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns.

    Defined cases: of null, empty and blank texts together one row stays (the longest,
    then the smallest id); of rows equal in id and text one stays, whatever their other
    columns; an empty table gives an empty result.
    """
    kept = _decide(docs).where("kept").select(
        F.col("doc_id").alias("_op8_id"), F.col("text_sha256").alias("_op8_s"), F.col("points").alias("_op8_p")
    )
    keyed = docs.withColumns(
        {
            "_op8_sha": F.sha2(normalised(F.col("text")), 256),
            "_op8_points": F.char_length(F.coalesce("text", F.lit(""))),
        }
    )
    same = (
        F.col("_op8_sha").eqNullSafe(F.col("_op8_s"))
        & (F.col("_op8_points") == F.col("_op8_p"))
        & F.col("doc_id").eqNullSafe(F.col("_op8_id"))
    )
    return keyed.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_op8_sha", "_op8_points"]).select(*docs.columns)
