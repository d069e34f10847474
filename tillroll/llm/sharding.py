"""Operator 10, sharding: best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts form a group that no shard boundary may cut.  Packing runs
on two levels, so that no task and not the driver ever holds all groups:

1. Groups (one row each, pre-aggregated) are dealt by digest over buckets.  In a
   bucket they come sorted by size, largest first, and enter the bin with the
   tightest remaining capacity that still holds them, found in a balanced tree.
   A bin holds 1/BINS of all bytes; a larger group gets a bin of its own.
2. The bins, a few thousand however large the input is, are packed the same way
   into the shards: the smallest capacity is sought at which best-fit-decreasing
   needs no more shards than asked for, which makes their sizes near equal.

The number of buckets is at most BINS, and a bucket leaves at most one bin less
than half full, so there are never more than 3 * BINS + 1 bins besides the groups
larger than a bin, of which there are at most BINS.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import settle

SHARDS = 16
BINS = 4096
GROUPS_PER_BUCKET = 200_000
ROWS_PER_SLOT_BUCKET = 500


class OpenBins:
    """Bins ordered by remaining capacity: a B-tree of two levels of sorted runs."""

    WIDTH = 512

    def __init__(self) -> None:
        self.runs: list[list[tuple[int, int]]] = []
        self.tops: list[tuple[int, int]] = []

    def add(self, left: int, number: int) -> None:
        item = (left, number)
        if not self.runs:
            self.runs, self.tops = [[item]], [item]
            return
        k = min(bisect_left(self.tops, item), len(self.runs) - 1)
        run = self.runs[k]
        insort(run, item)
        self.tops[k] = run[-1]
        if len(run) > self.WIDTH:
            half = len(run) // 2
            self.runs[k : k + 1] = [run[:half], run[half:]]
            self.tops[k : k + 1] = [run[half - 1], run[-1]]

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least capacity left that holds ``size``."""
        k = bisect_left(self.tops, (size, -1))
        if k == len(self.runs):
            return None
        run = self.runs[k]
        item = run.pop(bisect_left(run, (size, -1)))
        if run:
            self.tops[k] = run[-1]
        else:
            del self.runs[k], self.tops[k]
        return item


def best_fit(sizes: Iterable[int], capacity: int) -> Iterator[int]:
    """The bin number of each size, in order; sizes come largest first."""
    bins, made = OpenBins(), 0
    for size in sizes:
        found = bins.take(size)
        if found is None:
            found, made = (max(capacity, size), made), made + 1
        bins.add(found[0] - size, found[1])
        yield found[1]


def into_shards(sizes: list[int], shards: int) -> list[int]:
    """A shard for each size (largest first), at the least capacity that fits.

    Best-fit-decreasing always fits at the mean plus the largest size, so the
    search between the lower bound and that capacity ends with a packing.
    """
    if not sizes:
        return []
    low = max(sizes[0], math.ceil(sum(sizes) / shards))
    high = math.ceil(sum(sizes) / shards) + sizes[0]
    best = list(best_fit(sizes, high))
    while low < high:
        middle = (low + high) // 2
        found = list(best_fit(sizes, middle))
        if max(found) < shards:
            best, high = found, middle
        else:
            low = middle + 1
    return best


def _pack(capacity: int):
    def run(batches):
        bucket, bins, made = None, OpenBins(), 0
        for batch in batches:
            numbers = []
            for b, size in zip(batch["bucket"].to_pylist(), batch["weight"].to_pylist()):
                if b != bucket:
                    bucket, bins, made = b, OpenBins(), 0
                found = bins.take(size)
                if found is None:
                    found, made = (max(capacity, size), made), made + 1
                bins.add(found[0] - size, found[1])
                numbers.append(found[1])
            yield pa.RecordBatch.from_arrays(
                [batch["digest"], batch["bucket"], pa.array(numbers, pa.int64()), batch["weight"]],
                names=["digest", "bucket", "bin", "weight"],
            )

    return run


def shard(docs: DataFrame, shards: int = SHARDS, bins: int = BINS) -> DataFrame:
    """Put every row of ``docs`` (``doc_id``, ``text``; others ignored) in a shard.

    Returns ``doc_id``, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``shard``
    and ``slot`` (gapless from 0 in each shard, in order of a hash bucket of the
    row, then ``doc_id``).  Rows with equal texts share a shard.

    Defined cases: a null text has the size and checksum of an empty one and is
    equal to it; repeated rows and ids each take a slot; a null id is an id like
    others; an empty table gives an empty result; fewer groups than shards leave
    shards empty; a group larger than a fair share makes its shard as large.
    """
    spark = docs.sparkSession
    rows = settle(
        docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("bytes")).select(
            "doc_id",
            (F.octet_length("bytes") + 1).cast("long").alias("size"),
            F.crc32("bytes").alias("text_crc32"),
            F.unhex(F.sha2("bytes", 256)).alias("digest"),
        ),
        "op10-rows",
    )
    groups = settle(rows.groupBy("digest").agg(F.sum("size").alias("weight")), "op10-groups")
    n, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    n_rows = rows.count()
    capacity = max(1, math.ceil(total / bins))
    buckets = min(bins, max(1, math.ceil(n / GROUPS_PER_BUCKET)))

    packed = settle(
        groups.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)))
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", F.desc("weight"), "digest")
        .mapInArrow(_pack(capacity), "digest binary, bucket long, bin long, weight long"),
        "op10-packed",
    )
    # Bounded by the module's note: bins, not groups, reach the driver.
    filled = packed.groupBy("bucket", "bin").agg(F.sum("weight").alias("weight")).collect()
    filled.sort(key=lambda r: (-r["weight"], r["bucket"], r["bin"]))
    numbers = into_shards([r["weight"] for r in filled], shards)
    places = spark.createDataFrame(
        pd.DataFrame({"bucket": [r["bucket"] for r in filled], "bin": [r["bin"] for r in filled], "shard": numbers}),
        "bucket long, bin long, shard int",
    )
    placed = settle(packed.join(F.broadcast(places), ["bucket", "bin"]).select("digest", "shard"), "op10-placed")

    # Slots: numbered inside small buckets of rows, after the rows of the buckets before.
    parts = max(1, math.ceil(n_rows / max(ROWS_PER_SLOT_BUCKET, math.isqrt(n_rows))))
    dealt = settle(
        rows.join(placed, "digest")
        .withColumn("part", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(parts)))
        .drop("digest"),
        "op10-dealt",
    )
    before = (
        dealt.groupBy("shard", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "shard",
            "part",
            (F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before"),
        )
    )
    inside = Window.partitionBy("shard", "part").orderBy(F.asc_nulls_last("doc_id"), "size", "text_crc32")
    return (
        dealt.withColumn("inside", F.row_number().over(inside) - 1)
        .join(before, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("inside")).cast("long").alias("slot"))
    )
