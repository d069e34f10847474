"""Operator 4, mixing sources to target weights.  DataFrame functions only.

1. Targets: every source's share of all words by weight; a source stops at
   MAX_EPOCHS times its own words and the others share the excess.
2. Packing: a source's documents, in a fixed pseudorandom order, form one stream
   of words, cut into blocks of ``block_words``.  Offsets come from sums inside
   small buckets of rows plus the sums of the buckets before, so no task ever
   holds a whole source.
3. Draws: every output shard draws how many of its slots each source fills.  The
   draw is multinomial over the fractional parts of the expected counts (the
   whole parts are fixed).  Where a source was drawn more often than its target
   allows over all shards, its last slots go to the sources drawn too seldom.
4. The k-th slot of a source reads block perm(k mod n) in epoch k div n, where n
   is the source's number of blocks and perm a pseudorandom permutation of
   0..n-1 keyed by source and epoch.  Slots join blocks by that index.

All draws are hashes of fixed keys, so reruns and recomputed partitions agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import WORD, settle

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BLOCK_WORDS = 32
SHARD_SLOTS = 1024
ROWS_PER_BUCKET = 500
# Slots made by one task.
SLOTS_PER_TASK = 100_000
SEED = 11
# Rounds of the index permutation.
ROUNDS = 12


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``sid``, ``weight`` and ``target`` to (source, source_size), one row per source.

    Sources are taken by code point, null last, and weigh ``weights`` in turn.
    Sorted by cap over weight, the sources that a proportional share would push
    over their cap come first; the rest share what these leave.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    everything = Window.partitionBy(F.lit(0))
    by_ratio = Window.orderBy("ratio", "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("sid", F.lit(len(weights))) + 1).cast("int"))
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / (
        F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    return (
        sources.withColumn("sid", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumns({"total": F.sum("source_size").over(everything), "all_weight": F.sum("weight").over(everything)})
        .withColumn("level", level)
        .withColumn("free", F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "sid", "level")))
        .withColumn("level", F.min("free").over(everything)["level"])
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
        .select("source", "source_size", "sid", "weight", "target")
    )


def _uniform(*keys: Column) -> Column:
    """A number in [0, 1) that only the keys decide."""
    return F.pmod(F.xxhash64(F.lit(SEED), *keys), F.lit(1 << 52)) / float(1 << 52)


def permuted(index: Column, n: Column, *keys: Column) -> Column:
    """A pseudorandom permutation of 0..n-1, as swap-or-not rounds.

    Each round pairs x with (key - x) mod n and swaps both or none of a pair, so
    it maps 0..n-1 onto itself for every n.
    """

    def step(x, r):
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), r, *keys), n) - x, n)
        swap = F.pmod(F.xxhash64(F.lit(SEED + 1), r, F.greatest(x, partner), *keys), F.lit(2)) == 1
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, step)


def _laid_out(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with the offset of their first word in their source's stream."""
    n = sized.count()
    buckets = max(1, math.ceil(n / max(ROWS_PER_BUCKET, math.isqrt(n))))
    rows = sized.withColumn("bucket", F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "size"), F.lit(buckets)))
    cell = Window.partitionBy("source", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id", "size")
    start = F.sum("size").over(cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    cells = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    s, p = F.col("source"), F.col("p_source")
    base = (
        cells.join(plan.withColumnRenamed("source", "p_source"), s.eqNullSafe(p))
        .drop("p_source")
        .withColumn("base", F.sum("words").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("words"))
        .select(F.col("source").alias("c_source"), F.col("bucket").alias("c_bucket"), "base", "sid", "source_size", "target")
    )
    return (
        rows.withColumn("start", start)
        .join(base, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("bucket") == F.col("c_bucket")))
        .select("doc_id", "source", "size", "source_size", "target", "sid", (F.col("base") + F.col("start")).alias("offset"))
    )


def _numbered(rows: DataFrame, count: int) -> DataFrame:
    """``rows``, each with every ``shard`` below ``count`` and its ``group`` of shards.

    Groups are as many as shards in a group, so no list is longer than their root.
    """
    step = max(1, math.isqrt(count))
    groups = rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit((count - 1) // step))))
    low = F.col("group") * step
    return groups.repartition("group").withColumn("shard", F.explode(F.sequence(low, F.least(low + step, F.lit(count)) - 1)))


def _slots(plan: DataFrame, block_words: int, shard_slots: int, max_epochs: int) -> DataFrame:
    """One row per output slot: ``shard``, ``slot``, ``sid``, ``epoch``, ``block``."""
    blocks = F.ceil(F.col("source_size") / block_words)
    quota = F.least(blocks * max_epochs, F.round(F.col("target") * blocks / F.col("source_size")).cast("long"))
    plan = settle(
        plan.where("source_size > 0").select("sid", blocks.alias("blocks"), quota.alias("quota")), "op4-quota"
    )
    total, kinds = plan.agg(F.coalesce(F.sum("quota"), F.lit(0)), F.count(F.lit(1))).first()
    size = max(shard_slots, 64 * kinds)  # cells of shard and source stay fewer than slots
    shards = max(1, math.ceil(total / size))
    in_shard = Window.partitionBy("shard").orderBy("sid")
    whole = Window.partitionBy("shard")

    expected = F.col("room") * F.col("quota") / float(max(1, total))
    drawn = F.size(
        F.filter(
            F.sequence(F.lit(1), F.col("rest")),
            lambda r: (_uniform(F.col("shard"), r) * F.col("mass") >= F.col("high") - F.col("part"))
            & (_uniform(F.col("shard"), r) * F.col("mass") < F.col("high")),
        )
    )
    cells = settle(
        _numbered(plan, shards)
        .withColumn("room", F.least(F.lit(size), F.lit(total) - F.col("shard") * size))
        .withColumn("expected", expected)
        .withColumn("fixed", F.floor("expected"))
        .withColumn("part", F.col("expected") - F.col("fixed"))
        .withColumns(
            {
                "rest": F.col("room") - F.sum("fixed").over(whole),
                "high": F.sum("part").over(in_shard),
                "mass": F.sum("part").over(whole),
            }
        )
        # A draw counts for the source whose stretch of the unit mass it meets.
        .withColumn("count", F.col("fixed") + F.when(F.col("rest") > 0, drawn).otherwise(0))
        .withColumn("slot", F.sum("count").over(in_shard) - F.col("count"))
        .select("sid", "blocks", "quota", "group", "shard", "slot", "count"),
        "op4-drawn",
    )
    # A source's slots are numbered through: in groups of shards, and over the groups.
    groups = cells.groupBy("sid", "group").agg(F.sum("count").alias("slots"))
    base = F.sum("slots").over(Window.partitionBy("sid").orderBy("group")) - F.col("slots")
    within = F.sum("count").over(Window.partitionBy("sid", "group").orderBy("shard")) - F.col("count")
    cells = settle(
        cells.withColumn("within", within)
        .join(groups.select("sid", "group", base.alias("base")), ["sid", "group"])
        .select("sid", "blocks", "quota", "shard", "slot", (F.col("base") + F.col("within")).alias("first"), "count"),
        "op4-cells",
    )
    # The cells are few and their slots many: deal them out before they are made.
    slots = (
        cells.where("count > 0")
        .repartition(max(1, math.ceil(total / SLOTS_PER_TASK)), "shard", "sid")
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
        .select("sid", "blocks", "quota", "shard", (F.col("slot") + F.col("i")).alias("slot"), (F.col("first") + F.col("i")).alias("k"))
    )
    # Slots beyond a source's quota go, in order, to the sources below theirs.
    by_sid = Window.orderBy("sid")
    balance = settle(
        cells.groupBy("sid", "blocks", "quota")
        .agg(F.sum("count").alias("got"))
        .withColumns(
            {
                "over": F.greatest(F.col("got") - F.col("quota"), F.lit(0)),
                "under": F.greatest(F.col("quota") - F.col("got"), F.lit(0)),
            }
        )
        .withColumns({"over_before": F.sum("over").over(by_sid) - F.col("over"), "under_before": F.sum("under").over(by_sid) - F.col("under")}),
        "op4-balance",
    )
    spare = (
        slots.where("k >= quota")
        .join(balance.select("sid", "over_before"), "sid")
        .select("shard", "slot", (F.col("over_before") + F.col("k") - F.col("quota")).alias("x"))
    )
    wanted = balance.where("under > 0").select(
        "sid",
        "blocks",
        F.posexplode(F.sequence(F.col("got"), F.col("quota") - 1)).alias("at", "k"),
        "under_before",
    ).select("sid", "blocks", "k", (F.col("under_before") + F.col("at")).alias("x"))
    moved = spare.join(wanted, "x").select("sid", "blocks", "shard", "slot", "k")
    filled = slots.where("k < quota").select("sid", "blocks", "shard", "slot", "k").unionByName(moved)
    epoch = F.floor(F.col("k") / F.col("blocks"))
    return filled.select(
        "shard",
        "slot",
        "sid",
        epoch.alias("epoch"),
        permuted(F.pmod("k", "blocks"), F.col("blocks"), F.col("sid"), epoch).alias("block"),
    )


def _prepared(docs: DataFrame, weights, max_epochs) -> tuple[DataFrame, DataFrame]:
    sized = settle(docs.select("doc_id", "source", words(F.col("text")).alias("size")), "op4-sized")
    plan = settle(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs), "op4-plan"
    )
    return settle(_laid_out(sized, plan), "op4-laid"), plan


def _pieces(laid, plan, block_words, shard_slots, max_epochs) -> DataFrame:
    first = F.floor(F.col("offset") / block_words)
    last = F.floor((F.col("offset") + F.col("size") - 1) / block_words)
    start = F.greatest(F.col("offset"), F.col("block") * block_words)
    end = F.least(F.col("offset") + F.col("size"), (F.col("block") + 1) * block_words)
    blocks = (
        laid.where("size > 0")
        .withColumn("block", F.explode(F.sequence(first, last)))
        .select("sid", "block", "doc_id", "source", "offset", (start - F.col("offset")).alias("first_word"), (end - start).alias("n_words"))
    )
    slots = _slots(plan, block_words, shard_slots, max_epochs)
    # Slots are made by an explode whose output the planner can't foresee: no broadcast.
    return slots.hint("merge").join(blocks, ["sid", "block"])


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs=MAX_EPOCHS, block_words=BLOCK_WORDS, shard_slots=SHARD_SLOTS) -> DataFrame:
    """The mixed stream: which words of which document fill which output slot.

    Returns ``shard``, ``slot``, ``epoch``, ``source``, ``block``, ``doc_id``,
    ``first_word`` (from 0) and ``n_words``; a slot holds one block, a block one
    or more pieces of documents.  The defined cases are those of ``taken``: rows
    without words are in no slot; an empty table, or one without words, has none.
    """
    laid, plan = _prepared(docs, weights, max_epochs)
    return _pieces(laid, plan, block_words, shard_slots, max_epochs).select(
        "shard", "slot", "epoch", "source", "block", "doc_id", "first_word", "n_words"
    )


def taken(docs: DataFrame, weights=WEIGHTS, max_epochs=MAX_EPOCHS, block_words=BLOCK_WORDS, shard_slots=SHARD_SLOTS) -> DataFrame:
    """One row per row of ``docs``: the words that the mix takes of it.

    Returns ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and
    ``taken`` (repeats counted, at most ``max_epochs`` times ``size``).

    Defined cases: null and empty texts have size 0 and nothing is taken; a null
    source is a source of its own, after all others; repeated rows and null ids
    are rows of their own; if no row has a word, all targets are 0; an empty table
    gives an empty result.  A source ends within one block of its target.
    """
    laid, plan = _prepared(docs, weights, max_epochs)
    pieces = _pieces(laid, plan, block_words, shard_slots, max_epochs)
    sums = pieces.groupBy("sid", "offset").agg(F.sum("n_words").alias("words"))
    some = F.when(F.col("size") > 0, F.coalesce("words", F.lit(0))).otherwise(0).cast("long")
    return laid.join(sums, ["sid", "offset"], "left").select(
        "doc_id", "source", "size", "source_size", "target", some.alias("taken")
    )


def _copies(share: DataFrame, rows_per_part: int = 50_000) -> DataFrame:
    """``share`` (``source``, ``units`` words, ``times`` each is taken) with whole ``copies``.

    Along each source's rows, by size, the running sum of ``times`` is rounded down
    after adding the source's own fraction; a row's copies are the steps of that sum.
    So copies and times differ by less than one over any stretch of rows, and because
    the sizes only grow along it, a source's words differ from what the mix takes by
    at most its largest row.  The sums are integers and taken on two levels: in range
    partitions, then over these.
    """
    scale = 1 << 24
    keys = ["source", "units", "_op4_order", "_op4_id"]
    parts = max(1, math.ceil(share.count() / rows_per_part))
    placed = settle(
        share.withColumns({"_op4_step": F.round(F.col("times") * scale).cast("long"), "_op4_order": F.xxhash64(F.lit(SEED), "_op4_id")})
        .repartitionByRange(parts, *keys)
        .withColumn("_op4_part", F.spark_partition_id()),
        "op4-placed",
    )
    totals = placed.groupBy("source", "_op4_part").agg(F.sum("_op4_step").alias("sum"))
    before = Window.partitionBy("source").orderBy("_op4_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        F.col("source").alias("_op4_s"), F.col("_op4_part").alias("_op4_p"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("_op4_base")
    )
    line = Window.partitionBy("source", "_op4_part").orderBy("units", "_op4_order", "_op4_id").rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum("_op4_step").over(line) + F.col("_op4_base") + F.floor(_uniform(F.xxhash64("source"), F.lit(1)) * scale).cast("long")
    whole = lambda x: F.floor(x / scale)
    return (
        placed.join(bases, F.col("source").eqNullSafe(F.col("_op4_s")) & (F.col("_op4_part") == F.col("_op4_p")))
        .withColumn("_op4_run", run)
        .withColumn("copies", (whole(F.col("_op4_run")) - whole(F.col("_op4_run") - F.col("_op4_step"))).cast("int"))
        .select(*share.columns, "copies")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every row as often as the mix takes its words, as whole documents.

    A row taken t times its size stays floor(t) or floor(t) + 1 times (see ``_copies``),
    and each source's words differ from its target by at most its longest document
    and one block, however few documents hold them.

    Defined cases: rows without words go (null, empty or blank texts); a null source is
    a source of its own; rows equal in id, source and size stay equally often, and
    count as one long document above; an empty table gives an empty result.
    """
    share = (
        taken(docs)
        .where("size > 0")
        .groupBy("doc_id", "source", "size")
        .agg((F.sum("taken") / F.sum("size")).alias("times"), F.sum("size").alias("units"))
        .withColumnsRenamed({"doc_id": "_op4_id", "size": "_op4_n"})
    )
    counted = _copies(share).select("_op4_id", F.col("source").alias("_op4_source"), "_op4_n", F.col("copies").alias("_op4_copies"))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_op4_id"))
        & F.col("source").eqNullSafe(F.col("_op4_source"))
        & (F.col("_op4_size") == F.col("_op4_n"))
    )
    return (
        docs.withColumn("_op4_size", words(F.col("text")))
        .join(counted, same)
        .withColumn("_op4_copy", F.explode(F.array_repeat(F.lit(1), F.col("_op4_copies"))))
        .select(*docs.columns)
    )
