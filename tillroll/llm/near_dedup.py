"""Operator 3, n-gram Jaccard join: MinHash banding, then exact verification.

1. A text is the set of its 5-word shingles (64-bit hashes).  Texts with the same
   words in the same order form one class; each class is signed once.
2. Signature: MinHash values in bands of rows; the numbers of both are chosen so
   that a pair at the threshold meets in some band with the target recall.
   Classes are shuffled on band hashes.  The members of a bucket are tied to its
   smallest member, never to each other, and the connected components of these
   ties are candidate groups.
3. Each candidate group's shingle sets are brought together, and all its pairs are
   verified on full sets.  A large group is cut into blocks, and every pair of
   blocks is one task's work, so none holds more than two blocks.  What leaves a
   task is each member's number of links and one tie per member, never the pairs.
4. Components of the verified ties are the near-duplicate classes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import released, settle, slices, utf8
from tillroll.llm.components import components

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_HASHES = 160
BLOCK = 256
MEMBERS_PER_TASK = 2000
SEED = 3

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)
_BASE = np.uint64(0x100000001B3)


def bands_for(threshold: float, recall: float, max_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands reach the recall within max_hashes."""
    best = (max_hashes, 1)
    for rows in range(1, 33):
        meet = threshold**rows
        bands = math.ceil(math.log(1 - recall) / math.log(1 - meet)) if meet < 1 else 1
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * _ODD
    x ^= x >> np.uint64(29)
    x *= _ODD2
    return x ^ (x >> np.uint64(32))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _BASE and of its inverse modulo 2^64, at least n of each."""
    size = 1 << max(19, (n - 1).bit_length())
    if size not in _powers:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        tables = []
        for base in (_BASE, inverse):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers.clear()
        _powers[size] = tuple(tables)
    return _powers[size]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts in order, and the text it is in.

    A word's hash is a polynomial of its bytes, taken from running sums.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _power_table(len(data) + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    hashes = _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _ODD)
    limits = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(limits, starts, side="right")


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, the text of each; word counts and word-order keys.

    A text of fewer than WORDS words has one shingle, all its words; a text
    without words has none.
    """
    words, text = word_hashes(texts)
    counts = np.bincount(text, minlength=len(texts))
    firsts = np.cumsum(counts) - counts
    n = max(0, len(words) - WORDS + 1)
    value = np.zeros(n, np.uint64)
    for k in range(WORDS):
        value = value * _ODD2 + words[k : k + n]
    inside = np.flatnonzero(text[:n] == text[WORDS - 1 :]) if n else np.zeros(0, np.int64)
    value, owner = _mixed(value[inside]), text[inside]
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for k in range(WORDS - 1):
            there = counts[short] > k
            own[there] = own[there] * _ODD2 + words[firsts[short[there]] + k]
        value, owner = np.concatenate([value, _mixed(own + counts[short].astype(np.uint64))]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        value, owner = value[order], owner[order]
    keys = np.zeros((len(texts), 2), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        place = (np.arange(len(words)) - firsts[text]).astype(np.uint64)
        for side, salt in enumerate((_ODD, _ODD2)):
            keys[full, side] = _mixed(np.add.reduceat(_mixed(words * salt + place * _BASE), firsts[full]))
    return value, owner, counts, keys


def signatures(texts: list[bytes], bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word counts, word-order keys and band hashes of each text."""
    value, owner, counts, keys = shingles(texts)
    out = np.zeros((len(texts), bands), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        firsts = np.searchsorted(owner, full)
        draw = np.random.default_rng(SEED).integers(0, 1 << 63, (bands * rows, 2)).astype(np.uint64)
        for band in range(bands):
            hashed = np.full(len(full), band, np.uint64)
            for row in range(band * rows, (band + 1) * rows):
                least = np.minimum.reduceat((value ^ draw[row, 0]) * (draw[row, 1] | np.uint64(1)), firsts)
                hashed = _mixed(hashed * _ODD + least)
            out[full, band] = hashed
    return counts, keys, out


def _signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = utf8(batch["text"])
            parts = [signatures(texts[lo:hi], bands, rows) for lo, hi in slices(texts)]
            if not parts:
                continue
            counts, keys, hashes = (np.concatenate(x) for x in zip(*parts))
            n = len(texts)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(hashes.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_key"],
                    pa.array(counts.astype(np.int64)),
                    pa.array(keys[:, 0].copy().view(np.int64)),
                    pa.array(keys[:, 1].copy().view(np.int64)),
                    lists,
                ],
                names=["doc_id", "text_key", "words", "k1", "k2", "bands"],
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        released(run), "doc_id long, text_key long, words long, k1 long, k2 long, bands array<long>"
    )


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set on the left with each on the right."""
    if len(left) * len(right) <= 4:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left], np.int64)
    common = np.intersect1d(np.concatenate(left), np.concatenate(right))
    sides = []
    for sets in (left, right):
        flat = np.concatenate(sets)
        at = np.minimum(np.searchsorted(common, flat), max(0, len(common) - 1))
        hit = np.flatnonzero(common[at] == flat) if len(common) else np.zeros(0, np.int64)
        order = hit[np.argsort(at[hit], kind="stable")]
        sides.append((np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order], at[order]))
    out = np.zeros((len(left), len(right)), np.int64)
    for low in range(0, len(common), 4096):
        tables = []
        for (owner, at), sets in zip(sides, (left, right)):
            lo, hi = np.searchsorted(at, [low, low + 4096])
            table = np.zeros((len(sets), min(4096, len(common) - low)), np.float32)
            table[owner[lo:hi], at[lo:hi] - low] = 1
            tables.append(table)
        out += (tables[0] @ tables[1].T).astype(np.int64)
    return out


def links(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs have a Jaccard similarity of at least the threshold."""
    both = shared_counts(left, right)
    union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - both
    return (both > 0) & (both >= threshold * union - 1e-9)


def _verified(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        """All groups (or the one pair of blocks) of a task: link counts and ties."""
        node, group, block = (np.asarray(table[c]) for c in ("node", "root", "block"))
        n, key = np.asarray(table["n"]), np.asarray(table["k1"])
        first, second = table["i"][0].as_py(), table["j"][0].as_py()
        sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
        found: list[tuple[int, int, int]] = []
        order = np.lexsort((key, node, group))
        for part in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
            # Repeated rows have come as often as they occur; one of each counts.
            part = part[np.append(True, (np.diff(node[part]) != 0) | (np.diff(key[part]) != 0))]
            a = part[block[part] == first]
            b = a if first == second else part[block[part] == second]
            if not len(a) or not len(b):
                continue
            linked = links([sets[i] for i in a], [sets[i] for i in b], threshold)
            if first == second:
                np.fill_diagonal(linked, False)
            label = np.concatenate([node[a], node[b]])
            while True:  # smallest node of each component within the blocks
                la, lb = label[: len(a)], label[len(a) :]
                top = np.iinfo(np.int64).max
                na = np.minimum(la, np.where(linked, lb[None, :], top).min(axis=1))
                nb = np.minimum(lb, np.where(linked, na[:, None], top).min(axis=0))
                if first == second:
                    na = nb = np.minimum(na, nb)
                if (na == la).all() and (nb == lb).all():
                    break
                label = np.concatenate([na, nb])
            sides = [(a, linked @ n[b], la)] + ([(b, linked.T @ n[a], lb)] if first != second else [])
            for rows, weights, labels in sides:
                found += [x for x in zip(node[rows].tolist(), key[rows].tolist(), weights.tolist(), labels.tolist()) if x[2]]
        columns = list(zip(*found)) or [(), (), (), ()]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("node", "k1", "links", "label"), columns)})

    return run


def _sets(batches):
    """The sorted distinct shingles of each member."""
    for batch in batches:
        texts, out = utf8(batch["text"]), []
        for lo, hi in slices(texts):
            value, owner, _, _ = shingles(texts[lo:hi])
            cuts = np.searchsorted(owner, np.arange(1, hi - lo))
            out += [np.unique(s).tobytes() for s in np.split(value, cuts)]
        kept = ["root", "blocks", "block", "node", "k1", "n"]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(out, pa.binary())], names=[*kept, "shingles"])


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (``doc_id`` long, ``text``; others ignored).

    Returns ``doc_id``, ``class_id`` (smallest id of the class, a component of the
    links) and ``n_links`` (rows other than itself whose shingle set has at least
    the threshold's Jaccard similarity with its own, copies included).

    Defined cases: a null or empty text, or one of white space only, has no links
    and is a class of its own; so is a row with a null id (its ``class_id`` is
    null); a text of one to four words has one shingle; rows with one id are one
    node, so their classes are merged; repeated rows link to each other; an empty
    table gives an empty result.
    """
    bands, rows = bands_for(threshold, recall, MAX_HASHES)
    light = settle(_signed(docs, bands, rows), "op3-signed")
    n = light.count()
    usable = light.where("words > 0 AND doc_id IS NOT NULL")
    alone = light.where("words = 0 OR doc_id IS NULL").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    # One row per distinct word sequence.
    classes = settle(
        usable.groupBy("k1", "k2").agg(
            F.min(F.struct("doc_id", "text_key")).alias("first"),
            F.count(F.lit(1)).alias("n"),
            F.first("bands").alias("bands"),
        ).select("k1", "k2", F.col("first.doc_id").alias("node"), F.col("first.text_key").alias("text_key"), "n", "bands"),
        "op3-classes", n,
    )
    keyed = classes.select("node", F.explode("bands").alias("band"))
    buckets = settle(
        keyed.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1").select("band", "hub"),
        "op3-buckets", n,
    )
    ties = keyed.join(buckets, "band").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    groups = settle(components(ties, n), "op3-groups", n)
    sizes = settle(
        groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "op3-sizes", n
    )
    members = settle(
        groups.join(sizes, "root")
        .withColumn("block", F.pmod(F.xxhash64(F.lit(SEED), "node"), F.col("blocks")).cast("int"))
        .join(classes.select("node", "text_key", "k1", "n"), "node"),
        "op3-members", n,
    )
    tasks = max(1, math.ceil(members.count() / MEMBERS_PER_TASK))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("own_key"))
    matched = (F.col("doc_id") == F.col("node")) & (F.col("own_key") == F.col("text_key"))
    # One shuffle of the texts at every size, whatever share of them are members.
    sets = members.hint("merge").join(texts, matched).select("root", "blocks", "block", "node", "k1", "n", "text").mapInArrow(
        released(_sets), "root long, blocks int, block int, node long, k1 long, n long, shingles binary"
    )
    work = (
        sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        # Small groups share tasks; a pair of blocks of a large one has its own.
        .withColumn(
            "task",
            F.when(F.col("blocks") == 1, F.struct(F.pmod(F.xxhash64(F.lit(SEED), "root"), F.lit(tasks)).alias("g"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))).otherwise(
                F.struct(F.col("root").alias("g"), F.col("i").alias("i"), F.col("j").alias("j"))
            ),
        )
    )
    verified = settle(
        work.select("task", "root", "block", "node", "k1", "n", "i", "j", "shingles")
        .groupBy("task")
        .applyInArrow(_verified(threshold), "node long, k1 long, links long, label long"),
        "op3-verified",
    )
    linked = components(verified.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")), n)
    counted = verified.groupBy("node", "k1").agg(F.sum("links").alias("links"))
    decided = settle(
        classes.select("node", "k1", "k2", "n")
        .join(counted, ["node", "k1"], "left")
        .join(linked, "node", "left")
        .select("k1", "k2", F.coalesce("root", "node").alias("class_id"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "op3-decided", n,
    )
    return usable.select("doc_id", "k1", "k2").join(decided, ["k1", "k2"]).select("doc_id", "class_id", "n_links").unionByName(alone)


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each class the smallest id.

    Rows without words or without an id stay; of rows with one id one stays, and of
    rows without an id one of each text.
    """
    gone = near_duplicates(docs).where("doc_id <> class_id").select(F.col("doc_id").alias("_op3_id")).distinct()
    kept = docs.join(gone, F.col("doc_id") == F.col("_op3_id"), "left_anti")
    unnamed = F.when(F.col("doc_id").isNull(), F.md5(F.coalesce("text", F.lit(""))))
    return kept.withColumn("_op3_text", unnamed).dropDuplicates(["doc_id", "_op3_text"]).select(*docs.columns)
