"""Operator 13, document fingerprints: SimHash, and all fingerprints within a Hamming radius.

* The terms of a text are its words and its pairs of neighbouring words.  A word's hash
  is its MD5; a pair's is the first word's with the halves of the second's crossed in.
  A term that occurs n times weighs the number of binary digits of n.  Every term adds
  its weight to the BITS sums where its hash has a one and takes it off the others; the
  signs of the sums are the fingerprint.  Weights are integers, so equal texts have equal
  fingerprints in any order of summing.
* Search: the bits are cut into BLOCKS blocks.  Two fingerprints that differ in at most
  RADIUS bits agree in at least BLOCKS - RADIUS whole blocks.  For every choice of that
  many blocks there is a table of all fingerprints, permuted so that the chosen blocks
  lead; those with equal leading blocks meet in it and are compared in full.  A pair
  counts in the first table where it meets, so every pair counts once and none is
  emitted: what leaves a task is each fingerprint's number of neighbours.

Equal fingerprints are one entry with a count, so copies cost nothing.  Entries of a
crowded bucket are dealt over blocks, and each two blocks are one task's work.
"""

from __future__ import annotations

import hashlib
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import released, settle
from tillroll.llm.near_dedup import word_hashes

BITS = 128
RADIUS = 3
BLOCKS = 4
# Bytes of text that one pass looks at; a text of more than LONG_BYTES is read in pieces of that size.
PASS_BYTES = 1 << 17
LONG_BYTES = 1 << 20
# Terms of a long text that are held before equal ones are added up.
LONG_TERMS = 1 << 20
# Words whose MD5 a task keeps.
MEMO_WORDS = 200_000
# Fingerprints of a bucket that are compared at a time.
CROWD = 1024

_WORD = re.compile(rb"[^\x20\x09-\x0d]+")
_BLANK = re.compile(rb"[\x20\x09-\x0d]")


class Terms:
    """Words of a task, with their MD5 as two numbers."""

    def __init__(self, memo_words: int = MEMO_WORDS):
        self.memo_words = memo_words
        self.keys = np.zeros(0, np.uint64)  # hashes of the words kept, sorted
        self.sums = np.zeros((0, 2), np.uint64)

    def md5(self, words: np.ndarray, data: bytes, at: np.ndarray) -> np.ndarray:
        """MD5 halves of words given by distinct sorted hashes and a place of each in ``data``."""
        place = np.minimum(np.searchsorted(self.keys, words), max(0, len(self.keys) - 1))
        known = self.keys[place] == words if len(self.keys) else np.zeros(len(words), bool)
        out = np.empty((len(words), 2), np.uint64)
        out[known] = self.sums[place[known]]
        new = np.flatnonzero(~known)
        digests = [hashlib.md5(_WORD.match(data, p).group()).digest() for p in at[new].tolist()]
        out[new] = np.frombuffer(b"".join(digests), ">u8").reshape(-1, 2)
        if len(new):
            if len(self.keys) + len(new) > self.memo_words:
                self.keys, self.sums = words, out
            else:
                keys = np.concatenate([self.keys, words[new]])
                order = np.argsort(keys)
                self.keys, self.sums = keys[order], np.concatenate([self.sums, out[new]])[order]
        return out


def _starts(data: bytes) -> np.ndarray:
    """Where the words of ``data`` begin."""
    raw = np.frombuffer(data, np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    return np.flatnonzero(~blank & np.append(True, blank[:-1])) if len(raw) else np.zeros(0, np.int64)


def _votes(owner: np.ndarray, sums: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The BITS weighted sums of each of ``n`` texts; ``owner`` is sorted.

    Every bit is a byte of its own, eight of them in a number; up to 255 terms are added
    before a byte could overflow.
    """
    out = np.zeros((n, BITS), np.int64)
    for low in range(0, len(owner), 1 << 14):
        w = weight[low : low + (1 << 14)]
        own, part = np.repeat(owner[low : low + (1 << 14)], w), np.repeat(sums[low : low + (1 << 14)], w, axis=0)
        lanes = np.unpackbits(part.astype(">u8").view(np.uint8), axis=1).view(np.uint64)
        starts = np.flatnonzero(np.append(True, np.diff(own) != 0))
        sizes = np.diff(np.append(starts, len(own)))
        parts = -(-sizes // 255)
        cuts = np.repeat(starts, parts) + 255 * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        ones = np.add.reduceat(lanes, cuts, axis=0).view(np.uint8).astype(np.int64)
        if len(ones) > len(starts):
            ones = np.add.reduceat(ones, np.cumsum(parts) - parts, axis=0)
        out[own[starts]] += 2 * ones - sizes[:, None]
    return out


def _weights(times: np.ndarray) -> np.ndarray:
    """The number of binary digits of how often a term occurs."""
    return np.frexp(times.astype(np.float64))[1]


def simhash(texts: list[bytes], terms: Terms) -> list[str]:
    """The fingerprint of each text, as hexadecimal digits."""
    data = b"\n".join(texts) + b"\n"
    words, text = word_hashes(texts)
    distinct, at, back = np.unique(words, return_index=True, return_inverse=True)
    sums = terms.md5(distinct, data, _starts(data)[at])
    votes = np.zeros((len(texts), BITS), np.int64)
    n = len(distinct)
    if not n:
        return [row.tobytes().hex() for row in np.packbits(votes > 0, axis=1)]
    # PASS_BYTES bound the numbers of texts and words: three of them fit one integer.
    found, times = np.unique(text * n + back, return_counts=True)
    votes += _votes(found // n, sums[found % n], _weights(times), len(texts))
    pair = np.flatnonzero(text[:-1] == text[1:])
    if len(pair):
        found, times = np.unique((text[pair] * n + back[pair]) * n + back[pair + 1], return_counts=True)
        rest, right = np.divmod(found, n)
        owner, left = np.divmod(rest, n)
        votes += _votes(owner, sums[left] ^ sums[right][:, ::-1], _weights(times), len(texts))
    return [row.tobytes().hex() for row in np.packbits(votes > 0, axis=1)]


def likeness(a: str, b: str) -> float:
    """The share of bits in which two fingerprints agree."""
    return 1.0 - (int(a, 16) ^ int(b, 16)).bit_count() / BITS


def edited(text: str, other: str) -> str:
    """A text whose last half (rounded down) is replaced by the first as many characters of another."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _pieces(data: bytes):
    """A long text in pieces of about LONG_BYTES that end between words."""
    low = 0
    while low < len(data):
        found = _BLANK.search(data, low + LONG_BYTES)
        high = found.start() if found else len(data)
        yield data[low:high]
        low = high


def long_simhash(data: bytes) -> str:
    """The fingerprint of one text, with memory for its distinct terms only."""
    held: list[list] = [[], []]  # words, pairs: arrays of (high half, low half, times)
    last = np.zeros((0, 2), np.uint64)

    def added(parts: list) -> np.ndarray:
        high, low, times = np.concatenate(parts).T
        order = np.lexsort((low, high))
        fresh = np.flatnonzero(np.append(True, (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)))
        return np.stack([high[order][fresh], low[order][fresh], np.add.reduceat(times[order], fresh)], axis=1)

    for piece in _pieces(data):
        digests = b"".join([hashlib.md5(w).digest() for w in _WORD.findall(piece)])
        words = np.frombuffer(digests, ">u8").reshape(-1, 2).astype(np.uint64)
        line = np.concatenate([last, words])
        for parts, new in zip(held, (words, line[:-1] ^ line[1:, ::-1])):
            if not len(new):
                continue
            parts.append(np.concatenate([new, np.ones((len(new), 1), np.uint64)], axis=1))
            if sum(map(len, parts[1:])) > max(LONG_TERMS, len(parts[0])):
                parts[:] = [added(parts)]
        last = line[-1:]
    votes = np.zeros((1, BITS), np.int64)
    for parts in held:
        if parts:
            terms = added(parts)
            votes += _votes(np.zeros(len(terms), np.int64), terms[:, :2], _weights(terms[:, 2]), 1)
    return np.packbits(votes > 0).tobytes().hex()


def _hashed(texts: list[str], terms: Terms) -> list[str]:
    """Fingerprints of texts, about PASS_BYTES at a time."""
    out: list[str] = []
    own: list[bytes] = []
    for text in texts:
        data = text.encode()
        if own and sum(map(len, own)) + len(data) > PASS_BYTES:
            out += simhash(own, terms)
            own = []
        if len(data) > LONG_BYTES:
            out.append(long_simhash(data))
        else:
            own.append(data)
    return out + simhash(own, terms) if own else out


def _passes(sizes: list[int], limit: int):
    """Ranges of rows whose sizes add up to about ``limit``."""
    low = size = 0
    for i, n in enumerate(sizes):
        if i > low and size + n > limit:
            yield low, i
            low, size = i, 0
        size += n
    if low < len(sizes):
        yield low, len(sizes)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars`` (code points) and ``fingerprint`` of every row of ``docs``.

    Defined cases: a null text is empty; a text without words has the fingerprint zero;
    repeated rows and null ids are rows like others; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        terms = Terms()
        for batch in batches:
            for low, high in _passes(batch["size"].to_pylist(), 8 * PASS_BYTES):
                texts = [t or "" for t in batch["text"].slice(low, high - low).to_pylist()]
                made = [pa.array([len(t) for t in texts], pa.int64()), pa.array(_hashed(texts, terms), pa.string())]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(low, high - low), *made], names=["doc_id", "n_chars", "fingerprint"])

    size = F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")
    return docs.select("doc_id", "text", size).mapInArrow(released(run), f"doc_id {kind}, n_chars long, fingerprint string")


# -- each text beside the next one ------------------------------------------------

_PAIRED = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"


def _paired(texts: list[str], terms: Terms) -> list[list]:
    """The columns of _PAIRED of every text but the last, beside the text after it."""
    own, made = texts[:-1], [edited(a, b) for a, b in zip(texts, texts[1:])]
    marks, edits = _hashed(texts, terms), _hashed(made, terms)
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in made]
    return [[len(t) for t in own], digests, marks[:-1], edits, marks[1:]]


def beside_next(docs: DataFrame) -> DataFrame:
    """Every text's fingerprint, that of its edited text, and that of the next document.

    The edited text has the last half of the text (rounded down) replaced by the first
    as many characters of the next document.  Returns ``doc_id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next`` (shares of agreeing bits).

    The next document is that with the next greater id; rows without an id come first,
    rows of one id follow each other by their texts' hash; after the last row comes the
    first, which for a single row is itself.  The other defined cases are those of
    ``fingerprints``.

    Rows are range-partitioned once and streamed in order.  Only the first and the last
    row of each partition meet those of its neighbours in a second, small step.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {_PAIRED}, part int, head boolean, text string"
    names = [c.strip().split()[0] for c in schema.split(",")]
    types = [pa.int64(), *[pa.string()] * 4]

    def run(batches):
        terms, part, last = Terms(), TaskContext.get().partitionId(), None

        def edge(key, text: str, head: bool) -> pa.RecordBatch:
            void = [pa.nulls(1, t) for t in types]
            return pa.RecordBatch.from_arrays([key, *void, pa.array([part], pa.int32()), pa.array([head]), pa.array([text])], names=names)

        for batch in batches:
            for low, high in _passes(batch["size"].to_pylist(), 8 * PASS_BYTES):
                texts = [t or "" for t in batch["text"].slice(low, high - low).to_pylist()]
                keys = batch["doc_id"].slice(low, high - low)
                if last is None:
                    yield edge(keys.slice(0, 1), texts[0], True)
                else:
                    texts, keys = [last[1], *texts], pa.concat_arrays([last[0], keys])
                if len(texts) > 1:
                    n = len(texts) - 1
                    made = [pa.array(c, t) for c, t in zip(_paired(texts, terms), types)]
                    yield pa.RecordBatch.from_arrays([keys.slice(0, n), *made, pa.nulls(n, pa.int32()), pa.nulls(n, pa.bool_()), pa.nulls(n, pa.string())], names=names)
                last = keys.slice(len(keys) - 1, 1), texts[-1]
        if last is not None:
            yield edge(*last, False)

    def stitch(batches):
        terms = Terms()
        for batch in batches:
            for i, (text, other) in enumerate(zip(batch["text"].to_pylist(), batch["other"].to_pylist())):
                made = [pa.array(c, t) for c, t in zip(_paired([text, other], terms), types)]
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, 1), *made], names=names[: 1 + len(types)])

    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"), F.xxhash64("text").alias("order"))
    ordered = rows.repartitionByRange("doc_id", "order").sortWithinPartitions("doc_id", "order", "text").select("doc_id", "text", "size")
    done = settle(ordered.mapInArrow(released(run), schema), "op13-paired")
    heads = done.where("head").select(F.col("part").alias("head_part"), F.col("text").alias("other"))
    # Each partition's number and the next one's: as many rows as there are partitions.
    numbers = heads.select(F.col("head_part").alias("part"))
    after = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    tails = done.where("NOT head").select("doc_id", "part", "text").join(numbers.withColumn("head_part", after), "part").join(heads, "head_part")
    edges = tails.select("doc_id", "text", "other").mapInArrow(released(stitch), f"doc_id {kind}, {_PAIRED}")
    both = done.where("part IS NULL").drop("part", "head", "text").unionByName(edges)
    near = lambda other: (F.lit(1.0) - _differing("fingerprint", other) / BITS)
    return both.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        near("edited_fingerprint").alias("near_edited"), near("next_fingerprint").alias("near_next"),
    )


def _half(mark, k: int):
    """One half of a fingerprint as a number."""
    return F.conv(F.substring(mark, 1 + 16 * k, 16), 16, -10).cast("long")


def _differing(a: str, b: str):
    """In how many bits two fingerprints differ."""
    return sum(F.bit_count(_half(a, k).bitwiseXOR(_half(b, k))) for k in range(BITS // 64))


# -- search within a Hamming radius -------------------------------------------------


def choices(radius: int, blocks: int) -> list[tuple[int, ...]]:
    """The tables: which blocks lead in each."""
    if not 0 <= radius < blocks or BITS % blocks:
        raise ValueError("the radius must be below the number of blocks, which must divide the bits")
    return list(combinations(range(blocks), blocks - radius))


def _compared(left: np.ndarray, right: np.ndarray, radius: int, earlier: list[tuple[int, ...]], blocks: int) -> np.ndarray:
    """Which pairs are within the radius and meet in none of the earlier tables."""
    differ = [left[:, None, k] ^ right[None, :, k] for k in range(left.shape[1])]
    near = sum(np.bitwise_count(d).astype(np.int32) for d in differ) <= radius
    rows, columns = np.nonzero(near)
    if len(rows) and earlier:
        found = np.stack([d[rows, columns] for d in differ], axis=1).astype(">u8")
        bits = np.unpackbits(found.view(np.uint8), axis=1).reshape(len(rows), blocks, -1)
        same = ~bits.any(axis=2)
        for chosen in earlier:
            near[rows, columns] &= ~same[:, list(chosen)].all(axis=1)
    return near


def neighbours(marks: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, crowd: int = CROWD) -> DataFrame:
    """``fingerprint`` and ``n_near`` for every fingerprint of ``marks``.

    ``n_near`` is the number of rows of ``marks`` within ``radius`` bits, other rows of
    the same fingerprint included, the row itself not.  Every pair within the radius is
    found, whatever the size of its buckets.  Null fingerprints are left out.
    """
    tables = choices(radius, blocks)
    wide = BITS // blocks // 4  # hexadecimal digits of a block
    if wide * blocks * 4 != BITS:
        raise ValueError("a block must be whole hexadecimal digits")
    one = settle(marks.where("fingerprint IS NOT NULL").groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")), "op13-marks")
    own = [F.substring("fingerprint", 1 + wide * k, wide) for k in range(blocks)]
    leads = F.array(*[F.struct(F.lit(t).alias("table"), F.concat(*[own[k] for k in chosen]).alias("lead")) for t, chosen in enumerate(tables)])
    keyed = one.select("fingerprint", "n", F.explode(leads).alias("at")).select("fingerprint", "n", "at.table", "at.lead")
    buckets = settle(keyed.groupBy("table", "lead").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "op13-buckets")

    def compare(table: pa.Table) -> pa.Table:
        marks, first, second = table["fingerprint"].to_pylist(), table["i"][0].as_py(), table["j"][0].as_py()
        n, part = np.asarray(table["n"]), np.asarray(table["part"])
        number, key = np.asarray(table["table"]), np.asarray(table["lead"]).astype(str)
        bits = np.frombuffer(bytes.fromhex("".join(marks)), ">u8").astype(np.uint64).reshape(len(marks), -1)
        found = np.zeros(len(marks), np.int64)
        order = np.lexsort((key, number))
        fresh = (np.diff(number[order]) != 0) | (key[order][1:] != key[order][:-1])
        for rows in np.split(order, np.flatnonzero(fresh) + 1):
            a = rows[part[rows] == first] if first != second else rows
            b = rows[part[rows] == second] if first != second else rows
            if not len(a) or not len(b):
                continue
            earlier = tables[: number[rows[0]]]
            for low in range(0, len(a), 256):
                own = a[low : low + 256]
                near = _compared(bits[own], bits[b], radius, earlier, blocks)
                if first == second:
                    near &= own[:, None] != b[None, :]
                found[own] += near @ n[b]
                if first != second:
                    found[b] += near.T @ n[own]
        hit = np.flatnonzero(found)
        return pa.table({"fingerprint": pa.array([marks[i] for i in hit], pa.string()), "near": pa.array(found[hit])})

    # Small buckets share tasks; each two parts of a crowded one are a task of their own.
    tasks = max(1, -(-(buckets.agg(F.sum("members")).first()[0] or 0) // (16 * crowd)))
    parts = F.ceil(F.col("members") / crowd).cast("int")
    met = (
        keyed.join(buckets, ["table", "lead"])
        .withColumns({"parts": parts, "part": F.pmod(F.xxhash64(F.lit(13), "fingerprint"), parts).cast("int")})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
        .withColumn("shared", F.when(F.col("parts") == 1, F.pmod(F.xxhash64(F.lit(31), "table", "lead"), F.lit(tasks))))
        .withColumn("crowded", F.when(F.col("parts") > 1, F.struct("table", "lead", "i", "j")))
    )
    near = met.groupBy("shared", "crowded").applyInArrow(compare, "fingerprint string, near long")
    summed = near.groupBy("fingerprint").agg(F.sum("near").alias("near"))
    counted = one.join(summed, "fingerprint", "left").select("fingerprint", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_near"))
    return settle(counted, "op13-near")  # so that a join with it can be split at a hot fingerprint
