"""Operator 7, language ID: prediction by partial matching over bytes.

Each language has a byte context tree of order ORDER: for every context of up to
ORDER bytes, how often each byte followed it.  A byte's code length comes from
its longest context; a byte that the context never saw costs an escape there and
is coded one order lower, down to a uniform code over 256 bytes (method C: the
escape weighs as much as the number of distinct bytes seen).  The statistics are
frozen after training, so a byte's code length depends on its ORDER + 1 last
bytes only.  That makes it a table: the code lengths of every (ORDER + 1)-gram of
the training texts are computed once, those of other grams when met, by the same
recursion.  The language with the shortest code for the whole text wins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import give_back, released, slices, utf8, windows

ORDER = 4
# A language of at most this many bytes is learned whole.  Of any other, about this
# many bytes are drawn: windows of its documents at hashed places.
TRAIN_BYTES = 1_000_000
WINDOW = 1024
PART = 3
HELD_OUT = 1
SEED = 7
# Bytes of a long text that are coded in one pass.
PIECE_BYTES = 1 << 20
# Rows of an Arrow batch whose texts are held as Python bytes at one time.
ROWS = 512

_PAD = b"\n" * ORDER
_TABLE_BITS = 22
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % PART == HELD_OUT, F.lit(False))


def _led(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The (ORDER + 1)-gram that ends at each byte of each text, and the texts' starts.

    Every text has at least one byte and brings the ORDER bytes before it (at its
    own start new lines).
    """
    data = np.frombuffer(b"".join(texts) + b"\0" * 8, np.uint8)
    sizes = np.array([len(t) - ORDER for t in texts])
    starts = np.cumsum(sizes) - sizes
    grams = windows(data, ORDER + 1, len(data) - 8)
    inside = np.repeat(np.arange(len(texts)) * ORDER, sizes) + np.arange(sizes.sum())
    return grams[inside], starts


class ContextTrees:
    """Frozen counts of all languages, as sorted arrays per order."""

    def __init__(self, langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        self.orders = []  # by language, order 0..ORDER: grams, their counts, contexts, totals, distinct
        for grams, n in counts:
            own = []
            for k in range(ORDER + 1):
                last = grams & np.uint64((1 << 8 * (k + 1)) - 1)
                g, back = np.unique(last, return_inverse=True)
                c = np.bincount(back, n, len(g))
                contexts, back = np.unique(g >> np.uint64(8), return_inverse=True)
                own.append((g, c, contexts, np.bincount(back, c, len(contexts)), np.bincount(back, minlength=len(contexts))))
            self.orders.append(own)
        self.known = np.unique(np.concatenate([g for g, _ in counts])) if counts else np.zeros(0, np.uint64)
        self.bits = self.code_lengths(self.known).astype(np.float32)

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each gram after the bytes before it, by language."""
        out = np.zeros((len(grams), len(self.langs)))
        for lang, own in enumerate(self.orders):
            left = np.arange(len(grams))
            for k in range(ORDER, -1, -1):
                g, c, contexts, totals, distinct = own[k]
                last = grams[left] & np.uint64((1 << 8 * (k + 1)) - 1)
                context = last >> np.uint64(8)
                at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
                seen = contexts[at] == context
                room = np.where(seen, totals[at] + distinct[at], 1.0)
                here = np.minimum(np.searchsorted(g, last), len(g) - 1)
                coded = g[here] == last
                out[left, lang] += np.where(coded, np.log2(room) - np.log2(c[here]), np.where(seen, np.log2(room) - np.log2(np.maximum(distinct[at], 1)), 0.0))
                left = left[~coded]
            out[left, lang] += 8.0
        return out

    def table(self) -> np.ndarray:
        """Hash slot -> row of ``known`` (the last one with that hash)."""
        rows = np.zeros(1 << _TABLE_BITS, np.int32)
        rows[(self.known * _MULTIPLIER) >> np.uint64(64 - _TABLE_BITS)] = np.arange(len(self.known))
        return rows

    def totals(self, texts: list[bytes], table: np.ndarray) -> np.ndarray:
        """Code length of each whole text (of at least one byte), by language.

        A long text is coded in pieces, each led by the ORDER bytes before it.
        """
        if len(texts) == 1 and len(texts[0]) > PIECE_BYTES:
            whole = _PAD + texts[0]
            parts = [whole[k : k + PIECE_BYTES + ORDER] for k in range(0, len(texts[0]), PIECE_BYTES)]
            return sum(self._coded([part], table) for part in parts)
        return self._coded([_PAD + t for t in texts], table)

    def _coded(self, texts: list[bytes], table: np.ndarray) -> np.ndarray:
        grams, starts = _led(texts)
        rows = table[(grams * _MULTIPLIER) >> np.uint64(64 - _TABLE_BITS)]
        bits = self.bits[rows]
        other = np.flatnonzero(self.known[rows] != grams)
        if len(other):
            new, back = np.unique(grams[other], return_inverse=True)
            bits[other] = self.code_lengths(new).astype(np.float32)[back]
        return np.add.reduceat(bits, starts, axis=0, dtype=np.float64)


def _windows(text: bytes, share: float, start: float) -> list[bytes]:
    """The windows of a text that are learned, each led by the ORDER bytes before it.

    Window k is taken if a whole number lies in (start + (k-1) share, start + k share]:
    with probability ``share`` over all starts, evenly over the text.
    """
    whole = _PAD + text
    if share >= 1.0:
        return [whole]
    n = -(-len(text) // WINDOW)
    at = np.ceil((np.arange(int(start + n * share) + 2) - start) / share).astype(np.int64)
    return [whole[k * WINDOW : (k + 1) * WINDOW + ORDER] for k in at[(at >= 0) & (at < n)].tolist()]


def _count(batches):
    for batch in batches:
        lang = np.asarray(batch["lang"])
        drawn = [_windows(t, p, s) for t, p, s in zip(utf8(batch["text"]), batch["share"].to_pylist(), batch["start"].to_pylist())]
        for k in np.unique(lang):
            own = [w for found, l in zip(drawn, lang) if l == k for w in found]
            for lo, hi in slices(own, 1 << 22):
                g, n = np.unique(_led(own[lo:hi])[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(g), k, np.int32)), pa.array(g.astype(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )


def _counted(rows: DataFrame) -> pd.DataFrame:
    """Gram counts by language of the drawn windows of (lang, text, share, start)."""
    grams = rows.mapInArrow(released(_count), "lang int, gram long, n long")
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()


def train(docs: DataFrame, train_bytes: int = TRAIN_BYTES) -> ContextTrees:
    """Context trees of every ``lang`` of ``docs`` outside the held-out part.

    What reaches the driver is bounded by ``train_bytes`` for each language, however
    long its documents are.  No language is left out: if no window of one is drawn,
    its first document in hash order is learned, up to that many characters.
    """
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & (F.octet_length("text") > 0)).select(
        "doc_id", "lang", "text"
    )
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text").cast("long")).alias("bytes")).collect()
    langs = sorted(r["lang"] for r in sizes)
    if not langs:
        return ContextTrees([], [])
    share = {r["lang"]: min(1.0, train_bytes / r["bytes"]) for r in sizes}
    start = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", F.xxhash64("text")), F.lit(1 << 30)) / float(1 << 30)
    number = F.create_map(*[F.lit(x) for i, k in enumerate(langs) for x in (k, i)])[F.col("lang")]
    rows = rows.select(
        number.cast("int").alias("lang"),
        "text",
        F.create_map(*[F.lit(x) for k in langs for x in (k, share[k])])[F.col("lang")].alias("share"),
        start.alias("start"),
    )
    last = F.col("start") + (F.ceil(F.octet_length("text") / WINDOW) - 1) * F.col("share")
    some = F.floor(last) > F.floor(F.col("start") - F.col("share"))  # a window of it is drawn
    counted = _counted(rows.where((F.col("share") >= 1) | some))
    missing = sorted(set(range(len(langs))) - set(counted["lang"]))
    if missing:
        text = F.min_by(F.substring("text", 1, train_bytes), F.struct("start", "text"))
        first = rows.where(F.col("lang").isin(missing)).groupBy("lang").agg(text.alias("text"))
        counted = pd.concat([counted, _counted(first.select("lang", "text", F.lit(1.0).alias("share"), F.lit(0.0).alias("start")))])
    counted = counted.sort_values(["lang", "gram"])
    present = sorted(counted["lang"].unique())
    counts = [
        (own["gram"].to_numpy().astype(np.uint64), own["n"].to_numpy(np.float64))
        for own in (counted[counted["lang"] == k] for k in present)
    ]
    trees = ContextTrees([langs[k] for k in present], counts)
    del counted, counts
    give_back()
    return trees


def _annotated(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """``docs`` with ``_op7_lang`` and ``_op7_score`` added."""
    names = np.array([*trees.langs, "und"], dtype=object)
    columns = docs.columns

    def run(batches):
        table = trees.table()
        for batch in batches:
            n = batch.num_rows
            best, score = np.full(n, len(names) - 1), np.zeros(n)
            for first in range(0, n, ROWS):
                lettered = batch["_op7_letter"].slice(first, ROWS).to_pylist()
                rows = [i for i, known in enumerate(lettered) if known and trees.langs]
                own = utf8(batch["text"].slice(first, ROWS).take(pa.array(rows, pa.int32())))
                for lo, hi in slices(own):
                    bits = trees.totals(own[lo:hi], table)
                    at = [first + i for i in rows[lo:hi]]
                    best[at] = bits.argmin(axis=1)
                    score[at] = 1.0 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0)).sum(axis=1)
            kept = [batch[c] for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names[best], pa.string()), pa.array(score)], names=[*columns, "_op7_lang", "_op7_score"]
            )

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    schema = T.StructType([*docs.schema.fields, T.StructField("_op7_lang", T.StringType()), T.StructField("_op7_score", T.DoubleType())])
    return docs.withColumn("_op7_letter", letter).mapInArrow(released(run), schema)


def predict(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` for every row of ``docs``.

    ``score`` is the winner's share when languages weigh 2^-bits.  Defined cases:
    null text or text without a letter, or no learned language at all: ``und``
    and 0; ties: the language that comes first in the alphabet; repeated rows,
    null ids: rows like others; an empty table gives an empty result.
    """
    rows = _annotated(docs.select("doc_id", "text"), trees)
    return rows.select("doc_id", F.col("_op7_lang").alias("lang_pred"), F.col("_op7_score").alias("score"))


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a predicted language, all columns; ``und`` goes.

    Defined cases: rows without a letter (null, empty or blank texts among them) go, and
    all rows if no language can be learned; repeated rows and null ids are rows like
    others; an empty table gives an empty result.
    """
    return _annotated(docs, train(docs)).where(F.col("_op7_lang") != "und").select(*docs.columns)
