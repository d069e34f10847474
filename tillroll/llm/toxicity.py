"""Operator 5, toxicity: a linear classifier over character n-grams.

Features are the distinct lower-cased character 4- and 5-grams of a text, by a 64-bit
hash of their characters.  Learned are all features that at least MIN_TEXTS of the training
rows hold and whose chi-square against the label is significant, however many these are.
Each gets its naive Bayes log-count ratio; presence times ratio enters a ridge logistic
regression over them.  Scoring reads every character of every text.

The regression is fitted by L-BFGS: the features of the training rows are a table, and
each step's loss and gradient are partial sums over its partitions.

A long text is scored window by window, so that its length alone brings no
features together.  Its odds are the mean of its windows' odds: the passage that
makes a text toxic may be any one of them.  In training a feature counts by the
share of the text's windows that hold it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import released, settle

SIZES = (4, 5)
# A longer text is scored as windows of about this many characters, each half over the last.
WINDOW = 4096
# Labelled rows to learn from: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
# Training rows that must hold a feature, and its least chi-square against the label
# (one degree of freedom: by chance one feature in a million reaches it).
MIN_TEXTS = 3
SIGNIFICANT = 24.0
RIDGE = 1.0
STEPS = 40
# Steps of the optimiser whose curvature is remembered.
MEMORY = 8
THRESHOLD = 0.3
PART = 4
HELD_OUT = 2
SEED = 5

# Characters of text in one pass; features a training task holds at about a time.
PASS_CHARS = 1 << 17
FEATURES_PER_TASK = 20_000_000
_WIDTH = max(SIZES)
_BASE, _MIX = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % PART == HELD_OUT, F.lit(False))


def _passes(texts: list[str]):
    """Ranges of texts of about PASS_CHARS characters."""
    low = size = 0
    for i, text in enumerate(texts):
        if i > low and size + len(text) > PASS_CHARS:
            yield low, i
            low, size = i, 0
        size += len(text)
    if low < len(texts):
        yield low, len(texts)


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each n-gram size, the hash of the n-gram at every start; the starts' texts and places.

    A text begins with a blank and ends in blanks, so its first and last words have
    features like the others; starts are that blank and all characters.
    """
    lowered = [f" {t.lower()}" for t in texts]
    sizes = np.array([len(t) for t in lowered])
    chars = np.frombuffer((" " * (_WIDTH - 1)).join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    text = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.arange(len(text)) + (_WIDTH - 1) * text
    out, h = [], np.zeros(len(at), np.uint64)
    for n in range(_WIDTH):
        h = h * _BASE + chars[at + n] + np.uint64(1)
        if n + 1 in SIZES:
            mixed = (h ^ (h >> np.uint64(29))) * _MIX
            out.append((mixed ^ (mixed >> np.uint64(32))).view(np.int64))
    return out, text, place


class Grams:
    """Finds some n-grams, given as sorted hashes, in the windows of texts."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.bits = max(10, int(4 * len(known)).bit_length())
        slot = self._slot(known)
        self.first = np.full(1 << self.bits, -1, np.int32)
        self.first[slot[::-1]] = np.arange(len(known), dtype=np.int32)[::-1]
        # Grams whose slot another one has are sought among these.
        self.rest = np.flatnonzero(self.first[slot] != np.arange(len(known)))
        self.shared = np.zeros(1 << self.bits, bool)
        self.shared[slot[self.rest]] = True

    def _slot(self, found: np.ndarray) -> np.ndarray:
        return (found.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)

    def places(self, found: np.ndarray) -> np.ndarray:
        """Each gram's place among the known ones, or -1."""
        if not len(self.known):
            return np.full(len(found), -1, np.int32)
        slot = self._slot(found)
        out = self.first[slot]
        out[self.known[out] != found] = -1
        lost = np.flatnonzero((out < 0) & self.shared[slot])
        if len(lost):
            rest = self.known[self.rest]
            at = np.minimum(np.searchsorted(rest, found[lost]), len(rest) - 1)
            out[lost] = np.where(rest[at] == found[lost], self.rest[at], -1)
        return out

    def windows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How many windows each text has; then, for every window (counted through)
        and known gram in it, the window and the gram's place."""
        found, text, start = grams(texts)
        sizes = np.bincount(text, minlength=len(texts))
        halves = np.maximum(2, -(-2 * sizes // WINDOW))
        firsts = np.cumsum(halves - 1) - (halves - 1)
        n, out = max(1, len(self.known)), []
        half = start * halves[text] // sizes[text]
        low = firsts[text] + np.maximum(half - 1, 0)
        high = firsts[text] + np.minimum(half, halves[text] - 2)
        twice = low != high
        for gram in found:
            place = self.places(gram)
            out.append(low[place >= 0] * n + place[place >= 0])
            both = twice & (place >= 0)
            out.append(high[both] * n + place[both])
        out = np.unique(np.concatenate(out))  # a gram counts once in a window
        return halves - 1, out // n, out % n


class Model:
    def __init__(self, known: np.ndarray, weights: np.ndarray, bias: float):
        self.grams, self.weights, self.bias = Grams(known), weights, bias

    def scores(self, texts: list[str]) -> np.ndarray:
        logit = np.full(len(texts), self.bias)
        if len(self.weights) and len(texts):
            parts, window, place = self.grams.windows(texts)
            evidence = np.bincount(window, self.weights[place], parts.sum())
            first = np.cumsum(parts) - parts
            most = np.maximum.reduceat(evidence, first)
            logit += most + np.log(np.add.reduceat(np.exp(evidence - np.repeat(most, parts)), first) / parts)
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500)))


def loss_and_gradient(row: np.ndarray, place: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Logistic loss of rows given as (row, place, value), and its gradient; the last weight is the bias."""
    z = np.bincount(row, x * w[place], len(y)) + w[-1]
    loss = float(np.sum(np.logaddexp(0, z) - y * z))
    off = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
    gradient = np.bincount(place, x * off[row], len(w))
    gradient[-1] = off.sum()
    return loss, gradient


def minimise(value, w: np.ndarray, steps: int, tolerance: float = 1e-4) -> np.ndarray:
    """L-BFGS with backtracking; ``value`` gives loss and gradient."""
    loss, g = value(w)
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    scale = max(1.0, float(np.abs(g).max()))
    for _ in range(steps):
        if np.abs(g).max() <= tolerance * scale:
            break
        d, alphas = g.copy(), []
        for s, q in reversed(kept):
            alphas.append(float(s @ d) / float(s @ q))
            d -= alphas[-1] * q
        d *= float(kept[-1][0] @ kept[-1][1]) / float(kept[-1][1] @ kept[-1][1]) if kept else 1 / np.linalg.norm(g)
        for (s, q), a in zip(kept, reversed(alphas)):
            d += (a - float(q @ d) / float(s @ q)) * s
        rate = 1.0
        while True:
            new_loss, new_g = value(w - rate * d)
            if new_loss <= loss - 1e-4 * rate * float(g @ d) or rate < 1e-4:
                break
            rate /= 4
        s, q = -rate * d, new_g - g
        if float(s @ q) > 1e-12:
            kept = [*kept, (s, q)][-MEMORY:]
        w, loss, g = w + s, new_loss, new_g
    return w


def _counts(found, clean, toxic) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, np.int64)) for x in (found, clean, toxic)], names=["gram", "clean", "toxic"])


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, min_texts: int = MIN_TEXTS, significant: float = SIGNIFICANT
) -> Model:
    """Learn from at most ``sample_rows`` labelled documents outside the held-out part.

    A document labelled more than once is toxic if any of its labels says so; of the
    rows of one id one is learned.  The driver holds the features (at most those that
    the sample brings), one number each, and the sums over the rows; the rows stay in
    a table.
    """
    sample = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # At most sample_rows rows of two numbers: safe to broadcast at any input size.
    rows = settle(
        docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
        .groupBy("doc_id").agg(F.first("toxic").alias("toxic"), F.min(F.coalesce("text", F.lit(""))).alias("text")),
        "op5-rows",
    )

    def count(batches):
        for batch in batches:
            texts, y = batch["text"].to_pylist(), np.asarray(batch["toxic"])
            for low, high in _passes(texts):
                found, text, _ = grams(texts[low:high])
                cuts = np.searchsorted(text, np.arange(high - low + 1))
                own = [np.unique(np.concatenate([f[a:b] for f in found])) for a, b in zip(cuts, cuts[1:])]
                kind = np.repeat(y[low:high], [len(g) for g in own])
                distinct, back = np.unique(np.concatenate(own), return_inverse=True)
                yield _counts(distinct, np.bincount(back, kind == 0, len(distinct)), np.bincount(back, kind == 1, len(distinct)))

    n_clean, n_toxic = (int(x or 0) for x in rows.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first())
    if not n_clean or not n_toxic:  # one label or none: that label, or 0
        return Model(np.zeros(0, np.int64), np.zeros(0), 500.0 if n_toxic else -500.0)
    counted = settle(
        rows.mapInArrow(released(count), "gram long, clean long, toxic long")
        .groupBy("gram")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= min_texts),
        "op5-grams",
    )
    n = float(n_clean + n_toxic)
    present = (F.col("clean") + F.col("toxic")).cast("double")
    gap = F.col("toxic") * float(n_clean) - F.col("clean") * float(n_toxic)
    chi = n * gap * gap / F.greatest(F.lit(1e-9), present * (n - present) * float(n_clean) * float(n_toxic))
    chosen = counted.where(chi >= significant).toPandas().sort_values("gram")
    known, a, b = (chosen[c].to_numpy(np.int64) for c in ("gram", "toxic", "clean"))
    ratio = np.log((a + 1.0) / (a.sum() + len(a))) - np.log((b + 1.0) / (b.sum() + len(b)))

    def shares(batches):
        finder = Grams(known)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for low, high in _passes(texts):
                parts, window, place = finder.windows(texts[low:high])
                n = max(1, len(known))
                text = np.repeat(np.arange(high - low), parts)[window]
                cell, held = np.unique(text * n + place, return_counts=True)
                text, place = cell // n, cell % n
                share = (held / parts[text]).astype(np.float32)
                cuts = np.searchsorted(text, np.arange(high - low + 1))
                packed = [[v[i:j].tobytes() for i, j in zip(cuts, cuts[1:])] for v in (place.astype(np.int32), share)]
                yield pa.RecordBatch.from_arrays(
                    [batch["toxic"].slice(low, high - low), *(pa.array(p, pa.binary()) for p in packed)], names=["toxic", "places", "shares"]
                )

    features = settle(rows.mapInArrow(released(shares), "toxic int, places binary, shares binary"), "op5-features")
    tasks = max(1, math.ceil((a.sum() + b.sum()) / FEATURES_PER_TASK))
    features = features.coalesce(tasks)  # a bounded sample: few tasks for each of many steps

    def value(w: np.ndarray) -> tuple[float, np.ndarray]:
        scaled = np.append(w[:-1] * ratio, w[-1])

        def partial(batches):
            loss, gradient = 0.0, np.zeros(len(w))
            for batch in batches:
                for low in range(0, batch.num_rows, 512):
                    part = batch.slice(low, 512)
                    places, x = (part[c].to_pylist() for c in ("places", "shares"))
                    row = np.repeat(np.arange(len(places)), [len(p) // 4 for p in places])
                    one, own = loss_and_gradient(
                        row, np.frombuffer(b"".join(places), np.int32), np.frombuffer(b"".join(x), np.float32),
                        np.asarray(part["toxic"], np.float64), scaled,
                    )
                    loss += one
                    gradient += own
            yield pa.RecordBatch.from_arrays([pa.array([loss]), pa.array([gradient.tobytes()], pa.binary())], names=["loss", "gradient"])

        sums = sorted((r.loss, bytes(r.gradient)) for r in features.mapInArrow(released(partial), "loss double, gradient binary").collect())
        gradient = sum(np.frombuffer(g) for _, g in sums)
        gradient = np.append(gradient[:-1] * ratio, gradient[-1])
        kept = np.append(w[:-1], 1e-3 * w[-1])
        return sum(x for x, _ in sums) + RIDGE / 2 * float(w @ kept), gradient + RIDGE * kept

    w = minimise(value, np.append(np.zeros(len(known)), math.log(n_toxic / n_clean)), STEPS)
    return Model(known, w[:-1] * ratio, float(w[-1]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` for every row of ``docs``.

    Defined cases: a null text scores like an empty one, near the model's base
    rate; without training rows every score is 0, with one label only it is that
    label; repeated rows and null ids are rows like others; an empty table gives
    an empty result.
    """

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                texts = [t or "" for t in part["text"].to_pylist()]
                out = [model.scores(texts[low:high]) for low, high in _passes(texts)]
                values = np.concatenate(out)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(values), pa.array((values >= THRESHOLD).astype(np.int32))],
                    names=["doc_id", "score", "predicted"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {kind}, score double, predicted int")
