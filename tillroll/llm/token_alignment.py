"""Operator 12, cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Tokenizer A is byte-level BPE over a blank and the text, B a SentencePiece model over
the text (to which it adds the blank itself).

* Each whole text is encoded by both; the tokens' bytes, joined, must be those of blank
  and text in both.  Where a token of A and one of B end at the same byte and the next
  tokens of both begin with a blank, the document is cut into windows: a word with
  what hangs on it.  The cuts are found in both offset tables, not assumed.
* No token of either tokenizer reaches over a single blank between two other characters
  (checked in their vocabularies), so a text is cut there, and a stretch that was met
  before is not encoded again: its alignment is kept.
* A window is two tuples of ids, and its alignment depends on nothing else.  It is
  walked once and kept by those tuples; the same words come back all the time.
* Inside a window, groups end where both tokenizations end, and a pair of tokens is
  linked where their bytes overlap: one link for each stretch between two ends of either.

How often a pair of ids is linked is counted over the whole corpus by a shuffle with
map-side sums.  Documents look their pairs' counts up in two ways: the pairs with more
than a 1/HOT_PAIRS share of all links, of which there are fewer than HOT_PAIRS, are
broadcast; the rest, the long tail, is joined by a shuffle in which no key is hot.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import released, settle

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

# Pairs that are broadcast at most.
HOT_PAIRS = 50_000
# Windows that a task keeps, and the longest of these in tokens of A and B.
MEMO_WINDOWS = 100_000
MEMO_TOKENS = 24
# Stretches of text between blanks that a task keeps, and the longest of these in characters.
MEMO_STRETCHES = 200_000
MEMO_CHARS = 48
# Stretches that are encoded one by one if one of them has no tokens.
FEW_STRETCHES = 32
# Characters of text that are encoded in one pass; longest part of a text that is encoded at once.
PASS_CHARS = 1 << 18
PART_CHARS = 1 << 16

# A blank between letters or digits: no token of either kind reaches over it.
_SAFE = re.compile(r"(?<=[^\W_]) (?=[^\W_])")
# A blank between two characters that are none, and a token that would reach over one.
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_OVER = re.compile(r"\S ")


def byte_of_sign() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as they are, the others as signs from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Side:
    """One tokenizer: encodes texts, and knows the bytes of its tokens."""

    def __init__(self, tokens: list[bytes], encode):
        self.tokens, self.encode = tokens, encode
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.marked = np.array([t[:1] == b" " for t in tokens])


# --- fixed value: how byte-level BPE splits a text before it merges -----------
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# -----------------------------------------------------------------------------


def byte_side(path: str) -> Side:
    """Tokenizer A: encodes a blank and the text; special tokens' strings are plain text.

    Where the file's merges are in the order of their ids, as in the public files, the
    ids are the ranks that the faster of the two libraries needs; it gives the same ids.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    signs, vocabulary = byte_of_sign(), file["model"]["vocab"]
    merges = [m if isinstance(m, str) else "".join(m) for m in file["model"]["merges"]]
    of_bytes = {i: bytes(signs[c] for c in token) for token, i in vocabulary.items() if all(c in signs for c in token)}
    tokens = [of_bytes.get(i, b"") for i in range(max(vocabulary.values()) + 1)]
    ranked = all(vocabulary.get(m.replace(" ", "")) == 256 + i for i, m in enumerate(merges)) and len(of_bytes) == 256 + len(merges)
    if ranked and not file.get("normalizer") and file["pre_tokenizer"] == _SPLITTER:
        import tiktoken

        ranks = {token: i for i, token in of_bytes.items()}
        encoder = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        return Side(tokens, lambda texts: [encoder.encode_ordinary(" " + t) for t in texts])
    return Side(tokens, library_encoder(path))


_SPLITTER = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


def library_encoder(path: str):
    """Encodes a blank and each text by the library that the file is written for."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


def piece_side(path: str) -> Side:
    """Tokenizer B: encodes the text, to which the model adds a blank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return Side(tokens, lambda texts: model.encode(texts, num_threads=1))


def parts(text: str, limit: int) -> list[str]:
    """A text in parts of about ``limit`` characters, cut at blanks that no token crosses."""
    out, low = [], 0
    while len(text) - low > limit:
        found = _SAFE.search(text, low + limit)
        if not found:
            break
        out.append(text[low : found.start()])
        low = found.end()
    return [*out, text[low:]]


class Aligner:
    """Aligns the tokens of whole texts, window by window."""

    def __init__(self, a: Side, b: Side, memo_windows: int = MEMO_WINDOWS, part_chars: int = PART_CHARS):
        self.a, self.b, self.memo_windows = a, b, memo_windows
        self.memo: dict[tuple[bytes, bytes], tuple[str, bytes, int]] = {}
        # Parts are cut only if no token reaches over a blank between letters or digits.
        cuttable = not any(_SAFE.search(t.decode("utf-8", "ignore")) for side in (a, b) for t in side.tokens)
        self.part_chars = part_chars if cuttable else 1 << 62
        self.by_stretch = not any(_OVER.search(t.decode("utf-8", "ignore")) for side in (a, b) for t in side.tokens)
        self.stretches: dict[str, tuple[int, int, int, str, bytes]] = {}
        self.walked = self.encoded = 0
        # Every id as it is written inside a group and at its end.
        self.words = [f"{i}{mark}" for side, last in ((a, "|"), (b, ";")) for i in range(len(side.tokens)) for mark in (",", last)]

    def _walk(self, a: np.ndarray, b: np.ndarray, high_a: np.ndarray, high_b: np.ndarray) -> list[tuple[str, bytes, int]]:
        """Windows laid end to end, the k-th up to ``high_a[k]``, ``high_b[k]``: of each its
        groups as text (each closed by ;), its linked pairs as packed numbers, its number of groups.

        The windows cover the same bytes on both sides, so one pass over all ends does.
        """
        self.walked += len(high_a)
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        closed = ends_a[high_a - 1]  # where the windows end
        every, shared = np.union1d(ends_a, ends_b), np.intersect1d(ends_a, ends_b, assume_unique=True)
        # Between two ends of either side lies one token of each: a link.
        pairs = a[np.searchsorted(ends_a, every)].astype(np.int64) * len(self.b.tokens) + b[np.searchsorted(ends_b, every)]
        links = np.append(0, np.searchsorted(every, closed) + 1).tolist()
        groups = np.append(0, np.searchsorted(shared, closed) + 1)
        # The tokens as they are written: group by group, A before B, the last of a group marked.
        in_a, in_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        order = np.argsort(np.concatenate([2 * in_a, 2 * in_b + 1]), kind="stable")
        codes = np.concatenate([2 * a + (shared[in_a] == ends_a), 2 * (b + len(self.a.tokens)) + (shared[in_b] == ends_b)])[order].tolist()
        words, packed, high, low, out = self.words, pairs.tobytes(), (high_a + high_b).tolist(), 0, []
        for k, n in enumerate(np.diff(groups).tolist()):
            text = "".join([words[c] for c in codes[low : high[k]]])
            out.append((text, packed[8 * links[k] : 8 * links[k + 1]], n))
            low = high[k]
        return out

    def _tokens(self, texts: list[str]) -> tuple[list, list]:
        """Ids of each text by A and B; none where the bytes are not those of blank and text."""
        cut = [parts(t, self.part_chars) if t else [] for t in texts]
        flat = [p for own in cut for p in own]
        out: tuple[list, list] = ([], [])
        for side, found in zip((self.a, self.b), out):
            ids = iter(side.encode(flat) if flat else [])
            for own in cut:
                found.append(next(ids) if len(own) == 1 else [i for _ in own for i in next(ids)])
        for k, text in enumerate(texts):
            want = b" " + text.encode() if text else b""
            if any(b"".join(map(side.tokens.__getitem__, found[k])) != want for side, found in zip((self.a, self.b), out)):
                out[0][k], out[1][k] = [], []
        return out

    def _windows(self, a: np.ndarray, b: np.ndarray) -> tuple[list, np.ndarray]:
        """The windows' alignments in order, and how many tokens of A each ends after."""
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        to_a, to_b = np.searchsorted(ends_a, shared) + 1, np.searchsorted(ends_b, shared) + 1
        mark_a, mark_b = np.append(self.a.marked[a], True), np.append(self.b.marked[b], True)
        cut = np.flatnonzero(mark_a[to_a] & mark_b[to_b])
        to_a, to_b = to_a[cut], to_b[cut]
        packed_a, packed_b, memo = a.tobytes(), b.tobytes(), self.memo
        out, new, at = [], {}, []
        low_a = low_b = 0
        for high_a, high_b in zip((to_a * 4).tolist(), (to_b * 4).tolist()):
            key = (packed_a[low_a:high_a], packed_b[low_b:high_b])
            found = memo.get(key)
            if found is None:
                found = new.setdefault(key, len(new))  # its number among those to walk
                if found == len(at):
                    at.append((low_a // 4, high_a // 4, low_b // 4, high_b // 4))
            out.append(found)
            low_a, low_b = high_a, high_b
        if new:
            where = np.array(at)
            walked = self._walk(
                np.concatenate([a[i:j] for i, j, _, _ in at]), np.concatenate([b[i:j] for _, _, i, j in at]),
                np.cumsum(where[:, 1] - where[:, 0]), np.cumsum(where[:, 3] - where[:, 2]),
            )
            out = [walked[x] if type(x) is int else x for x in out]
            if len(memo) + len(new) > self.memo_windows:
                memo.clear()
            short = 4 * MEMO_TOKENS
            memo.update((key, w) for key, w in zip(new, walked) if len(key[0]) <= short and len(key[1]) <= short)
        return out, to_a

    def align(self, texts: list[str]):
        """For each text: tokens of A and B, groups, groups as text, packed links."""
        known = self.stretches
        if len(known) > MEMO_STRETCHES:
            known.clear()
        cut = [_BETWEEN.split(t) if self.by_stretch else [t] for t in texts]
        new = list(dict.fromkeys(s for own in cut for s in own if s not in known))
        self.encoded += len(new)
        plain = [s for s in new if s and not (s[0].isspace() or s[-1].isspace())] if self.by_stretch else []
        self._learn(plain)
        edges = [s for s in new if s not in known]
        known.update(zip(edges, self._stretches(edges)))
        for own in cut:
            n_a, n_b, n_groups, text, links = zip(*map(known.__getitem__, own))
            if 0 in n_a:  # a stretch without tokens: nor has the text any
                yield 0, 0, 0, "", b""
            else:
                yield sum(n_a), sum(n_b), sum(n_groups), "".join(text)[:-1], b"".join(links)
        for s in new:
            if len(s) > MEMO_CHARS:
                del known[s]

    def _learn(self, new: list[str]) -> None:
        """Encode new stretches as one text, blanks between them, and walk each as a window.

        Stretches without tokens spoil the text they are in: it is halved until they are
        among a few, which are left to ``_stretches``.
        """
        if not new:
            return
        (ids_a,), (ids_b,) = self._tokens([" ".join(new)])
        if not ids_a:
            if len(new) > FEW_STRETCHES:
                self._learn(new[: len(new) // 2])
                self._learn(new[len(new) // 2 :])
            return
        a, b = np.array(ids_a, np.int32), np.array(ids_b, np.int32)
        ends = np.cumsum([len(s.encode()) + 1 for s in new])
        # The blanks of the tokenizers: no token reaches over the end of a stretch.
        high_a = np.searchsorted(np.cumsum(self.a.sizes[a]), ends) + 1
        high_b = np.searchsorted(np.cumsum(self.b.sizes[b]), ends) + 1
        counts = zip(np.diff(high_a, prepend=0).tolist(), np.diff(high_b, prepend=0).tolist())
        walked = self._walk(a, b, high_a, high_b)
        self.stretches.update((s, (n_a, n_b, n, text, links)) for s, (n_a, n_b), (text, links, n) in zip(new, counts, walked))

    def _stretches(self, texts: list[str]):
        """As ``align``, of texts that are taken whole; every group is closed by ;."""
        ids_a, ids_b = self._tokens(texts)
        a = np.fromiter(chain.from_iterable(ids_a), np.int32)
        b = np.fromiter(chain.from_iterable(ids_b), np.int32)
        found, to_a = self._windows(a, b)
        # Every text begins with a blank, so no window reaches from one text into the next.
        cuts = np.searchsorted(to_a, np.cumsum([len(own) for own in ids_a]), side="right")
        low = 0
        for own_a, own_b, high in zip(ids_a, ids_b, cuts.tolist()):
            own = found[low:high]
            low = high
            yield len(own_a), len(own_b), sum([w[2] for w in own]), "".join([w[0] for w in own]), b"".join([w[1] for w in own])


def _passes(column: pa.Array):
    """Ranges of a text column of about PASS_CHARS characters."""
    low = size = 0
    for i, n in enumerate(pc.utf8_length(column).fill_null(0).to_pylist()):
        if size and size + n > PASS_CHARS:
            yield low, i
            low, size = i, 0
        size += n
    if low < len(column):
        yield low, len(column)


_COUNTED = "n_a long, n_b long, n_groups long, n_links long"
_LINKS = "links array<struct<pair: long, n: int>>"


def _aligned(docs: DataFrame, byte_model: str, piece_model: str, as_groups: bool) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        aligner = Aligner(byte_side(byte_model), piece_side(piece_model))
        span = len(aligner.a.tokens) * len(aligner.b.tokens)
        for batch in batches:
            for low, high in _passes(batch["text"]):
                texts = [t or "" for t in batch["text"].slice(low, high - low).to_pylist()]
                counts, groups, packed = [], [], []
                for n_a, n_b, n_groups, text, links in aligner.align(texts):
                    counts.append((n_a, n_b, n_groups, len(links) // 8))
                    groups.append(text if as_groups else hashlib.sha256(text.encode()).hexdigest() if text else "")
                    packed.append(links)
                pairs = np.frombuffer(b"".join(packed), np.int64)
                text = np.repeat(np.arange(len(texts)), [c[3] for c in counts])
                # A text's pairs and how often each is linked; text and pair fit one integer.
                found, times = np.unique(text * span + pairs, return_counts=True)
                offsets = np.append(0, np.cumsum(np.bincount(found // span, minlength=len(texts)))).astype(np.int32)
                links = pa.StructArray.from_arrays([pa.array(found % span), pa.array(times.astype(np.int32))], names=["pair", "n"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(low, high - low),
                        *(pa.array([c[k] for c in counts], pa.int64()) for k in range(4)),
                        pa.array(groups, pa.string()),
                        pa.ListArray.from_arrays(pa.array(offsets), links),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"],
                )

    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {kind}, {_COUNTED}, groups string, {_LINKS}")


def groups(docs: DataFrame, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> DataFrame:
    """The alignment of every row of ``docs``: ``doc_id``, ``n_a``, ``n_b`` and ``groups``.

    ``groups`` is an array of (``a``, ``b``), the ids of A and B that cover the same
    bytes, in order.  The defined cases are those of ``link_counts``.
    """
    ids = lambda side: F.transform(F.split(side, ","), lambda i: i.cast("int"))
    both = lambda g: F.struct(ids(F.split_part(g, F.lit("|"), F.lit(1))).alias("a"), ids(F.split_part(g, F.lit("|"), F.lit(2))).alias("b"))
    none = F.array().cast("array<struct<a: array<int>, b: array<int>>>")
    found = F.when(F.col("groups") == "", none).otherwise(F.transform(F.split("groups", ";"), both))
    return _aligned(docs, byte_model, piece_model, True).select("doc_id", "n_a", "n_b", found.alias("groups"))


def pair_counts(links: DataFrame, width: int) -> DataFrame:
    """``pair``, ``count`` and ``best`` (its count is the highest of its B id) of (pair, n) rows.

    At most ``width`` rows, one for each id of B, are broadcast.
    """
    counts = settle(links.groupBy("pair").agg(F.sum("n").alias("count")), "op12-counts")
    highest = counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("count").alias("highest"))
    return settle(
        counts.join(F.broadcast(highest), F.col("pair") % width == F.col("b")).select(
            "pair", "count", (F.col("count") == F.col("highest")).alias("best")
        ),
        "op12-pairs",
    )


def link_counts(
    docs: DataFrame, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL, hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``; others ignored).

    Returns ``doc_id``, ``n_a``, ``n_b`` (tokens), ``n_groups`` (stretches between
    bytes where tokens of A and B both end), ``n_links`` (overlapping pairs of tokens),
    ``n_best`` (links whose pair's count over all rows is the highest of its B id, ties
    included), ``count_sum`` (of the links' counts) and ``groups_sha256`` (digest of
    ``a1,a2|b1;a3|b2,b3``).

    Defined cases: a null or empty text, and one whose bytes A or B changes (for
    instance one with U+2581), has no tokens: zeros and an empty string; repeated rows
    and null ids are rows like others and count; an empty table gives an empty result.
    """
    width = len(piece_side(piece_model).tokens)
    rows = settle(_aligned(docs, byte_model, piece_model, False).withColumn("key", F.monotonically_increasing_id()), "op12-aligned")
    links = rows.select("key", F.inline("links"))
    pairs = pair_counts(links, width)
    total = pairs.agg(F.sum("count")).first()[0] or 0
    # Fewer than hot_pairs pairs can hold more than this many links each.
    limit = total // hot_pairs
    hot, cold = pairs.where(F.col("count") > limit), pairs.where(F.col("count") <= limit)
    sums = [F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")]
    found = settle(
        links.join(F.broadcast(hot), "pair").groupBy("key").agg(*sums).unionByName(
            links.join(F.broadcast(hot.select("pair")), "pair", "left_anti").hint("merge").join(cold, "pair").groupBy("key").agg(*sums)
        ),
        "op12-found",
    )
    totals = found.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.join(totals, "key", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), F.col("groups").alias("groups_sha256")
    )
