"""Operator 6, SentencePiece encoding and decoding by a max-plus parallel scan.

Encoding takes the pieces and scores of a SentencePiece model and finds, for a
whole text, the segmentation with the greatest sum of scores; of equal sums the
one whose pieces, from the end of the text, start earlier.  That is a longest path,
a product of matrices over (max, +), so it can be cut anywhere:

* A document of up to CHUNK_CHARS characters is one chunk and solved in place.
* A giant document is split into chunks, dealt over all tasks.  Where a chunk
  begins, the state is how many characters the last piece reaches into it.  Each
  chunk yields the transfer matrix from entry state to exit state; a parallel
  prefix over the document's matrices gives the best score of every boundary
  state; with these each chunk is backtraced on its own, for each exit state; and
  the exit states, fixed from the end of the document, pick the pieces.

Inside a chunk, places that no piece crosses (before a run of blanks; around a
character that no piece has) cut it into units whose matrix is one number.  Equal
units are solved once, many at a time.
"""

from __future__ import annotations

import hashlib
import math
import re
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import KEPT, released, settle

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_CHARS = 32_768
# Characters of text in one pass; units kept solved between passes; longest unit of a pass.
PASS_CHARS = 1 << 20
MEMO_UNITS = 120_000
LOCKSTEP_CHARS = 48

_RESULT = "n_tokens long, ids array<int>, text_sha256 string"

BLANK = "▁"  # how a model's pieces write a blank
_LOW = -(1 << 60)
_SLOT_BITS = 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def log_probabilities(scores: list[float]) -> list[float]:
    """The scores of a unigram model as they are; those of a BPE model by Zipf's law.

    A BPE model's scores are no log-probabilities but merge ranks, written 0, -1, -2,
    ...: merges were made in the order of their pieces' frequency.  The piece of rank
    r gets the probability 1 / ((r + 1) H), H the sum over all ranks.
    """
    ranks = {-s for s in scores if s < 0}
    if len(ranks) < 2 or any(not float(s).is_integer() for s in scores):
        return list(scores)
    total = math.log(sum(1 / (r + 1) for r in ranks))
    return [-math.log(max(0.0, -s) + 1) - total for s in scores]


class Vocabulary:
    """Pieces and scores of a model file; small, and shipped with the tasks."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.n = len(pieces)
        # Sums must not depend on their order, so scores are integers: 1024ths.
        integers = [round(s * 1024) for s in log_probabilities(scores)]
        self.pieces: dict[str, tuple[int, int]] = {}
        self.surface = [b""] * self.n
        self.bytes: dict[int, int] = {}
        self.unknown = 0
        for i, (piece, kind) in enumerate(zip(pieces, kinds)):
            if kind == "byte":
                self.bytes[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            elif kind == "unknown":
                self.unknown, self.surface[i] = i, " ⁇ ".encode()
            elif kind == "normal":
                text = piece.replace(BLANK, " ")
                self.pieces[text] = (i, integers[i])
                self.surface[i] = text.encode()
        self.longest = max(map(len, self.pieces), default=1)
        # A character that is no piece costs more than any piece.
        self.unknown_score = min((s for _, s in self.pieces.values()), default=0) - 10 * 1024
        self.alphabet = sorted(set("".join(self.pieces)))
        crossing = any(" " in p.lstrip(" ") for p in self.pieces)
        line = "" if "\n" in self.alphabet else "\n"
        self.unit = None if crossing else re.compile(f" +[^ {line}]*|{line or '(?!)'}|[^ {line}]+", re.DOTALL)
        self.code = np.uint16 if self.n <= 1 << 16 else np.uint32

    @staticmethod
    def load(model_file: str = MODEL_FILE) -> Vocabulary:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=model_file)
        kinds = [
            "byte" if m.is_byte(i) else "unknown" if m.is_unknown(i) else "other" if m.is_control(i) or m.is_unused(i) else "normal"
            for i in range(m.get_piece_size())
        ]
        return Vocabulary([m.id_to_piece(i) for i in range(len(kinds))], [m.get_score(i) for i in range(len(kinds))], kinds)

    def single(self, char: str) -> list[int]:
        """The ids of a character that is no piece: its bytes, or unknown."""
        own = [self.bytes.get(b, -1) for b in char.encode()]
        return own if min(own) >= 0 else [self.unknown]


class Segmenter:
    """Solves units and chunks for one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.v = vocabulary
        self.memo: dict[str, tuple[bytes, int]] = {}
        self.long: list[str] = []  # the units of the memo over LOCKSTEP_CHARS
        self.codes = np.zeros(0x110000, np.int64)  # 0: in no piece
        for i, c in enumerate(v.alphabet):
            self.codes[ord(c)] = i + 1
        width = len(v.alphabet) + 1
        nodes: dict[int, int] = {}
        self.piece, score = [-1], [0]
        self.prefixes = set()
        for text, (i, s) in v.pieces.items():
            node = 0
            for n, c in enumerate(text, 1):
                self.prefixes.add(text[:n])
                key = node * width + int(self.codes[ord(c)])
                if key not in nodes:
                    nodes[key] = len(self.piece)
                    self.piece.append(-1)
                    score.append(0)
                node = nodes[key]
            self.piece[node], score[node] = i, s
        self.piece, self.score, self.width = np.array(self.piece), np.array(score), width
        keys = np.fromiter(nodes.keys(), np.int64, len(nodes))
        after = np.fromiter(nodes.values(), np.int64, len(nodes))
        self.slot_key = np.full(1 << _SLOT_BITS, -1, np.int64)
        self.slot_after = np.zeros(1 << _SLOT_BITS, np.int64)
        slot = self._slot(keys)
        self.slot_key[slot], self.slot_after[slot] = keys, after
        rest = np.flatnonzero(self.slot_key[slot] != keys)
        order = rest[np.argsort(keys[rest])]
        self.rest_key, self.rest_after = np.append(keys[order], 1 << 62), np.append(after[order], 0)

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _MULTIPLIER) >> np.uint64(64 - _SLOT_BITS)

    def _step(self, node: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The trie node after ``node`` by a character; 0 if there is none."""
        key = node * self.width + code
        slot = self._slot(key)
        out = np.where(self.slot_key[slot] == key, self.slot_after[slot], 0)
        lost = np.flatnonzero((out == 0) & (code > 0))
        if len(lost):
            at = np.searchsorted(self.rest_key, key[lost])
            out[lost] = np.where(self.rest_key[at] == key[lost], self.rest_after[at], 0)
        return out

    def _lockstep(self, units: list[str]) -> list[tuple[bytes, int]]:
        """Units of like lengths, solved side by side."""
        n, sizes = len(units), np.array([len(u) for u in units])
        size = int(sizes.max())
        chars = np.frombuffer("".join([u.ljust(size, "\0") for u in units]).encode("utf-32-le"), np.uint32)
        codes = np.where(np.arange(size) < sizes[:, None], self.codes[chars.reshape(n, size)], 0)
        best = np.full((n, size + 1), _LOW, np.int64)
        best[:, 0] = 0
        back, ids = np.zeros((n, size + 1), np.int8), np.full((n, size + 1), -1, np.int64)
        for start in range(size):
            rows = np.flatnonzero(sizes > start)
            node, alone = np.zeros(len(rows), np.int64), np.zeros(n, bool)
            alone[rows] = True
            for length in range(1, min(self.v.longest, size - start) + 1):
                node = self._step(node, codes[rows, start + length - 1])
                on = node > 0
                rows, node = rows[on], node[on]
                if length == 1:
                    alone[rows[self.piece[node] >= 0]] = False
                if not len(rows):
                    break
                is_piece = self.piece[node] >= 0
                at, own = rows[is_piece], node[is_piece]
                sums = best[at, start] + self.score[own]
                better = sums > best[at, start + length]
                at = at[better]
                best[at, start + length] = sums[better]
                back[at, start + length] = length
                ids[at, start + length] = self.piece[own[better]]
            at = np.flatnonzero(alone)
            sums = best[at, start] + self.v.unknown_score
            better = sums > best[at, start + 1]
            at = at[better]
            best[at, start + 1], back[at, start + 1], ids[at, start + 1] = sums[better], 1, -1
        # Backtrace, all units one piece at a time.
        end, path = sizes.copy(), []
        while end.any():
            path.append(np.where(end > 0, np.arange(n) * (size + 1) + end, -1))
            end = np.where(end > 0, end - back[np.arange(n), end], 0)
        steps = np.array(path[::-1]).T
        used = steps >= 0
        flat, cuts = ids.ravel()[steps[used]], np.cumsum(used.sum(axis=1))
        out, total = [], best[np.arange(n), sizes]
        if (flat >= 0).all():
            packed, wide = flat.astype(self.v.code).tobytes(), np.dtype(self.v.code).itemsize
            low = 0
            for i, high in enumerate(cuts.tolist()):
                out.append((packed[low * wide : high * wide], int(total[i])))
                low = high
            return out
        where, low = steps[used] % (size + 1), 0
        for i, high in enumerate(cuts.tolist()):
            own = []
            for k in range(low, high):
                own += [int(flat[k])] if flat[k] >= 0 else self.v.single(units[i][where[k] - 1])
            out.append((np.array(own, self.v.code).tobytes(), int(total[i])))
            low = high
        return out

    def forward(self, text: str, entry: dict[int, int], end: int):
        """Best sums from the entry positions; pieces start before ``end``.

        ``entry`` maps positions to the score of paths that arrive there from the
        left.  Returns position -> (sum, start of the last piece, or -1 if the path
        came from the left, id of the last piece, or -1 for a bare character).
        """
        v, prefixes = self.v, self.prefixes
        best = {p: (s, -1, -1) for p, s in entry.items() if s > _LOW // 2}
        for start in range(end):
            here = best.get(start)
            if here is None:
                continue
            here, alone = here[0], True
            for stop in range(start + 1, min(start + v.longest, len(text)) + 1):
                part = text[start:stop]
                if part not in prefixes:
                    break
                found = v.pieces.get(part)
                if found is not None:
                    if stop == start + 1:
                        alone = False
                    was = best.get(stop)
                    if was is None or here + found[1] > was[0]:
                        best[stop] = (here + found[1], start, found[0])
            if alone and start < len(text):
                was = best.get(start + 1)
                if was is None or here + v.unknown_score > was[0]:
                    best[start + 1] = (here + v.unknown_score, start, -1)
        return best

    def back(self, text: str, best: dict, end: int) -> tuple[int, list[int]]:
        """The entry position and the ids of the best path that ends at ``end``."""
        own: list[list[int]] = []
        while best[end][1] >= 0:
            _, start, i = best[end]
            own.append([i] if i >= 0 else self.v.single(text[start]))
            end = start
        return end, [i for part in reversed(own) for i in part]

    def solve(self, units: list[str]) -> None:
        """Put units into the memo."""
        units = sorted(units, key=len)
        long = next((i for i, u in enumerate(units) if len(u) > LOCKSTEP_CHARS), len(units))
        for at in range(0, long, 1 << 14):
            part = units[at : min(long, at + (1 << 14))]
            self.memo.update(zip(part, self._lockstep(part)))
        for u in units[long:]:
            best = self.forward(u, {0: 0}, len(u))
            self.long.append(u)
            self.memo[u] = (np.array(self.back(u, best, len(u))[1], self.v.code).tobytes(), best[len(u)][0])

    def units(self, text: str) -> list[str]:
        return self.v.unit.findall(text) if self.v.unit else [text]

    def ready(self, units: list[list[str]]) -> None:
        """Have every unit of the lists in the memo."""
        all_units = set().union(*units) if units else set()
        missing = [u for u in all_units if u not in self.memo]
        if len(self.memo) + len(missing) > MEMO_UNITS:
            self.memo.clear()
            missing = list(all_units)
        self.solve(missing)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts of any length."""
        units = [self.units(prepared(t)) if t else [] for t in texts]
        self.ready(units)
        memo = self.memo
        out = [b"".join([memo[u][0] for u in own]) for own in units]
        self._trim()
        return out

    def _trim(self) -> None:
        """Forget long units, so that the memo is bounded in bytes too."""
        for unit in self.long:
            self.memo.pop(unit, None)
        self.long.clear()

    # -- chunks of a giant document --------------------------------------------

    def _cuts(self, text: str, end: int) -> tuple[int, int] | None:
        """First and last place inside [1, end) that no piece crosses."""
        if self.v.unit is None:
            return None
        starts = [m.start() for m in self.v.unit.finditer(text[: end])][1:]
        # A unit that begins with the chunk's own first blank run may belong to
        # blanks before it; later ones are cut for certain.
        return (starts[0], starts[-1]) if starts else None

    def transfer(self, text: str, end: int) -> np.ndarray:
        """Matrix [entry, exit] of best sums; ``text`` reaches past ``end``."""
        states = self.v.longest
        out = np.full((states, states), _LOW, np.int64)
        cuts = self._cuts(text, end)
        if cuts is None:
            for a in range(states):
                best = self.forward(text, {a: 0}, end)
                for b in range(states):
                    if end + b in best and best[end + b][1] >= 0:
                        out[a, b] = best[end + b][0]
            return out
        first, last = cuts
        units = self.units(text[first:last])
        self.ready([units])
        middle = sum(self.memo[u][1] for u in units)
        tail = self.forward(text[last:], {0: 0}, end - last)
        exits = [(b, tail[end - last + b][0]) for b in range(states) if end - last + b in tail]
        for a in range(min(states, first + 1)):
            head = self.forward(text[:first], {a: 0}, first)
            for b, s in exits if first in head else []:
                out[a, b] = head[first][0] + middle + s
        return out

    def variants(self, text: str, end: int, scores: np.ndarray) -> list[tuple[int, int, bytes]]:
        """(exit, entry, packed ids) for every exit state, given the entry states' scores."""
        states = self.v.longest
        entry = {a: int(s) for a, s in enumerate(scores)}
        pack = lambda ids: np.array(ids, self.v.code).tobytes()
        cuts = self._cuts(text, end)
        if cuts is None:
            best = self.forward(text, entry, end)
            ends = [b for b in range(states) if end + b in best and best[end + b][1] >= 0]
            found = [(b, *self.back(text, best, end + b)) for b in ends]
            return [(b, a, pack(ids)) for b, a, ids in found]
        first, last = cuts
        head = self.forward(text[:first], {a: s for a, s in entry.items() if a <= first}, first)
        a, ids = self.back(text[:first], head, first)
        units = self.units(text[first:last])
        self.ready([units])
        shared = pack(ids) + b"".join(self.memo[u][0] for u in units)
        rest = text[last:]
        tail = self.forward(rest, {0: 0}, end - last)
        ends = [b for b in range(states) if end - last + b in tail]
        return [(b, a, shared + pack(self.back(rest, tail, end - last + b)[1])) for b in ends]


def prepared(text: str) -> str:
    """A text as pieces see it: one blank in front, and the blank sign is a blank."""
    return " " + text.replace(BLANK, " ")


def times(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Product of matrices (or of stacks of them) over (max, +)."""
    return np.maximum((left[..., :, :, None] + right[..., None, :, :]).max(axis=-2), _LOW)


def prefixes(matrices: np.ndarray) -> np.ndarray:
    """All products of the first 1, 2, ... matrices, by pairs of pairs."""
    if len(matrices) < 2:
        return matrices
    even = len(matrices) // 2 * 2
    pairs = prefixes(times(matrices[0:even:2], matrices[1:even:2]))
    out = np.empty_like(matrices)
    out[0], out[1:even:2] = matrices[0], pairs
    if len(matrices) > 2:
        out[2::2] = times(pairs[: len(out[2::2])], matrices[2::2])
    return out


def _segmenter(vocabulary: Vocabulary) -> Segmenter:
    """The segmenter of this Python worker; workers serve many tasks."""
    kept = sys.modules.setdefault(KEPT, types.ModuleType(KEPT))
    tag = hashlib.md5(repr(list(vocabulary.pieces.items())).encode()).digest()
    if getattr(kept, "segmenter_tag", None) != tag:
        kept.segmenter, kept.segmenter_tag = Segmenter(vocabulary), tag
    return kept.segmenter


def _id_lists(packed: list[bytes], code) -> pa.Array:
    sizes = np.array([len(p) for p in packed], np.int64) // np.dtype(code).itemsize
    values = np.frombuffer(b"".join(packed), code).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values))


def _surface(vocabulary: Vocabulary, ids) -> bytes:
    """The text of ids; the blank in front goes."""
    return b"".join([vocabulary.surface[i] for i in ids])[1:]


def _rows(vocabulary: Vocabulary, doc_ids: pa.Array, packed: list[bytes]) -> pa.Table:
    """Result rows: ids, their number, and the digest of the text they decode to."""
    ids = [np.frombuffer(p, vocabulary.code) for p in packed]
    digests = [hashlib.sha256(_surface(vocabulary, i.tolist())).hexdigest() for i in ids]
    sizes = pa.array([len(i) for i in ids], pa.int64())
    return pa.table({"doc_id": doc_ids, "n_tokens": sizes, "ids": _id_lists(packed, vocabulary.code), "text_sha256": pa.array(digests, pa.string())})


def encode(docs: DataFrame, model_file: str = MODEL_FILE, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (array of int) and ``text_sha256`` for every
    row of ``docs``; the digest is of the text that is decoded from ``ids``.

    Defined cases: null and empty texts have no ids; the sign U+2581 counts as a
    blank, as in any SentencePiece model; a character that is no piece becomes its
    bytes (or the unknown id, if the model has no byte pieces); repeated rows and
    null ids are rows like others; an empty table gives an empty result.
    """
    vocabulary = Vocabulary.load(model_file)
    if chunk_chars < 2 * vocabulary.longest:
        raise ValueError("a chunk must be longer than two pieces")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def small(batches):
        segmenter = _segmenter(vocabulary)
        for batch in batches:
            texts, low = batch["text"].to_pylist(), 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (size == 0 or size + len(texts[high]) <= PASS_CHARS):
                    size += len(texts[high])
                    high += 1
                packed = segmenter.encode(texts[low:high])
                yield from _rows(vocabulary, batch["doc_id"].slice(low, high - low), packed).to_batches()
                low = high

    solved = rows.where(F.char_length("text") <= chunk_chars).mapInArrow(released(small, keep=True), f"doc_id {kind}, {_RESULT}")
    return solved.unionByName(_giants(rows.where(F.char_length("text") > chunk_chars), vocabulary, kind, chunk_chars))


def _giants(rows: DataFrame, vocabulary: Vocabulary, kind: str, chunk_chars: int) -> DataFrame:
    states = vocabulary.longest

    def split(batches):
        for batch in batches:
            for i, text in enumerate(batch["text"].to_pylist()):
                text = prepared(text)
                n = max(1, len(text) // chunk_chars)  # the last chunk takes the rest
                for k in range(n):
                    low = k * chunk_chars
                    high = len(text) if k == n - 1 else low + chunk_chars
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["doc_id"].slice(i, 1),
                            batch["key"].slice(i, 1),
                            pa.array([k], pa.int32()),
                            pa.array([high - low], pa.int32()),
                            pa.array([text[low : high + states - 1]]),
                        ],
                        names=["doc_id", "key", "chunk", "size", "text"],
                    )

    # Rows equal in id and text are split once and dealt out again at the end.
    keyed = rows.withColumn("key", F.md5(F.concat_ws("\0", F.col("doc_id").cast("string"), "text")))
    copies = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    chunks = settle(
        keyed.mapInArrow(split, f"doc_id {kind}, key string, chunk int, size int, text string").dropDuplicates(["key", "chunk"]),
        "op6-chunks",
    )

    def matrices(batches):
        segmenter = _segmenter(vocabulary)
        for batch in batches:
            out = [segmenter.transfer(t, n).tobytes() for t, n in zip(batch["text"].to_pylist(), batch["size"].to_pylist())]
            yield pa.RecordBatch.from_arrays([batch["key"], batch["chunk"], pa.array(out, pa.binary())], names=["key", "chunk", "matrix"])

    def scan(table: pa.Table) -> pa.Table:
        """Entry scores of each chunk: a prefix over matrices, a 32nd of the text or less."""
        table = table.sort_by("chunk")
        own = np.stack([np.frombuffer(m, np.int64).reshape(states, states) for m in table["matrix"].to_pylist()])
        entry = np.full((len(own), states), _LOW, np.int64)
        entry[0, 0] = 0
        entry[1:] = prefixes(own)[:-1, 0]
        return pa.table({"key": table["key"], "chunk": table["chunk"], "scores": pa.array([e.tobytes() for e in entry], pa.binary())})

    scores = (
        chunks.repartition("key", "chunk")
        .mapInArrow(released(matrices, keep=True), "key string, chunk int, matrix binary")
        .groupBy("key")
        .applyInArrow(scan, "key string, chunk int, scores binary")
    )

    def backtrace(batches):
        segmenter = _segmenter(vocabulary)
        for batch in batches:
            for i, (text, size, entry) in enumerate(zip(*(batch[c].to_pylist() for c in ("text", "size", "scores")))):
                found = segmenter.variants(text, size, np.frombuffer(entry, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch[c].slice(i, 1).take(pa.array([0] * len(found))) for c in ("doc_id", "key", "chunk")),
                        pa.array([f[0] for f in found], pa.int32()),
                        pa.array([f[1] for f in found], pa.int32()),
                        pa.array([f[2] for f in found], pa.binary()),
                    ],
                    names=["doc_id", "key", "chunk", "exit", "entry", "ids"],
                )

    def join(table: pa.Table) -> pa.Table:
        """From the document's end, where the exit state is 0, to its start."""
        found = {(c, x): (e, i) for c, x, e, i in zip(*(table[c].to_pylist() for c in ("chunk", "exit", "entry", "ids")))}
        state, parts = 0, []
        for chunk in range(max(c for c, _ in found), -1, -1):
            state, own = found[chunk, state]
            parts.append(own)
        out = _rows(vocabulary, table["doc_id"].slice(0, 1), [b"".join(reversed(parts))])
        return out.add_column(0, "key", table["key"].slice(0, 1))

    whole = (
        chunks.join(scores, ["key", "chunk"])
        .select("doc_id", "key", "chunk", "size", "text", "scores")
        .mapInArrow(released(backtrace, keep=True), f"doc_id {kind}, key string, chunk int, exit int, entry int, ids binary")
        .groupBy("key")
        .applyInArrow(join, f"key string, doc_id {kind}, {_RESULT}")
    )
    return whole.join(copies, "key").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("key", "copies", "copy")


def decode(rows: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """``rows`` with ``text``, decoded from ``ids``: the exact inverse of ``encode``.

    Null or empty ids give an empty text.  All columns of ``rows`` but ``ids`` and
    any earlier ``text`` are kept; repeated rows and null ids are rows like others; an
    empty table gives an empty result.  What U+2581 was comes back as a blank.
    """
    vocabulary = Vocabulary.load(model_file)
    kept = [c for c in rows.columns if c not in ("ids", "text")]

    def run(batches):
        for batch in batches:
            texts = [_surface(vocabulary, ids).decode("utf-8", "replace") if ids else "" for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(texts, pa.string())], names=[*kept, "text"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return rows.select(*kept, "ids").mapInArrow(run, f"{schema}, text string")
