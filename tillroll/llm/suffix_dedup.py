"""Operator 9, suffix-array dedup: bytes covered by a string of LENGTH bytes that an
earlier document also holds.

Suffixes are sorted one bucket at a time, with long ties settled by the ranks of a
precomputed cover sample.  The sample is a cover by content: of every LENGTH-byte
string the ANCHOR-byte grams with the smallest hash are sampled, so equal strings
hold a sampled position at equal offsets.  That is what a difference cover gives
for any two positions, at a third of its density (see the README for figures).

1. Documents are dealt over buckets.  A bucket lists the hashes of its anchors,
   packed by hash range; a range finds the hashes that two documents hold.  Any
   repeated string holds such an anchor.
2. A bucket lists, for these anchors, their context: the bytes that the strings
   around the anchor can reach.  Equal contexts of a bucket are listed once, with
   the smallest document, so a passage in a third of all documents costs one entry
   a bucket.
3. A hash range sorts its contexts anchor by anchor (the suffix bucket): all bytes
   from the anchor on, and all bytes before it backwards.  These ranks, with the
   longest common prefixes of neighbours, are the cover sample's ranks: two suffixes
   that start j bytes before their anchors agree on LENGTH bytes exactly if the
   anchors' ranks agree to j bytes backwards and LENGTH - j bytes forwards.  So
   each suffix of the bucket is sorted by two integers instead of its bytes.
4. Each bucket learns which of its strings an earlier document holds, and removes
   the bytes they cover.

An anchor that occurs more than HOT times (the end of a line that a third of all
documents hold, say, each followed by something else) would gather too many
contexts.  The strings around such an anchor are listed one by one instead, each
distinct string once per bucket, and dealt by their own hash.

The documents are shuffled once; the three passes over a bucket read the same
shuffle files.  Comparison is of bytes throughout; hashes only choose what meets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 50
ANCHOR = 20
BUCKET_BYTES = 2_000_000
HOT = 100_000
SEED = 9

_SLICE = 1 << 17
_NONE = np.iinfo(np.int64).max  # the place of a null id: after all others
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)


class Plan:
    """String length, anchor length and what follows from them."""

    def __init__(self, length: int, anchor: int, parts: int, hot: int):
        if not 8 <= anchor <= length:
            raise ValueError("an anchor has from 8 bytes up to the string's length")
        self.length, self.anchor, self.parts, self.hot = length, anchor, parts, hot
        self.reach = length - anchor  # bytes before an anchor that a string can hold
        self.entry = 8 + self.reach + length + 4  # anchor hash, context, and its two lengths
        self.kind = np.dtype((np.void, self.entry))
        self.string = np.dtype((np.void, 8 + length))

    def part(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.parts)) >> np.uint64(32)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def _gram_hashes(data: np.ndarray, n: int, count: int) -> np.ndarray:
    """A hash of the n >= 8 bytes at each of the first ``count`` positions."""
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    words = np.ascontiguousarray(words[: count + n - 8]).view(np.uint64).ravel()
    out = words[:count] * _A
    out ^= out >> np.uint64(29)
    for at in [*range(8, n - 8, 8), *([n - 8] if n > 8 else [])]:
        out += words[at : at + count]
        out *= _B
        out ^= out >> np.uint64(31)
    out *= _A
    out ^= out >> np.uint64(32)
    return out


def _anchors(data: np.ndarray, ends: np.ndarray, plan: Plan):
    """Positions and hashes of the sampled grams of ``data``, slice by slice.

    A position is sampled if its hash is the smallest of the ``reach + 1`` grams of
    some string of ``length`` bytes within a document; ``ends`` are the documents'
    ends.  So a document's sample does not depend on its neighbours.
    """
    width, n = plan.reach + 1, len(data) - plan.anchor + 1
    for low in range(0, max(0, n), _SLICE):
        high = min(n, low + _SLICE)
        first, last = max(0, low - plan.reach), min(n, high + plan.reach)
        hashes = _gram_hashes(data[first : last + plan.anchor - 1], plan.anchor, last - first)
        if len(hashes) < width:
            continue
        least = _sliding_min(hashes, width)
        for end in ends[np.searchsorted(ends, first) : np.searchsorted(ends, last + plan.length)]:
            least[max(0, end - plan.length + 1 - first) : max(0, end - first)] = 0
        # Largest of the minima of all windows that hold the position.
        edge = np.zeros(plan.reach, np.uint64)
        most = ~_sliding_min(~np.concatenate([edge, least, edge]), width)
        own = slice(low - first, high - first)
        at = np.flatnonzero((most[own] == hashes[own]) & (most[own] > 0))
        yield at + low, hashes[own][at]


# What is shuffled is packed: texts of a bucket together, hashes as byte planes.
_CODEC = "zstd"


def _packed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec=_CODEC, asbytes=True)


def _unpacked(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec=_CODEC, asbytes=True)


def _pack_sorted(x: np.ndarray) -> bytes:
    """Sorted integers as differences, first all lowest bytes, then the next ones."""
    steps = np.diff(x, prepend=x.dtype.type(0))
    return _packed(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack_sorted(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpacked(data), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def _pack_documents(batches):
    """The documents of each bucket of a batch as one compressed row."""
    options = pa.ipc.IpcWriteOptions(compression=_CODEC)
    for batch in batches:
        table = pa.Table.from_batches([batch])
        bucket = np.asarray(batch["bucket"])
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        numbers, blobs = [], []
        for rows in np.split(order, cuts):
            if len(rows):
                own = table.select(["doc_id", "bytes"]).take(pa.array(rows))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema, options=options) as writer:
                    writer.write_table(own)
                numbers.append(int(bucket[rows[0]]))
                blobs.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "documents"])


class Bucket:
    """The documents of a bucket as one run of bytes."""

    def __init__(self, table: pa.Table):
        parts = [pa.ipc.open_stream(b).read_all() for b in table["documents"].to_pylist()]
        ids = [i for p in parts for i in p["doc_id"].to_pylist()]
        texts = [t for p in parts for t in p["bytes"].to_pylist()]
        self.ids = ids
        self.order = np.array([_NONE if i is None else i for i in ids], np.int64)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(texts), np.uint8)

    def anchors(self, plan: Plan):
        """Positions, hashes and documents of the anchors within documents."""
        for at, hashes in _anchors(self.data, self.starts + self.sizes, plan):
            yield at, hashes, np.searchsorted(self.starts, at, side="right") - 1

    def entries(self, plan: Plan, shared: np.ndarray):
        """Anchors whose hash is in the sorted ``shared``: positions, documents, entries."""
        padded = np.concatenate([np.zeros(plan.reach, np.uint8), self.data, np.zeros(plan.length, np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(padded, plan.reach + plan.length)
        columns = np.arange(plan.reach + plan.length)
        out = []
        for at, hashes, doc in self.anchors(plan):
            place = np.minimum(np.searchsorted(shared, hashes), max(0, len(shared) - 1))
            hit = np.flatnonzero(shared[place] == hashes) if len(shared) else np.zeros(0, np.int64)
            at, hashes, doc = at[hit], hashes[hit], doc[hit]
            before = np.minimum(at - self.starts[doc], plan.reach)
            after = np.minimum(self.starts[doc] + self.sizes[doc] - at, plan.length)
            raw = np.empty((len(at), plan.entry), np.uint8)
            raw[:, :8] = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
            own = (columns >= plan.reach - before[:, None]) & (columns < plan.reach + after[:, None])
            raw[:, 8:-4] = np.where(own, view[at], 0)
            raw[:, -4:-2] = before.astype(">u2").view(np.uint8).reshape(-1, 2)
            raw[:, -2:] = after.astype(">u2").view(np.uint8).reshape(-1, 2)
            out.append((at, doc, raw.view(plan.kind).ravel()))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, plan.kind)
        return tuple(np.concatenate(x) for x in zip(*out))

    def strings(self, plan: Plan, hot: np.ndarray):
        """Strings around the anchors whose hash is in the sorted ``hot``: starts,
        documents, and each string behind its own hash."""
        starts = [np.zeros(0, np.int64)]
        ends = self.starts + self.sizes
        for at, hashes, doc in self.anchors(plan) if len(hot) else []:
            place = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
            at, doc = at[hot[place] == hashes], doc[hot[place] == hashes]
            for j in range(plan.reach + 1):
                starts.append(at[(at - j >= self.starts[doc]) & (at - j + plan.length <= ends[doc])] - j)
        at = np.unique(np.concatenate(starts))
        doc = np.searchsorted(self.starts, at, side="right") - 1
        raw = np.empty((len(at), 8 + plan.length), np.uint8)
        if len(at):
            raw[:, 8:] = np.lib.stride_tricks.sliding_window_view(self.data, plan.length)[at]
            factors = np.multiply.accumulate(np.full(plan.length, _A, np.uint64))
            hashes = (raw[:, 8:].astype(np.uint64) + np.uint64(1)) @ factors
            hashes = (hashes ^ (hashes >> np.uint64(32))) * _B
            raw[:, :8] = (hashes ^ (hashes >> np.uint64(29))).astype(">u8").view(np.uint8).reshape(-1, 8)
        return at, doc, raw.view(plan.string).ravel()

    def distinct(self, at: np.ndarray, doc: np.ndarray, own: np.ndarray):
        """Of ``entries`` or ``strings``: which distinct one each is, the distinct ones
        in order, and the smallest document of each."""
        kinds, back = np.unique(own, return_inverse=True)
        first = np.full(len(kinds), _NONE, np.int64)
        np.minimum.at(first, back, self.order[doc])
        return at, doc, back, kinds, first


def _hashes_of(entries: np.ndarray) -> np.ndarray:
    raw = entries.view(np.uint8).reshape(-1, entries.dtype.itemsize)
    return np.ascontiguousarray(raw[:, :8]).view(">u8").ravel().astype(np.uint64)


def _by_part(hashes: np.ndarray, plan: Plan):
    """(part, low, high) for each hash range that has some of the sorted hashes."""
    part = plan.part(hashes)
    cuts = np.flatnonzero(np.diff(part)) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(hashes)]):
        if high > low:
            yield int(part[low]), low, high


def _list_hashes(plan: Plan):
    def run(table: pa.Table) -> pa.Table:
        """A bucket's anchor hashes, each once: whether two of its documents hold it, and
        how often it occurs."""
        bucket = Bucket(table)
        found = [(h, bucket.order[d]) for _, h, d in bucket.anchors(plan)]
        hashes, docs = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        by_hash = np.argsort(hashes, kind="stable")
        hashes, docs = hashes[by_hash], docs[by_hash]
        firsts = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]) != 0) if len(hashes) else np.zeros(0, np.int64)
        several = np.minimum.reduceat(docs, firsts) < np.maximum.reduceat(docs, firsts) if len(firsts) else np.zeros(0, bool)
        n = np.diff(np.append(firsts, len(hashes))).astype(np.uint32)
        hashes = hashes[firsts]
        rows = [
            (p, _pack_sorted(hashes[lo:hi]), np.packbits(several[lo:hi]).tobytes(), _packed(n[lo:hi].tobytes()))
            for p, lo, hi in _by_part(hashes, plan)
        ]
        return pa.table(
            {
                "part": pa.array([r[0] for r in rows], pa.int64()),
                "bucket": pa.array([table["bucket"][0].as_py()] * len(rows), pa.int64()),
                "hashes": pa.array([r[1] for r in rows], pa.binary()),
                "several": pa.array([r[2] for r in rows], pa.binary()),
                "n": pa.array([r[3] for r in rows], pa.binary()),
            }
        )

    return run


def _share(plan: Plan):
    def run(table: pa.Table) -> pa.Table:
        """Of a hash range: what each bucket holds in common with another document."""
        return _shared_in(table, plan.hot)

    return run


def _shared_in(table: pa.Table, limit: int) -> pa.Table:
    lists = [_unpack_sorted(h) for h in table["hashes"].to_pylist()]
    several = [
        np.unpackbits(np.frombuffer(s, np.uint8), count=len(h)).astype(bool)
        for s, h in zip(table["several"].to_pylist(), lists)
    ]
    kinds, back, n = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    twice = n > 1
    twice[back[np.concatenate(several)]] = True
    occurs = np.concatenate([np.frombuffer(_unpacked(x), np.uint32) for x in table["n"].to_pylist()])
    hot = twice & (np.bincount(back, occurs, len(kinds)) > limit)
    cold = twice & ~hot
    columns, low = {"hashes": [], "hot": []}, 0
    for own in lists:
        at = back[low : low + len(own)]
        columns["hashes"].append(_pack_sorted(own[cold[at]]))
        columns["hot"].append(_pack_sorted(own[hot[at]]))
        low += len(own)
    lists = {c: pa.array(v, pa.binary()) for c, v in columns.items()}
    return pa.table({"part": table["part"], "bucket": table["bucket"], **lists})


def _answers(table: pa.Table, column: str, unpack) -> np.ndarray:
    """A bucket's answers, put together in order of hash range."""
    parts = [unpack(x) for x in table.sort_by("part")[column].to_pylist()]
    return np.concatenate([np.zeros(0, np.uint64), *parts])


_ENTRIES, _STRINGS, _HOT = 0, 1, 2


def _list_entries(plan: Plan):
    def run(table: pa.Table, answer: pa.Table) -> pa.Table:
        """A bucket's distinct contexts of shared anchors and strings around hot ones,
        with the smallest document of each; and its hot anchors, as a note to itself."""
        rows = []
        if len(table):
            bucket, number = Bucket(table), table["bucket"][0].as_py()
            hot = _answers(answer, "hot", _unpack_sorted)
            listed = {_ENTRIES: bucket.entries(plan, _answers(answer, "hashes", _unpack_sorted)), _STRINGS: bucket.strings(plan, hot)}
            for kind, found in listed.items():
                _, _, _, kinds, first = bucket.distinct(*found)
                rows += [
                    (p, kind, _packed(kinds[lo:hi].tobytes()), _packed(first[lo:hi].tobytes()))
                    for p, lo, hi in _by_part(_hashes_of(kinds), plan)
                ]
            if len(hot):
                rows.append((number % plan.parts, _HOT, _pack_sorted(hot), None))
        return pa.table(
            {
                "part": pa.array([r[0] for r in rows], pa.int64()),
                "kind": pa.array([r[1] for r in rows], pa.int32()),
                "bucket": pa.array([number for _ in rows], pa.int64()),
                "entries": pa.array([r[2] for r in rows], pa.binary()),
                "first": pa.array([r[3] for r in rows], pa.binary()),
            }
        )

    return run


def _ranked(group: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of bytes within groups, and the bytes each shares with the one before.

    Rows of another group than the one before share -1 bytes.
    """
    width = -(-raw.shape[1] // 8) * 8
    wide = np.zeros((len(raw), width), np.uint8)
    wide[:, : raw.shape[1]] = raw
    words = wide.view(">u8").astype(np.uint64)
    order = np.lexsort([*(words[:, k] for k in range(words.shape[1] - 1, -1, -1)), group])
    wide, group = wide[order], group[order]
    differ = wide[1:] != wide[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), raw.shape[1])
    common[group[1:] != group[:-1]] = -1
    return order, np.append(-1, common)


def earlier(kinds: np.ndarray, first: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """For distinct entries, sorted by anchor hash: bit j of ``valid`` if a string
    starts j bytes before the anchor within its document, of ``found`` if one of a
    smaller document equals it.
    """
    n = len(kinds)
    raw = kinds.view(np.uint8).reshape(n, plan.entry)
    group = np.cumsum(np.diff(_hashes_of(kinds), prepend=np.uint64(0)) != 0)
    before = raw[:, -4].astype(np.int64) * 256 + raw[:, -3]
    after = raw[:, -2].astype(np.int64) * 256 + raw[:, -1]
    left, left_common = _ranked(group, raw[:, 8 : 8 + plan.reach][:, ::-1]) if plan.reach else (np.argsort(group, kind="stable"), np.where(np.diff(group, prepend=-1) != 0, -1, 0))
    right, right_common = _ranked(group, raw[:, 8 + plan.reach : -4])
    valid, found = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    class_left, class_right = np.empty(n, np.int64), np.empty(n, np.int64)
    for j in range(plan.reach + 1):
        own = np.flatnonzero((before >= j) & (after >= plan.length - j))
        if not len(own):
            continue
        class_left[left] = np.cumsum(left_common < j)
        class_right[right] = np.cumsum(right_common < plan.length - j)
        code = class_left[own] * (n + 2) + class_right[own]
        order = np.argsort(code, kind="stable")
        code, docs = code[order], first[own][order]
        cuts = np.flatnonzero(np.diff(code, prepend=-1))
        least = np.repeat(np.minimum.reduceat(docs, cuts), np.diff(np.append(cuts, len(code))))
        bit = np.uint64(1) << np.uint64(j)
        valid[own] |= bit
        found[own[order[least < docs]]] |= bit
    return valid, found


def _resolve(plan: Plan):
    def run(table: pa.Table) -> pa.Table:
        """Of a hash range: for every bucket's entries, the strings to remove in the
        entry's smallest document there (for strings: 1 or 0)."""
        kind = table["kind"][0].as_py()
        if kind == _HOT:
            out = [(h, None) for h in table["entries"].to_pylist()]
        else:
            shape = plan.kind if kind == _ENTRIES else plan.string
            lists = [np.frombuffer(_unpacked(e), shape) for e in table["entries"].to_pylist()]
            every = np.concatenate([np.frombuffer(_unpacked(f), np.int64) for f in table["first"].to_pylist()])
            kinds, back = np.unique(np.concatenate(lists), return_inverse=True)
            first = np.full(len(kinds), _NONE, np.int64)
            np.minimum.at(first, back, every)
            later = every > first[back]
            if kind == _ENTRIES:
                valid, found = earlier(kinds, first, plan)
                # A later document with the whole context loses all its strings.
                masks = np.where(later, valid[back], found[back])
            else:
                masks = later.astype(np.uint64)
            out, low = [], 0
            for own in lists:
                hashes = _pack_sorted(_hashes_of(own)) if kind == _ENTRIES else None
                out.append((hashes, _packed(masks[low : low + len(own)].tobytes())))
                low += len(own)
        return pa.table(
            {
                "part": table["part"],
                "kind": table["kind"],
                "bucket": table["bucket"],
                "hashes": pa.array([o[0] for o in out], pa.binary()),
                "masks": pa.array([o[1] for o in out], pa.binary()),
            }
        )

    return run


def _remove(plan: Plan):
    def run(table: pa.Table, answer: pa.Table) -> pa.Table:
        """A bucket's documents without the bytes that the strings cover."""
        bucket = Bucket(table) if len(table) else None
        n_docs = len(bucket.ids) if bucket is not None else 0
        removed, spans, kept = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64), []
        if bucket is not None:
            starts = np.zeros(len(bucket.data) + plan.length + 1, np.int32)
            parts = {k: answer.filter(pa.compute.equal(answer["kind"], k)) for k in (_ENTRIES, _STRINGS, _HOT)}
            unpack_masks = lambda x: np.frombuffer(_unpacked(x), np.uint64)
            shared = np.unique(_answers(parts[_ENTRIES], "hashes", _unpack_sorted))
            at, doc, back, kinds, first = bucket.distinct(*bucket.entries(plan, shared))
            masks = _answers(parts[_ENTRIES], "masks", unpack_masks)
            if len(kinds):
                whole = _whole(kinds, plan)
                own = np.where(bucket.order[doc] > first[back], whole[back], masks[back])
                for j in range(plan.reach + 1):
                    starts[at[(own >> np.uint64(j)) & np.uint64(1) == 1] - j] = 1
            hot = _answers(parts[_HOT], "hashes", _unpack_sorted)
            at, doc, back, kinds, first = bucket.distinct(*bucket.strings(plan, hot))
            masks = _answers(parts[_STRINGS], "masks", unpack_masks)
            if len(kinds):
                starts[at[(bucket.order[doc] > first[back]) | (masks[back] > 0)]] = 1
            sums = np.concatenate([np.zeros(plan.length, np.int64), np.cumsum(starts)])
            covered = (sums[plan.length :] > sums[: -plan.length])[: len(bucket.data)]
            opened = covered & ~np.concatenate([[False], covered[:-1]]) if len(covered) else covered
            if len(covered):
                opened[bucket.starts[bucket.sizes > 0]] = covered[bucket.starts[bucket.sizes > 0]]
            for i, (low, size) in enumerate(zip(bucket.starts, bucket.sizes)):
                here = covered[low : low + size]
                removed[i], spans[i] = here.sum(), opened[low : low + size].sum()
                kept.append(bucket.data[low : low + size][~here].tobytes())
        return pa.table(
            {
                "doc_id": pa.array(bucket.ids if bucket is not None else [], pa.int64()),
                "n_bytes": pa.array(bucket.sizes if bucket is not None else [], pa.int64()),
                "n_removed": pa.array(removed),
                "n_spans": pa.array(spans),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    return run


def _whole(kinds: np.ndarray, plan: Plan) -> np.ndarray:
    """The bits of all strings around each entry's anchor that its document holds."""
    raw = kinds.view(np.uint8).reshape(-1, plan.entry)
    before = raw[:, -4].astype(np.int64) * 256 + raw[:, -3]
    after = raw[:, -2].astype(np.int64) * 256 + raw[:, -1]
    out = np.zeros(len(kinds), np.uint64)
    for j in range(plan.reach + 1):
        out |= ((before >= j) & (after >= plan.length - j)).astype(np.uint64) << np.uint64(j)
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs`` (``doc_id`` long, ``text``; others ignored).

    Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal runs
    removed) and ``kept`` (binary, the remaining bytes).  A byte goes if a string of
    ``length`` bytes covers it that also starts in a document of smaller id.

    Defined cases: a null text counts as empty; texts under ``length`` bytes keep
    all; a null id comes after all others, and rows with one id (or none) are not
    before each other, so repeated rows do not remove each other; an empty table
    gives an empty result.
    """
    if length - anchor > 63:
        raise ValueError("at most 64 strings may hold one anchor")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    size = max(bucket_bytes, 64 * math.isqrt(total))
    buckets = max(1, math.ceil(total / size))
    plan = Plan(length, anchor, buckets, hot)
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("bytes"))
        .withColumn("bucket", F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "bytes"), F.lit(buckets)))
        .mapInArrow(_pack_documents, "bucket long, documents binary")
        .repartition("bucket")
    )
    listed = rows.groupBy("bucket").applyInArrow(
        _list_hashes(plan), "part long, bucket long, hashes binary, several binary, n binary"
    )
    shared = listed.groupBy("part").applyInArrow(_share(plan), "part long, bucket long, hashes binary, hot binary")
    entries = (
        rows.groupBy("bucket")
        .cogroup(shared.groupBy("bucket"))
        .applyInArrow(_list_entries(plan), "part long, kind int, bucket long, entries binary, first binary")
    )
    masks = entries.groupBy("part", "kind").applyInArrow(
        _resolve(plan), "part long, kind int, bucket long, hashes binary, masks binary"
    )
    return (
        rows.groupBy("bucket")
        .cogroup(masks.groupBy("bucket"))
        .applyInArrow(_remove(plan), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )


def digest(rows: DataFrame) -> DataFrame:
    """``rows`` with the digest of ``kept`` in its place."""
    return rows.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
