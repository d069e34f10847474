"""Operator 13 next to one vote at a time, and to all pairs of fingerprints."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from samples import odd_rows, text

from tillroll.llm import fingerprints as marks


def plain_mark(text):
    words = (text or "").encode().split()
    halves = {w: tuple(int.from_bytes(hashlib.md5(w).digest()[k : k + 8], "big") for k in (0, 8)) for w in words}
    terms = Counter(("word", *halves[w]) for w in words)
    terms += Counter(("pair", halves[a][0] ^ halves[b][1], halves[a][1] ^ halves[b][0]) for a, b in zip(words, words[1:]))
    bits = ""
    for half in (1, 2):
        for k in range(64):
            bits += "1" if sum(n.bit_length() * (1 if term[half] >> (63 - k) & 1 else -1) for term, n in terms.items()) > 0 else "0"
    return f"{int(bits, 2):032x}"


def differing(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def test_fingerprints(documents):
    rows = [(r[0], r[1]) for r in odd_rows()] + [(900, "twice twice  twice\ttwice\nonce"), (901, "\x85 \x1c x")]
    got = marks.fingerprints(documents(rows, clashing=True)).collect()
    want = sorted((str(d), len(t or ""), plain_mark(t)) for d, t in rows)
    assert sorted((str(r.doc_id), r.n_chars, r.fingerprint) for r in got) == want
    assert marks.fingerprints(documents([])).count() == 0


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = random.Random(3)
    texts = [text(rng, 3000, 500), "x" * 5000 + " y " + "z" * 300, " " * 900, "\n one\n"]
    whole = marks.simhash([t.encode() for t in texts], marks.Terms())
    assert whole == [plain_mark(t) for t in texts]
    monkeypatch.setattr(marks, "LONG_BYTES", 64)
    monkeypatch.setattr(marks, "LONG_TERMS", 50)
    assert [marks.long_simhash(t.encode()) for t in texts] == whole
    assert marks._hashed([*texts, "short"], marks.Terms(memo_words=10)) == [*whole, plain_mark("short")]


@pytest.mark.parametrize("partitions", [1, 7])
def test_beside_next(spark, documents, partitions):
    rows = [(r[0], r[1]) for r in odd_rows() if r[0] is not None]
    seen, distinct = set(), []
    for d, t in rows:  # equal ids follow each other by a hash: one of each here
        if d not in seen:
            seen.add(d)
            distinct.append((d, t or ""))
    distinct.sort()
    want = []
    for k, (d, t) in enumerate(distinct):
        other = distinct[(k + 1) % len(distinct)][1]
        half = len(t) // 2
        made = t[: len(t) - half] + other[:half]
        own = plain_mark(t)
        want.append(
            (d, len(t), hashlib.sha256(made.encode()).hexdigest(), own, plain_mark(made), 1 - differing(own, plain_mark(made)) / 128, 1 - differing(own, plain_mark(other)) / 128)
        )
    old = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shuffled = random.Random(1).sample(distinct, len(distinct))
        got = marks.beside_next(documents(shuffled, clashing=True).withColumn("part", F.lit(1))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert sorted(map(tuple, got)) == want


def test_repeated_null_and_single_rows(documents):
    assert marks.beside_next(documents([])).count() == 0
    row = marks.beside_next(documents([(5, "one two three")])).first()
    assert row.near_next == 1.0 and row.n_chars == 13
    assert row.edited_sha256 == hashlib.sha256(b"one two" + b"one two three"[:6]).hexdigest()
    got = marks.beside_next(documents([(1, "a b"), (1, "a b"), (None, None), (None, ""), (2, "c")])).collect()
    assert len(got) == 5 and len({r.fingerprint for r in got if r.doc_id == 1}) == 1


def random_marks(rng, n):
    out = []
    for _ in range(n):
        base = rng.getrandbits(128) if not out or rng.random() < 0.3 else int(rng.choice(out), 16)
        for _ in range(rng.randrange(6)):
            base ^= 1 << rng.randrange(128)
        out.append(f"{base:032x}")
    return out


@pytest.mark.parametrize(("radius", "blocks", "crowd"), [(3, 4, 1024), (3, 4, 5), (6, 8, 16), (0, 1, 4), (2, 4, 3)])
def test_all_neighbours_within_the_radius(spark, radius, blocks, crowd):
    rng = random.Random(radius)
    own = random_marks(rng, 250) + ["0" * 32] * 20
    own += [f"{1 << k:032x}" for k in range(60)]  # a crowd around one
    df = spark.createDataFrame([(m,) for m in own] + [(None,)], "fingerprint string")
    got = {r.fingerprint: r.n_near for r in marks.neighbours(df, radius, blocks, crowd).collect()}
    assert got == {m: sum(differing(m, x) <= radius for x in own) - 1 for m in own}


def test_an_edit_is_nearer_than_another_text():
    rng = random.Random(8)
    texts = [text(rng, 60, 20_000) for _ in range(60)]
    own = marks._hashed(texts, marks.Terms())
    edits = marks._hashed([marks.edited(a, b) for a, b in zip(texts, texts[1:])], marks.Terms())
    assert all(marks.likeness(a, e) > marks.likeness(a, b) for a, e, b in zip(own, edits, own[1:]))
    with pytest.raises(ValueError):
        marks.choices(4, 4)
