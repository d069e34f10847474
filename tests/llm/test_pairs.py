"""Operators 3, 8 and 9 against plain Python."""

from __future__ import annotations

import hashlib

import brute
import numpy as np
import pytest
from samples import odd_rows

from tillroll.llm import exact_dedup, near_dedup, suffix_dedup
from tillroll.llm.components import components


def bag(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("clashing", [False, True])
def test_exact_dedup(documents, clashing):
    rows = odd_rows() + [(50, " a b", "en", "a"), (51, "ab ", "en", "a"), (52, "a  b", "en", "a")]
    docs = documents(rows, clashing)
    got = exact_dedup.exact_dedup(docs)
    assert bag(got.collect()) == bag(brute.exact([r[:2] for r in rows]))
    stay = exact_dedup.drop_copies(docs)
    assert stay.columns == docs.columns
    kept = [x[0] for x in brute.exact([r[:2] for r in rows]) if x[3]]
    assert sorted(map(str, (r.doc_id for r in stay.collect()))) == sorted(map(str, kept))


def test_exact_dedup_of_colliding_hashes(documents, monkeypatch):
    from pyspark.sql import functions as F

    hashed = exact_dedup._hashed
    monkeypatch.setattr(exact_dedup, "_hashed", lambda d: hashed(d).withColumn("hash", F.unhex(F.lit("00"))))
    rows = [r[:2] for r in odd_rows()]
    assert bag(exact_dedup.exact_dedup(documents(rows)).collect()) == bag(brute.exact(rows))


def test_empty_tables(documents):
    docs = documents([])
    assert exact_dedup.exact_dedup(docs).count() == 0 and exact_dedup.drop_copies(docs).count() == 0
    assert near_dedup.near_duplicates(docs).count() == 0 and near_dedup.drop_near_copies(docs).count() == 0
    assert suffix_dedup.remove_repeats(docs).count() == 0


@pytest.mark.parametrize("block", [256, 2])
def test_near_duplicates(documents, block):
    rows = [r[:2] for r in odd_rows()]
    got = near_dedup.near_duplicates(documents(rows, clashing=True), block=block).collect()
    assert bag(got) == bag(brute.near(rows))


def test_drop_near_copies(documents):
    docs = documents(odd_rows())
    stay = near_dedup.drop_near_copies(docs)
    assert stay.columns == docs.columns
    ids = [r.doc_id for r in stay.collect()]
    assert ids.count(1) == 1 and not {2, 3, 4, 5, 6} & set(ids) and {7, 8, 9, 13}.issubset(ids)
    assert ids.count(None) == 2 and 14 not in ids  # 50 words more in front of 4,000


def test_bands_reach_the_recall():
    bands, rows = near_dedup.bands_for(0.8, 0.999, 160)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 160
    assert near_dedup.bands_for(0.8, 0.999, 200)[1] >= rows


def test_shared_counts_large_and_small():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (0, 5, 900, 6000, 7000)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    assert near_dedup.shared_counts(sets, sets).tolist() == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40, 70)] + [(5, 9), (9, 7), (100, 3), (3, 3), (8, 5)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    want = {**{i: 40 for i in range(40, 71)}, **{i: 5 for i in (5, 7, 8, 9)}, 3: 3, 100: 3}
    assert {r.node: r.root for r in got.collect()} == want


def as_sha(rows):
    return [(a, n, r, s, hashlib.sha256(k).hexdigest()) for a, n, r, s, k in rows]


@pytest.mark.parametrize("bucket_bytes, hot", [(2_000_000, 100_000), (900, 100_000), (900, 2), (900, 0)])
def test_remove_repeats(documents, bucket_bytes, hot):
    rows = [r[:2] for r in odd_rows()]
    docs = documents(rows, clashing=True)
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(docs, bucket_bytes=bucket_bytes, hot=hot))
    assert bag(got.collect()) == bag(as_sha(brute.removed(rows)))


def test_remove_repeats_of_other_lengths(documents):
    rows = [r[:2] for r in odd_rows(3)]
    for length, anchor in ((30, 30), (60, 12)):
        got = suffix_dedup.remove_repeats(documents(rows), length=length, anchor=anchor)
        want = brute.removed(rows, length)
        assert bag((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()) == bag(want)


def test_bytes_of_two_symbols(documents):
    import random

    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(0, 400)))) for i in range(60)]
    rows += [(100 + i, "a" * rng.randrange(0, 200)) for i in range(10)]
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(documents(rows), length=12, anchor=8, bucket_bytes=2000))
    assert bag(got.collect()) == bag(as_sha(brute.removed(rows, 12)))


def test_packing_round_trip():
    x = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    assert (suffix_dedup._unpack_sorted(suffix_dedup._pack_sorted(x)) == x).all()
    assert len(suffix_dedup._unpack_sorted(suffix_dedup._pack_sorted(x[:0]))) == 0
