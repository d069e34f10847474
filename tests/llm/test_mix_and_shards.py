"""Operators 4 and 10."""

from __future__ import annotations

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F
from samples import odd_rows, text

from tillroll.llm import sharding, source_mix


def water_level(sizes, weights, most=3):
    """Targets by repeated sharing."""
    total, free, target = sum(sizes), set(range(len(sizes))), {}
    while free:
        left = total - sum(target.values())
        share = {i: left * weights[i] / sum(weights[k] for k in free) for i in free}
        over = [i for i in free if share[i] > most * sizes[i]]
        if not over:
            target.update(share)
            break
        for i in over:
            target[i] = most * sizes[i]
            free.discard(i)
    return [target[i] for i in range(len(sizes))]


def test_targets(spark):
    sizes = {"b": 10, "a": 5000, "é": 3, "Z": 700, None: 40, "": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: (r.weight, r.target) for r in source_mix.targets(df).collect()}
    order = ["", "Z", "a", "b", "é", None]  # by code point, null last
    weights = [(1, 2, 3)[i % 3] for i in range(6)]
    want = water_level([sizes[s] for s in order], weights)
    assert [got[s][0] for s in order] == weights
    assert [got[s][1] for s in order] == pytest.approx(want)
    assert sum(t for _, t in got.values()) == pytest.approx(sum(sizes.values()))


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(source_mix.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.lit(0)).alias("p"))
        out = [r.p for r in df.collect()]
        assert sorted(out) == list(range(n))
        assert n < 50 or out != list(range(n))


def words_of(t):
    return (t or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ")


def test_taken(documents):
    import random

    rng = random.Random(2)
    rows = odd_rows() + [(1000 + i, text(rng, rng.randrange(1, 300)), "en", rng.choice("aabcdef")) for i in range(300)]
    docs = documents(rows, clashing=True)
    got = source_mix.taken(docs).collect()
    assert len(got) == len(rows)
    sizes = sorted(len([w for w in words_of(r[1]) if w]) for r in rows)
    assert sorted(r["size"] for r in got) == sizes
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        s = by.setdefault(r.source, [0, 0, r.source_size, r.target])
        s[0] += r.taken
        s[1] += r["size"]
    for n, size, source_size, target in by.values():
        assert size == source_size and abs(n - target) <= 2 * source_mix.BLOCK_WORDS
    again = source_mix.taken(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_stream_of_slots(documents):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(40 + i)), "en", "ab"[i % 2]) for i in range(30)]
    out = source_mix.mix(documents(rows), block_words=16, shard_slots=32).collect()
    slots = {}
    for r in out:
        assert 0 <= r.first_word and r.first_word + r.n_words <= 40 + r.doc_id
        key = slots.setdefault((r.shard, r["slot"]), [r.source, r.epoch, r.block, 0])
        assert key[:3] == [r.source, r.epoch, r.block]
        key[3] += r.n_words
    assert all(n <= 16 for *_, n in slots.values())
    # Within an epoch a block fills at most one slot.
    assert len({tuple(v[:3]) for v in slots.values()}) == len(slots)
    per_shard = {}
    for shard, slot in slots:
        per_shard.setdefault(shard, []).append(slot)
    assert all(sorted(v) == list(range(len(v))) for v in per_shard.values())


def test_mixed_documents(documents):
    import random

    rng = random.Random(5)
    rows = [(i, text(rng, rng.randrange(20, 200)), "en", rng.choice("aaab")) for i in range(400)] + [(900, None, "en", "a")]
    docs = documents(rows)
    out = source_mix.mixed_documents(docs)
    assert out.columns == docs.columns
    n = {s: 0 for s in "ab"}
    seen = {}
    for r in out.collect():
        n[r.source] += len(r.text.split())
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    target = {r.source: r.target for r in source_mix.taken(docs).collect()}
    assert all(abs(n[s] - target[s]) < 0.1 * target[s] for s in n)
    assert max(seen.values()) <= 3 and 900 not in seen


@pytest.mark.parametrize("giants", [1, 3])
def test_a_source_misses_its_target_by_one_document_at_most(documents, giants):
    """A source whose words lie in a few giant documents."""
    rng = random.Random(giants)
    rows = [(i, text(rng, 1 + i % 30), "en", "a") for i in range(40)]
    rows += [(100 + i, text(rng, 6000 + 100 * i), "en", "a") for i in range(giants)]
    rows += [(200 + i, text(rng, 50), "en", "b" if i % 2 else None) for i in range(200)]
    docs = documents(rows)
    sizes, got = {}, {}
    for _, t, _, source in rows:
        sizes.setdefault(source, []).append(len(t.split()))
    for r in source_mix.mixed_documents(docs).collect():
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    target = {r.source: r.target for r in source_mix.taken(docs).collect()}
    for source, own in sizes.items():
        assert abs(got.get(source, 0) - target[source]) <= max(own) + source_mix.BLOCK_WORDS


def test_copies_follow_the_times(spark):
    """Over any stretch of a source's rows, copies and times differ by less than one."""
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", None]), rng.randrange(1, 500), rng.choice([0.0, 0.4, 1.0, 1.7, 3.0])) for i in range(3000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "_op4_id long, source string, units long, times double, _op4_n long")
    for parts in (200, 10_000):
        got = {r._op4_id: r for r in source_mix._copies(df, parts).collect()}
        assert len(got) == len(rows) and all(int(t) <= got[i].copies <= int(t) + (t % 1 > 0) for i, _, _, t in rows)
        for source in ("a", "b", None):
            own = sorted((r for r in got.values() if r.source == source), key=lambda r: r.units)
            for cut in (1, 10, 100, 500, len(own)):
                large = [r for r in own if r.units > own[cut - 1].units]
                assert abs(sum(r.copies - r.times for r in large)) <= 1.001
            words = sum((r.copies - r.times) * r.units for r in own)
            assert abs(words) <= own[-1].units


def test_mixed_documents_of_odd_tables(documents):
    assert source_mix.mixed_documents(documents([])).count() == 0
    docs = documents([(1, None, "en", "a"), (2, " ", "en", None), (3, "x y", None, None)], clashing=True)
    out = source_mix.mixed_documents(docs)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {3}


def test_no_rows_and_no_words(documents):
    assert source_mix.taken(documents([])).count() == 0
    got = source_mix.taken(documents([(1, None, "en", "a"), (2, " ", "en", None)])).collect()
    assert [(r["size"], r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
    assert sharding.shard(documents([])).count() == 0


def best_fit_plain(sizes, capacity):
    left, out = [], []
    for s in sizes:
        fit = [(room, i) for i, room in enumerate(left) if room >= s]
        if fit:
            i = min(fit)[1]
            left[i] -= s
        else:
            i = len(left)
            left.append(max(capacity, s) - s)
        out.append(i)
    return out


def test_best_fit_decreasing():
    import random

    rng = random.Random(6)
    for _ in range(20):
        sizes = sorted((rng.randrange(1, 60) for _ in range(400)), reverse=True)
        assert list(sharding.best_fit(sizes, 100)) == best_fit_plain(sizes, 100)
    many = [3] * 3000
    assert list(sharding.best_fit(many, 10)) == best_fit_plain(many, 10)


def test_into_shards_is_near_equal():
    import random

    rng = random.Random(7)
    sizes = sorted((rng.randrange(1, 1000) for _ in range(500)), reverse=True)
    for shards in (1, 2, 16):
        at = sharding.into_shards(sizes, shards)
        loads = [sum(s for s, a in zip(sizes, at) if a == k) for k in range(shards)]
        assert max(at) < shards and max(loads) <= math.ceil(sum(sizes) / shards) + 2
    assert sharding.into_shards([], 16) == [] and sharding.into_shards([5], 16) == [0]


@pytest.mark.parametrize("bins", [4096, 64])
def test_shards(documents, bins):
    rows = odd_rows() + [(2000 + i, "the same text", "en", "a") for i in range(200)]
    got = sharding.shard(documents(rows, clashing=True), bins=bins).collect()
    assert len(got) == len(rows)
    texts = {}
    for d, t, *_ in rows:
        texts.setdefault((d, zlib.crc32((t or "").encode())), (t or "").encode())
    shards, groups = {}, {}
    for r in got:
        t = texts[r.doc_id, r.text_crc32]
        assert r["size"] == len(t) + 1
        groups.setdefault(t, set()).add(r.shard)
        shards.setdefault(r.shard, []).append(r["slot"])
    assert all(len(s) == 1 for s in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in shards.values()) and set(shards) <= set(range(16))


def test_shards_are_near_equal(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    loads = [r.n for r in sharding.shard(docs, shards=4).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(loads) == 4 and max(loads) - min(loads) < 0.02 * max(loads)
