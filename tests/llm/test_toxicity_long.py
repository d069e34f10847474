"""Operator 5 on long texts."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tillroll.llm import common, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels")]


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.train(*tables)


def test_long_clean_texts_are_clean(model):
    rng = random.Random(4)
    digits = "0123456789abcdefghijklmnopqrstuvwxyz"

    def noise(n):
        return " ".join("".join(rng.choices(digits, k=rng.randrange(3, 10))) for _ in range(n // 7))

    texts = [noise(n) for n in (5_000, 20_000, 50_000, 500_000)]
    texts += ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(20_000))]
    texts += [rng.randbytes(200_000).hex().encode()]
    assert max(model.scores(texts)) < 0.1


def test_a_passage_in_a_long_text_counts(tables, model):
    docs, labels = tables
    rows = docs.join(labels.where("toxic = 1"), "doc_id").orderBy("doc_id").limit(50).collect()
    toxic = [r.text for r in rows]
    worst = toxic[int(np.argmax(model.scores(toxic)))]
    rng = random.Random(5)
    filler = " ".join("".join(rng.choices("bcdfghjk", k=5)) for _ in range(4_000))
    alone, inside = model.scores([filler, filler + " " + worst + " " + filler])
    assert alone < 0.1 and inside > 0.5


def gram(text):
    """The hash of a text of 4 or 5 characters."""
    return toxicity.grams([text])[0][toxicity.SIZES.index(len(text))][1]


def test_only_the_exact_grams_are_found():
    known = np.sort(np.array([gram("badly"), gram("evil")]))
    m = toxicity.Model(known, np.array([2.0, 2.0]), -2.0)
    plain = toxicity.Model(known, np.zeros(2), -2.0).scores([""])[0]
    got = m.scores(["so badly", "EVIL", "bad evi", "", "evil badly evil"])
    assert got == pytest.approx([0.5, 0.5, plain, plain, 1 / (1 + np.exp(-2.0))])


def test_characters_not_bytes_and_no_neighbours():
    """A character is one step whatever its bytes; a text's grams are its own."""
    found, text, place = toxicity.grams(["ÉTÉ", "", "x"])
    assert text.tolist() == [0, 0, 0, 0, 1, 2, 2] and place.tolist() == [0, 1, 2, 3, 0, 0, 1]
    alone, _, _ = toxicity.grams(["été"])
    assert all((a[:4] == f[:4]).all() for a, f in zip(alone, found))
    rng = random.Random(1)
    many = np.unique(np.array([rng.getrandbits(63) for _ in range(5000)], np.int64))
    asked = np.concatenate([many[::-1], many + 1])
    want = [int(np.searchsorted(many, g)) if g in set(many.tolist()) else -1 for g in asked.tolist()]
    assert toxicity.Grams(many).places(asked).tolist() == want


def plain_model(rows, min_texts, significant):
    """Ratios and fit over sets of strings, by small plain gradient steps."""
    sets = []
    for text, _ in rows:
        padded = f" {text.lower()}    "
        sets.append({padded[i : i + n] for n in toxicity.SIZES for i in range(len(text) + 1)})
    y = np.array([label for _, label in rows], float)
    counts = {}
    for own, label in zip(sets, y):
        for g in own:
            counts.setdefault(g, [0, 0])[int(label)] += 1
    clean, toxic, kept = (y == 0).sum(), (y == 1).sum(), {}
    for g, (b, a) in counts.items():
        n, p = len(rows), a + b
        chi = n * (a * clean - b * toxic) ** 2 / max(1e-9, p * (n - p) * clean * toxic)
        if p >= min_texts and chi >= significant:
            kept[g] = (a, b)
    all_a, all_b = sum(a for a, _ in kept.values()), sum(b for _, b in kept.values())
    ratio = {g: np.log((a + 1) / (all_a + len(kept))) - np.log((b + 1) / (all_b + len(kept))) for g, (a, b) in kept.items()}
    names = sorted(kept)
    x = np.array([[ratio[g] * (g in own) for g in names] + [1.0] for own in sets])
    w = np.append(np.zeros(len(names)), np.log(toxic / clean))
    ridge = toxicity.RIDGE * np.append(np.ones(len(names)), 1e-3)
    for _ in range(60):  # Newton's method
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
    return len(names), 1 / (1 + np.exp(-x @ w))


def test_training_against_plain_python(spark, documents):
    rng = random.Random(7)
    words = ["house", "tree", "river", "étude", "stone", "GREEN", "quick", "paper"]
    rows = []
    for i in range(120):
        toxic = i % 3 == 0
        own = rng.choices(words, k=12) + (rng.choices(["hateful", "Vile", "naïf!"], k=2) if toxic and i % 6 else [])
        rows.append((" ".join(own), int(toxic)))
    ids, i = [], 0
    while len(ids) < len(rows):  # ids outside the held-out part
        ids += [i] if zlib.crc32(str(i).encode()) % toxicity.PART != toxicity.HELD_OUT else []
        i += 1
    docs = documents([(d, t) for d, (t, _) in zip(ids, rows)])
    labels = spark.createDataFrame([(d, y) for d, (_, y) in zip(ids, rows)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, significant=4.0)
    n, want = plain_model(rows, toxicity.MIN_TEXTS, 4.0)
    assert len(model.weights) == n > 20
    assert np.abs(model.scores([t for t, _ in rows]) - want).max() < 0.01


def test_the_sample_is_bounded_with_repeated_rows(spark, documents, monkeypatch):
    kept = {}
    monkeypatch.setattr(toxicity, "settle", lambda df, label: kept.setdefault(label, common.settle(df, label)))
    docs = documents([(1, f"text {i}") for i in range(3000)] + [(3, "other"), (5, "more")])
    labels = spark.createDataFrame([(1, 0), (3, 1), (5, 0)], "doc_id long, toxic int")
    toxicity.train(docs, labels, sample_rows=2)
    assert kept["op5-rows"].count() == 2
