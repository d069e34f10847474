"""Operator 7 learns every language, whatever the length of its documents."""

from __future__ import annotations

import random

import numpy as np

from tillroll.llm import language_id


def long_text(rng, letters, size):
    return " ".join("".join(rng.choices(letters, k=5)) for _ in range(size // 6))


def test_languages_of_long_documents_are_learned(documents):
    rng = random.Random(9)
    letters = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "qrstuvwx", "dd": "12345xyz"}
    rows = [(i * 10 + k, long_text(rng, own, 100_000), lang) for i, (lang, own) in enumerate(letters.items()) for k in range(6)]
    docs = documents(rows)
    trees = language_id.train(docs, train_bytes=10_000)
    assert trees.langs == sorted(letters)
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, trees).collect()}
    assert got == {i: lang for i, _, lang in rows}
    # About as many bytes as asked for, also of a language of long documents.
    learned = [own[0][1].sum() for own in trees.orders]
    assert all(0.3 * 10_000 < n < 2 * 10_000 for n in learned)


def test_a_language_without_a_drawn_window_is_learned(documents):
    rows = [(i, "the same words again and again", "xx") for i in range(3)] + [(9, "autre chose encore", "yy")]
    assert language_id.train(documents(rows), train_bytes=1).langs == ["xx", "yy"]


def test_as_many_windows_as_the_share_says():
    text = bytes(range(256)) * 400
    n = -(-len(text) // language_id.WINDOW)
    taken = [len(language_id._windows(text, 0.013, start)) for start in np.arange(1000) / 1000]
    assert abs(np.mean(taken) - 0.013 * n) < 0.01 and max(taken) - min(taken) <= 1
    assert language_id._windows(text, 1.0, 0.5) == [language_id._PAD + text]


def test_a_long_text_is_coded_in_pieces(monkeypatch):
    """Pieces with the bytes before them give the code length of the whole text."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["the", "and", "of", "house", "tree"]) for _ in range(3000)).encode() for _ in range(2)]
    trees = language_id.ContextTrees(
        ["a", "b"], [np.unique(language_id._led([language_id._PAD + t])[0], return_counts=True) for t in texts]
    )
    table = trees.table()
    whole = trees.totals([texts[0]], table)
    monkeypatch.setattr(language_id, "PIECE_BYTES", 1000)
    assert np.allclose(trees.totals([texts[0]], table), whole)
