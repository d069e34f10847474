"""Small texts with every special case."""

from __future__ import annotations

import random


def text(rng, words, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def odd_rows(seed=1):
    """(doc_id, text, lang, source): nulls, empty texts, ties, repeats, near copies, long texts."""
    rng = random.Random(seed)
    base = text(rng, 120, 10_000)
    words = base.split()
    near = [" ".join([*words[:k], "changed", *words[k + 1 :]]) for k in (10, 40, 70, 100)]
    long = text(rng, 4000, 10_000)
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),  # a repeated row
        (3, near[0], "en", "b"),
        (4, near[1], "en", "b"),
        (5, near[2], "en", None),
        (6, near[3], "de", None),
        (7, None, "en", "a"),
        (8, "", None, "b"),
        (9, " \t\n", "de", "b"),
        (10, "one two three", "en", "c"),
        (11, "one  two\tthree", "en", "c"),
        (12, "12 34 -- !!", None, "c"),
        (13, long, "en", "c"),
        (14, text(rng, 50) + " " + long, "en", "d"),
        (None, base, "en", "a"),
        (None, "no id here at all", "fr", "z"),
        (15, "été à Zürich — 漢字 😀 naïve " * 8, "fr", "z"),
        (16, "été à Zürich — 漢字 😀 naïve " * 8, "fr", "z"),
        (17, "ab" * 90, "en", "z"),
        (18, "x" + "ab" * 90, "en", "z"),
    ]
    rows += [(20 + i, text(rng, 60, 5000), rng.choice(["en", "de", "fr"]), rng.choice("abcd")) for i in range(20)]
    return rows
