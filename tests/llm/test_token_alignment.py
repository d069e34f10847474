"""Operator 12 next to plain interval overlaps of every token with every other."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from samples import odd_rows

from tillroll.llm import token_alignment as align

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def sides():
    return align.byte_side(align.BYTE_MODEL), align.piece_side(align.PIECE_MODEL)


def spans(side, ids):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(side.tokens[i]), i))
        at += len(side.tokens[i])
    return out


def plain_document(sides, text):
    """Token lists, linked pairs and groups of one text."""
    if not text:
        return [], [], [], ""
    own = [side.encode([text])[0] for side in sides]
    if any(b"".join(side.tokens[i] for i in ids) != (" " + text).encode() for side, ids in zip(sides, own)):
        return [], [], [], ""
    a, b = (spans(side, ids) for side, ids in zip(sides, own))
    pairs = [(x, y) for lo, hi, x in a for low, high, y in b if lo < high and low < hi]
    ends = sorted({s[1] for s in a} & {s[1] for s in b})
    groups, before = [], 0
    for end in ends:
        groups.append("|".join(",".join(str(i) for lo, hi, i in s if before <= lo and hi <= end) for s in (a, b)))
        before = end
    return *own, pairs, ";".join(groups)


def plain(sides, rows):
    found = [(doc, *plain_document(sides, text)) for doc, text in rows]
    counts = Counter(p for *_, pairs, _ in found for p in pairs)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    return [
        (
            doc, len(a), len(b), len(groups.split(";")) if groups else 0, len(pairs),
            sum(counts[p] == highest[p[1]] for p in pairs), sum(counts[p] for p in pairs),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for doc, a, b, pairs, groups in found
    ]


TEXTS = [
    "The quick brown fox.", "  two  blanks\n\nand lines \t", "a▁b", "<s> and <|endoftext|> are text", "naïve — 漢字😀 été",
    "      x    ", "x" * 70 + " yyy", "don't we'll I'd 12 345,678.90", " ", "\n", "ﬁ ① Å", "\0 nul", "á é",
    "مرحبا بالعالم", "def f(x):\n    return x  # ok\n",
]


@pytest.mark.parametrize("hot_pairs", [align.HOT_PAIRS, 5])
def test_counts(documents, sides, hot_pairs):
    rows = [(r[0], r[1][:4000] if r[1] else r[1]) for r in odd_rows()] + [(100 + k, t) for k, t in enumerate(TEXTS * 2)]
    df = align.link_counts(documents(rows, clashing=True), hot_pairs=hot_pairs)
    assert sorted(map(str, (tuple(r) for r in df.select(*COLUMNS).collect()))) == sorted(map(str, plain(sides, rows)))


def test_groups_are_the_ids(documents, sides):
    rows = [(k, t) for k, t in enumerate([*TEXTS, None, ""])]
    for r in align.groups(documents(rows)).collect():
        a, b, _, groups = plain_document(sides, rows[r.doc_id][1])
        assert [x for g in r.groups for x in g.a] == a and [x for g in r.groups for x in g.b] == b
        assert ";".join(f"{','.join(map(str, g.a))}|{','.join(map(str, g.b))}" for g in r.groups) == groups


def test_both_libraries_give_the_same_ids(sides):
    """The ranks' encoder next to the file's own library, on words and on random strings."""
    rng = random.Random(9)
    texts = TEXTS + [r[1] for r in odd_rows() if r[1]] + [" " * 100_000, "x" * 30_000, "\n" * 5000 + "a"]
    letters = [*"abcdefghijklmnopqrstuvwxyz  ABCéü'0123.,!\n\t", "漢", "😀", "\u0301", "\x85", "\u200b"]
    texts += ["".join(rng.choices(letters, k=rng.randrange(1, 30))) for _ in range(20_000)]
    assert sides[0].encode(texts) == align.library_encoder(align.BYTE_MODEL)(texts)


def test_parts_change_nothing(sides):
    """A text cut at every safe blank has the tokens of the whole."""
    rng = random.Random(5)
    words = ["the", "naïve", "12", "don't", "\n", "", "x.", "ab ", "été", "—", "漢字", "I'd", "5th", "'s", "_"]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(40)] + TEXTS
    whole = align.Aligner(*sides, part_chars=1 << 30)
    cut = align.Aligner(*sides, part_chars=1)
    assert any(len(align.parts(t, 1)) > 20 for t in texts)
    assert whole._tokens(texts) == cut._tokens(texts)
    assert list(whole.align(texts)) == list(cut.align(texts))


def test_windows_are_walked_once(sides):
    """Repeated windows come from the memo, and a small memo changes nothing."""
    text = " ".join(["every word again"] * 300)
    aligner, small = align.Aligner(*sides), align.Aligner(*sides, memo_windows=2)
    assert list(aligner.align([text, text])) == list(small.align([text, text]))
    assert aligner.walked < 10 and len(small.memo) <= 10


def test_a_hot_text_and_a_long_one(documents, sides):
    rows = [(k, "the same text for a third of all rows") for k in range(200)] + [(500, "long text " * 30_000)]
    got = {r.doc_id: r for r in align.link_counts(documents(rows)).collect()}
    want = plain(sides, rows[:200])
    assert len(got) == 201 and all(got[k].n_links == want[0][4] for k in range(200))
    assert len({got[k].count_sum for k in range(200)}) == 1 and got[500].n_a >= 60_000


def test_empty_table(documents):
    assert align.link_counts(documents([])).count() == 0
    assert align.link_counts(documents([(1, None), (2, "")])).select("n_links", "groups_sha256").collect() == [(0, ""), (0, "")]


def test_stretches_are_encoded_once(sides):
    """Stretches between blanks come from the memo; whole texts give the same."""
    texts = ["the cat saw the cat", "", "the  cat,\tsaw (the) cat ", " the cat's \u00a8 cat", "a\u2581b cat", "caf\u00e9 \u00e9t\u00e9 \u4f60 \u597d 's 12 3", "\ufb01 cat", "x\u3000 y \u200b z", "x\x1c y"]
    aligner, whole = align.Aligner(*sides), align.Aligner(*sides)
    whole.by_stretch = False
    assert aligner.by_stretch
    assert list(aligner.align(texts)) == list(whole.align(texts))
    before = aligner.encoded
    list(aligner.align(["cat the saw cat the"] * 3))
    assert aligner.encoded == before
