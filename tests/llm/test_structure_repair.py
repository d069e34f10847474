"""Operator 11 next to a plain dynamic program over whole strings."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tillroll.llm import structure_repair as repair

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
BARE = " \t\n\x0b\f\r"


def plain(rows):
    """(conv_id, ...) of COLUMNS for damaged rows, one conversation at a time."""
    out = []
    for conv in {r[0] for r in rows}:
        key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", hashlib.sha256((r[3] or "").encode()).hexdigest())
        own = sorted((r for r in rows if r[0] == conv), key=key)
        seen, counts, best = set(), [0, 0, 0], {"": (0, "", ())}  # roles so far -> cost, audit, lines
        initials = [(r[2] or "")[:1] for r in own]

        def grow(paths):
            # Only the last letters of the roles matter: "" , s, u, a.
            least = {}
            for roles, cost, audit, lines in paths:
                state = roles[-1:]
                if re.fullmatch("s?(ua)*u?", roles) and (state not in least or (cost, audit) < least[state][:2]):
                    least[state] = (cost, audit, lines)
            return least

        # One representative of all role strings with the same last letter.
        word = {"": "", "s": "s", "u": "u", "a": "ua"}

        def inserts(best):
            paths = [(word[s], *p) for s, p in best.items()]
            for _ in range(3):
                more = [(roles + r, c + 2, a + "I", lines + (f"{name}:",)) for roles, c, a, lines in paths for r, name in (("u", "user"), ("a", "assistant"))]
                paths += [m for m in more if re.fullmatch("s?(ua)*u?", m[0])]
            return grow(paths)

        for _, _, role, text in own:
            text = text or ""
            blank, again = not text.strip(BARE), (role, text) in seen
            cut = not blank and not again and text.rstrip(BARE)[-1] not in ".!?"
            seen.add((role, text))
            counts = [counts[0] + blank, counts[1] + (again and not blank), counts[2] + cut]
            paths = []
            for s, (cost, audit, lines) in inserts(best).items():
                paths.append((word[s], cost + 3, audit + "D", lines))
                if not blank and not again:
                    paths.append((word[s] + (role or "-")[:1], cost + cut, audit + "K", lines + (f"{role}:{text}",)))
                    for name in ("user", "assistant"):
                        paths.append((word[s] + name[0], cost + 2 + cut, audit + "R", lines + (f"{name}:{text}",)))
            best = grow(paths)
        ends = inserts(best)
        cost, audit, lines = min(p for s, p in ends.items() if s in ("", "a"))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def random_rows(seed, conversations=40, longest=9):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "uber", "", None]
    texts = ["Yes.", "Yes.", "No", "No", "", " \t", None, "Why?\n", "cut off", "é!", "a\nb", "…"]
    rows = []
    for conv in [*range(conversations), None]:
        for k in range(rng.randrange(1, longest)):
            turn = rng.choice([k, k, k, 2 * k, 0, None])
            rows.append((conv, turn, rng.choice(roles), rng.choice(texts)))
    return rows


def result(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("piece_rows", [repair.PIECE_ROWS, 2])
def test_repair(spark, piece_rows):
    rows = random_rows(1)
    rows += [(1000, k, ["user", "assistant", "tool"][k % 3 if k % 7 else 2], f"turn {k // 2}{'.' if k % 4 else ''}") for k in range(150)]
    rng = random.Random(2)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("n", "first", "piece", "audit", "cost", "digest")})
    got = result(repair.repair(df, piece_rows))
    assert got == plain(rows)


def test_turns_are_those_of_the_digest(spark):
    rows = random_rows(3)
    df = spark.createDataFrame(rows, SCHEMA)
    audited = repair.audits(df)
    lines = {}
    for r in sorted(repair.repaired_turns(df, audited).collect(), key=lambda r: (str(r.conv_id), r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, *_, sha in plain(rows):
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == sha
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines.get(conv, [])))


def test_damage(spark):
    rows = [(c, t, r, x) for c in [*range(60), None] for t in [0, 1, None] for r, x in [("user", "Is it? Yes."), ("system", None)]]
    want = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if k == 4 else r, "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 and x else x)
        want += [row] * (0 if k == 0 else 2 if k == 3 else 1)
    got = repair.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    # Every conversation is there, also one that lost all its rows.
    lost = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = result(repair.repaired_damage(spark.createDataFrame([(lost, 0, "user", "Hello.")], SCHEMA)))
    assert got == [(lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(empty).count() == 0 and repair.repaired_damage(empty).count() == 0
    assert repair.repaired_turns(empty, repair.audits(empty)).count() == 0


def test_one_conversation_holds_everything(spark):
    """One conversation, one turn number, mostly equal rows, long texts."""
    rows = [(7, 1, "user", "same text.")] * 300 + [(7, 1, "assistant", "long " * 20_000 + str(k)) for k in range(20)]
    got = result(repair.repair(spark.createDataFrame(rows, SCHEMA), 16))
    assert got == plain(rows) and got[0][3] == 299


@pytest.mark.parametrize("mod", [repair._MOD, 2, 5])
def test_comparison_survives_hash_collisions(mod):
    """Linked edits compare as their strings do, also when most hashes collide."""
    rng = random.Random(mod)
    nodes = [(repair.Edits(None, ""), "")]
    for _ in range(600):
        parent, text = rng.choice(nodes[-60:] + nodes[:3])
        label = rng.choice(["D", "I", "K", "R"]) if rng.random() < 0.9 else "".join(rng.choices("DI", k=3))
        nodes.append((repair.Edits(parent, label, mod), text + label))
    for _ in range(3000):
        (a, s), (b, t) = rng.choice(nodes), rng.choice(nodes)
        if not s.startswith(t) and not t.startswith(s):
            assert repair.precedes(a, b) == (s < t)
    assert all(n.since(0) == s for n, s in nodes)
