"""Operator 11, conversation structure repair: the cheapest edits that give legal turns.

A conversation's roles, by their first letters, must read ``(s?(ua)+)?``.  Its rows are
kept, given another role or deleted, and empty turns are inserted, at least cost; of
equally cheap edits the least in ASCII order is taken.  That is a shortest path over
four states (nothing yet, or the last role's letter), row after row.

* A path's edits are linked nodes, each a letter after its parent, so paths share their
  prefixes.  A node knows its ancestors at distances 1, 2, 4, ... and a rolling hash of
  all its letters: two equally cheap paths are compared at the first place where they
  differ, found by binary search.  Equal hashes are verified letter by letter (then the
  two share their ancestors from there on), so a collision changes nothing.
* Rows are range-partitioned by conversation and turn.  A conversation that lies
  inside one partition is solved there.  One that crosses partitions, or is longer than
  PIECE_ROWS, is solved in pieces, each from all four entry states; a piece is a matrix
  of (cost, edits), and matrices combine associatively.
* Texts move once, in the pass that applies the edits.  It streams each conversation
  in order, so a task holds one batch and one conversation's edits, however many rows
  the conversation has.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import WHITESPACE, released, settle

KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
CUT_COST = 1
# Rows of one conversation that are solved as one piece at most.
PIECE_ROWS = 20_000
OUT_ROWS = 1000

_MOD = (1 << 61) - 1
_BASE = 1_000_003

# States: no role yet, then the last role's letter.  A repaired conversation ends in ENDS.
STATES = 4
ENDS = (0, 3)
AFTER = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
EXPECTED = ("user", "user", "assistant", "user")
LEGAL = ("su", "ua", "au")


class Edits:
    """The edits so far: a label after those of a parent, with lifted ancestors and a hash."""

    __slots__ = ("label", "steps", "size", "mark", "ups")

    def __init__(self, parent: Edits | None, label: str, mod: int = _MOD):
        self.label = label
        if parent is None:
            self.steps = self.size = self.mark = 0
            self.ups: list[Edits] = []
            return
        self.steps, self.size, mark = parent.steps + 1, parent.size + len(label), parent.mark
        for c in label:
            mark = (mark * _BASE + ord(c)) % mod
        self.mark = mark
        ups, at, k = [parent], parent, 0
        while len(at.ups) > k:
            at = at.ups[k]
            ups.append(at)
            k += 1
        self.ups = ups

    def up(self, steps: int) -> Edits:
        """The ancestor with that many steps."""
        node = self
        while node.steps > steps:
            node = node.ups[(node.steps - steps).bit_length() - 1]
        return node

    def since(self, steps: int) -> str:
        """The letters after the ancestor with that many steps."""
        parts, node = [], self
        while node.steps > steps:
            parts.append(node.label)
            node = node.ups[0]
        return "".join(reversed(parts))


def alike(x: Edits, y: Edits) -> bool:
    """Whether two nodes of equally many steps have the same letters; hashes are verified."""
    if x is y:
        return True
    if x.mark != y.mark or x.size != y.size:
        return False
    p, q = x, y
    while p is not q:
        if p.label != q.label:
            low = min(p.steps, q.steps)
            while low and p.up(low) is not q.up(low):
                low -= 1
            return x.since(low) == y.since(low)
        if not p.steps:
            break
        p, q = p.ups[0], q.ups[0]
    if x.label == y.label:
        y.ups = x.ups  # verified: from here on they share their prefix
    return True


def precedes(a: Edits, b: Edits) -> bool:
    """Whether the letters of ``a`` come before those of ``b`` in ASCII order."""
    steps = min(a.steps, b.steps)
    x, y = a.up(steps), b.up(steps)
    if alike(x, y):
        return a.steps < b.steps
    for k in range(len(x.ups) - 1, -1, -1):
        if k < len(x.ups) and not alike(x.ups[k], y.ups[k]):
            x, y = x.ups[k], y.ups[k]
    # The parents of x and y are alike.
    p, q = x.label, y.label
    if not p.startswith(q) and not q.startswith(p):
        return p < q
    return a.since(x.steps - 1) < b.since(y.steps - 1)


def cheapest(found: list[tuple[int, Edits, str]], mod: int = _MOD) -> tuple[int, Edits] | None:
    """The cheapest of (cost, edits before, label); of equals the least in ASCII order."""
    if not found:
        return None
    cost = min(f[0] for f in found)
    nodes = [Edits(parent, label, mod) if label else parent for c, parent, label in found if c == cost]
    best = nodes[0]
    for node in nodes[1:]:
        if precedes(node, best):
            best = node
    return cost, best


def inserted(heads: list, mod: int = _MOD) -> list:
    """The best path to every state when empty turns may be inserted here."""
    out = list(heads)
    for state, sources in ((2, (0, 1, 3)), (3, (2,))):
        found = [(out[state][0], out[state][1], "")] if out[state] else []
        found += [(out[s][0] + COST[INSERT], out[s][1], INSERT) for s in sources if out[s]]
        out[state] = cheapest(found, mod)
    return out


def advanced(heads: list, initial: str, gone: bool, cut: bool, mod: int = _MOD) -> list:
    """The best paths after one more row: its role's letter, must it go, is it cut short."""
    heads = inserted(heads, mod)
    found: list[list] = [[] for _ in range(STATES)]
    extra = CUT_COST if cut else 0
    for state, head in enumerate(heads):
        if head is None:
            continue
        cost, node = head
        found[state].append((cost + COST[DELETE], node, DELETE))
        if gone:
            continue
        for letter, edit in ((initial, KEEP), ("u", REROLE), ("a", REROLE)):
            to = AFTER.get(letter, (None,) * STATES)[state]
            if to is not None:
                found[to].append((cost + COST[edit] + extra, node, edit))
    return [cheapest(f, mod) for f in found]


def started(entry: int) -> list:
    return [(0, Edits(None, "")) if s == entry else None for s in range(STATES)]


def ended(heads: list, mod: int = _MOD) -> tuple[int, str]:
    """Cost and letters of the best path that ends here."""
    heads = inserted(heads, mod)
    cost, node = cheapest([(heads[s][0], heads[s][1], "") for s in ENDS if heads[s]], mod)
    return cost, node.since(0)


class Piece:
    """Consecutive rows of one conversation: its counts, and the paths through it."""

    def __init__(self, entries: range):
        self.heads = {e: started(e) for e in entries}
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, initial: str, n: int, blank: bool, seen: bool, cut: bool) -> None:
        """``n`` equal rows of one turn."""
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        self.first = initial if self.rows == 0 else self.first
        self.illegal += int(self.rows > 0 and self.last + initial not in LEGAL) + (n - 1) * (initial * 2 not in LEGAL)
        self.last = initial
        self.rows += n
        fresh = 0 if blank or seen else 1
        self.blank += n if blank else 0
        self.duplicate += 0 if blank else n - fresh
        self.truncated += int(fresh and cut)
        for k in range(n):
            gone = k >= fresh
            for entry, heads in self.heads.items():
                self.heads[entry] = advanced(heads, initial, gone, cut and not gone)

    def result(self, whole: bool) -> dict:
        paths = []
        if whole:
            cost, audit = ended(self.heads[0])
            paths.append({"entry": 0, "exit": 0, "cost": cost, "audit": audit})
        else:
            for entry, heads in self.heads.items():
                found = enumerate(inserted(heads))
                paths += [{"entry": entry, "exit": s, "cost": h[0], "audit": h[1].since(0)} for s, h in found if h]
        kept = ("blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "turns")
        return {k: getattr(self, k) for k in kept} | {"whole": whole, "paths": paths}


def combined(pieces: list[dict]) -> dict:
    """One conversation's result from those of its pieces, in order."""
    total = {k: sum(p[k] for p in pieces) for k in ("blank", "duplicate", "truncated", "illegal", "turns")}
    heads, last, high = started(0), None, None
    for p in pieces:
        total["illegal"] += int(last is not None and last + p["first"] not in LEGAL)
        total["turns"] -= int(high is not None and p["low"] == high)
        last, high = p["last"], p["high"] if p["high"] is not None else high
        found: list[list] = [[] for _ in range(STATES)]
        for path in p["paths"]:
            head = heads[path["entry"]]
            if head is not None:
                found[path["exit"]].append((head[0] + path["cost"], head[1], path["audit"]))
        heads = [cheapest(f) for f in found]
    low = next((p["low"] for p in pieces if p["low"] is not None), None)
    cost, audit = ended(heads)
    return total | {"low": low, "high": high, "cost": cost, "audit": audit}


def sorted_rows(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` that count, and the digest that orders rows of one turn."""
    text = F.coalesce("text", F.lit(""))
    return rows.select("conv_id", "turn", "role", text.alias("text"), F.sha2(text, 256).alias("digest"))


_ORDER = ["conv_id", "turn", "role", "digest"]
_PATHS = "array<struct<entry: int, exit: int, cost: long, audit: string>>"
_COUNTS = "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long"


def _flagged(rows: DataFrame) -> DataFrame:
    """One light row for all equal rows of a turn, with its faults."""
    bare = F.rtrim(F.col("text"), F.lit(WHITESPACE))
    light = sorted_rows(rows).select(
        *_ORDER, (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut")
    )
    merged = settle(light.groupBy(*_ORDER).agg(F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut")), "op11-rows")
    again = (
        merged.where("NOT blank").groupBy("conv_id", "role", "digest")
        .agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("places")).where("places > 1")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("role").eqNullSafe(F.col("r")) & (F.col("digest") == F.col("d"))
    seen = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    initial = F.coalesce(F.substring("role", 1, 1), F.lit(""))
    return merged.join(again, same, "left").select(*_ORDER, initial.alias("initial"), "n", "blank", seen.alias("seen"), "cut")


def _pieces(rows: DataFrame, piece_rows: int) -> DataFrame:
    kind = rows.schema["conv_id"].dataType.simpleString()
    result = f"conv_id {kind}, part int, piece int, whole boolean, first string, last string, {_COUNTS}, paths {_PATHS}"
    names = [c.strip().split()[0] for c in result.split(", paths")[0].split(",")] + ["paths"]

    def run(batches):
        part, out = TaskContext.get().partitionId(), []
        conv, piece, number, types = None, None, 0, None

        def close(last: bool) -> None:
            # Only a conversation that starts and ends inside the partition is known to be whole.
            whole = number == 0 and not last and len(piece.heads) == 1
            out.append({"conv_id": conv, "part": part, "piece": number} | piece.result(whole))

        def table() -> pa.RecordBatch:
            path = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
            wide = {"conv_id": types, "part": pa.int32(), "piece": pa.int32(), "whole": pa.bool_(), "first": pa.string(), "last": pa.string(), "paths": pa.list_(path)}
            made = [pa.array([o[n] for o in out], wide.get(n, pa.int64())) for n in names]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names=names)

        for batch in batches:
            types = batch["conv_id"].type
            columns = (batch[c].to_pylist() for c in ("conv_id", "turn", "initial", "n", "blank", "seen", "cut"))
            for own, turn, initial, n, blank, seen, cut in zip(*columns):
                if piece is None:  # the partition's first conversation may have begun before it
                    conv, piece = own, Piece(range(STATES))
                elif own != conv:
                    close(False)
                    conv, piece, number = own, Piece(range(1)), 0
                elif piece.rows >= piece_rows:
                    close(True)
                    piece, number = Piece(range(STATES)), number + 1
                piece.add(turn, initial, n, blank, seen, cut)
                if len(out) >= OUT_ROWS:
                    yield table()
        if piece is not None:
            close(True)
            yield table()

    ordered = rows.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    return ordered.mapInArrow(released(run), result)


def audits(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per ``conv_id`` of ``rows`` (``turn`` integer, ``role``, ``text``; others ignored).

    Returns ``conv_id``, ``gaps`` (turn numbers missing between the least and the
    greatest), ``blank``, ``duplicate``, ``truncated`` (rows by their first fault),
    ``illegal`` (neighbours whose roles' letters are not su, ua or au), ``cost`` and
    ``audit`` (the edits' letters in order, K, R, D or I).

    Order: by turn, null first; rows of one turn by role, then by their texts'
    digest, so equal rows are neighbours.  A row is blank without a character outside
    [\\x20\\x09-\\x0D], a duplicate if its role and text were there earlier, truncated if
    its last such character is none of ``.!?``; blank and duplicate rows must go.
    Defined cases: a null text is empty; a null or empty role has no letter, so the
    row cannot stay as it is; a null ``conv_id`` is a conversation like others; turns
    that are all null have no gaps; an empty table gives an empty result.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    pieces = settle(_pieces(_flagged(rows), piece_rows), "op11-pieces")

    def join(table: pa.Table) -> pa.Table:
        found = combined(table.sort_by([("part", "ascending"), ("piece", "ascending")]).drop_columns(["conv_id"]).to_pylist())
        columns = [table["conv_id"].slice(0, 1)]
        columns += [pa.array([found[c]], pa.int64()) for c in (*counts, "cost")] + [pa.array([found["audit"]], pa.string())]
        return pa.table(columns, names=["conv_id", *counts, "cost", "audit"])

    counts = [c.strip().split()[0] for c in _COUNTS.split(",")]
    solved = pieces.where("whole").select(
        "conv_id", *counts, F.col("paths")[0]["cost"].alias("cost"), F.col("paths")[0]["audit"].alias("audit")
    )
    crossing = pieces.where("NOT whole").groupBy("conv_id").applyInArrow(join, f"conv_id {kind}, {_COUNTS}, cost long, audit string")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long"))
    return solved.unionByName(crossing).select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _applied(rows: DataFrame, audited: DataFrame, each, schema: str) -> DataFrame:
    """Stream every conversation's rows in order beside its edits; ``each`` takes them."""
    null = F.lit(None)
    edits = audited.select(
        "conv_id", F.lit(0).alias("kind"), null.cast("long").alias("turn"), null.cast("string").alias("role"),
        null.cast("string").alias("digest"), F.col("audit").alias("text"),
    )
    turns = sorted_rows(rows).withColumn("kind", F.lit(1)).select(*edits.columns)
    order = ["conv_id", "kind", "turn", "role", "digest"]

    def run(batches):
        yield from each(batches)

    return edits.unionByName(turns).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(released(run), schema)


class _Walk:
    """One conversation's edits, applied row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def _turn(self, edit: str, role: str, text: str) -> tuple[str, str, str]:
        self.state = AFTER[role[0]][self.state]
        return edit, role, text

    def inserts(self):
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.at += 1
            yield self._turn(INSERT, EXPECTED[self.state], "")

    def row(self, role: str, text: str):
        """The turns that one row becomes, with those inserted before it."""
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != DELETE:
            yield self._turn(edit, role if edit == KEEP else EXPECTED[self.state], text)


def _walked(batches):
    """(conv_id as an Arrow slice, edit, role, text) in order; edit None ends a conversation."""
    walk, key = None, None
    for batch in batches:
        ids = batch["conv_id"]
        for i, (kind, role, text) in enumerate(zip(*(batch[c].to_pylist() for c in ("kind", "role", "text")))):
            if kind == 0:
                if walk:
                    yield from ((key, *t) for t in walk.inserts())
                    yield key, None, None, None
                walk, key = _Walk(text), ids.slice(i, 1)
            else:
                yield from ((key, *t) for t in walk.row(role, text))
    if walk:
        yield from ((key, *t) for t in walk.inserts())
        yield key, None, None, None


def repaired_turns(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 0), ``edit``, ``role``, ``text``.

    ``audited`` is what ``audits`` gives for these rows.  An inserted turn has an
    empty text; a conversation of which nothing stays has no rows.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def each(batches):
        out, place = [], 0

        def table():
            ids = pa.concat_arrays([o[0] for o in out])
            made = [pa.array([o[k] for o in out], t) for k, t in ((1, pa.int64()), (2, pa.string()), (3, pa.string()), (4, pa.string()))]
            out.clear()
            return pa.RecordBatch.from_arrays([ids, *made], names=["conv_id", "place", "edit", "role", "text"])

        for key, edit, role, text in _walked(batches):
            if edit is None:
                place = 0
                continue
            out.append((key, place, edit, role, text))
            place += 1
            if len(out) >= OUT_ROWS:
                yield table()
        if out:
            yield table()

    return _applied(rows, audited, each, f"conv_id {kind}, place long, edit string, role string, text string")


def repaired_digests(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """``conv_id`` and ``repaired_sha256``: of the repaired ``role:text``, joined by new lines.

    A digest over a whole conversation is one pass over its turns in order; it is
    taken as they stream by.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def each(batches):
        out, digest, lead = [], hashlib.sha256(), ""

        def table():
            made = [pa.concat_arrays([o[0] for o in out]), pa.array([o[1] for o in out], pa.string())]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names=["conv_id", "repaired_sha256"])

        for key, edit, role, text in _walked(batches):
            if edit is not None:
                digest.update(f"{lead}{role}:{text}".encode())
                lead = "\n"
                continue
            out.append((key, digest.hexdigest()))
            digest, lead = hashlib.sha256(), ""
            if len(out) >= OUT_ROWS:
                yield table()
        if out:
            yield table()

    return _applied(rows, audited, each, f"conv_id {kind}, repaired_sha256 string")


def repair(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """``audits`` of ``rows`` with ``repaired_sha256``; the defined cases are those of ``audits``."""
    audited = settle(audits(rows, piece_rows), "op11-audits")
    digests = repaired_digests(rows, audited).withColumnRenamed("conv_id", "_op11_conv")
    return audited.join(digests, F.col("conv_id").eqNullSafe(F.col("_op11_conv"))).drop("_op11_conv")


def damage_number(conv_id: Column, turn: Column) -> Column:
    """A row's number from 0 to 19, by its ids; a null id reads as one blank."""
    name = F.concat(F.coalesce(conv_id.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    return F.crc32(name.cast("binary")) % 20


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults put in: rows dropped, emptied, cut short, repeated, given to the user."""
    k = damage_number(F.col("conv_id"), F.col("turn"))
    text = F.when(k == 1, F.lit("")).when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return conversations.where(k != 0).select(
        "conv_id", "turn",
        F.when(k == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def repaired_damage(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged rows, one row per original ``conv_id``.

    A conversation that lost all its rows has counts and cost 0, no edits and the
    digest of the empty string.
    """
    names = conversations.select(F.col("conv_id").alias("_op11_own")).distinct()
    found = repair(damaged(conversations))
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return (
        names.join(found, F.col("_op11_own").eqNullSafe(F.col("conv_id")), "left")
        .withColumns(zero | {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))})
        .select(F.col("_op11_own").alias("conv_id"), *zero, "audit", "repaired_sha256")
    )
