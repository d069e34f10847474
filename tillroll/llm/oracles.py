"""DuckDB SQL of operators 11 and 13."""

from __future__ import annotations


def _grown(head: str, cost: str, edit: str, line: str | None) -> str:
    """A path (cost, audit, said) with one more edit; null stays null."""
    said = f"{head}.said" if line is None else f"{head}.said || chr(10) || {line}"
    made = f"{{'cost': {head}.cost + {cost}, 'audit': {head}.audit || '{edit}', 'said': {said}}}"
    return f"CASE WHEN {head} IS NULL THEN NULL ELSE {made} END"


def _least(*paths: str) -> str:
    return f"list_min([{', '.join(paths)}])"


def _if(condition: str, path: str) -> str:
    return f"CASE WHEN {condition} THEN {path} END"


_INSERT_USER = _least("h2", *(_grown(h, "2", "I", "'user:'") for h in ("h0", "h1", "h3")))
_INSERT_ASSISTANT = _least("h3", _grown("i2", "2", "I", "'assistant:'"))


def _row(initial: str, role: str, state: str, sources: tuple[str, ...], rerole: bool) -> str:
    own = "role || ':' || text"
    paths = [_grown(state, "3", "D", None)]
    for h in sources:
        paths.append(_if(f"NOT gone AND initial = '{initial}'", _grown(h, "cut", "K", own)))
        if rerole:
            paths.append(_if("NOT gone", _grown(h, "2 + cut", "R", f"'{role}:' || text")))
    return _least(*paths)


# A path's least is by cost, then by its edits.  The crc32 of an ASCII string, bit by bit.
STRUCTURE_REPAIR = rf"""
WITH RECURSIVE named AS (
    SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
    FROM conversations
), numbered AS (
    SELECT *, xor(list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(substr(name, i, 1)) AS BIGINT))),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)))
    ), CAST(4294967295 AS BIGINT)) % 20 AS k
    FROM named
), damaged AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
           coalesce(CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END, '') AS text,
           unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM numbered WHERE k <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, sha256(text), copy) AS pos,
           coalesce(substr(role, 1, 1), '') AS initial, NOT regexp_matches(text, '[^ 	-
]') AS blank
    FROM damaged
), flagged AS (
    SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS earlier
    FROM placed
), marked AS (
    SELECT *, blank OR again AS gone,
           CASE WHEN NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 1 ELSE 0 END AS cut
    FROM flagged
), counted AS (
    SELECT conv_id, max(pos) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE again) AS duplicate, sum(cut) AS truncated,
           count(*) FILTER (WHERE pos > 1 AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
), dp AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS pos, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'said': ''}} AS h0,
           CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, said VARCHAR)) AS h1,
           CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, said VARCHAR)) AS h2,
           CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, said VARCHAR)) AS h3
    FROM counted
    UNION ALL
    SELECT conv_id, pos,
           {_row("", "", "h0", (), False)},
           {_row("s", "", "h1", ("h0",), False)},
           {_row("u", "user", "i2", ("h0", "h1", "i3"), True)},
           {_row("a", "assistant", "i3", ("i2",), True)}
    FROM (
        SELECT d.conv_id, m.pos, h0, h1, i2, i3, role, text, initial, gone, cut
        FROM (SELECT *, {_INSERT_ASSISTANT} AS i3 FROM (SELECT *, {_INSERT_USER} AS i2 FROM dp)) d
        JOIN marked m ON m.conv_id IS NOT DISTINCT FROM d.conv_id AND m.pos = d.pos + 1
    )
), ends AS (
    SELECT d.conv_id, {_least("h0", "i3")} AS best
    FROM (SELECT *, {_INSERT_ASSISTANT} AS i3 FROM (SELECT *, {_INSERT_USER} AS i2 FROM dp)) d
    JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id AND c.n = d.pos
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(best.cost, 0) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.said, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""

# SimHash: words and pairs of words, hashed by MD5, vote on 128 bits.
FINGERPRINTS = r"""
WITH d AS (
    SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST) AS r, doc_id, coalesce(text, '') AS text FROM documents
), e AS (
    SELECT r, doc_id, text, CAST(length(text) AS BIGINT) AS n_chars,
           coalesce(lead(text) OVER (ORDER BY r), first_value(text) OVER (ORDER BY r)) AS other
    FROM d
), v AS (
    SELECT r, 0 AS edit, text FROM e
    UNION ALL
    SELECT r, 1, left(text, n_chars - n_chars // 2) || left(other, n_chars // 2) FROM e
), w AS (
    SELECT r, edit, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM v
), placed AS (
    SELECT r, edit, i, words[i] AS word, words[i + 1] AS after
    FROM (SELECT r, edit, words, unnest(range(1, len(words) + 1)) AS i FROM w)
), known AS (
    SELECT word, CAST('0x' || substr(md5(word), 1, 16) AS UBIGINT) AS hi, CAST('0x' || substr(md5(word), 17, 16) AS UBIGINT) AS lo
    FROM (SELECT DISTINCT word FROM placed)
), terms AS (
    SELECT r, edit, hi, lo, count(*) AS times FROM placed JOIN known USING (word) GROUP BY ALL
    UNION ALL
    SELECT r, edit, xor(a.hi, b.lo), xor(a.lo, b.hi), count(*) FROM placed
    JOIN known a ON a.word = placed.word JOIN known b ON b.word = placed.after GROUP BY r, edit, a.hi, a.lo, b.hi, b.lo
), votes AS (
    SELECT r, edit, bit,
           sum(weight * (2 * CAST((hi >> (63 - bit)) & 1 AS INTEGER) - 1)) AS hi_votes,
           sum(weight * (2 * CAST((lo >> (63 - bit)) & 1 AS INTEGER) - 1)) AS lo_votes
    FROM (SELECT r, edit, hi, lo, length(bin(times)) AS weight FROM terms), (SELECT unnest(range(64)) AS bit)
    GROUP BY r, edit, bit
), halves AS (
    SELECT r, edit,
           CAST(sum(CASE WHEN hi_votes > 0 THEN CAST(1 AS UBIGINT) << (63 - bit) ELSE 0 END) AS UBIGINT) AS hi,
           CAST(sum(CASE WHEN lo_votes > 0 THEN CAST(1 AS UBIGINT) << (63 - bit) ELSE 0 END) AS UBIGINT) AS lo
    FROM votes GROUP BY r, edit
), marks AS (
    SELECT v.r, v.edit, v.text, coalesce(hi, 0) AS hi, coalesce(lo, 0) AS lo
    FROM v LEFT JOIN halves h ON h.r = v.r AND h.edit = v.edit
), lined AS (
    SELECT r, hi, lo, coalesce(lead(hi) OVER (ORDER BY r), first_value(hi) OVER (ORDER BY r)) AS next_hi,
           coalesce(lead(lo) OVER (ORDER BY r), first_value(lo) OVER (ORDER BY r)) AS next_lo
    FROM marks WHERE edit = 0
), near AS (
    SELECT a.hi, a.lo, sum(b.n) - 1 AS n_near
    FROM (SELECT DISTINCT hi, lo FROM lined) a
    JOIN (SELECT hi, lo, count(*) AS n FROM lined GROUP BY ALL) b ON bit_count(xor(a.hi, b.hi)) + bit_count(xor(a.lo, b.lo)) <= {RADIUS}
    GROUP BY a.hi, a.lo
)
SELECT e.doc_id, e.n_chars, sha256(m.text) AS edited_sha256,
       format('{:016x}', l.hi) || format('{:016x}', l.lo) AS fingerprint,
       format('{:016x}', m.hi) || format('{:016x}', m.lo) AS edited_fingerprint,
       CAST(1 - (bit_count(xor(l.hi, m.hi)) + bit_count(xor(l.lo, m.lo))) / 128.0 AS DOUBLE) AS near_edited,
       CAST(1 - (bit_count(xor(l.hi, l.next_hi)) + bit_count(xor(l.lo, l.next_lo))) / 128.0 AS DOUBLE) AS near_next,
       CAST(n_near AS BIGINT) AS n_near
FROM e JOIN lined l USING (r) JOIN marks m ON m.r = e.r AND m.edit = 1 JOIN near ON near.hi = l.hi AND near.lo = l.lo
"""
