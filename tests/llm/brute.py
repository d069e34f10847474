"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib


def removed(rows, length=50):
    """Operator 9: doc_id -> (n_bytes, n_removed, n_spans, kept bytes), as a list in row order."""
    place = lambda i: float("inf") if i is None else i
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            key = data[p : p + length]
            first[key] = min(first.get(key, float("inf")), place(doc))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < place(doc):
                gone[p : p + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return out


def shingle_set(text, n=5):
    words = (text or "").encode().split()
    if not words:
        return frozenset()
    if len(words) < n:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def near(rows, threshold=0.8):
    """Operator 3: list of (doc_id, class_id, n_links) in row order."""
    sets = [shingle_set(t) for _, t in rows]
    linked = [[] for _ in rows]
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            if len(sets[i]) * threshold > len(sets[j]) + 1e-9 or len(sets[j]) * threshold > len(sets[i]) + 1e-9:
                continue
            both = len(sets[i] & sets[j])
            if both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                linked[i].append(j)
                linked[j].append(i)
    by_id = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and sets[i]:
            by_id.setdefault(doc, []).append(i)
    out = [None] * len(rows)
    seen = set()
    for i in range(len(rows)):
        if i in seen:
            continue
        todo, part = [i], []
        seen.add(i)
        while todo:
            k = todo.pop()
            part.append(k)
            for m in [*linked[k], *(by_id.get(rows[k][0], []) if sets[k] else [])]:
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        least = min((rows[k][0] for k in part if rows[k][0] is not None), default=None)
        for k in part:
            out[k] = (rows[k][0], least, len(linked[k]))
    return out


def exact(rows):
    """Operator 8: sorted list of (doc_id, keep_id, group_size, kept, sha)."""
    gone = str.maketrans("", "", " \t\n\x0b\x0c\r")
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").translate(gone), []).append((doc, len(text or "")))
    out = []
    for norm, own in groups.items():
        sha = hashlib.sha256(norm.encode()).hexdigest()
        order = sorted(own, key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        out += [(d, order[0][0], len(own), k == 0, sha) for k, (d, _) in enumerate(order)]
    return out


def segment(vocabulary, text):
    """Operator 6: the best segmentation, one text at a time, left to right."""
    if not text:
        return []
    text = " " + text.replace("▁", " ")
    best = [None] * (len(text) + 1)
    best[0] = (0, -1, -1)
    for start in range(len(text)):
        here, alone = best[start][0], True
        for stop in range(start + 1, min(start + vocabulary.longest, len(text)) + 1):
            piece = vocabulary.pieces.get(text[start:stop])
            if piece is None:
                continue
            alone = alone and stop > start + 1
            if best[stop] is None or here + piece[1] > best[stop][0]:
                best[stop] = (here + piece[1], start, piece[0])
        if alone and (best[start + 1] is None or here + vocabulary.unknown_score > best[start + 1][0]):
            best[start + 1] = (here + vocabulary.unknown_score, start, -1)
    end, parts = len(text), []
    while end:
        _, start, i = best[end]
        parts.append([i] if i >= 0 else vocabulary.single(text[start]))
        end = start
    return [i for p in reversed(parts) for i in p]
