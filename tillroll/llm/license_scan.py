"""Operator 2, license scans: canonical digests of entire texts, hash-joined to known ones.

A text is brought to a canonical form (copyright lines out, lower case,
punctuation to blanks, equivalent spellings to one) and its digest is looked up
among the digests of known licences and notices.  Looked up are the entire
document and, for notices placed inside documents, each entire line.

Only words make the form, so how a text is wrapped does not matter.  Where a licence
is wrapped so that its own copyright statement shares a line with other words, the
form with all lines kept is looked up too.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.licenses import KNOWN, PHRASES, SPELLINGS

# A line that states whose the copyright is: the word or sign with a year (or its
# placeholder), the word with the sign, or that all rights are reserved.
_YEAR = r"(?:19[0-9][0-9]|20[0-9][0-9]|[<\[{(]? ?(?:year|yyyy)\b)"
COPYRIGHT = (
    r"^[^a-z0-9]*(?:"
    rf"(?:copyright|copr\.?)[ \t,:]*(?:\(c\)|©)?[ \t,:]*{_YEAR}"
    r"|(?:copyright|copr\.?)[ \t]*(?:\(c\)|©)"
    rf"|(?:\(c\)|©)[ \t,:]*(?:copyright[ \t,:]*)?{_YEAR}"
    r"|all rights reserved[^a-z0-9]*$"
    r")"
)
COPYRIGHT_LINE = re.compile(COPYRIGHT, re.ASCII)
_MARKS = re.compile("[^a-z0-9\x80-\U0010ffff]+")
# A registry of up to this many rows is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 100_000
# Rows of an Arrow batch that are taken apart at one time.
ROWS = 256


def _words(line: str) -> list[str]:
    return [SPELLINGS.get(w, w) for w in _MARKS.split(line) if w]


def _form(words: list[str]) -> str:
    """Words as one text, with equivalent phrases written alike."""
    form = f" {' '.join(words)} "
    for phrase, same in PHRASES.items():
        form = form.replace(f" {phrase} ", f" {same} ")
    return form.strip()


def canonical(text: str, whole: bool = False) -> str:
    """The canonical form, ``whole`` with copyright lines kept; empty if nothing is left."""
    lines = text.lower().split("\n")
    return _form([w for line in lines if whole or not COPYRIGHT_LINE.match(line) for w in _words(line)])


def _md5(form: str) -> bytes | None:
    return hashlib.md5(form.encode("utf-8", "surrogatepass")).digest() if form else None


def digest(text: str) -> bytes | None:
    return _md5(canonical(text))


def known_digests(known: DataFrame) -> DataFrame:
    """(license_id, text) rows as distinct (digest, license_id); the first id wins a digest."""

    def run(batches):
        for batch in batches:
            known = [(t, i) for i, t in zip(batch["license_id"].to_pylist(), batch["text"].to_pylist()) if t and i]
            pairs = [(_md5(canonical(t, whole)), i) for t, i in known for whole in (False, True)]
            pairs = [(d, i) for d, i in pairs if d]
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in pairs], pa.binary()), pa.array([i for _, i in pairs], pa.string())],
                names=["digest", "license_id"],
            )

    return (
        known.select("license_id", "text")
        .mapInArrow(run, "digest binary, license_id string")
        .groupBy("digest")
        .agg(F.min("license_id").alias("license_id"))
    )


TEXT, ALL_LINES, LINE = 0, 1, 2


def _units(batches):
    """Row by row: the digest of the text, with all its lines if that differs, then of its lines."""
    for batch in batches:
        for low in range(0, batch.num_rows, ROWS):
            row, kinds, digests = [], [], []
            for i, text in enumerate(batch["text"].slice(low, ROWS).to_pylist(), low):
                lines = (text or "").lower().split("\n")
                words = [_words(line) for line in lines]
                kept = [w for line, w in zip(lines, words) if w and not COPYRIGHT_LINE.match(line)]
                found = [(TEXT, _md5(_form([w for own in kept for w in own])))]
                if len(kept) < sum(map(bool, words)):
                    found.append((ALL_LINES, _md5(_form([w for own in words for w in own]))))
                found += [(LINE, _md5(_form(own))) for own in kept]
                row += [i] * len(found)
                kinds += [k for k, _ in found]
                digests += [d for _, d in found]
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(at), batch["_op2_row"].take(at), pa.array(kinds, pa.int32()), pa.array(digests, pa.binary())],
                names=["doc_id", "row", "kind", "digest"],
            )


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per (doc_id, text) of ``docs``: which known licences it is and holds.

    Returns ``doc_id``, ``text_digest`` (hex, of the canonical whole text; null if
    that is empty), ``license_id`` (of the whole text, null if unknown),
    ``notices`` (sorted ids of its lines that are known, joined by commas) and
    ``n_notices`` (such lines, repeats counted).  ``known`` has ``license_id`` and
    ``text``; without it the built-in registry is used.

    Defined cases: a null text counts as empty and is no licence; of rows equal in
    id and text one is returned; a digest known under several ids gets the
    smallest; null ids are rows like others; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    if known is None:
        known = spark.createDataFrame(KNOWN, "license_id string, text string")
    registry = known_digests(known)
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        registry = F.broadcast(registry)
    kind = docs.schema["doc_id"].dataType.simpleString()
    units = docs.select("doc_id", "text", F.xxhash64("text").alias("_op2_row")).mapInArrow(
        _units, f"doc_id {kind}, row long, kind int, digest binary"
    )
    of = lambda kind, column: F.when(F.col("kind") == kind, F.col(column))
    line = of(LINE, "license_id")
    # Lines that are no notice are dropped before the shuffle.
    return (
        units.join(registry, "digest", "left")
        .where((F.col("kind") == TEXT) | F.col("license_id").isNotNull())
        .groupBy("doc_id", "row")
        .agg(
            F.max(F.lower(F.hex(of(TEXT, "digest")))).alias("text_digest"),
            F.coalesce(F.max(of(TEXT, "license_id")), F.max(of(ALL_LINES, "license_id"))).alias("license_id"),
            F.array_join(F.sort_array(F.collect_set(line)), ",").alias("notices"),
            # Repeated rows count once.
            (F.count(line) / F.count_if(F.col("kind") == TEXT)).cast("long").alias("n_notices"),
        )
        .drop("row")
    )
