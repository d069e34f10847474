"""Table sets that are replaced as a whole.

A build writes its tables to a folder of its own.  When all are there, one small
pointer file is put in place, and the set it names is the current one: readers resolve
the newest pointer once and then read that set, whatever is built meanwhile.  A build
that breaks off leaves a folder that no pointer names.

Pointers are ordered by how many source files the set was built from, then by version:
a build that started from an older state never replaces a newer one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tillroll.sources import storage

# Sets that stay readable besides the current one, and how long any set stays that was current.
KEEP = 2
GRACE_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Published:
    """One version: each table's folder, and the state of the ledger it was built from."""

    name: str
    version: int
    tables: dict[str, str] = field(default_factory=dict)
    source: tuple[int, int] = (-1, 0)


def _pointers(root: str) -> str:
    return f"{root}/pointers"


def _sets(root: str) -> str:
    return f"{root}/versions"


def current(spark: SparkSession, root: str) -> Published | None:
    """The set that readers see now; None before the first one."""
    while True:
        names = sorted(storage.listed(spark, _pointers(root)))
        if not names:
            return None
        text = storage.get(spark, f"{_pointers(root)}/{names[-1]}")
        if text is not None:  # else a newer one has come and this one has gone
            found = json.loads(text)
            tables = {key: f"{_sets(root)}/{where}" for key, where in found["tables"].items()}
            return Published(names[-1], found["version"], tables, (found["files"], int(found["names"])))


def new_folder(root: str) -> str:
    """A folder for the tables of a set to come."""
    return f"{_sets(root)}/{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, tables: dict[str, str], source: tuple[int, int], base: Published | None) -> Published:
    """Make the given folders the tables of a new version after ``base``; its other tables stay."""
    version = (base.version if base else 0) + 1
    merged = {**(base.tables if base else {}), **tables}
    relative = {key: where.removeprefix(f"{_sets(root)}/") for key, where in merged.items()}
    files, names = source
    name = f"{max(0, files):012d}-{version:012d}-{uuid.uuid4().hex}"
    storage.put(spark, f"{_pointers(root)}/{name}", json.dumps({"version": version, "tables": relative, "files": files, "names": str(names)}))
    return Published(name, version, merged, source)


def retire(spark: SparkSession, root: str, keep: int = KEEP, grace_s: float = GRACE_SECONDS) -> int:
    """Delete sets that nobody needs: not the current one, not the ``keep`` before it, none
    whose pointer or folder changed within ``grace_s``.  Returns how many folders went."""
    pointers = storage.listed(spark, _pointers(root))
    old = sorted(pointers)[: -1 - keep]
    if not old:
        return 0
    limit = storage.now(spark, root) - grace_s
    gone = [name for name in old if pointers[name] <= limit]
    for name in gone:
        storage.remove(spark, f"{_pointers(root)}/{name}")
    used = set()
    for name in storage.listed(spark, _pointers(root)):
        text = storage.get(spark, f"{_pointers(root)}/{name}")
        used |= {where.split("/")[0] for where in json.loads(text)["tables"].values()} if text else set()
    unused = [name for name, at in storage.listed(spark, _sets(root)).items() if name not in used and at <= limit]
    for name in unused:
        storage.remove(spark, f"{_sets(root)}/{name}")
    return len(unused)
