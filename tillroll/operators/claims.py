"""Claims: two runs never take the same source file at the same time.

A run puts a claim file with the names it means to take, then looks at the others.  A
name that another live claim holds is left to it if that run's id is smaller; otherwise
the run waits until the other has withdrawn or finished.  Whoever looks second sees the
first, so no two runs go on with one name, on any store whose listings show what was
put before.  What a finished run has taken is in the ledger by then.

A claim of a run that died stops counting after EXPIRY_SECONDS by the store's clock.
Should that run still be alive, both replace the same partitions with the same rows.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tillroll.sources import storage

EXPIRY_SECONDS = 6 * 3600
_WAIT_SECONDS = 0.5


def _others(spark: SparkSession, folder: str, own: str, expiry_s: float) -> dict[str, set[str]]:
    """The names that each other live claim holds."""
    out, limit = {}, None
    for run, at in storage.listed(spark, folder).items():
        if run == own:
            continue
        limit = storage.now(spark, folder) - expiry_s if limit is None else limit
        text = storage.get(spark, f"{folder}/{run}") if at > limit else None
        if text is None:
            if at <= limit:
                storage.remove(spark, f"{folder}/{run}")
            continue
        out[run] = set(json.loads(text))
    return out


@contextmanager
def claimed(spark: SparkSession, folder: str, names: list[str], expiry_s: float = EXPIRY_SECONDS, run: str | None = None) -> Iterator[list[str]]:
    """Hold those of ``names`` that no other run is taking; the claim ends with the block.

    The caller looks at the ledger again inside the block: a name may have been
    finished by another run before it was claimed here.
    """
    run = run or uuid.uuid4().hex
    path, held = f"{folder}/{run}", set(names)
    storage.put(spark, path, json.dumps(sorted(held)))
    try:
        while True:
            others = _others(spark, folder, run, expiry_s)
            lost = {n for other, own in others.items() if other < run for n in own & held}
            if lost:  # theirs: say so, then look again
                held -= lost
                storage.remove(spark, path)
                storage.put(spark, path, json.dumps(sorted(held)))
            elif any(own & held for own in others.values()):
                time.sleep(_WAIT_SECONDS)
            else:
                break
        yield [n for n in names if n in held]
    finally:
        storage.remove(spark, path)
