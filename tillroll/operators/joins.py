"""Joins whose broadcast side is proven small at run time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side (rows) we ever broadcast on our own authority.  Above it the
# join is left to the planner (shuffle join, AQE may still switch at run time
# from measured shuffle sizes).
BROADCAST_MAX_ROWS = 100_000


_CHECKED: dict = {}


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, memo_key=None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows, so it stays cheap even when
    the answer is no.  ``memo_key`` names an immutable input (e.g. a read-only
    dimension file) whose answer may be reused within the session.
    """
    if memo_key is not None:
        key = (id(df.sparkSession), max_rows, memo_key)
        if key not in _CHECKED:
            _CHECKED[key] = df.limit(max_rows + 1).count() <= max_rows
        return _CHECKED[key]
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(
    left: DataFrame,
    right: DataFrame,
    on,
    how: str = "inner",
    max_rows: int = BROADCAST_MAX_ROWS,
    memo_key=None,
) -> DataFrame:
    """``left.join(right)`` broadcasting ``right`` only after a size check."""
    side = F.broadcast(right) if is_small(right, max_rows, memo_key) else right
    return left.join(side, on, how)
