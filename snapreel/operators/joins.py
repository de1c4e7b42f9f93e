"""Broadcast only behind a size check.

Adaptive execution already turns a join into a broadcast when the measured
side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``. This helper
is for the few places where a *planning-time* hint is wanted: it reads the
optimizer's size estimate and hints a broadcast only when the estimate is
under a bound; otherwise the join stays a shuffle join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024
UNKNOWN_BYTES = 1 << 60               # Spark's estimate for an input that it cannot size
MAX_BROADCAST_ROWS = 1_000_000       # compressed files can hold many rows in few bytes


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate of ``df`` (no job is run); None if unknown.

    The estimate is an upper bound built from file sizes and row widths;
    where Spark cannot estimate (e.g. after a generator over a VARIANT) it
    grows huge, which every caller treats as "not small".
    """
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else str(size))
    except Exception:  # pragma: no cover - estimate unavailable (e.g. Connect)
        return None


def input_size_bytes(df: DataFrame) -> int | None:
    """Bytes of the inputs ``df`` reads: the sum over its plan's leaf relations
    (file sizes for scans, actual size for local data); None when one is unknown. Grounded in real
    bytes, unlike the derived estimate, so it suits sizing a table layout."""
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
        total = 0
        while leaves.hasNext():
            size = leaves.next().stats().sizeInBytes()
            total += int(size if isinstance(size, int) else str(size))
        return total if total < UNKNOWN_BYTES else None
    except Exception:  # pragma: no cover
        return None


def is_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` is estimated at ``max_bytes`` at most and counted to have
    ``MAX_BROADCAST_ROWS`` rows at most (a count that stops beyond the bound)."""
    size = estimated_size_bytes(df)
    if size is None or size > max_bytes:
        return False
    return df.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when its estimated size is at most ``max_bytes``."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def match(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A semi or anti join on ``keys`` in which null equals null."""
    same = reduce(lambda a, b: a & b, (F.col(f"_l.{k}").eqNullSafe(F.col(f"_r.{k}")) for k in keys))
    return left.alias("_l").join(right.alias("_r"), same, how)


def restrict_to(big: DataFrame, small: DataFrame, keys: list[str],
                max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Rows of ``big`` whose key occurs in ``small`` (nulls are a value of their own).

    When ``small`` passes the size check it is broadcast into a semi join,
    so ``big`` is streamed where it lies instead of being shuffled; beyond
    the bound the semi join is an ordinary shuffle join.
    """
    return match(big, broadcast_if_small(small.select(*keys), max_bytes), keys, "left_semi")
