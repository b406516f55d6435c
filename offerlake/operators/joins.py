"""Join helpers with an explicit broadcast size check.

A side is broadcast only when its size is *proven* small: either a dimension whose
row count the caller bounds, or a plan whose optimizer size estimate (from file sizes)
is under the threshold.  Anything else is left to Catalyst/AQE (sort-merge or
shuffled-hash join, with AQE's runtime skew splitting).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (None if unavailable)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - defensive: stats API differences
        return None


def fits_broadcast(df: DataFrame, limit_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit_bytes


def join_dimension(fact: DataFrame, dim: DataFrame, on: Column | str | list, how: str = "inner",
                   limit_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Join a (possibly huge) fact side to a dimension; broadcast the dimension only if
    its estimated size is under ``limit_bytes``, else let the planner shuffle."""
    right = F.broadcast(dim) if fits_broadcast(dim, limit_bytes) else dim
    return fact.join(right, on, how)
