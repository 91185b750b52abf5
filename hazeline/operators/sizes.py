"""Size checks made before choosing a strategy or broadcasting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIB = 1 << 20


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; an over-estimate where it has no statistics."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = 64 * MIB) -> DataFrame:
    """Broadcast hint only behind a size check; beyond it the join shuffles as usual."""
    return F.broadcast(df) if estimated_bytes(df) <= limit else df
