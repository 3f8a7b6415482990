"""Broadcast a code table only after its size has been checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 200_000
SMALL_BYTES = 10 * 1024 * 1024  # Spark's own default limit for broadcasting by estimate


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's own size estimate, taken from file sizes; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def source_bytes(df: DataFrame) -> int:
    """The size of the files or rows that a frame is made from; runs no job and optimises nothing."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Hint a broadcast where counting shows at most ``max_rows`` rows.

    A table with a small estimate is left alone, as Spark broadcasts it by itself. A larger
    estimate, as for a derived table, is settled by counting up to the limit. A table beyond the
    limit gets no hint and is joined by shuffle.
    """
    if estimated_bytes(df) <= SMALL_BYTES:
        return df
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
