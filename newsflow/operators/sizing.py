"""Size checks that decide whether a side table may be sent to every task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 100_000
MAX_BYTES = 16 * 1024 * 1024


def is_small(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Whether ``df`` stays within both bounds; at most ``max_rows + 1`` rows are looked at."""
    width = F.octet_length(F.to_json(F.struct("*")))
    probe = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    )
    seen = probe.first()
    return seen["rows"] <= max_rows and seen["bytes"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Hint a broadcast for a checked small side; a larger side is left to a shuffle join."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def spread_if_narrow(df: DataFrame) -> DataFrame:
    """Deal a table that arrives in fewer pieces than there are cores out to all of them.

    Text work is heavy per row, and a small table may be a single row group. A table of many
    splits, as any large one, is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df
