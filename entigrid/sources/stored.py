"""Steps kept as tables in the shared folder, and what may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from entigrid.session import scratch_path

# A side of a join is broadcast only when it was counted to have no more rows than this.
BROADCAST_ROWS = 200_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once and read back: they aren't computed again by later passes, and a
    lost executor costs no more than a read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Marked for a broadcast if it was counted to be small; else Spark joins it by a shuffle."""
    limit = BROADCAST_ROWS if rows is None else rows
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
