"""Measured sizes, so that only data known to be small is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 1_000_000


def fits_broadcast(settled: DataFrame) -> bool:
    """Row count and column bytes of an already computed DataFrame, in one pass."""
    width = [
        F.coalesce(F.octet_length(c), F.lit(0))
        if t == "string"
        else F.lit(16)
        for c, t in settled.dtypes
    ]
    row_bytes = sum(width, F.lit(16)).cast("long")
    rows, size = settled.agg(F.count(F.lit(1)), F.sum(row_bytes)).first()
    return rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES


def broadcast_if_small(settled: DataFrame) -> DataFrame:
    """Hint a broadcast only when the measured size allows it."""
    return F.broadcast(settled) if fits_broadcast(settled) else settled
