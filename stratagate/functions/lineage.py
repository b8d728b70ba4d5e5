"""Lineage columns every published row carries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratagate import vocabulary as v


def lineage(period: str, part: Column, run_id: str) -> tuple[Column, ...]:
    values = (F.lit(period), part, F.lit(run_id))
    return tuple(c.alias(name) for c, name in zip(values, v.LINEAGE, strict=True))
