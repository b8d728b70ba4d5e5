"""Keyed upsert as a new version of the table, and the catalogue built on it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.operators.checks import as_problems, require


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    update: Sequence[str],
) -> DataFrame:
    """Insert new keys whole; on known keys only ``update`` columns change.

    A key may stand once in the source: which row should win is not for the table
    to decide, so a doubled one stops the upsert.
    """
    require(doubled_source(source, key, "source"))
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    s = source.withColumn("_in_source", F.lit(True)).alias("s")
    same = reduce(and_, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key])
    both = t.join(s, same, "full")

    def pick(c: str):
        old, new = F.col(f"t.{c}"), F.col(f"s.{c}")
        if c in update:
            return F.when(F.col("_in_source"), new).otherwise(old).alias(c)
        return F.when(F.col("_in_target"), old).otherwise(new).alias(c)

    return both.select(*[pick(c) for c in target.columns])


def doubled_source(source: DataFrame, key: Sequence[str], subject: str) -> DataFrame:
    """Keys that a source of an upsert holds more than once."""
    doubled = source.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return as_problems(
        doubled,
        "upsert_source",
        subject,
        F.format_string("key %s in %d source rows", F.to_json(F.struct(*key)), "_n"),
    )


def catalog_sync(name: str, target: DataFrame, source: DataFrame) -> DataFrame:
    """Structure follows the contracts; curated columns are kept once written."""
    curated = v.CATALOG_CURATED[name]
    to_confirm = {c: F.lit(v.TO_CONFIRM) for c in curated}
    structural = [c for c in target.columns if c not in curated]
    incoming = source.withColumns(to_confirm) if to_confirm else source
    return upsert(target, incoming, v.CATALOG_KEYS[name], structural)
