"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagate.operators.sizing import BROADCAST_ROWS
from stratagate.session import fewer_tasks, settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _as_is(df: DataFrame) -> DataFrame:
    return df


def _few(df: DataFrame, rows: int) -> DataFrame:
    """Fewer tasks for rows that are broadcast or few; others stay where an exchange put them."""
    return fewer_tasks(df, rows) if rows <= BROADCAST_ROWS else df


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node that has an edge, with its component's least node.

    ``edges`` has columns u and v of one orderable type; loops, doubled and
    turned edges and NULL ends count for nothing. Neighbours are never gathered:
    each round takes minima with map-side combines and joins them back, and the
    diameter shrinks to stars in a logarithmic number of rounds. The number of edges,
    which never grows, bounds what a round makes; few edges take few tasks.
    """
    known = F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))
    now = settle(
        edges.where(known)
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = None
    while (state := _state(now)) != before:
        before = state
        rows = 2 * state[0]
        met = F.broadcast if rows <= BROADCAST_ROWS else _as_is
        now = _few(now, rows)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m"))
        least = met(_few(least.select("u", F.least("_m", "u").alias("_m")), rows))
        # every larger neighbour moves to the least one
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        large = settle(_few(large.distinct(), rows))
        # a node and its smaller neighbours move to the least of these
        least = _few(large.groupBy("u").agg(F.min("v").alias("_m")), rows)
        moved = large.join(met(least), "u").where("v != _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
        now = settle(
            _few(moved.unionByName(least.select("u", F.col("_m").alias("v"))).distinct(), rows)
        )
    roots = _few(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct(), state[0])
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
