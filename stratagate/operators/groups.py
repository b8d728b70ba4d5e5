"""Group sizes and copy numbers that stay balanced when one group is huge.

A plain window over the key would send a hot key, with all its columns, to one
task. Here repeated keys meet the rows by a broadcast where they are few; where
they are many, rows move once by key, and those of hot keys under a salt.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratagate.operators import sizing
from stratagate.session import settle

CHUNK = 10_000
#: Shares of one hot key in an exchange.
SALTS = 4096
#: Shares of all keys, by hash; in one of ``PROBED`` each key is counted.
BUCKETS = 65_536
PROBED = 64
#: A key with more rows than so many average buckets is hot.
HOT_BUCKETS = 4


def repeated_keys(rows: DataFrame, key: list[str], size: str) -> DataFrame:
    """Keys held by more than one row (NULL counts as a value)."""
    return (
        rows.groupBy(*key)
        .agg(F.count(F.lit(1)).alias(size))
        .where(F.col(size) > 1)
    )


def _meet(rows: DataFrame, keys: DataFrame, key: list[str], how: str):
    """Null-safe equality join that keeps the columns of ``rows``."""
    renamed = keys.withColumnsRenamed({k: f"_group_{k}" for k in key})
    same = reduce(and_, [rows[k].eqNullSafe(renamed[f"_group_{k}"]) for k in key])
    return rows.join(renamed, same, how).drop(*[f"_group_{k}" for k in key])


def with_group_size(rows: DataFrame, key: list[str], size: str) -> DataFrame:
    """Add the number of rows sharing the key, without collecting any group.

    Repeated keys are all counted only where they are likely to be few enough to be
    broadcast; otherwise the one exchange that the rows need anyway counts them.
    """
    total, counted = rows.count(), None
    # a repeated key has two rows at least
    if total > 2 * sizing.BROADCAST_ROWS:
        counted = settle(_bucket_counts(rows, key))
    if counted is None or _repeated_about(counted) <= sizing.BROADCAST_ROWS:
        repeated = settle(repeated_keys(rows, key, size))
        if sizing.fits_broadcast(repeated):
            joined = _meet(rows, F.broadcast(repeated), key, "left")
            return joined.withColumn(size, F.coalesce(size, F.lit(1).cast("bigint")))
        return _one_exchange(rows, key, size, total, repeated)
    return _one_exchange(rows, key, size, total, _large_keys(rows, key, size, total, counted))


def _bucket(key: list[str]) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


def _bucket_counts(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows per bucket of keys; in one bucket of ``PROBED``, rows per key."""
    probed = [F.when(F.col("_bucket") % PROBED == 0, F.col(k)).alias(k) for k in key]
    return (
        rows.select(_bucket(key).alias("_bucket"), *key)
        .groupBy("_bucket", *probed)
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _repeated_about(counted: DataFrame) -> int:
    """Repeated keys of all buckets, from the probed ones; it only chooses a way."""
    return PROBED * counted.where(F.col("_bucket") % PROBED == 0).where("_n > 1").count()


def _hot_rows(total: int) -> int:
    """Rows that make a key hot: what a few buckets hold on average."""
    return -(-HOT_BUCKETS * total // BUCKETS)


def _large_keys(
    rows: DataFrame, key: list[str], size: str, total: int, counted: DataFrame
) -> DataFrame | None:
    """Repeated keys of the buckets that are large enough to hold a hot one."""
    heavy = (
        counted.groupBy("_bucket")
        .agg(F.sum("_n").alias("_n"))
        .where(F.col("_n") > _hot_rows(total))
        .select("_bucket")
    )
    if heavy.isEmpty():
        return None
    # at most one bucket of HOT_BUCKETS is heavy
    inside = rows.withColumn("_bucket", _bucket(key)).join(F.broadcast(heavy), "_bucket", "left_semi")
    return settle(repeated_keys(inside, key, size))


def _one_exchange(
    rows: DataFrame, key: list[str], size: str, total: int, large: DataFrame | None
) -> DataFrame:
    """Sizes of hot keys by broadcast, of all others where the key's rows meet.

    ``large`` holds every hot key. At most total / threshold keys are hot, which
    bounds the broadcast side; its bytes are measured too. Rows that have met a hot
    key go through the same exchange under a salt, so they are spread; other keys
    have no more rows than the threshold each. The rows are read once.
    """
    if large is None:
        return rows.withColumn(size, F.count(F.lit(1)).over(Window.partitionBy(*key)))
    threshold = _hot_rows(total)
    hot = large.where(F.col(size) > threshold)
    while not sizing.fits_broadcast(hot):
        threshold *= 2
        hot = large.where(F.col(size) > threshold)
    met = _meet(rows, F.broadcast(hot.withColumnRenamed(size, "_hot")), key, "left")
    spread = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(
        1 + F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    )
    together = Window.partitionBy(*key, "_salt")
    counted = met.withColumn("_salt", spread.cast("long")).withColumn(size, F.count(F.lit(1)).over(together))
    return counted.withColumn(size, F.coalesce("_hot", size)).drop("_hot", "_salt")


def number_copies(
    rows: DataFrame, group: str, order: str, index: str
) -> DataFrame:
    """Number the rows of each ``group`` from 1, following ``order``.

    Rows equal in every column are interchangeable, so they travel as one row
    with a count. The window then holds one row per distinct (group, order),
    and the copies are written out again in bounded chunks.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    others = [c for c in rows.columns if c not in (group, order)]
    before = (
        Window.partitionBy(group)
        .orderBy(order, *others)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = counted.withColumn(
        "_before", F.coalesce(F.sum("_n").over(before), F.lit(0))
    )
    single = placed.where(F.col("_n") == 1).withColumn(index, F.col("_before") + 1)
    # with its number given, adaptive execution leaves this exchange as it is
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (
        placed.where(F.col("_n") > 1)
        .withColumn(
            "_chunk",
            F.explode(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(CHUNK))),
        )
        .repartition(tasks, group, order, "_chunk")
    )
    many = chunks.withColumn(
        index,
        _span(
            F.col("_before") + F.col("_chunk"),
            F.least(F.lit(CHUNK), F.col("_n") - F.col("_chunk")),
        ),
    )
    keep = [*rows.columns, index]
    return single.select(keep).unionByName(many.select(keep))


def _span(before: Column, length: Column) -> Column:
    return F.explode(F.sequence(before + 1, before + length))
