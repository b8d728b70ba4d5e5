"""Small helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def boxed(docs: DataFrame, *more: Column) -> DataFrame:
    """The rows as one column ``_whole``, and more; no name of theirs can clash."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_whole"), *more)


def unboxed(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of boxed rows, some of them changed."""
    return rows.select(
        *[changed.get(c, F.col("_whole").getField(c)).alias(c) for c in columns]
    )


def slices(batches: Iterator[pa.RecordBatch], rows: int = ARROW_ROWS):
    """Pieces of at most ``rows`` rows, so that Python lists stay small.

    A worker outlives its task, so what the task's batches took is given back.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
        pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, NULL as None."""
    return column.cast(pa.binary()).to_pylist()


def task_count(spark: SparkSession) -> int:
    """Partitions of an explicit exchange, as the session sizes them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
