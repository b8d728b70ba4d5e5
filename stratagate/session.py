"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Rows of ids that are worth a task of their own.
TASK_ROWS = 20_000


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Set SQL settings (dots written as double underscores) and put them back."""
    names = {k.replace("__", "."): val for k, val in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, val in names.items():
            spark.conf.set(k, val)
        yield
    finally:
        for k, val in before.items():
            spark.conf.unset(k) if val is None else spark.conf.set(k, val)


def lenient(spark: SparkSession):
    """Expressions built inside give NULL where ANSI mode would raise.

    A rule whose arithmetic cannot be evaluated is a violation, not a failed job.
    """
    return settings(spark, spark__sql__ansi__enabled="false")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame) -> DataFrame:
    """Compute once, keep in the shared folder, cut the lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def fewer_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of at most so many rows, in no more partitions than these fill.

    Tasks then follow the rows, also where the session asks for many partitions.
    """
    tasks = max(1, -(-rows // TASK_ROWS))
    most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(tasks) if tasks < most else df


def settle_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """Settled rows, in no more partitions than they fill, and their number."""
    settled = settle(df)
    rows = settled.count()
    return fewer_tasks(settled, rows), rows


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute once into a columnar table of the shared folder and read that."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
