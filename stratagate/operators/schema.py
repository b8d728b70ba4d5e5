"""Schema comparison as data: one row per change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagate.operators.checks import as_problems


def schema_rows(
    spark: SparkSession, entity: str, schema: list[tuple[str, str]]
) -> DataFrame:
    rows = [(entity, name, kind, at) for at, (name, kind) in enumerate(schema)]
    return spark.createDataFrame(
        rows, "entity string, name string, type string, pos int"
    )


def schema_diff(current: DataFrame, planned: DataFrame) -> DataFrame:
    """(entity, change, name) for added, removed, retyped and reordered columns.

    Both sides: entity, name, type, pos. Order is compared among the columns
    both sides have; an order change is one row without a name.
    """
    both = current.select(
        "entity", "name", F.col("type").alias("old"), F.col("pos").alias("old_pos")
    ).join(
        planned.select(
            "entity", "name", F.col("type").alias("new"), F.col("pos").alias("new_pos")
        ),
        ["entity", "name"],
        "full",
    )
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(F.col("old") != F.col("new"), "retyped")
    )
    changed = both.select("entity", change.alias("change"), "name").where(
        "change is not null"
    )

    def in_order(pos: str):
        # a table's column names, never its rows
        names = F.array_sort(F.collect_list(F.struct(pos, "name")))
        return F.transform(names, lambda x: x["name"])

    reordered = (
        both.where("old is not null and new is not null")
        .groupBy("entity")
        .agg(in_order("old_pos").alias("before"), in_order("new_pos").alias("after"))
        .where("before <> after")
        .select(
            "entity",
            F.lit("reordered").alias("change"),
            F.lit(None).cast("string").alias("name"),
        )
    )
    return changed.unionByName(reordered)


def schema_change(diff: DataFrame, versions: DataFrame) -> DataFrame:
    """A changed schema needs a version above the published one.

    ``versions``: entity, version, published (NULL when never published).
    """
    changed = diff.groupBy("entity").agg(F.count(F.lit(1)).alias("changes"))
    refused = changed.join(versions, "entity").where(
        F.col("published").isNull() | (F.col("version") <= F.col("published"))
    )
    return as_problems(
        refused,
        "schema_change",
        F.col("entity"),
        F.format_string(
            "%d schema changes without a version above %s",
            "changes",
            F.coalesce(F.col("published").cast("string"), F.lit("none")),
        ),
    )
