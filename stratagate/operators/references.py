"""Diagnosis of coded columns against the tables that define their codes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Contract


def orphans(values: DataFrame, official: DataFrame) -> DataFrame:
    """Distinct non-null codes in use that the reference does not list."""
    used = values.toDF("value").where("value is not null").distinct()
    return used.join(official.toDF("value").distinct(), "value", "left_anti")


def orphan_examples(values: DataFrame, official: DataFrame, limit: int = v.EXAMPLES):
    return orphans(values, official).orderBy("value").limit(limit)


def _layout(column: str, reference, found: DataFrame) -> DataFrame:
    return found.select(
        F.lit(column).alias("coluna"),
        F.lit(reference.identifier).alias("referencia"),
        F.lit(reference.column).alias("coluna_referenciada"),
        "orfaos_distintos",
        "exemplos",
        "resultado",
    )


def diagnose(
    silver: DataFrame, contract: Contract, tables: Mapping[str, DataFrame]
) -> DataFrame:
    """One row per coded column: orphan count, ten examples, result.

    A reference absent from ``tables`` is reported as missing.
    """
    found = []
    for f in contract.fields:
        if f.reference is None:
            continue
        if f.reference.identifier not in tables:
            one = silver.sparkSession.range(1).select(
                F.lit(None).cast("bigint").alias("orfaos_distintos"),
                F.lit(None).cast("array<string>").alias("exemplos"),
                F.lit(v.REFERENCE_MISSING).alias("resultado"),
            )
        else:
            official = tables[f.reference.identifier].select(f.reference.column)
            one = _count_and_examples(orphans(silver.select(f.name), official))
        found.append(_layout(f.name, f.reference, one))
    return reduce(DataFrame.unionByName, found)


def _count_and_examples(missing: DataFrame) -> DataFrame:
    nothing = F.lit(None)
    counted = missing.agg(
        F.count(F.lit(1)).alias("n"), nothing.cast("string").alias("value")
    )
    shown = missing.orderBy("value").limit(v.EXAMPLES).select(
        nothing.cast("bigint").alias("n"), F.col("value").cast("string").alias("value")
    )
    return counted.union(shown).agg(
        F.max("n").alias("orfaos_distintos"),
        F.array_sort(F.collect_list("value")).alias("exemplos"),
        F.when(F.max("n") == 0, v.REFERENCE_OK)
        .otherwise(v.REFERENCE_ORPHANS)
        .alias("resultado"),
    )


def severity(result: Column) -> Column:
    order = F.create_map(
        *[F.lit(x) for i, word in enumerate(v.REFERENCE_SEVERITY) for x in (word, i)]
    )
    return F.try_element_at(order, result)


def verdict(results: DataFrame, *by: str) -> DataFrame:
    """The worst result; no coded column at all is fine."""
    worst = F.max_by("resultado", severity(F.col("resultado")))
    return results.groupBy(*by).agg(
        F.coalesce(worst, F.lit(v.REFERENCE_OK)).alias("resultado")
    )
