"""The run log: append-only rows, one at the start and one at the end of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratagate import vocabulary as v


def newest(runs: DataFrame, *by: str) -> DataFrame:
    """Newest row of each group; Spark keeps one candidate per task and group."""
    moment = F.coalesce("finalizado_em", "iniciado_em")
    order = Window.partitionBy(*by).orderBy(moment.desc(), F.col("id_execucao").desc())
    return (
        runs.withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def current(log: DataFrame) -> DataFrame:
    """Present state of each run: the end row when there is one."""
    order = Window.partitionBy("identificador", "id_execucao").orderBy(
        F.col("finalizado_em").desc_nulls_last()
    )
    return (
        log.withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def effective(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("status").isin(*v.EFFECTIVE))


def latest_effective(runs: DataFrame) -> DataFrame:
    return newest(effective(runs), "identificador", "tipo")


def latest_acquisition(runs: DataFrame) -> DataFrame:
    """Newest acquisition that brought files, per base and period."""
    brought = effective(runs).where(
        (F.col("tipo") == v.ACQUISITION) & (F.col("resultado") == v.ACQUIRED)
    )
    return newest(brought, "identificador", "competencia")


def newest_first(runs: DataFrame) -> DataFrame:
    return runs.orderBy(
        F.coalesce("finalizado_em", "iniciado_em").desc(), F.col("id_execucao").desc()
    )


def compatible_inspections(runs: DataFrame) -> DataFrame:
    return (
        effective(runs)
        .where((F.col("tipo") == v.INSPECTION) & (F.col("resultado") == v.COMPATIBLE))
        .select("identificador", "hash_leitura")
        .distinct()
    )


def approvals(runs: DataFrame) -> DataFrame:
    return (
        effective(runs)
        .where((F.col("tipo") == v.APPROVAL) & (F.col("resultado") == v.RESULT_APPROVED))
        .select("identificador", "hash_contrato")
        .distinct()
    )


def by_type_and_status(runs: DataFrame) -> DataFrame:
    return runs.groupBy("tipo", "status").agg(F.count(F.lit(1)).alias("execucoes"))


def silver_provenance(runs: DataFrame) -> DataFrame:
    """Each effective Silver run beside the Bronze run it read."""
    silver = effective(runs).where(F.col("tipo") == v.SILVER)
    bronze = runs.select(
        F.col("id_execucao").alias("id_execucao_origem"),
        F.col("id_execucao").alias("bronze_execucao"),
        F.col("hash_leitura").alias("bronze_hash_leitura"),
    )
    return silver.select("identificador", "id_execucao_origem").join(
        bronze, "id_execucao_origem"
    )


def detail(runs: DataFrame, field: str) -> DataFrame:
    """One field of the JSON details beside the run."""
    return runs.select(
        "identificador",
        "id_execucao",
        F.get_json_object("detalhes", f"$.{field}").alias(field),
    )


# ---------------------------------------------- quarantine acceptance


def duplicate_ids(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.groupBy("id_quarentena")
        .agg(F.count(F.lit(1)).alias("linhas"))
        .where("linhas > 1")
    )


def by_problem_group(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.groupBy("identificador", "camada", "grupo_problema")
        .agg(F.count(F.lit(1)).alias("linhas"))
        .orderBy(F.desc("linhas"), "identificador", "camada", "grupo_problema")
    )
