"""On-demand inspection of a delivery, diagnosis of references, catalogue sync."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Contract
from stratagate.operators import checks, profile, references, runlog
from stratagate.operators.checks import PublicationBlocked
from stratagate.operators.upsert import catalog_sync
from stratagate.plans.acquire import fingerprint_of, manifest_of
from stratagate.plans.runs import Run, attempt, history, new_run_id
from stratagate.sinks.store import Store
from stratagate.sources import delimited
from stratagate.sources.delimited import path_of
from stratagate.sources.landing import matches, select_parts


def require_period(store: Store, identifier: str, period: str) -> None:
    asked = store.spark.createDataFrame(
        [(identifier, period)], "identificador string, competencia string"
    )
    checks.require(checks.period_format(asked))


def inspect_delivery(store: Store, contract: Contract, period: str) -> Run:
    """Compare the files of the period's acquisition with the contract.

    The log names the acquisition, its fingerprint, the verdict and the folder of the
    report: one row per part (``parts``), their ``widths``, ``samples`` and
    ``problems``. Blank parts are in it; parts without a file never are.
    """
    spark = store.spark
    with attempt(store, v.INSPECTION, contract.identifier, period, contract) as run:
        require_period(store, contract.identifier, period)
        acquired = runlog.latest_acquisition(history(store, contract.base_identifier)).where(
            F.col("competencia") == period
        )
        source = acquired.first()
        if source is None:
            raise PublicationBlocked(f"no acquisition of {contract.base_identifier} for {period}")
        selected = select_parts(manifest_of(acquired), contract.file_pattern)
        run.values["id_execucao_origem"] = source.id_execucao
        run.values["publication_fingerprint"] = fingerprint_of(selected)
        folder = json.loads(source.detalhes)["pasta"]
        # the reader takes the folder; names that the pattern leaves out are pruned
        lines = profile.byte_lines(spark, folder, folder, contract.split_parts).where(
            matches(path_of("file"), contract.file_pattern)
        )
        survey = profile.Survey(lines, contract)
        at = store.folder(f"{store.control}.inspecoes", run.id)
        run.drafts.append(at)
        tables = {"problems": survey.problems(), "widths": survey.widths(), "samples": survey.samples()}
        for name, rows in tables.items():
            rows.write.parquet(f"{at}/{name}")
        problems = spark.read.parquet(f"{at}/problems")
        survey.report(problems).write.parquet(f"{at}/parts")
        result = profile.overall(spark.read.parquet(f"{at}/parts")).first()
        run.drafts.clear()
        run.values["resultado"] = result.verdict
        run.details["relatorio"] = at
        run.details["problemas_total"] = problems.count()
        shown = problems.orderBy(delimited.PART, "problem").limit(v.EXAMPLES)
        run.details["problemas"] = [f"{r[0]}: {r[1]}" for r in shown.collect()]
    return run


def diagnose_references(store: Store, contract: Contract, period: str) -> Run:
    """Count codes without a match in their reference tables; never blocks rows."""
    with attempt(store, v.DIAGNOSIS, contract.identifier, period, contract) as run:
        require_period(store, contract.identifier, period)
        table = f"{store.silver}.{contract.identifier}"
        if not store.exists(table):
            raise PublicationBlocked(f"no Silver table {table}")
        wanted = {f.reference.identifier for f in contract.fields if f.reference}
        if not wanted:
            run.values["resultado"] = v.REFERENCE_OK
            return run
        tables = {
            i: store.spark.table(f"{store.silver}.{i}")
            for i in wanted
            if store.exists(f"{store.silver}.{i}")
        }
        found = references.diagnose(store.spark.table(table), contract, tables)
        rows = [r.asDict() for r in found.collect()]
        run.details["referencias"] = rows
        run.values["resultado"] = max(
            (r["resultado"] for r in rows), key=v.REFERENCE_SEVERITY.index
        )
    return run


def sync_catalog(store: Store, name: str, rows: DataFrame) -> None:
    """New version of a catalogue table: structure updated, curation kept."""
    spark = store.spark
    table = f"{store.control}.{name}"
    wanted = spark.createDataFrame([], v.CATALOG_DDL[name])
    target = spark.table(table) if store.exists(table) else wanted
    folder = store.folder(table, new_run_id())
    catalog_sync(name, target, rows).write.parquet(folder)
    store.point(table, folder, wanted.dtypes)
