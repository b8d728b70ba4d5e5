"""Silver: typed, checked rows; the withdrawn ones go to the quarantine."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Contract
from stratagate.operators import checks
from stratagate.operators.evaluate import (
    Evaluation,
    blocking_examples,
    evaluate,
    fired,
    published_rows,
    totals,
)
from stratagate.operators.quarantine import Origin, withdrawn_rows
from stratagate.operators.runlog import latest_effective
from stratagate.plans.publish import publish, require_governance, require_schema
from stratagate.plans.runs import Run, attempt
from stratagate.sinks.store import Store


def write_and_measure(ev: Evaluation, period: str, run_id: str, folder: str) -> dict:
    """Write the published rows; totals come from the same pass.

    The metrics sit in the writing stage, so a retried task counts once.
    """
    seen = Observation()
    watched = Evaluation(ev.rows.observe(seen, *totals(ev.checks)), ev.checks, ev.contract)
    published_rows(watched, period, run_id).write.parquet(folder)
    return seen.get


def violations(ev: Evaluation, measured: dict) -> list[dict]:
    listed = [
        {
            "classe": c.kind,
            "regra": c.rule,
            "coluna": c.column,
            "acao": c.action,
            "linhas": measured[fired(i)],
        }
        for i, c in enumerate(ev.checks)
        if measured[fired(i)]
    ]
    return sorted(listed, key=lambda x: (x["classe"], x["coluna"] or ""))


def publish_silver(
    store: Store, contract: Contract, period: str, allow_earlier: bool = False
) -> Run:
    """Publish the typed rows of the current Bronze of the period."""
    spark = store.spark
    table = f"{store.silver}.{contract.identifier}"
    schema = contract.silver_schema()
    with attempt(store, v.SILVER, contract.identifier, period, contract) as run:
        runs = require_governance(store, contract, run, allow_earlier)
        require_schema(store, table, contract, schema, runs, v.SILVER)
        source = latest_effective(runs).where(F.col("tipo") == v.BRONZE).first()
        run.values |= {
            "publication_fingerprint": source.publication_fingerprint,
            "id_execucao_origem": source.id_execucao,
            "linhas_origem": source.linhas_publicadas,
        }
        bronze = spark.table(f"{store.bronze}.{contract.identifier}")
        checks.require(
            checks.snapshot(
                checks.snapshot_composition(bronze),
                source.id_execucao,
                period,
                source.linhas_publicadas,
                contract.identifier,
            )
        )
        ev = evaluate(bronze, contract)
        version = store.folder(table, run.id)
        run.drafts.append(version)
        measured = write_and_measure(ev, period, run.id, version)
        run.details["violacoes"] = violations(ev, measured)
        if measured["total"] != source.linhas_publicadas:
            raise checks.PublicationBlocked(
                f"evaluated {measured['total']} rows, Bronze has {source.linhas_publicadas}"
            )
        if measured["block"]:
            run.details["exemplos_bloqueio"] = [
                r.asDict() for r in blocking_examples(ev).collect()
            ]
            raise checks.PublicationBlocked(
                f"{measured['block']} rows with a blocking violation"
            )
        if measured["alert"]:
            run.alerts.append(f"{measured['alert']} rows with an alerting violation")
        publication = Origin(
            contract, "silver", period, source.publication_fingerprint, run.id
        )
        publish(
            store,
            table,
            version,
            schema,
            contract,
            run,
            publication,
            withdrawn_rows(ev),
            expected_published=measured["total"] - measured["withdraw"],
            expected_withdrawn=measured["withdraw"],
        )
    return run
