"""The last steps of every publication: quarantine, reconcile, then repoint."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stratagate import vocabulary as v
from stratagate.contract import Contract
from stratagate.operators import checks, quarantine
from stratagate.operators.quarantine import Origin
from stratagate.operators.runlog import latest_effective
from stratagate.operators.schema import schema_change, schema_diff, schema_rows
from stratagate.plans.runs import Run, history
from stratagate.session import written
from stratagate.sinks.store import Store

LINEAGE_COMMENTS = {
    v.PERIOD_COL: "Period of the publication (YYYY-MM).",
    v.PART_COL: "Delivered file the row came from.",
    v.RUN_COL: "Run that published the row.",
}
LAYER_COMMENTS = {
    v.BRONZE: "Bronze: text as delivered.",
    v.SILVER: "Silver: types, domains and rules of the contract applied.",
}


def table_comment(contract: Contract, kind: str) -> str:
    origin = f"Contract {contract.identifier} version {contract.version}."
    return " ".join(t for t in (contract.description, LAYER_COMMENTS[kind], origin) if t)


def column_comments(contract: Contract, kind: str) -> dict[str, str]:
    comments = {f.name: f.description for f in contract.fields}
    if kind == v.SILVER:
        comments |= {
            f.label_column: f"Label of {f.name}."
            for f in contract.fields
            if f.label_column
        }
    return comments | LINEAGE_COMMENTS


def require_governance(
    store: Store, contract: Contract, run: Run, allow_earlier: bool
) -> DataFrame:
    """Evidence of the state, version and period; returns the run history."""
    runs = history(store, contract.identifier)
    request = store.spark.createDataFrame(
        [
            (
                contract.identifier,
                run.values["tipo"],
                run.values["competencia"],
                contract.version,
                contract.state,
                contract.read_hash,
                contract.full_hash,
            )
        ],
        "identificador string, tipo string, competencia string, versao_contrato int,"
        " estado_contrato string, hash_leitura string, hash_contrato string",
    )
    found = [
        checks.period_format(request),
        checks.evidence(request, runs),
        checks.version(request, runs),
        checks.period(request, runs, allow_earlier),
    ]
    if run.values["tipo"] == v.SILVER:
        found.append(checks.provenance(request, runs))
    checks.require(*found)
    return runs


def require_schema(
    store: Store, table: str, contract: Contract, schema, runs: DataFrame, kind: str
) -> None:
    if not store.exists(table):
        return
    current = store.schema_of(table)
    if current == schema:
        return
    spark = store.spark
    last = latest_effective(runs).where(f"tipo = '{kind}'").select("versao_contrato").first()
    versions = spark.createDataFrame(
        [(table, contract.version, last and last[0])],
        "entity string, version int, published int",
    )
    diff = schema_diff(
        schema_rows(spark, table, current), schema_rows(spark, table, schema)
    )
    checks.require(schema_change(diff, versions))


def append_quarantine(store: Store, rows: DataFrame, publication: Origin) -> int:
    """Append the rows not stored yet, then count by reading back those that are.

    The rows are evaluated once; both joins then read their ids from a table.
    """
    rows = written(rows, "withdrawn")

    def stored() -> DataFrame:
        return quarantine.of_publication(store.spark.table(store.quarantine), publication)

    store.append(store.quarantine, quarantine.new_rows(rows, stored()))
    return quarantine.present_rows(stored(), rows).count()


def publish(
    store: Store,
    table: str,
    folder: str,
    schema: list[tuple[str, str]],
    contract: Contract,
    run: Run,
    publication: Origin,
    withdrawn: DataFrame,
    expected_published: int,
    expected_withdrawn: int,
) -> None:
    """Reconcile counts measured apart from each other; only then repoint."""
    kind = run.values["tipo"]
    kept = 0
    if expected_withdrawn:
        layout = quarantine.quarantine_layout(withdrawn, publication)
        kept = append_quarantine(store, layout, publication)
    published = store.count_version(folder, schema)
    run.values |= {
        "tabela_destino": table,
        "linhas_publicadas": published,
        "linhas_quarentena": kept,
    }
    source = run.values["linhas_origem"]
    due = {
        "source rows": (published + kept, source),
        "published rows": (published, expected_published),
        "quarantined rows": (kept, expected_withdrawn),
    }
    wrong = [f"{found} {what}, {wanted} due" for what, (found, wanted) in due.items() if found != wanted]
    if wrong:
        raise checks.PublicationBlocked("reconciliation: " + "; ".join(wrong))
    # from here on the folder is the table's
    run.drafts.clear()
    store.point(table, folder, schema, table_comment(contract, kind), column_comments(contract, kind))
    run.details["snapshot"] = folder
