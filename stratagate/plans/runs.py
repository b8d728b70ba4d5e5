"""One publishing attempt, logged at its start and at its end whatever happens."""

from __future__ import annotations

import json
import secrets
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Contract
from stratagate.operators import runlog
from stratagate.operators.checks import PublicationBlocked
from stratagate.session import settle
from stratagate.sinks.store import Store


def new_run_id() -> str:
    return f"{datetime.now(UTC):%Y%m%dT%H%M%SZ}-{secrets.token_hex(4)}"


@dataclass
class Run:
    values: dict
    details: dict = field(default_factory=dict)
    alerts: list[str] = field(default_factory=list)
    #: Folders written by the attempt and not published; they go when it stops.
    drafts: list[str] = field(default_factory=list)

    @property
    def id(self) -> str:
        return self.values["id_execucao"]

    def row(self) -> dict:
        details = {**self.details, **({"alertas": self.alerts} if self.alerts else {})}
        text = json.dumps(details, ensure_ascii=False, sort_keys=True) if details else None
        return {**self.values, "detalhes": text}


def log(store: Store, run: Run) -> None:
    schema = store.spark.table(store.run_log).schema
    row = run.row()
    store.append(
        store.run_log,
        store.spark.createDataFrame([tuple(row.get(c) for c in schema.names)], schema),
    )


def history(store: Store, identifier: str) -> DataFrame:
    """Present state of one identifier's runs; prunes to its partition.

    One row per attempt of one table, read by several checks: computed once.
    """
    rows = store.spark.table(store.run_log)
    return settle(runlog.current(rows.where(F.col("identificador") == identifier)))


def compact_closed(store: Store, before: str) -> dict[str, int]:
    """Compact the run log and the quarantine of all periods before one.

    Attempts of those periods are over; the quarantine is put in the order of its
    ids, so a lookup reads only files that can hold them.
    """
    by, closed = [v.PARTITION_COL, v.PERIOD_COL], f"{v.PERIOD_COL} < '{before}'"
    return {
        store.run_log: store.compact(store.run_log, by, closed, ["iniciado_em", "id_execucao"]),
        store.quarantine: store.compact(store.quarantine, by, closed, ["id_quarentena"]),
    }


@contextmanager
def attempt(
    store: Store, kind: str, identifier: str, period: str, contract: Contract | None = None
) -> Iterator[Run]:
    run = Run(
        {
            "id_execucao": new_run_id(),
            "identificador": identifier,
            "tipo": kind,
            "status": v.RUNNING,
            "competencia": period,
            "iniciado_em": datetime.now(UTC),
        }
    )
    if contract is not None:
        run.values |= {
            "fonte": contract.source,
            "base": contract.base,
            "entidade": contract.entity,
            "versao_contrato": contract.version,
            "estado_contrato": contract.state,
            "hash_leitura": contract.read_hash,
            "hash_contrato": contract.full_hash,
        }
    log(store, run)
    try:
        yield run
        run.values["status"] = v.SUCCESS_WITH_ALERT if run.alerts else v.SUCCESS
    except PublicationBlocked as problem:
        run.values |= {"status": v.BLOCKED, "motivo": str(problem)[: v.ERROR_CHARS]}
        raise
    except Exception as error:
        reason = f"{type(error).__name__}: {error}"
        run.values |= {"status": v.FAILED, "motivo": reason[: v.ERROR_CHARS]}
        raise
    finally:
        for folder in run.drafts:
            store.discard(folder)
        run.values["finalizado_em"] = datetime.now(UTC)
        log(store, run)
