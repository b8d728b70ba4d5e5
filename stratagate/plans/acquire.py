"""Register a deposited delivery: which files landed, with size and hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.operators import checks, runlog
from stratagate.plans.runs import Run, attempt, history
from stratagate.sinks.store import Store
from stratagate.sources.landing import landing_manifest, publication_fingerprint, select_parts

PARTS_TYPE = "partes array<struct<part:string,path:string,bytes:bigint,sha256:string>>"


def manifest_of(runs: DataFrame) -> DataFrame:
    """Landed files listed in the details of acquisition runs."""
    listed = F.from_json("detalhes", PARTS_TYPE)["partes"]
    return runs.select("identificador", "competencia", F.inline(listed))


def acquire(
    store: Store,
    base: str,
    period: str,
    folder: str,
    declared: Sequence[str] = (),
    force: bool = False,
) -> Run:
    """Log the files below ``folder``; a known period is not landed again unless forced."""
    with attempt(store, v.ACQUISITION, base, period) as run:
        asked = store.spark.createDataFrame(
            [(base, period)], "identificador string, competencia string"
        )
        checks.require(checks.period_format(asked))
        known = runlog.latest_acquisition(history(store, base)).where(
            F.col("competencia") == period
        )
        before = known.first()
        if before is not None and not force:
            run.values["resultado"] = v.EXISTING
            run.values["id_execucao_origem"] = before.id_execucao
            return run
        manifest = landing_manifest(store.spark, folder, folder)
        wanted = store.spark.createDataFrame([(d,) for d in declared], "part string")
        problems = [checks.landed(wanted, manifest)]
        if before is not None:
            earlier = manifest_of(known)
            same_place = manifest.join(earlier.select("path"), "path", "left_semi")
            problems.append(checks.relanded(earlier, same_place))
        checks.require(*problems)
        # a delivery's files, not their rows
        run.details["partes"] = [r.asDict() for r in manifest.collect()]
        run.details["pasta"] = folder
        run.values["resultado"] = v.ACQUIRED
    return run


def selected_parts(store: Store, base: str, period: str, pattern: str) -> DataFrame:
    """Files of the period's acquisition that match the contract's pattern."""
    runs = runlog.latest_acquisition(history(store, base)).where(
        F.col("competencia") == period
    )
    return select_parts(manifest_of(runs), pattern)


def fingerprint_of(parts: DataFrame) -> str:
    return publication_fingerprint(parts).first()[0]
