"""Bronze: text as delivered, malformed lines set apart, one parse of the files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Contract
from stratagate.operators import checks
from stratagate.operators.quarantine import Origin, malformed_rows
from stratagate.plans.publish import publish, require_governance, require_schema
from stratagate.plans.runs import Run, attempt
from stratagate.plans.totals import total_of
from stratagate.session import settings, settle
from stratagate.sinks.store import Store
from stratagate.sources import delimited
from stratagate.sources.delimited import LINE

WELL_FORMED = "_well_formed"


def stage(
    rows: DataFrame, contract: Contract, period: str, run_id: str, folder: str
) -> None:
    """Write well-formed and malformed rows side by side, parsing only once."""
    staged = rows.select(
        *delimited.bronze_columns(contract, period, run_id),
        F.col(LINE),
        F.col(LINE).isNull().alias(WELL_FORMED),
    )
    # two open files per task instead of a sort on the flag
    with settings(
        rows.sparkSession, spark__sql__maxConcurrentOutputFileWriters="2"
    ):
        staged.write.partitionBy(WELL_FORMED).parquet(folder)


def staged_counts(staged: DataFrame) -> DataFrame:
    """Rows read and malformed per part, from two columns of the staged rows."""
    return staged.groupBy(F.col(v.PART_COL).alias("part")).agg(
        F.count(F.lit(1)).alias("read"),
        F.count_if(~F.col(WELL_FORMED)).alias("malformed"),
    )


def publish_bronze(
    store: Store,
    contract: Contract,
    period: str,
    manifest: DataFrame,
    folder: str,
    fingerprint: str,
    declared_total: DataFrame | None = None,
    allow_earlier: bool = False,
) -> Run:
    """Publish the selected parts of one delivery.

    ``manifest``: part and path of the files the contract selects, below
    ``folder``. ``declared_total``: one row with the total the source declares; without
    it the contract's totals file tells, if the contract names one.
    """
    spark = store.spark
    table = f"{store.bronze}.{contract.identifier}"
    schema = contract.bronze_schema()
    with attempt(store, v.BRONZE, contract.identifier, period, contract) as run:
        run.values["publication_fingerprint"] = fingerprint
        runs = require_governance(store, contract, run, allow_earlier)
        require_schema(store, table, contract, schema, runs, v.BRONZE)
        checks.require(
            checks.part_count(manifest, contract.part_count, contract.identifier)
        )
        # paths of the contracted parts, as the reader wants them
        paths = [delimited.literal_path(r.path) for r in manifest.select("path").collect()]
        lines = settle(
            delimited.measured_lines(
                spark, paths, folder, contract.dialect.encoding, contract.split_parts
            )
        )
        if contract.dialect.header:
            named = manifest.select("part").join(lines, "part")
            checks.require(checks.header(named.select("part", "value"), contract))
        version = store.folder(table, run.id)
        run.drafts.append(version)
        rows = delimited.scan_rows(spark, contract, paths, folder)
        stage(rows, contract, period, run.id, version)
        staged = spark.read.parquet(version)
        read = staged_counts(staged)
        physical = lines.select("part", "physical")
        counts = _part_table(manifest, physical, read).collect()
        run.details["partes"] = {
            r.part: {"fisicas": r.physical, "lidas": r.read, "malformadas": r.malformed}
            for r in counts
        }
        measured = spark.createDataFrame(
            counts, "part string, physical bigint, read bigint, malformed bigint"
        )
        header = int(contract.dialect.header)
        run.values["linhas_origem"] = sum(max(r.physical - header, 0) for r in counts)
        action = contract.actions[v.MALFORMED]
        problems = [
            checks.parts(
                manifest,
                measured.select("part", "physical"),
                measured.select("part", "read", "malformed"),
                contract.dialect.header,
            ),
            checks.tolerance(measured, contract.dialect.tolerance, contract.identifier),
            checks.malformed_blocks(measured, action, contract.identifier),
        ]
        if declared_total is None and contract.declared_total is not None:
            declared_total = settle(total_of(store, contract, period, folder))
        if declared_total is not None:
            run.details["total_declarado"] = declared_total.first()[0]
            problems.append(
                checks.declared_total(measured, declared_total, contract.identifier)
            )
        checks.require(*problems)
        total = sum(r.read for r in counts)
        bad = sum(r.malformed for r in counts)
        if bad and action in v.ALERTING:
            run.alerts.append(f"{bad} malformed lines in quarantine")
        publication = Origin(contract, "bronze", period, fingerprint, run.id)
        publish(
            store,
            table,
            f"{version}/{WELL_FORMED}=true",
            schema,
            contract,
            run,
            publication,
            malformed_rows(staged.where(~F.col(WELL_FORMED)), LINE, action),
            expected_published=total - bad,
            expected_withdrawn=bad,
        )
    return run


def _part_table(
    manifest: DataFrame, physical: DataFrame, read: DataFrame
) -> DataFrame:
    """One row per file: contracted, found or read."""
    zero = F.lit(0).cast("bigint")
    return (
        manifest.select("part")
        .join(physical, "part", "full")
        .join(read, "part", "full")
        .select(
            "part",
            *[F.coalesce(c, zero).alias(c) for c in ("physical", "read", "malformed")],
        )
    )
