"""The total a source declares about an entity, in a file of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagate.contract import Contract
from stratagate.operators import checks, profile
from stratagate.plans.acquire import selected_parts
from stratagate.session import settle
from stratagate.sinks.store import Store
from stratagate.sources import delimited


def total_of(store: Store, contract: Contract, period: str, folder: str) -> DataFrame:
    """One row: the total that the contract's own totals contract declares.

    Its file is looked for in the same acquisition and has to be exactly one part,
    which decodes as declared and shows the declared header. A total that is not
    one row of digits is NULL, which no count of rows agrees with.
    """
    totals, column = contract.declared_total
    spark, dialect = store.spark, totals.dialect
    if totals.base_identifier != contract.base_identifier:
        raise checks.PublicationBlocked(f"{totals.identifier} is not of {contract.base_identifier}")
    part = settle(selected_parts(store, totals.base_identifier, period, totals.file_pattern))
    checks.require(checks.part_count(part, 1, totals.identifier))
    path = [delimited.literal_path(part.first().path)]
    raw = profile.byte_lines(spark, path, folder, totals.split_parts)
    undecoded = profile.encoding(raw, dialect.encoding, delimited.PART).where("NOT decodes_declared")
    problems = [
        checks.as_problems(undecoded, "declared_total", F.col(delimited.PART), F.lit("does not decode as declared"))
    ]
    if dialect.header:
        first = delimited.measured_lines(spark, path, folder, dialect.encoding, totals.split_parts)
        problems.append(checks.header(first.select("part", "value"), totals))
    checks.require(*problems)
    return checks.total_from_file(delimited.scan_rows(spark, totals, path, folder), column)
