"""Dataset checks. Each returns (check, subject, problem) rows; empty = passed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Contract
from stratagate.operators.runlog import effective, latest_effective
from stratagate.session import written

PERIOD_PATTERN = "^[0-9]{4}-(0[1-9]|1[0-2])$"


class PublicationBlocked(Exception):
    """A check found problems; nothing was published."""


def as_problems(df: DataFrame, check: str, subject, problem: Column) -> DataFrame:
    subject = F.lit(subject) if isinstance(subject, str) else subject
    return df.select(
        F.lit(check).alias("check"),
        subject.cast("string").alias("subject"),
        problem.alias("problem"),
    )


def all_problems(*found: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, found)


def require(*found: DataFrame) -> None:
    """Stop when any check has a problem.

    All problems are kept in a table of the shared folder, which the message names
    with their number; it quotes as many as an error text holds.
    """
    every = all_problems(*found)
    if every.isEmpty():
        return
    problems = written(every, "problems")
    total = problems.count()
    quoted, size = [], 0
    for p in problems.orderBy("check", "subject", "problem").limit(v.ERROR_CHARS).toLocalIterator():
        told = f"{p.check} {p.subject}: {p.problem}"
        size += len(told) + 2
        if quoted and size > v.ERROR_CHARS - 200:
            break
        quoted.append(told)
    where = f" ({total} problems in {problems.inputFiles()[0].rsplit('/', 1)[0]})"
    raise PublicationBlocked("; ".join(quoted) + (where if total > len(quoted) else ""))


def _text(pattern: str, *columns) -> Column:
    return F.format_string(pattern, *columns)


# ------------------------------------------------------------ delivery


def period_valid(period: Column) -> Column:
    return F.coalesce(period.rlike(PERIOD_PATTERN), F.lit(False))


def period_format(request: DataFrame) -> DataFrame:
    """A period is a year and a month, or its order means nothing."""
    return as_problems(
        request.where(~period_valid(F.col("competencia"))),
        "period_format",
        F.col("identificador"),
        _text("period %s is not YYYY-MM", F.coalesce("competencia", F.lit("NULL"))),
    )


def part_count(selected: DataFrame, expected: int | None, subject: str) -> DataFrame:
    counted = selected.agg(F.count(F.lit(1)).alias("found"))
    wrong = F.col("found") == 0
    if expected is not None:
        wrong = wrong | (F.col("found") != expected)
    return as_problems(
        counted.where(wrong),
        "part_count",
        subject,
        _text(f"%d parts found, expected {expected or 'at least 1'}", "found"),
    )


def header_names(line: Column, separator: str, quote: str, escape: str = '"') -> Column:
    """Names of a header line: quotes and escapes honoured; BOM and blanks dropped."""
    s, q, e = (f"\\Q{x}\\E" for x in (separator, quote, escape))
    plain = f"(?!{q}|{e})."
    token = f"(?:^|{s})({q}(?:{plain}|{e}{q}|{e}(?!{q}))*{q}|(?:(?!{s}).)*)"
    clean = F.regexp_replace(line, "^﻿", "")
    found = F.regexp_extract_all(clean, F.lit(token), F.lit(1))

    def bare(name: Column) -> Column:
        inner = F.regexp_replace(name, f"^{q}(.*){q}$", "$1")
        return F.trim(F.replace(inner, F.lit(escape + quote), F.lit(quote)))

    return F.transform(found, bare)


def header(first_lines: DataFrame, contract: Contract) -> DataFrame:
    """Found header of every part against the declared names and positions."""
    expected = contract.expected_header
    place = F.create_map(
        *[F.lit(x) for i, names in enumerate(expected) for n in names for x in (n, i)]
    )
    d = contract.dialect
    found = first_lines.select(
        F.col(first_lines.columns[0]).alias("part"),
        header_names(F.col("value"), d.separator, d.quote, d.escape).alias("names"),
    )

    def misplaced(name: Column, at: Column) -> Column:
        declared = F.try_element_at(place, name)
        return F.when(
            declared.isNull(), _text("undeclared column %s", name)
        ).when(
            declared != at,
            _text("column %s at position %d, declared %d", name, at + 1, declared + 1),
        )

    width = F.when(
        F.size("names") != len(expected),
        _text(f"%d columns, declared {len(expected)}", F.size("names")),
    )
    missing = [
        F.when(
            ~F.arrays_overlap("names", F.array(*map(F.lit, names))),
            F.lit(f"missing column {names[0]}"),
        )
        for names in expected
    ]
    problems = F.array_compact(
        F.concat(F.array(width), F.transform("names", misplaced), F.array(*missing))
    )
    return as_problems(
        found.select("part", F.explode(problems).alias("problem")),
        "header",
        F.col("part"),
        F.col("problem"),
    )


def unexpected_parts(contracted: DataFrame, *seen: DataFrame) -> DataFrame:
    """Parts read or measured that the contract did not select."""
    every = reduce(DataFrame.union, [s.select("part") for s in seen]).distinct()
    return every.join(contracted.select("part"), "part", "left_anti")


def parts(
    contracted: DataFrame, physical: DataFrame, read: DataFrame, has_header: bool
) -> DataFrame:
    """Every part: physical = read, and at least one well-formed row."""
    per_part = (
        contracted.select("part", F.lit(True).alias("contracted"))
        .join(physical, "part", "full")
        .join(read, "part", "full")
    )
    expected = F.greatest(
        F.coalesce("physical", F.lit(0)) - int(has_header), F.lit(0)
    )
    rows = F.coalesce("read", F.lit(0))
    valid = rows - F.coalesce("malformed", F.lit(0))
    known = F.col("contracted").isNotNull()
    found = F.array_compact(
        F.array(
            F.when(
                known & (rows != expected),
                _text("%d physical lines, %d rows read", expected, rows),
            ),
            F.when(known & (valid == 0), F.lit("no valid row")),
            F.when(~known, F.lit("not a contracted part")),
        )
    )
    return as_problems(
        per_part.select("part", F.explode(found).alias("problem")),
        "parts",
        F.col("part"),
        F.col("problem"),
    )


def tolerance(read: DataFrame, limit: float, subject: str) -> DataFrame:
    """Malformed share above the limit; no rows at all pass."""
    total = read.agg(
        F.coalesce(F.sum("read"), F.lit(0)).alias("read"),
        F.coalesce(F.sum("malformed"), F.lit(0)).alias("malformed"),
    )
    over = (F.col("read") > 0) & (F.col("malformed") / F.greatest("read", F.lit(1)) > limit)
    return as_problems(
        total.where(over),
        "tolerance",
        subject,
        _text("%d of %d lines malformed", "malformed", "read"),
    )


def malformed_blocks(read: DataFrame, action: str, subject: str) -> DataFrame:
    total = read.agg(F.coalesce(F.sum("malformed"), F.lit(0)).alias("malformed"))
    blocked = (F.col("malformed") > 0) & F.lit(action == v.BLOCK)
    return as_problems(
        total.where(blocked),
        "malformed_blocks",
        subject,
        _text("%d malformed lines under a blocking action", "malformed"),
    )


def declared_total(read: DataFrame, declared: DataFrame, subject: str) -> DataFrame:
    """Total published by the source against the rows read; both one-row frames."""
    total = read.agg(F.coalesce(F.sum("read"), F.lit(0)).alias("read"))
    both = (
        total.withColumn("declared", F.lit(None).cast("bigint"))
        .union(declared.select(F.lit(None).cast("bigint"), declared.columns[0]))
        .agg(F.max("read").alias("read"), F.max("declared").alias("declared"))
    )
    differs = F.col("declared").isNull() | (F.col("declared") != F.col("read"))
    return as_problems(
        both.where(differs),
        "declared_total",
        subject,
        _text("declared %s, read %d", F.coalesce(F.col("declared").cast("string"), F.lit("nothing")), "read"),
    )


def total_from_file(rows: DataFrame, column: str) -> DataFrame:
    """The source's own total: exactly one row, digits only; otherwise NULL."""
    text = F.trim(column)
    number = F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))
    return rows.agg(
        F.when(F.count(F.lit(1)) == 1, F.max(number)).alias("declared_total")
    )


def landed(declared: DataFrame, manifest: DataFrame) -> DataFrame:
    """Every declared file landed; no part landed twice under one name."""
    absent = declared.select("part").join(manifest.select("part"), "part", "left_anti")
    twice = manifest.groupBy("part").count().where("count > 1")
    return all_problems(
        as_problems(absent, "landed", F.col("part"), F.lit("declared but not landed")),
        as_problems(twice, "landed", F.col("part"), _text("landed %d times", "count")),
    )


def relanded(before: DataFrame, after: DataFrame) -> DataFrame:
    """A part landed again must carry the same hash."""
    both = before.select("part", F.col("sha256").alias("old")).join(
        after.select("part", F.col("sha256").alias("new")), "part"
    )
    return as_problems(
        both.where("old <> new"), "relanded", F.col("part"), F.lit("content differs")
    )


# ---------------------------------------------------------- governance


def reconciliation(runs: DataFrame) -> DataFrame:
    """Source rows = published + quarantined, for every publishing run."""
    kept = F.col("linhas_publicadas") + F.col("linhas_quarentena")
    off = runs.where(F.col("linhas_origem") != kept)
    return as_problems(
        off,
        "reconciliation",
        F.col("id_execucao"),
        _text(
            "source %d, published %d, quarantined %d",
            "linhas_origem",
            "linhas_publicadas",
            "linhas_quarentena",
        ),
    )


def period(requested: DataFrame, runs: DataFrame, allow_earlier: bool) -> DataFrame:
    """Requested (identificador, tipo, competencia) must not go back in time."""
    current = latest_effective(runs).select(
        "identificador", "tipo", F.col("competencia").alias("current")
    )
    back = requested.join(current, ["identificador", "tipo"]).where(
        (F.col("competencia") < F.col("current")) & ~F.lit(allow_earlier)
    )
    return as_problems(
        back,
        "period",
        F.col("identificador"),
        _text("%s is before %s", "competencia", "current"),
    )


def version_hashes(runs: DataFrame) -> DataFrame:
    """Contract hashes effectively published under each version."""
    published = effective(runs).where(F.col("tipo").isin(v.BRONZE, v.SILVER))
    return published.groupBy("identificador", "versao_contrato").agg(
        F.array_sort(F.collect_set("hash_contrato")).alias("hashes")
    )


def version(requested: DataFrame, runs: DataFrame) -> DataFrame:
    """Same version, other hash: a silent change of the contract."""
    published = (
        effective(runs)
        .where(F.col("tipo").isin(v.BRONZE, v.SILVER))
        .groupBy("identificador", "versao_contrato", F.col("hash_contrato").alias("other"))
        .count()
    )
    changed = (
        requested.join(published, ["identificador", "versao_contrato"])
        .where(F.col("other") != F.col("hash_contrato"))
        .select("identificador", "versao_contrato")
        .distinct()
    )
    return as_problems(
        changed,
        "version",
        F.col("identificador"),
        _text("version %d was published with another hash", "versao_contrato"),
    )


def provenance(requested: DataFrame, runs: DataFrame) -> DataFrame:
    """Silver reads only a current Bronze of the same period and read hash."""
    bronze = (
        latest_effective(runs)
        .where(F.col("tipo") == v.BRONZE)
        .select(
            "identificador",
            F.col("id_execucao").alias("bronze_run"),
            F.col("competencia").alias("bronze_period"),
            F.col("hash_leitura").alias("bronze_hash"),
        )
    )
    both = requested.join(bronze, "identificador", "left")
    none = F.col("bronze_run").isNull()

    def differs(theirs: str, mine: str) -> Column:
        return ~none & ~F.col(theirs).eqNullSafe(F.col(mine))

    found = F.array_compact(
        F.array(
            F.when(none, F.lit("no effective Bronze")),
            F.when(
                differs("bronze_period", "competencia"),
                _text("Bronze is of %s", F.coalesce("bronze_period", F.lit("no period"))),
            ),
            F.when(
                differs("bronze_hash", "hash_leitura"),
                F.lit("Bronze was read under another hash"),
            ),
        )
    )
    return as_problems(
        both.select("identificador", F.explode(found).alias("problem")),
        "provenance",
        F.col("identificador"),
        F.col("problem"),
    )


def snapshot_composition(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(v.RUN_COL, v.PERIOD_COL).agg(F.count(F.lit(1)).alias("rows"))


def snapshot(
    composition: DataFrame, run_id: str, period_: str, rows: int, subject: str
) -> DataFrame:
    """The Bronze table is exactly the logged publication."""
    mine = (F.col(v.RUN_COL) == run_id) & (F.col(v.PERIOD_COL) == period_)
    seen = composition.agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(mine).alias("mine"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
    )
    found = F.array_compact(
        F.array(
            F.when(
                (F.col("groups") != 1) | (F.col("mine") != 1),
                _text("%d publications in the table, %d expected one", "groups", "mine"),
            ),
            F.when(F.col("total") != rows, _text(f"%d rows, run logged {rows}", "total")),
        )
    )
    return as_problems(
        seen.select(F.explode(found).alias("problem")),
        "snapshot",
        subject,
        F.col("problem"),
    )


def evidence(requested: DataFrame, runs: DataFrame) -> DataFrame:
    """A declared state needs its evidence; an obsolete contract never publishes.

    ``requested``: identificador, estado_contrato, hash_leitura, hash_contrato.
    """
    done = effective(runs)
    inspected = (
        done.where((F.col("tipo") == v.INSPECTION) & (F.col("resultado") == v.COMPATIBLE))
        .select("identificador", "hash_leitura", F.lit(True).alias("inspected"))
        .distinct()
    )
    approved = (
        done.where((F.col("tipo") == v.APPROVAL) & (F.col("resultado") == v.RESULT_APPROVED))
        .select("identificador", "hash_contrato", F.lit(True).alias("approved"))
        .distinct()
    )
    known = requested.join(inspected, ["identificador", "hash_leitura"], "left").join(
        approved, ["identificador", "hash_contrato"], "left"
    )
    state = F.col("estado_contrato")
    found = F.array_compact(
        F.array(
            F.when(state == v.OBSOLETE, F.lit("obsolete contract")),
            F.when(
                state.isin(v.VALIDATED, v.APPROVED) & F.col("inspected").isNull(),
                F.lit("no compatible inspection for this read hash"),
            ),
            F.when(
                (state == v.APPROVED) & F.col("approved").isNull(),
                F.lit("no approval for this contract hash"),
            ),
        )
    )
    return as_problems(
        known.select("identificador", F.explode(found).alias("problem")),
        "evidence",
        F.col("identificador"),
        F.col("problem"),
    )
