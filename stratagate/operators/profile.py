"""Physical profile of delivered files, over whole files.

Everything here is an aggregate with a map-side combine; no line is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Contract, Dialect
from stratagate.operators import checks
from stratagate.operators.sizing import broadcast_if_small
from stratagate.session import settle, written
from stratagate.sources.delimited import PART, decoded, has_text, source_part


def byte_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    folder: str,
    split: bool = False,
) -> DataFrame:
    """Lines cut at LF only, with the size of the file they come from.

    The reader keeps the bytes as they are, so lengths and validity are exact.
    """
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("lineSep", "\n")
        .text(paths)
    )
    return lines.select(
        source_part(folder, split).alias(PART),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        "value",
        F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id()).alias("at"),
    )


def terminators(lines: DataFrame) -> DataFrame:
    """CRLF, LF, mixed or none, per part.

    Line bytes plus one LF each exceed the file size by one when the last line
    has no LF, and fall short by three when the reader dropped a UTF-8 BOM.
    """
    ends_cr = F.col("value").endswith("\r")
    return _terminators(
        lines.groupBy(PART, "file").agg(
            F.count_if(ends_cr).alias("crlf"),
            F.count_if(~ends_cr).alias("plain"),
            (F.max("file_size") - F.sum(F.octet_length("value") + 1)).alias("rest"),
        )
    )


def _terminators(files: DataFrame) -> DataFrame:
    lf = F.col("plain") - F.col("rest").isin(-1, 2).cast("int")
    counted = files.groupBy(PART).agg(
        F.sum("crlf").alias("crlf"),
        F.sum(lf).alias("lf"),
        F.bool_or(F.col("rest").isin(2, 3)).alias("bom"),
    )
    crlf, lf = F.col("crlf") > 0, F.col("lf") > 0
    kind = (
        F.when(crlf & lf, "mixed")
        .when(crlf, "CRLF")
        .when(lf, "LF")
        .otherwise("undefined")
    )
    return counted.select(PART, kind.alias("terminator"), "bom")


def occurrences(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def likely_separator(lines: DataFrame, *by: str) -> DataFrame:
    """Candidate found in every line, with the most stable count.

    Stability is the number of lines showing the commonest count; then the
    larger count, then the order of the candidates.
    """
    counts = mark_counts(F.col("value"))
    patterns = (
        lines.select(*by, *counts)
        .groupBy(*by, *MARKS)
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    return _best_separator(patterns, *by)


MARKS = [f"_n{i}" for i in range(len(v.SEPARATOR_CANDIDATES))]


def mark_counts(text: Column) -> list[Column]:
    return [occurrences(text, m).alias(n) for m, n in zip(v.SEPARATOR_CANDIDATES, MARKS, strict=True)]


def _best_separator(patterns: DataFrame, *by: str) -> DataFrame:
    marks = v.SEPARATOR_CANDIDATES
    each = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("rank"),
                    F.lit(m).alias("separator"),
                    F.col(f"_n{i}").alias("n"),
                    "lines",
                )
                for i, m in enumerate(marks)
            ]
        )
    )
    by_count = (
        patterns.select(*by, each)
        .groupBy(*by, "rank", "separator", "n")
        .agg(F.sum("lines").alias("lines"))
    )
    scored = (
        by_count.groupBy(*by, "rank", "separator")
        .agg(F.min("n").alias("least"), F.max(F.struct("lines", "n")).alias("mode"))
        .where("least > 0")
    )
    best = F.max_by("separator", F.struct("mode.lines", "mode.n", -F.col("rank")))
    return scored.groupBy(*by).agg(best.alias("separator"))


def record_width(line: Column, dialect: Dialect) -> Column:
    """Number of fields in a line, separators inside quotes left out."""
    s, q = f"\\Q{dialect.separator}\\E", f"\\Q{dialect.quote}\\E"
    if dialect.escape == dialect.quote:
        plain = F.replace(line, F.lit(dialect.quote * 2), F.lit(""))
    else:
        plain = F.regexp_replace(line, f"\\Q{dialect.escape}\\E.", "")
    bare = F.regexp_replace(plain, f"(^|{s}){q}[^{dialect.quote}]*({q}|$)", "$1")
    return occurrences(bare, dialect.separator) + 1


def widths(lines: DataFrame, dialect: Dialect, *by: str) -> DataFrame:
    return lines.groupBy(*by, record_width(F.col("value"), dialect).alias("width")).agg(
        F.count(F.lit(1)).alias("lines")
    )


def encoding(lines: DataFrame, declared: str, *by: str) -> DataFrame:
    """Does every line decode as declared, does it read as UTF-8, is it ASCII?"""
    undecoded, not_utf8, not_ascii = _byte_flags(F.col("value"), declared)
    counted = lines.groupBy(*by).agg(
        F.count_if(undecoded).alias("undecoded"),
        F.count_if(not_utf8).alias("not_utf8"),
        F.count_if(not_ascii).alias("not_ascii"),
    )
    return _encoding(counted, declared, *by)


def _byte_flags(text: Column, declared: str) -> tuple[Column, Column, Column]:
    utf8 = F.is_valid_utf8(text)
    decodes = {
        "utf-8": utf8,
        "iso-8859-1": F.lit(True),
        # the five bytes this charset leaves undefined
        "windows-1252": ~F.decode(text.cast("binary"), "ISO-8859-1").rlike(
            "[\\u0081\\u008D\\u008F\\u0090\\u009D]"
        ),
    }[declared]
    return ~decodes, ~utf8, text.rlike("[^\\x00-\\x7F]")


def _encoding(counted: DataFrame, declared: str, *by: str) -> DataFrame:
    return counted.select(
        *by,
        (F.col("undecoded") == 0).alias("decodes_declared"),
        (F.col("not_utf8") == 0).alias("decodes_utf8"),
        (
            F.lit(declared != "utf-8") & (F.col("not_utf8") == 0) & (F.col("not_ascii") > 0)
        ).alias("looks_utf8"),
    )


def samples(rows: DataFrame, columns: Sequence[str], *by: str) -> DataFrame:
    """Up to three distinct non-empty values of each column, 60 characters each.

    Smallest, largest and the smallest in between: two aggregates over the
    data, whatever the number of distinct values.
    """
    cut = rows.select(
        *by,
        *[F.nullif(F.substring(c, 1, v.SAMPLE_CHARS), F.lit("")).alias(c) for c in columns],
    )
    ends = settle(
        cut.groupBy(*by).agg(
            *[f(c).alias(f"_{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
        )
    )
    middle = cut.join(broadcast_if_small(ends), list(by)).groupBy(*by).agg(
        *[
            F.min(
                F.when(
                    (F.col(c) > F.col(f"_min_{c}")) & (F.col(c) < F.col(f"_max_{c}")), F.col(c)
                )
            ).alias(f"_mid_{c}")
            for c in columns
        ]
    )
    shown = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.array_distinct(
                        F.array_compact(F.array(f"_min_{c}", f"_mid_{c}", f"_max_{c}"))
                    ).alias("samples"),
                )
                for c in columns
            ]
        )
    )
    return ends.join(middle, list(by)).select(*by, shown)


def part_problems(
    lines: DataFrame, raw_lines: DataFrame, first: DataFrame, contract: Contract
) -> DataFrame:
    """(part, problem) rows of an inspection; a part without any is compatible.

    ``lines`` are the physical lines, ``raw_lines`` the same as
    :func:`byte_lines`, ``first`` the first line of every part.
    """
    dialect = contract.dialect
    return problems_of(
        encoding(raw_lines, dialect.encoding, PART),
        likely_separator(lines, PART),
        widths(lines, dialect, PART),
        first,
        contract,
    )


def record_counts(every: DataFrame, first: DataFrame, contract: Contract) -> DataFrame:
    """(part, records, off): records of a part, and those of another width."""
    dialect = contract.dialect
    if dialect.header:
        # the header line is not a record
        header = widths(first, dialect, PART).withColumn("lines", F.lit(-1).cast("bigint"))
        every = every.unionByName(header)
    other = F.when(F.col("width") != len(contract.source_fields), F.col("lines")).otherwise(0)
    return every.groupBy(PART).agg(F.sum("lines").alias("records"), F.sum(other).alias("off"))


def problems_of(
    enc: DataFrame, separator: DataFrame, every: DataFrame, first: DataFrame, contract: Contract
) -> DataFrame:
    """Problems from the encoding, likely separator, widths and first line of every part."""
    dialect = contract.dialect
    problem = F.col("problem")
    found = enc.select(
        PART,
        F.explode(
            F.array_compact(
                F.array(
                    F.when(~F.col("decodes_declared"), F.lit("does not decode as declared")),
                    F.when(F.col("looks_utf8"), F.lit("reads as UTF-8, another charset is declared")),
                )
            )
        ).alias("problem"),
    ).union(
        separator.where(F.col("separator") != dialect.separator).select(
            PART, F.concat(F.lit("likely separator "), "separator").alias("problem")
        )
    )
    if dialect.header:
        named = checks.header(first, contract)
        found = found.union(named.select(F.col("subject").alias(PART), problem))
    records = record_counts(every, first, contract)
    shape = F.when(F.col("records") <= 0, F.lit("no data records")).when(
        F.col("off") > 0,
        F.format_string("%d of %d records of another width", "off", "records"),
    )
    return found.union(records.select(PART, shape.alias("problem")).where(problem.isNotNull()))


def verdict(parts: DataFrame, problems: DataFrame) -> DataFrame:
    """Verdict per part."""
    counted = problems.groupBy(PART).agg(F.count(F.lit(1)).alias("problems"))
    n = F.coalesce("problems", F.lit(0))
    return parts.select(PART).join(counted, PART, "left").select(
        PART,
        n.alias("problems"),
        F.when(n == 0, v.COMPATIBLE).otherwise(v.INCOMPATIBLE).alias("verdict"),
    )


def overall(verdicts: DataFrame) -> DataFrame:
    """Compatible only when there are parts and all of them are."""
    fine = F.coalesce(F.bool_and(F.col("verdict") == v.COMPATIBLE), F.lit(False))
    return verdicts.agg(
        F.count(F.lit(1)).alias("parts"),
        F.when(fine, v.COMPATIBLE).otherwise(v.INCOMPATIBLE).alias("verdict"),
    )


# ------------------------------------------------------------ one scan


class Survey:
    """Everything an inspection tells about the parts of a delivery.

    One pass over the byte lines writes a table of line patterns: per file, how many
    lines show the same counts of separator candidates and the same width, with
    their terminators, bytes, encoding, first line and the least and greatest value
    of every column. All reports are aggregates of that table; only the sample
    between least and greatest takes a second pass.
    """

    def __init__(self, lines: DataFrame, contract: Contract):
        self.contract = contract
        self.columns = [f.name for f in contract.source_fields]
        self._records = self._records_of(lines)
        self.patterns = written(self._patterns(), "survey")

    def _records_of(self, lines: DataFrame) -> DataFrame:
        """Lines as the row reader cuts them: at a lone CR too, blank ones apart."""
        dialect = self.contract.dialect
        undecoded, not_utf8, not_ascii = _byte_flags(F.col("value"), dialect.encoding)
        ends_cr = F.col("value").endswith("\r")
        body = F.when(ends_cr, F.substring("value", 1, F.length("value") - 1)).otherwise(F.col("value"))
        cut = lines.select(
            PART, "file", "file_size", "at",
            ends_cr.alias("_cr"), (F.octet_length("value") + 1).alias("_bytes"),
            undecoded.alias("_undecoded"), not_utf8.alias("_not_utf8"), not_ascii.alias("_not_ascii"),
            F.posexplode(F.split(body, "\r")).alias("_place", "_raw"),
        )
        text = decoded(F.col("_raw"), dialect.encoding)
        seen = cut.withColumn("_seen", has_text(F.col("_raw"))).withColumn("value", text)
        layout = ", ".join(f"`{c}` string" for c in self.columns)
        options = {"sep": dialect.separator, "quote": dialect.quote, "escape": dialect.escape}
        width = F.when(F.col("_seen"), record_width(F.col("value"), dialect))
        return seen.withColumn("width", width).withColumn(
            "_row",
            F.when(
                F.col("width") == len(self.columns),
                F.from_csv("value", layout, {**options, "columnNameOfCorruptRecord": "_malformed"}),
            ),
        ).withColumn("_row", F.when(~self._like_header(), F.col("_row")))

    def _like_header(self) -> Column:
        if not self.contract.dialect.header:
            return F.lit(False)
        named = [
            F.coalesce(F.trim(F.regexp_replace(F.col("_row").getField(f.name), "^\ufeff", "")).isin(*f.header_names), F.lit(False))
            for f in self.contract.source_fields
        ]
        return reduce(and_, named)

    def _shown(self, column: str) -> Column:
        return F.nullif(F.substring(F.col("_row").getField(column), 1, v.SAMPLE_CHARS), F.lit(""))

    def _patterns(self) -> DataFrame:
        once = F.col("_place") == 0
        first = F.when(F.col("at").isNotNull() & F.col("_seen"), F.struct("at", "_place"))
        marks = [F.when(F.col("_seen"), c).alias(n) for c, n in zip(mark_counts(F.col("value")), MARKS, strict=True)]
        shown = [self._shown(c).alias(f"_v{i}") for i, c in enumerate(self.columns)]
        rows = self._records.select("*", *marks, *shown)
        ends = [f(f"_v{i}").alias(f"_{f.__name__}{i}") for i in range(len(self.columns)) for f in (F.min, F.max)]
        return rows.groupBy(PART, "file", *MARKS, "width").agg(
            F.count_if("_seen").alias("lines"),
            F.count_if(once & F.col("_cr")).alias("crlf"),
            F.count_if(once & ~F.col("_cr")).alias("plain"),
            F.coalesce(F.sum(F.when(once, F.col("_bytes"))), F.lit(0)).alias("bytes"),
            F.max("file_size").alias("file_size"),
            *[F.count_if(once & F.col(f"_{n}")).alias(n) for n in ("undecoded", "not_utf8", "not_ascii")],
            F.min(F.when(first.isNotNull(), F.struct("at", "_place", "value"))).alias("first"),
            *ends,
        )

    @property
    def seen(self) -> DataFrame:
        return self.patterns.where("lines > 0")

    def terminators(self) -> DataFrame:
        files = self.patterns.groupBy(PART, "file").agg(
            F.sum("crlf").alias("crlf"),
            F.sum("plain").alias("plain"),
            (F.max("file_size") - F.sum("bytes")).alias("rest"),
        )
        return _terminators(files)

    def encoding(self) -> DataFrame:
        flags = ("undecoded", "not_utf8", "not_ascii")
        counted = self.patterns.groupBy(PART).agg(*[F.sum(c).alias(c) for c in flags])
        return _encoding(counted, self.contract.dialect.encoding, PART)

    def separators(self) -> DataFrame:
        return _best_separator(self.seen.select(PART, *MARKS, "lines"), PART)

    def widths(self) -> DataFrame:
        return self.seen.groupBy(PART, "width").agg(F.sum("lines").alias("lines"))

    def first(self) -> DataFrame:
        """(part, value): the first line of every part that has one."""
        firsts = self.patterns.groupBy(PART).agg(F.min("first").alias("_first"))
        return firsts.select(PART, F.col("_first.value").alias("value")).where("value IS NOT NULL")

    def problems(self) -> DataFrame:
        return problems_of(self.encoding(), self.separators(), self.widths(), self.first(), self.contract)

    def samples(self) -> DataFrame:
        """(part, column, samples), as :func:`samples` tells them, of records of the declared width."""
        names = [f"_{f}{i}" for i in range(len(self.columns)) for f in ("min", "max")]
        bounds = self.patterns.groupBy(PART).agg(
            *[getattr(F, n[1:4])(n).alias(n) for n in names]
        )
        bounds = settle(bounds)
        shown = self._records.where("_row IS NOT NULL").select(
            PART, *[self._shown(c).alias(f"_v{i}") for i, c in enumerate(self.columns)]
        )
        between = [
            F.min(F.when((F.col(f"_v{i}") > F.col(f"_min{i}")) & (F.col(f"_v{i}") < F.col(f"_max{i}")), F.col(f"_v{i}"))).alias(f"_mid{i}")
            for i in range(len(self.columns))
        ]
        middle = shown.join(broadcast_if_small(bounds), PART).groupBy(PART).agg(*between)
        each = F.inline(
            F.array(*[
                F.struct(
                    F.lit(c).alias("column"),
                    F.array_distinct(F.array_compact(F.array(f"_min{i}", f"_mid{i}", f"_max{i}"))).alias("samples"),
                )
                for i, c in enumerate(self.columns)
            ])
        )
        return bounds.join(middle, PART, "left").select(PART, each)

    def report(self, problems: DataFrame) -> DataFrame:
        """One row per part: terminator, encoding, separator, records, first line, verdict."""
        parts = self.patterns.select(PART).distinct()
        told = [
            self.terminators(), self.encoding(), self.separators(),
            record_counts(self.widths(), self.first(), self.contract).withColumnRenamed("off", "other_width"),
            self.first().withColumnRenamed("value", "first_line"), verdict(parts, problems),
        ]
        return reduce(lambda a, b: a.join(b, PART, "left"), told, parts)
