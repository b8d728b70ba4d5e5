"""Delimited deliveries: parsed rows as text, and the physical lines beside them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stratagate import vocabulary as v
from stratagate.contract import Contract, Dialect
from stratagate.functions.lineage import lineage

LINE = "_malformed_line"
PART = "_part"
#: Scheme and authority of a URI, such as s3://bucket or file:.
_AUTHORITY = re.compile("^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?")


def path_of(file: Column | str) -> Column:
    """A file's path as it was given, without the encoding of file metadata."""
    # '+' stands for itself in a path; only %XX sequences are encoded
    return F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))


def source_part(folder: str, split: bool = False, file: str = "_metadata.file_path") -> Column:
    """File path below the delivery folder, with percent-encoding undone.

    With ``split`` a part is a folder of files, and its name is the first level.
    """
    place = _AUTHORITY.sub("", folder)
    # a relative folder may start anywhere
    start = "^/" if place.startswith("/") else "/"
    below = start + re.escape(place.strip("/")) + ("/+([^/]+)/" if split else "/+(.+)$")
    return F.regexp_extract(F.regexp_replace(path_of(file), _AUTHORITY.pattern, ""), below, 1)


def literal_path(path: str) -> str:
    """A path for a reader that would take brackets, stars and the like as a glob."""
    return re.sub(r"([][{}*?\\])", r"\\\1", path)


def has_text(line: Column) -> Column:
    """Whether the CSV reader sees a line: one of characters up to U+0020 it skips."""
    return line.rlike("[^\\x00-\\x20]")


#: Bytes that windows-1252 reads otherwise than ISO-8859-1, and what it reads there.
_SHIFTED = "".join(map(chr, range(0x80, 0xA0)))
_WINDOWS = _SHIFTED.encode("iso-8859-1").decode("windows-1252", errors="replace")


def _as_read(text: str, encoding: str) -> str:
    """A separator or quote as the reader's charset shows its byte."""
    if encoding != "windows-1252":
        return text
    return text.translate(str.maketrans(_WINDOWS, _SHIFTED))


def _recoded(text: Column, encoding: str) -> Column:
    """Text the reader took as ISO-8859-1, by its declared charset.

    Spark decodes windows-1252 only in a session told to allow all of Java's charsets.
    Both charsets have one byte per character and the same line ends, so the text is
    read as ISO-8859-1, and the characters that differ are put in their place.
    """
    return F.translate(text, _SHIFTED, _WINDOWS) if encoding == "windows-1252" else text


def reader_options(dialect: Dialect) -> dict[str, str]:
    return {
        "sep": _as_read(dialect.separator, dialect.encoding),
        "quote": _as_read(dialect.quote, dialect.encoding),
        "escape": _as_read(dialect.escape, dialect.encoding),
        "encoding": v.CHARSETS[dialect.encoding],
        "header": str(dialect.header).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": LINE,
        "multiLine": "false",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        # a wrong field count must be seen whatever columns a query asks for
        "columnPruning": "false",
        "recursiveFileLookup": "true",
    }


def scan_rows(
    spark: SparkSession,
    contract: Contract,
    paths: str | Sequence[str],
    folder: str,
) -> DataFrame:
    """Every column as text; a line of the wrong width keeps its text in LINE."""
    columns = [f.name for f in contract.source_fields] + [LINE]
    schema = StructType([StructField(c, StringType()) for c in columns])
    rows = (
        spark.read.schema(schema)
        .options(**reader_options(contract.dialect))
        .csv(paths)
    )
    # the CSV reader refuses a plan that asks for the malformed line alone, so a
    # data column takes part in it
    first, encoding = F.col(columns[0]), contract.dialect.encoding
    return rows.select(
        *[_recoded(F.col(c), encoding).alias(c) for c in columns[:-1]],
        F.when(first.isNull() | first.isNotNull(), _recoded(F.col(LINE), encoding)).alias(LINE),
        source_part(folder, contract.split_parts).alias(PART),
    )


def scan_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    folder: str,
    split: bool = False,
) -> DataFrame:
    """Physical lines, read without the CSV parser; blank ones are left out."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    return lines.where(has_text(F.col("value"))).select(
        source_part(folder, split).alias(PART), "value"
    )


def decoded(line: Column, encoding: str) -> Column:
    """Text of a line the text reader took as UTF-8, by its declared charset."""
    if encoding == "utf-8":
        return line
    return _recoded(F.decode(line.cast("binary"), v.CHARSETS[encoding]), encoding)


def measured_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    folder: str,
    encoding: str = "utf-8",
    split: bool = False,
) -> DataFrame:
    """Part, physical lines and first line (``value``) of every part, in one job."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    first = F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id())
    seen = lines.where(has_text(F.col("value"))).select(
        source_part(folder, split).alias("part"),
        decoded(F.col("value"), encoding).alias("value"),
        first.alias("_at"),
    )
    return seen.groupBy("part").agg(
        F.count(F.lit(1)).alias("physical"), F.min_by("value", "_at").alias("value")
    )


def first_lines(
    spark: SparkSession, paths: str | Sequence[str], folder: str, encoding: str = "utf-8"
) -> DataFrame:
    """First line of every file."""
    return measured_lines(spark, paths, folder, encoding).select(
        F.col("part").alias(PART), "value"
    )


def well_formed(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(LINE).isNull())


def malformed(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(LINE).isNotNull())


def bronze_columns(contract: Contract, period: str, run_id: str) -> list[Column]:
    """Contract order; a column absent at the source stays as NULL text."""
    business = [
        F.lit(None).cast("string").alias(f.name) if f.absent else F.col(f.name)
        for f in contract.fields
    ]
    return [*business, *lineage(period, F.col(PART), run_id)]


def bronze_rows(
    rows: DataFrame, contract: Contract, period: str, run_id: str
) -> DataFrame:
    return well_formed(rows).select(*bronze_columns(contract, period, run_id))


def part_counts(rows: DataFrame) -> DataFrame:
    """Rows read and rows malformed, per part."""
    return rows.groupBy(F.col(PART).alias("part")).agg(
        F.count(F.lit(1)).alias("read"),
        F.count(LINE).alias("malformed"),
    )


def physical_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.col(PART).alias("part")).agg(
        F.count(F.lit(1)).alias("physical")
    )


def source_rows(physical: DataFrame, header: bool) -> DataFrame:
    """Rows the source holds, from physical lines alone."""
    data = F.greatest(F.col("physical") - int(header), F.lit(0))
    return physical.agg(F.coalesce(F.sum(data), F.lit(0)).alias("source_rows"))
