"""The landed files of a publication: manifest, selection and fingerprint."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagate.sources.delimited import path_of, source_part
from stratagate.sources.digest import file_digests


def landing_manifest(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Part, path, size and SHA-256 of every landed file, empty ones too.

    Files of any size go through the session's own readers, whatever their store.
    """
    return file_digests(spark, path).select(
        source_part(folder, file="file").alias("part"), path_of("file").alias("path"), "bytes", "sha256"
    )


def glob_to_regex(pattern: str) -> str:
    """Shell-style file pattern as a full-match regular expression."""
    pieces = re.split(r"(\*|\?|\[[^\]]+\])", pattern)
    translated = {"*": ".*", "?": "."}
    body = "".join(
        translated.get(p) or (p.replace("[!", "[^", 1) if p.startswith("[") and p != "[" else re.escape(p))
        for p in pieces
    )
    return f"(?s)^{body}$"


def matches(path: Column, pattern: str) -> Column:
    """Base name against a pattern, ignoring case."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    return name.rlike(glob_to_regex(pattern.lower()))


def select_parts(manifest: DataFrame, pattern: str) -> DataFrame:
    return manifest.where(matches(F.col("path"), pattern)).orderBy("part")


def publication_fingerprint(manifest: DataFrame, *by: str) -> DataFrame:
    """SHA-256 over the sorted ``part|sha256`` lines of each publication.

    A list of the files of a publication, never of their rows.
    """
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("part", "sha256"))),
        lambda p: F.concat_ws("|", p["part"], p["sha256"]),
    )
    text = F.array_join(lines, "\n")
    return manifest.groupBy(*by).agg(
        F.sha2(text, 256).alias("publication_fingerprint")
    )
