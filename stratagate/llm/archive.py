"""Content-addressed WARC archive: headers apart, every payload once.

``write_archive`` keeps two tables in a folder:

* ``headers``: one row per page with the exact header block of its WARC record and
  the SHA-256 that addresses its payload;
* ``payloads``: one row per SHA-256 with the payload, compressed.

``read_archive`` joins them, checks that every payload has its digest, and gives
the original records back byte by byte. Pages with equal payloads of at least
``revisit_from`` bytes become one response (the largest page_id) and revisits,
whose records carry no payload but name the digest of the whole one.

Only digests are exchanged to choose the responses, and equal payloads are
combined before their exchange, so a payload shared by a third of the pages
moves once per task. Equal SHA-256 is verified by a second digest and the length.

Defined cases: NULL html is an empty payload; NULL url gives no target header;
rows that repeat a page_id and its payload are numbered, the first being the
response where that page is it and the others revisiting it; NULL page_ids never
become a response unless all are NULL; an empty table gives an empty archive;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratagate.llm.tables import slices, text_bytes
from stratagate.session import new_folder

REVISIT_FROM = 1000
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID(int=0)


def _record_id(page_id: int | None, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{number}')}>"


def header_block(
    page_id: int | None,
    number: int,
    url: str | None,
    payload_bytes: int,
    sha1: str,
    refers_to: int | None,
    revisit: bool,
) -> bytes:
    """Header lines of a record, up to the blank line before its block."""
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, number)),
        ("WARC-Date", DATE),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", " ".join(url.split())))
    fields.append(("WARC-Payload-Digest", f"sha1:{sha1}"))
    fields.append(("X-Payload-Length", str(payload_bytes)))
    if revisit:
        fields.append(("WARC-Profile", PROFILE))
        fields.append(("WARC-Refers-To", _record_id(refers_to, 0)))
        fields.append(("X-Refers-To-Page", "" if refers_to is None else str(refers_to)))
    fields.append(("Content-Type", "text/html; charset=utf-8"))
    fields.append(("Content-Length", str(0 if revisit else payload_bytes)))
    lines = "".join(f"\r\n{name}: {value}" for name, value in fields)
    return VERSION + lines.encode() + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; raises when it is not well formed."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not blank or lines[0].encode() != VERSION or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:-4]
    if len(block) != int(fields["Content-Length"]):
        raise ValueError("block and Content-Length differ")
    return fields, block


def _digests(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload")).select(
        "page_id",
        "url",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("sha1"),
        F.sha2("payload", 256).alias("sha256"),
    )


def _chosen(found: DataFrame) -> DataFrame:
    """One row per digest: the page that answers, after verifying the digest."""
    summed = found.groupBy("sha256").agg(
        F.max("page_id").alias("answer"),
        F.min("sha1").alias("_one"),
        F.max("sha1").alias("_other"),
        F.min("payload_bytes").alias("_least"),
        F.max("payload_bytes").alias("_most"),
    )
    same = (F.col("_one") == F.col("_other")) & (F.col("_least") == F.col("_most"))
    return summed.select(
        "sha256",
        F.when(same, F.col("answer")).otherwise(
            F.raise_error(F.lit("two payloads share a SHA-256")).cast("long")
        ).alias("answer"),
    )


def write_archive(pages: DataFrame, folder: str, revisit_from: int = REVISIT_FROM) -> None:
    """Write the header and payload tables of ``pages``."""
    found = _digests(pages)
    # equal (page, payload) rows are counted, and written out again below
    alike = found.groupBy("page_id", "url", "payload_bytes", "sha1", "sha256").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    within = Window.partitionBy("page_id", "sha256").orderBy("url")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    numbered = alike.withColumn("_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    rows = numbered.join(_chosen(found), "sha256").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("_rows") - 1)).alias("_copy")
    )
    number = F.col("_first") + F.col("_copy")
    answers = F.col("page_id").eqNullSafe(F.col("answer")) & (number == 0)
    typed = rows.select(
        "page_id",
        number.alias("number"),
        "url",
        "payload_bytes",
        "sha1",
        "sha256",
        "answer",
        ((F.col("payload_bytes") >= revisit_from) & ~answers).alias("revisit"),
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 4096):
            heads, addresses = [], []
            for page, number, url, size, sha1, sha256, answer, revisit in zip(
                *[c.to_pylist() for c in piece.columns], strict=True
            ):
                heads.append(header_block(page, number, url, size, sha1, answer, revisit))
                addresses.append(sha256)
            yield pa.RecordBatch.from_arrays(
                [pa.array(heads, pa.binary()), pa.array(addresses, pa.string())], ["header", "sha256"]
            )

    typed.mapInArrow(describe, "header binary, sha256 string").write.option(
        "compression", "zstd"
    ).parquet(f"{folder}/headers")

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zipper = zstandard.ZstdCompressor(level=3)
        for piece in slices(batches):
            payloads = [p or b"" for p in text_bytes(piece.column(0))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([hashlib.sha256(p).hexdigest() for p in payloads], pa.string()),
                    pa.array([zipper.compress(p) for p in payloads], pa.binary()),
                ],
                ["sha256", "zipped"],
            )

    pages.select("html").mapInArrow(press, "sha256 string, zipped binary").groupBy("sha256").agg(
        F.first("zipped").alias("zipped")
    ).write.option("compression", "none").parquet(f"{folder}/payloads")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Every record again: header, payload (of the digest) and the record's bytes parsed.

    Columns: page_id, payload_bytes, payload_digest, record_type, refers_to,
    record_bytes. Raises when a payload does not have its digests or a record is
    not well formed.
    """
    headers = spark.read.parquet(f"{folder}/headers")
    payloads = spark.read.parquet(f"{folder}/payloads")
    joined = headers.join(payloads, "sha256", "left").select("header", "sha256", "zipped")

    def whole(text: str) -> int | None:
        return int(text) if text else None

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for piece in slices(batches):
            out = []
            for header, sha256, zipped in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                payload = unzip.decompress(zipped)
                if hashlib.sha256(payload).hexdigest() != sha256:
                    raise ValueError(f"payload of {sha256} is damaged")
                revisit = header.startswith(VERSION + b"\r\nWARC-Type: revisit")
                record = header + (b"" if revisit else payload) + b"\r\n\r\n"
                fields, _ = parse_record(record)
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(fields["X-Payload-Length"])
                if hashlib.sha1(payload).hexdigest() != digest or len(payload) != size:
                    raise ValueError(f"payload of {sha256} is not the one of its record")
                out.append(
                    (
                        whole(fields["X-Page-ID"]),
                        size,
                        digest,
                        fields["WARC-Type"],
                        whole(fields.get("X-Refers-To-Page", "")),
                        len(record),
                    )
                )
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            names = "page_id payload_bytes payload_digest record_type refers_to record_bytes".split()
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names
            )

    return joined.mapInArrow(
        rebuild,
        "page_id long, payload_bytes long, payload_digest string, record_type string,"
        " refers_to long, record_bytes long",
    )


def archive_pages(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` in the shared folder and read every record back."""
    folder = new_folder(pages.sparkSession, "archive")
    write_archive(pages, folder)
    return read_archive(pages.sparkSession, folder)
