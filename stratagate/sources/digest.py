"""SHA-256 of files of any size, through the session's own readers.

A hash goes through a file in order, so its bytes have to meet in one task; nothing
says they have to be one row. Lines are read by splits with their bytes as they
are, packed into chunks where they are read, exchanged by file, put in order again
and folded into one state per file. No more than a few chunks are held.

The line reader leaves out a byte order mark and does not tell whether the last
line ends in LF. The size of the file tells both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagate.session import settings, settle

CHUNK = 256 * 1024
#: Bytes of one batch between Spark and Python; a longer line is a batch of its own.
BATCH = 16 * 1024 * 1024
MARK = b"\xef\xbb\xbf"
#: Names whose content the line reader would decompress; they are read whole.
PACKED = "(?i)[.](gz|bz2|deflate|lz4|snappy|zst|passthrough)$"

_CHUNK_DDL = "file string, size long, start long, number long, bytes binary"
_CHUNKS = pa.schema(
    [("file", pa.string()), ("size", pa.int64()), ("start", pa.int64()), ("number", pa.int64()), ("bytes", pa.binary())]
)
_DIGESTS = pa.schema([("file", pa.string()), ("sha256", pa.string())])


def _packed_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive lines of one split as chunks, every line with an LF."""
    split, number, held, size = None, 0, [], 0

    def chunk():
        row = {"file": split[0], "size": split[1], "start": split[2], "number": number, "bytes": b"".join(held)}
        return pa.RecordBatch.from_pylist([row], schema=_CHUNKS)

    for batch in batches:
        for here in _by_split(batch):
            first = tuple(here.column(c)[0].as_py() for c in ("file", "size", "start"))
            if split != first:
                if held:
                    yield chunk()
                split, number, held, size = first, 0, [], 0
            lines = pa.ListArray.from_arrays([0, here.num_rows], here.column("line"))
            joined = pc.binary_join(lines, b"\n")[0].as_py()
            held += (joined, b"\n")
            size += len(joined) + 1
            if size >= CHUNK:
                yield chunk()
                number, held, size = number + 1, [], 0
    if held:
        yield chunk()


def _by_split(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, in order, by the split they were read from."""
    ends = batch.slice(0, 1), batch.slice(batch.num_rows - 1)
    if batch.num_rows < 2 or ends[0].select(["file", "start"]) == ends[1].select(["file", "start"]):
        # splits follow each other, so nothing else is in between
        yield from [batch] if batch.num_rows else []
        return
    half = batch.num_rows // 2
    yield from _by_split(batch.slice(0, half))
    yield from _by_split(batch.slice(half))


class _State:
    """Hash of one file, with and without a byte order mark before it."""

    def __init__(self, file: str, size: int):
        self.file, self.size, self.read = file, size, 0
        self.plain, self.marked = hashlib.sha256(), hashlib.sha256(MARK)

    def add(self, data: bytes) -> None:
        # the last LF read so far may not be there
        more = data[:-1] if not self.read else b"\n" + data[:-1]
        self.plain.update(more)
        self.marked.update(more)
        self.read += len(data)

    def digest(self) -> str:
        known = {0: (self.plain, b"\n"), -1: (self.plain, b""), 3: (self.marked, b"\n"), 2: (self.marked, b"")}
        if self.size - self.read not in known:
            raise ValueError(f"{self.file}: {self.read} bytes read, {self.size} listed")
        state, end = known[self.size - self.read]
        state.update(end)
        return state.hexdigest()


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per file, from its chunks in order."""
    state = None

    def row():
        return pa.RecordBatch.from_pylist([{"file": state.file, "sha256": state.digest()}], schema=_DIGESTS)

    for batch in batches:
        for file, size, data in zip(batch.column("file"), batch.column("size"), batch.column("bytes"), strict=True):
            if state is None or state.file != file.as_py():
                if state is not None:
                    yield row()
                state = _State(file.as_py(), size.as_py())
            state.add(data.as_py())
    if state is not None:
        yield row()


def line_digests(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha256) of every file below ``path`` that is neither empty nor packed."""
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("start"),
            F.col("value").cast("binary").alias("line"),
        )
        .where(~F.col("file").rlike(PACKED))
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        lines.mapInArrow(_packed_lines, _CHUNK_DDL)
        .repartition(tasks, "file")
        .sortWithinPartitions("file", "start", "number")
        .mapInArrow(_folded, "file string, sha256 string")
    )


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(file, bytes, sha256) of every file below ``path``, computed once.

    ``file`` is the encoded path, as file metadata shows it. Empty files and
    those of nothing but a byte order mark have no line, but they have a row. Files
    whose name says that they are compressed are hashed as they are, in one row
    each, which the reader limits to 2 GiB; it refuses larger ones by name. So is
    a single line of an uncompressed file limited, not the file.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.col("_metadata.file_path").alias("file")
    plain = listed.select(name, "length").where(~F.col("file").rlike(PACKED))
    whole = listed.select(name, "length", "content").where(F.col("file").rlike(PACKED))
    packed = whole.select("file", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    alone = F.when(F.col("length") == len(MARK), F.lit(hashlib.sha256(MARK).hexdigest()))
    hashed = plain.join(line_digests(spark, path), "file", "left").select(
        "file", F.col("length").alias("bytes"), F.coalesce("sha256", alone).alias("sha256")
    )
    # scans leave empty files out, the listing they start from does not; the two
    # may write the scheme of a path in different ways
    names = spark.createDataFrame([(f,) for f in listed.inputFiles()], "file string")
    place = F.regexp_replace("file", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/").alias("_place")
    seen = plain.select("file").unionByName(whole.select("file")).select(place)
    empty = names.withColumn("_place", place).join(seen, "_place", "left_anti")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    bare = empty.select(F.regexp_replace("file", "^file:/+", "file:/").alias("file"), F.lit(0).cast("long").alias("bytes"), none.alias("sha256"))
    with settings(spark, spark__sql__execution__arrow__maxBytesPerBatch=str(BATCH)):
        return settle(hashed.unionByName(packed).unionByName(bare))
