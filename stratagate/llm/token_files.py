"""Token-id files: zstandard frames per document under one shared dictionary.

Documents are encoded whole, an end id is appended, and the ids are written in
ascending document order. A file is a table of blocks; a block holds

    magic, width of an id, SHA-256 of the dictionary, number of documents,
    index (document id, number of ids, end offset of its frame), frames

so one short document is read by one bisection and one small decompression.

Every shard covers a range of document ids and is written by one task in order;
each block knows how many ids its shard holds before it, so reading needs only
one total per shard to place every document.

Defined cases: NULL or empty text gives the end id alone; NULL document ids come
first; rows with equal ids are ordered by their frames; an empty table gives no
blocks. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratagate.llm.tables import slices, task_count
from stratagate.llm.tokens import encoder
from stratagate.session import new_folder

MAGIC = b"IDBLOCK1"
HEAD = struct.Struct("<8sB32sI")
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("n_tokens", "<u8"), ("end", "<u8")])

#: Documents (about so many) and ids of each that the dictionary is trained on.
SAMPLE_DOCUMENTS = 2000
SAMPLE_IDS = 4096
DICTIONARY_BYTES = 110 * 1024
BLOCK_DOCUMENTS = 1024
BLOCK_BYTES = 4 * 1024 * 1024
LEVEL = 3


def _serialized(packed: bytes, end_id: int, width: int) -> bytes:
    ids = np.frombuffer(packed + struct.pack("<I", end_id), "<u4")
    return ids.astype("<u2" if width == 2 else "<u4").tobytes()


def train_dictionary(docs: DataFrame, path: str, end_id: int, width: int) -> bytes:
    """Dictionary fitted on a bounded sample, spread by a hash of the document id."""
    keyed = docs.select("text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("at"))
    rows = docs.count()
    share = (1 << 30) * min(1.0, SAMPLE_DOCUMENTS / max(rows, 1))

    def serialize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            texts = piece.column(0).to_pylist()
            out = [
                _serialized(encoder(path).encode(t), end_id, width)[: SAMPLE_IDS * width]
                for t in texts
            ]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    sample = keyed.where(F.col("at") < int(share)).select("text")
    samples = [r[0] for r in sample.mapInArrow(serialize, "ids binary").toLocalIterator()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(samples)).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little text to train on
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)


def _shards(docs: DataFrame, shards: int) -> list[int]:
    """Upper bounds of ranges of document ids with about equally many documents."""
    steps = [i / shards for i in range(1, shards)]
    found = docs.where("doc_id IS NOT NULL").approxQuantile("doc_id", steps, 0.2 / shards)
    return sorted({int(x) for x in found})


def write_blocks(docs: DataFrame, path: str, end_id: int, width: int, folder: str) -> None:
    """Encode every document, order by id and write blocks and the dictionary."""
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, path, end_id, width)
    named = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(named, dictionary)], "hash binary, bytes binary").coalesce(
        1
    ).write.parquet(f"{folder}/dictionary")
    shards = task_count(spark)
    bounds = np.array(_shards(docs, shards), dtype=np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, press = encoder(path), _compressor(dictionary)
        for piece in slices(batches):
            ids = piece.column(0)
            plain = ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            frames, counts = [], []
            for text in piece.column(1).to_pylist():
                data = _serialized(known.encode(text), end_id, width)
                frames.append(press.compress(data))
                counts.append(len(data) // width)
            shard = np.searchsorted(bounds, plain, side="left").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard), ids, pa.array(counts, pa.int64()), pa.array(frames, pa.binary())],
                ["shard", "doc_id", "n_tokens", "frame"],
            )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = _BlockWriter(named, width)
        for piece in slices(batches):
            for row in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                if block := writer.add(*row):
                    yield block
        if block := writer.close():
            yield block

    frames = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encode, "shard int, doc_id long, n_tokens long, frame binary"
    )
    ordered = frames.repartition(shards, "shard").sortWithinPartitions(
        F.col("shard"), F.col("doc_id").asc_nulls_first(), "frame"
    )
    ordered.mapInArrow(
        build, "shard int, block int, before long, n_tokens long, data binary"
    ).write.option("compression", "none").parquet(f"{folder}/blocks")


class _BlockWriter:
    """Gather the sorted documents of a task into blocks, shard by shard."""

    def __init__(self, named: bytes, width: int):
        self.named, self.width = named, width
        self.shard, self.block, self.before = None, 0, 0
        self.rows, self.size = [], 0

    def add(self, shard: int, doc_id: int | None, n_tokens: int, frame: bytes):
        done = None
        full = len(self.rows) >= BLOCK_DOCUMENTS or self.size >= BLOCK_BYTES
        if self.rows and (full or shard != self.shard):
            done = self.close()
        if shard != self.shard:
            self.shard, self.block, self.before = shard, 0, 0
        self.rows.append((doc_id, n_tokens, frame))
        self.size += len(frame)
        return done

    def close(self) -> pa.RecordBatch | None:
        if not self.rows:
            return None
        index = np.zeros(len(self.rows), INDEX)
        index["doc_id"] = [r[0] or 0 for r in self.rows]
        index["known"] = [r[0] is not None for r in self.rows]
        index["n_tokens"] = [r[1] for r in self.rows]
        index["end"] = np.cumsum([len(r[2]) for r in self.rows])
        head = HEAD.pack(MAGIC, self.width, self.named, len(self.rows))
        data = head + index.tobytes() + b"".join(r[2] for r in self.rows)
        tokens = sum(r[1] for r in self.rows)
        row = [self.shard, self.block, self.before, tokens, data]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        names = ["shard", "block", "before", "n_tokens", "data"]
        self.rows, self.size = [], 0
        self.block, self.before = self.block + 1, self.before + tokens
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, types, strict=True)], names
        )


class BlockReader:
    """Random access to the documents of one block."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, self.width, named, count = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        if named != hashlib.sha256(dictionary).digest():
            raise ValueError("block was written with another dictionary")
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.press = zstandard.ZstdDecompressor(dict_data=shared)
        self.index = np.frombuffer(data, INDEX, count, HEAD.size)
        self.frames = memoryview(data)[HEAD.size + count * INDEX.itemsize :]
        self.ends = [0, *self.index["end"].tolist()]

    def ids(self, position: int) -> np.ndarray:
        frame = self.frames[self.ends[position] : self.ends[position + 1]]
        data = self.press.decompress(frame)
        ids = np.frombuffer(data, "<u2" if self.width == 2 else "<u4").astype("<u4")
        if len(ids) != self.index["n_tokens"][position]:
            raise ValueError("a frame does not hold the ids its index names")
        return ids

    def document(self, doc_id: int) -> np.ndarray | None:
        """Ids of one document by bisection, or None."""
        first = int((self.index["known"] == 0).sum())
        at = bisect_left(self.index["doc_id"], doc_id, first)
        found = at < len(self.index) and self.index["doc_id"][at] == doc_id
        return self.ids(at) if found else None


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32."""
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["bytes"])
    blocks = spark.read.parquet(f"{folder}/blocks")
    # one row per shard, a number the session sets, is ordered in one task
    totals = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "shard", F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("shard_start")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 4):
            for start, data in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                reader = BlockReader(data, dictionary)
                index = reader.index
                counts = index["n_tokens"].astype(np.int64)
                sums = [zlib.crc32(reader.ids(i)) for i in range(len(index))]
                begins = start + np.cumsum(counts) - counts
                named = pa.array(index["doc_id"].copy(), mask=index["known"] == 0)
                yield pa.RecordBatch.from_arrays(
                    [named, pa.array(begins), pa.array(counts), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return (
        blocks.join(F.broadcast(starts), "shard")
        .select((F.col("shard_start") + F.col("before")).alias("start"), "data")
        .mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
    )


def token_documents(docs: DataFrame, path: str, end_id: int, width: int = 2) -> DataFrame:
    """Write the token-id files of ``docs`` into the shared folder and read them back."""
    folder = new_folder(docs.sparkSession, "token-files")
    write_blocks(docs, path, end_id, width, folder)
    return read_documents(docs.sparkSession, folder)
