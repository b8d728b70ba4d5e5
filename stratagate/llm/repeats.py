"""Removal of repeated 200-byte strings by a distributed prefix-free parse.

Every text is parsed at *triggers*: places where a rolling hash is the least of
all within one string's length. Whether and where a string of 200 bytes has its
trigger depends on the string alone, so equal strings, wherever they start, hang
on equal triggers at equal distance. What starts before a trigger up to the next
earlier one is its *phrase*; distinct phrases are the dictionary, and the triggers
of a text in order are its parse.

The order of the corpus up to 200 bytes is needed only where neighbours are equal
so far, so no order is written out: suffixes of the dictionary are refined into
rank classes, which is what sorting them to that depth would put side by side.

* class by trigger: strings on a trigger that stands nowhere else are unique;
* equal phrases with equal surroundings: all their strings are repeated;
* phrases that agree in part are cut into blocks of 16 starts, classed by the
  bytes that all strings of the block share, and then into single starts.

Each level drops what is alone in its class, keeps one phrase per distinct
content, and only sends hashes and places. Classes are counted with map-side
combines and met by joins that Spark can split, so one class may be huge. Texts
that occur more than once are settled by their digest and looked at once.

Hashes have 64 bits and are compared inside the class of the level above.

Defined cases: NULL text has no bytes; texts under 200 bytes lose nothing;
repeated rows are copies of each other; strings may overlap themselves; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagate.llm.tables import slices, task_count, text_bytes
from stratagate.session import new_folder, settle, written

LENGTH = 200
#: Bytes of a trigger.
TRIGGER = 48
#: Starts of one block of the second level.
BLOCK = 16

_M = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as many as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            size = max(size, 2 * len(self.up))
            self.up = self._grown(_M, size)
            self.down = self._grown(pow(_M, -1, 2**64), size)
        return self.up, self.down

    @staticmethod
    def _grown(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


_POWERS = _Powers()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashed:
    """Hashes of any substrings of one text."""

    def __init__(self, data: bytes):
        values = _TABLE[np.frombuffer(data, np.uint8)]
        up, self.down = _POWERS.to(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray, salt=0) -> np.ndarray:
        plain = (self.sums[end] - self.sums[start]) * self.down[start]
        extra = np.asarray(salt, dtype=np.int64).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return _mixed(plain + extra).view(np.int64)


def triggers(hashed: Hashed, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Triggers of a text and the first and last start of a string hanging on each."""
    width = LENGTH - TRIGGER + 1
    count = size - TRIGGER + 1
    at = np.arange(count, dtype=np.int64)
    order = hashed.of(at, at + TRIGGER).view(np.uint64)
    packed = (order & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    padded = np.full(-(-count // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:count] = packed
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = size - LENGTH + 1
    least = np.minimum(back[:starts], ahead[width - 1 : width - 1 + starts])
    trigger = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, trigger[1:] != trigger[:-1]])
    last = np.r_[first[1:], starts] - 1
    return trigger[first], first, last


_RANGES = "up long, key long, whole long, tid long, at int, low short, high short"
_NAMES = ["up", "key", "whole", "tid", "at", "low", "high"]


def _ranges(tid: int, hashed: Hashed, up, key, at, low, high) -> pa.RecordBatch:
    """Rows of starts ``at - high`` to ``at - low``, with the hash of all their bytes."""
    whole = hashed.of(at - high, at - low + LENGTH, low * 512 + high)
    columns = [up, key, whole, np.full(len(at), tid, np.int64)]
    columns += [at.astype(np.int32), low.astype(np.int16), high.astype(np.int16)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _NAMES)


def _by_trigger(tid: int, data: bytes, _) -> pa.RecordBatch:
    hashed = Hashed(data)
    at, first, last = triggers(hashed, len(data))
    key = hashed.of(at, at + TRIGGER)
    return _ranges(tid, hashed, np.zeros_like(key), key, at, at - last, at - first)


def _wanted(rows: list[dict]) -> list[np.ndarray]:
    return [np.array([r[k] for r in rows], dtype=np.int64) for k in ("up", "at", "low", "high")]


def _by_block(tid: int, data: bytes, rows: list[dict]) -> pa.RecordBatch:
    up, at, low, high = _wanted(rows)
    first, count = low // BLOCK, high // BLOCK - low // BLOCK + 1
    row = np.repeat(np.arange(len(at)), count)
    block = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    up, at, low, high = up[row], at[row], low[row], high[row]
    hashed = Hashed(data)
    shared = at - block * BLOCK
    key = hashed.of(shared, shared + LENGTH - BLOCK + 1, block + 1)
    low, high = np.maximum(low, block * BLOCK), np.minimum(high, block * BLOCK + BLOCK - 1)
    return _ranges(tid, hashed, up, key, at, low, high)


def _by_start(tid: int, data: bytes, rows: list[dict]) -> pa.RecordBatch:
    up, at, low, high = _wanted(rows)
    count = high - low + 1
    row = np.repeat(np.arange(len(at)), count)
    back = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    hashed = Hashed(data)
    start = at[row] - back
    key = hashed.of(start, start + LENGTH, back + 1)
    return _ranges(tid, hashed, up[row], key, at[row], back, back)


def _expanded(texts: DataFrame, how: Callable) -> DataFrame:
    """Ranges of every text; column ``rows`` has the ranges to refine, if any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for piece in slices(batches, 64):
            columns = [c.to_pylist() for c in piece.columns]
            rows = columns[2] if len(columns) > 2 else [None] * len(columns[0])
            for tid, zipped, wanted in zip(columns[0], columns[1], rows, strict=True):
                yield how(tid, unzip.decompress(zipped), wanted)

    return texts.mapInArrow(run, _RANGES)


def _classed(ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ranges whose strings are all repeated, and ranges to refine further."""
    classes = (
        ranges.groupBy("up", "key")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            (F.min("whole") == F.max("whole")).alias("_alike"),
        )
        .where(F.col("_n") > 1)
        .select("up", "key", "_alike")
    )
    # written first: a join of two plain exchanges is one whose hot class can be split
    classes = written(classes, "classes")
    shared = written(ranges.join(classes, ["up", "key"]), "ranges")
    alike = shared.where("_alike").select("tid", "at", "low", "high")
    mixed = shared.where("NOT _alike")
    # what a class holds several times over goes on once, to be met by the others
    contents = mixed.groupBy("up", "key", "whole").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("tid", "at", "low", "high")).alias("_one")
    )
    contents = written(contents, "contents")
    several = contents.where(F.col("_n") > 1).select("up", "key", "whole")
    settled = mixed.join(several, ["up", "key", "whole"], "left_semi").select("tid", "at", "low", "high")
    further = contents.select(F.col("key").alias("up"), "_one.*")
    return alike.unionByName(settled), further


def _text_id(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def _described(docs: DataFrame) -> DataFrame:
    """doc_id, tid, n_bytes and the digest of every row."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    found = docs.select("doc_id", data.alias("_data")).select(
        "doc_id", F.octet_length("_data").cast("long").alias("n_bytes"), F.sha2("_data", 256).alias("sha256")
    )
    tid = F.conv(F.substring("sha256", 1, 16), 16, -10).cast("long")
    return found.withColumn("tid", tid)


def _stored_texts(docs: DataFrame, name: str) -> DataFrame:
    """Distinct texts of at least ``LENGTH`` bytes, compressed, in buckets by tid."""

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zipper = zstandard.ZstdCompressor(level=3)
        for piece in slices(batches):
            texts = [t for t in text_bytes(piece.column(0)) if t is not None and len(t) >= LENGTH]
            ids = [_text_id(hashlib.sha256(t).digest()) for t in texts]
            zipped = [zipper.compress(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(zipped, pa.binary())], ["tid", "zipped"]
            )

    spark = docs.sparkSession
    buckets = task_count(spark)
    distinct = docs.select("text").mapInArrow(press, "tid long, zipped binary").groupBy("tid")
    (
        distinct.agg(F.first("zipped").alias("zipped"))
        .repartition(buckets, "tid")
        .write.bucketBy(buckets, "tid")
        .option("path", new_folder(spark, "texts"))
        .option("compression", "none")
        .saveAsTable(name)
    )
    return spark.table(name)


def _with_rows(texts: DataFrame, ranges: DataFrame, columns: list[str]) -> DataFrame:
    """Texts that have ranges, with all of theirs; a text's ranges are bounded by it."""
    own = ranges.groupBy("tid").agg(F.collect_list(F.struct(*columns)).alias("rows"))
    return texts.join(own, "tid").select("tid", "zipped", "rows")


def _cut(data: bytes, spans: np.ndarray) -> tuple[int, int, str]:
    """Bytes removed, maximal runs and the digest of what is left."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    fresh = np.r_[True, spans[1:, 0] > reach[:-1]]
    begin = spans[fresh, 0]
    end = reach[np.r_[np.flatnonzero(fresh)[1:] - 1, len(spans) - 1]]
    kept, at = hashlib.sha256(), 0
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        kept.update(data[at:a])
        at = b
    kept.update(data[at:])
    return int((end - begin).sum()), len(begin), kept.hexdigest()


def _removed(texts: DataFrame, found: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip = zstandard.ZstdDecompressor()
        for piece in slices(batches, 64):
            out = []
            for tid, zipped, rows in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                spans = np.array(
                    [(r["at"] - r["high"], r["at"] - r["low"] + LENGTH) for r in rows], dtype=np.int64
                )
                out.append((tid, *_cut(unzip.decompress(zipped), spans)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(types)],
                ["tid", "n_removed", "n_spans", "kept_sha256"],
            )

    return _with_rows(texts, found, ["at", "low", "high"]).mapInArrow(
        run, "tid long, n_removed long, n_spans long, kept_sha256 string"
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    spark = docs.sparkSession
    described = written(_described(docs), "described")
    copies = settle(described.groupBy("tid").count().where(F.col("count") > 1).select("tid"))
    name = f"repeats_{uuid.uuid4().hex[:12]}"
    texts = _stored_texts(docs, name)
    found, ranges = _classed(_expanded(texts.select("tid", "zipped"), _by_trigger))
    results = [found]
    for how in (_by_block, _by_start):
        rows = _with_rows(texts, ranges, ["up", "at", "low", "high"])
        found, ranges = _classed(_expanded(rows, how))
        results.append(found)
    # copies are removed whole and need no second look at their text
    every = reduce(DataFrame.unionByName, results).join(copies, "tid", "left_anti")
    removed = written(_removed(texts, every), "removed")
    spark.sql(f"DROP TABLE {name}")
    whole = F.col("_copied").isNotNull() & (F.col("n_bytes") >= LENGTH)
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        described.join(copies.withColumn("_copied", F.lit(True)), "tid", "left")
        .join(removed, "tid", "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0))).alias("n_spans"),
            F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        )
    )
