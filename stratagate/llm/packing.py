"""Best-fit packing of token pieces after a dominance reduction.

Only the sizes of the pieces decide the packing, and a size lies between 1 and
the capacity. So the instance is a histogram of at most ``capacity`` rows, which
the driver solves as counts; it returns *patterns* (sizes in one sequence, and
how many sequences look so). Their number depends on the capacity alone.

1. Reduction (Martello and Toth): a set of at most two pieces is fixed for good
   where it dominates every other set with its larger piece: the piece fills a
   sequence, no piece fits beside it, its partner fills the rest exactly, or the
   largest partner that fits is at least as large as any pair or more that fits.
2. Best fit, largest size first, for what is left.

Every piece then gets its rank among the pieces of its size, by counts per
bucket, and its rank names its place in the patterns. No group is gathered.

Defined cases: NULL or empty text is one piece holding the end id; rows with
equal ids are packed each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratagate.llm.tables import slices
from stratagate.llm.tokens import encoder
from stratagate.session import written

#: Pieces per bucket of the ranking, about.
BUCKET = 50_000


@dataclass
class Pattern:
    """Sequences that hold the same sizes; ``runs`` are (size, copies) in order."""

    times: int
    room: int
    runs: list[tuple[int, int]] = field(default_factory=list)

    def with_run(self, times: int, size: int, copies: int) -> Pattern:
        return Pattern(times, self.room - size * copies, [*self.runs, (size, copies)])


def _largest_rest(counts: np.ndarray, room: int, taken: int) -> int:
    """Upper bound on what several pieces besides one of ``taken`` fill of ``room``.

    Exact for two pieces; if three of the smallest fit, the room itself.
    """
    left = counts.copy()
    left[taken] -= 1
    sizes = np.flatnonzero(left[: room + 1] > 0)
    if not len(sizes):
        return 0
    smallest = np.repeat(sizes[:3], np.minimum(left[sizes[:3]], 3))[:3]
    if len(smallest) == 3 and smallest.sum() <= room:
        return room
    fits = np.zeros(room + 1, dtype=np.int64)
    fits[sizes] = sizes
    fits = np.maximum.accumulate(fits)
    partner = fits[room - sizes]
    doubled = (partner == sizes) & (left[sizes] < 2)
    below = fits[np.maximum(sizes - 1, 0)]
    partner = np.where(doubled, np.minimum(below, fits[room - sizes]), partner)
    sums = np.where(partner > 0, sizes + partner, 0)
    return int(sums.max(initial=0))


def reduce_instance(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Fix dominating sets and take them out of ``counts`` (in place)."""
    fixed = []
    if counts[capacity]:
        fixed.append(Pattern(int(counts[capacity]), 0, [(capacity, 1)]))
        counts[capacity] = 0
    for size in range(capacity - 1, 0, -1):
        while counts[size]:
            room = capacity - size
            counts[size] -= 1
            fitting = np.flatnonzero(counts[: room + 1])
            counts[size] += 1
            if not len(fitting):
                fixed.append(Pattern(int(counts[size]), room, [(size, 1)]))
                counts[size] = 0
                break
            partner = int(fitting[-1])
            if partner < room and _largest_rest(counts, room, size) > partner:
                break
            if partner == size:
                # a pair of equals stays dominating while the counts only shrink
                times = int(counts[size]) // 2
                fixed.append(Pattern(times, room - size, [(size, 2)]))
                counts[size] -= 2 * times
            else:
                times = int(min(counts[size], counts[partner]))
                fixed.append(Pattern(times, room - partner, [(size, 1), (partner, 1)]))
                counts[size] -= times
                counts[partner] -= times
    return fixed


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit, largest first, over groups of sequences that look alike."""
    by_room: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    for size in range(capacity, 0, -1):
        left = int(counts[size])
        for room in range(size, capacity):
            groups, by_room[room] = by_room[room], []
            while groups:
                group = groups.pop()
                if not left:
                    by_room[room].append(group)
                    continue
                each = min(group.room // size, left)
                times = min(group.times, left // each)
                filled = group.with_run(times, size, each)
                by_room[filled.room].append(filled)
                left -= times * each
                if rest := group.times - times:
                    if left and left < each:
                        part = group.with_run(1, size, left)
                        by_room[part.room].append(part)
                        left, rest = 0, rest - 1
                    if rest:
                        groups.append(Pattern(rest, group.room, group.runs))
        if left:
            each = capacity // size
            if left >= each:
                times = left // each
                new = Pattern(times, capacity - each * size, [(size, each)])
                by_room[new.room].append(new)
                left -= times * each
            if left:
                new = Pattern(1, capacity - left * size, [(size, left)])
                by_room[new.room].append(new)
    return [group for groups in by_room for group in groups]


def pack(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Patterns for a histogram indexed by size."""
    left = counts.astype(np.int64).copy()
    fixed = reduce_instance(left, capacity)
    return fixed + best_fit(left, capacity)


class _Places:
    """Sequence and offset of the rank-th piece of each size."""

    def __init__(self, patterns: list[Pattern]):
        parts: dict[int, list[tuple[int, int, int]]] = {}
        first = 0
        for pattern in patterns:
            at = 0
            for size, copies in pattern.runs:
                parts.setdefault(size, []).append((pattern.times * copies, first, at, copies))
                at += size * copies
            first += pattern.times
        self.parts = {}
        for size, rows in parts.items():
            table = np.array(rows, dtype=np.int64)
            self.parts[size] = (np.cumsum(table[:, 0]), *table.T)

    def of(self, size: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends, amount, first, at, copies = self.parts[size]
        row = np.searchsorted(ends, ranks, side="right")
        within = ranks - (ends[row] - amount[row])
        return first[row] + within // copies[row], at[row] + within % copies[row] * size


def pieces_of(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32."""
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for rows in slices(batches):
            ids, *texts = rows.column(0).to_pylist(), rows.column(1)
            out = ([], [], [], [], [])
            for doc_id, text in zip(ids, texts[0].to_pylist(), strict=True):
                data = known.encode(text) + end
                total = len(data) // 4
                first = total % capacity or capacity
                bounds = [0, *range(first, total + 1, capacity)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    row = (doc_id, piece, a, b - a, zlib.crc32(data[4 * a : 4 * b]))
                    for values, value in zip(out, row, strict=True):
                        values.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, types, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def ranked(pieces: DataFrame) -> DataFrame:
    """Add the rank of each piece among those of its length, from 0.

    Ranks count inside buckets of about ``BUCKET`` pieces; what comes before a
    bucket is summed over counts, of which there is one per bucket and length.
    """
    buckets = max(1, -(-pieces.count() // BUCKET))
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int")
    dealt = pieces.withColumn("_bucket", bucket)
    counts = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ahead = (
        Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = counts.select(
        F.col("length").alias("_length"),
        F.col("_bucket").alias("_at"),
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("_bucket", "length").orderBy("doc_id", "piece", "ids_crc32")
    placed = dealt.withColumn("_inside", F.row_number().over(inside) - 1)
    return placed.join(
        before,
        (placed["length"] == before["_length"]) & (placed["_bucket"] == before["_at"]),
    ).select(*pieces.columns, (F.col("_before") + F.col("_inside")).alias("rank"))


def pack_documents(docs: DataFrame, path: str, end_id: int, capacity: int) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    pieces = written(pieces_of(docs, path, end_id, capacity), "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    # at most one row per size
    for row in pieces.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    places = _Places(pack(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 8192):
            sizes = rows.column(3).to_numpy()
            ranks = rows.column(5).to_numpy()
            sequence, offset = np.zeros((2, len(sizes)), dtype=np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                sequence[at], offset[at] = places.of(int(size), ranks[at])
            columns = [*rows.columns[:5], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(
                columns,
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked(pieces).mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long,"
        " sequence_id long, offset long",
    )
