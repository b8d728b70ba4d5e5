"""SimHash near-duplicates found by the generalised pigeonhole principle.

Fingerprints of D bits link when they differ in at most ``radius`` bits.

1. Equal fingerprints collapse; what follows works on distinct ones.
2. The bits' co-occurrence over all fingerprints is summed task by task into one
   D x D matrix. Correlated bits are grouped into the same part.
3. Thresholds T_1..T_m of the parts with sum(T) = radius - m + 1 come from dynamic
   programming over estimated work: probes sent and candidates met. T = -1 leaves
   a part out. Two fingerprints within the radius agree up to T_i on some part i,
   whatever thresholds are chosen, so no link is lost.
4. Every fingerprint is sent to the values of each part within its threshold.
   Inside one value, distances are verified and only a spanning forest of the
   links is kept, so a large group costs about its size and never all its pairs.
   A value with very many fingerprints is split into blocks, each pair of blocks
   being a group of its own.
5. Components of the forests give the groups.

Defined cases: NULL text and text without words have fingerprint zero, and link
like any other; fewer words than a shingle make one shingle; repeated rows share
their fingerprint; NULL document ids are kept and never name a component unless
nothing else does; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagate.llm.components import components
from stratagate.llm.tables import boxed, slices, task_count, text_bytes, unboxed
from stratagate.operators.sizing import broadcast_if_small
from stratagate.session import fewer_tasks, settle, settle_counted, written

SEED = 42
#: Words of a shingle of a fingerprint.
SHINGLE = 3
#: Fingerprints under one value of a part before it is split into blocks.
BLOCK = 20_000
#: Work of sending one probe and of comparing one pair, in the same unit.
PROBE_COST, PAIR_COST = 1.0, 0.02
_CHUNK = 4096


def shingle_hashes(text: bytes | None, shingle: int) -> np.ndarray:
    """XXH64 of the word shingles of a text, A-Z in lower case."""
    words = (text or b"").lower().split()  # splits at 0x20 and 0x09-0x0D only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(p, SEED) for p in parts]), ">u8").astype(np.uint64)


def _more_bits(hashes: np.ndarray, word: int) -> np.ndarray:
    """The word-th 64 bits derived from each hash; word 0 is the hash itself."""
    if word == 0:
        return hashes
    x = hashes + np.uint64(word * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray, words: int = 1) -> bytes:
    """Bits set in over half of the hashes, as ``8 * words`` big-endian bytes."""
    out = []
    for word in range(words):
        counts = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), _CHUNK):
            some = _more_bits(hashes[at : at + _CHUNK], word).astype(">u8")
            bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1)
            counts += bits.sum(axis=0, dtype=np.uint32)
        out.append(np.packbits(counts * 2 > len(hashes)).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, shingle: int, words: int = 1) -> DataFrame:
    """(doc_id, fp) for every row; fp is binary."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            found = [
                fingerprint(shingle_hashes(t, shingle), words) for t in text_bytes(rows.column(1))
            ]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(found, pa.binary())], ["doc_id", "fp"]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        of, "doc_id long, fp binary"
    )


def _matrix(column: pa.Array, words: int) -> np.ndarray:
    """Fingerprints of a batch as bytes, one row each."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, 8 * words)


def summed_lines(lines: DataFrame) -> dict[int, np.ndarray]:
    """Sums of the lines (i, line) of int64 with the same i."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, line in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(line, np.int64)
        lines = [x.tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array(lines, pa.binary())], ["i", "line"]
        )

    summed = lines.repartition(task_count(lines.sparkSession), "i").mapInArrow(
        add, "i int, line binary"
    )
    return {r["i"]: np.frombuffer(bytes(r["line"]), np.int64) for r in summed.collect()}


def bit_statistics(distinct: DataFrame, words: int) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often two bits are set together, over all."""
    size = 64 * words

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((size, size), dtype=np.int64), 0
        for piece in slices(batches, 8192):
            bits = np.unpackbits(_matrix(piece.column(0), words), axis=1).astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
            rows += len(bits)
        if rows:
            lines = [total[i].tobytes() for i in range(size)] + [np.int64(rows).tobytes()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size + 1), pa.int32()), pa.array(lines, pa.binary())], ["i", "line"]
            )

    found = summed_lines(distinct.select("fp").mapInArrow(count, "i int, line binary"))
    if not found:
        return 0, np.zeros((size, size), dtype=np.int64)
    return int(found[size][0]), np.stack([found[i] for i in range(size)])


def group_bits(rows: int, together: np.ndarray, parts: int) -> list[np.ndarray]:
    """Bits in ``parts`` groups of nearly equal width, correlated bits together."""
    size = len(together)
    mean = np.diag(together) / max(rows, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    tied = np.abs(together / max(rows, 1) - np.outer(mean, mean)) / np.outer(spread, spread)
    np.fill_diagonal(tied, 0)
    free, groups = list(range(size)), []
    for part in range(parts):
        width = size // parts + (part < size % parts)
        first = max(free, key=lambda b: tied[b, free].max())
        group = [first]
        free.remove(first)
        while len(group) < width:
            best = max(free, key=lambda b: tied[b, group].sum())
            group.append(best)
            free.remove(best)
        groups.append(np.array(sorted(group)))
    return groups


def _within(differ: np.ndarray, most: int) -> np.ndarray:
    """Chance that independent bits differ in at most 0, 1 .. most places."""
    chance = np.zeros(most + 1)
    chance[0] = 1.0
    for q in differ:
        chance[1:] = chance[1:] * (1 - q) + chance[:-1] * q
        chance[0] *= 1 - q
    return np.cumsum(chance)


def allocate(
    rows: int, together: np.ndarray, groups: list[np.ndarray], radius: int
) -> tuple[float, list[int]]:
    """Thresholds of least estimated work, by dynamic programming over the parts."""
    mean = np.diag(together) / max(rows, 1)
    differ = 2 * mean * (1 - mean)
    pairs = rows * (rows - 1) / 2
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        near = _within(differ[group], radius)
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, radius + 1):
                probes = sum(comb(len(group), k) for k in range(t + 1))
                if probes > 10_000:
                    break
                # probes meet probes, so a value is shared up to twice the distance
                met = pairs * near[t] * (1 + (t > 0) * len(group)) if t >= 0 else 0.0
                total = cost + PROBE_COST * rows * probes + PAIR_COST * met
                if used + t not in step or total < step[used + t][0]:
                    step[used + t] = (total, [*chosen, t])
        best = step
    return best[radius - len(groups) + 1]


def plan_parts(
    rows: int, together: np.ndarray, radius: int, choices: Sequence[int]
) -> list[tuple[np.ndarray, int]]:
    """Parts and thresholds; of several numbers of parts, the one of least work."""
    plans = []
    for parts in choices:
        groups = group_bits(rows, together, parts)
        cost, thresholds = allocate(rows, together, groups, radius)
        plans.append((cost, parts, list(zip(groups, thresholds, strict=True))))
    return [p for p in min(plans, key=lambda x: x[:2])[2] if p[1] >= 0]


def _masks(width: int, threshold: int) -> np.ndarray:
    found = [
        sum(1 << b for b in bits)
        for k in range(threshold + 1)
        for bits in combinations(range(width), k)
    ]
    return np.array(found, dtype=np.int64)


def probes(distinct: DataFrame, plan: list[tuple[np.ndarray, int]], words: int) -> DataFrame:
    """(key, fp): every fingerprint under each part value within the threshold."""
    prepared = [(bits, _masks(len(bits), t)) for bits, t in plan]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 2048):
            bits = np.unpackbits(_matrix(piece.column(0), words), axis=1)
            for part, (own, masks) in enumerate(prepared):
                weights = np.int64(1) << np.arange(len(own), dtype=np.int64)
                value = bits[:, own].astype(np.int64) @ weights
                keys = (value[:, None] ^ masks[None, :]) | (np.int64(part) << np.int64(48))
                row = np.repeat(np.arange(len(value)), len(masks))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), piece.column(0).take(pa.array(row))], ["key", "fp"]
                )

    return distinct.select("fp").mapInArrow(send, "key long, fp binary")


def _distances(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.bitwise_count(rows ^ one).sum(axis=1, dtype=np.int64)


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among some fingerprints."""
    links, left = [], np.arange(len(fps))
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = _distances(fps[left], fps[at]) <= radius
            links.extend((at, x) for x in left[near])
            reached.extend(left[near])
            left = left[~near]
    return links


def _group_links(keys: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Forest links of every run of equal keys."""
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    sizes = np.diff(np.r_[starts, len(keys)])
    links = []
    # runs of two and three by whole columns, larger ones each by itself
    small = (sizes == 2) | (sizes == 3)
    for a, b, runs in ((0, 1, small), (0, 2, sizes == 3), (1, 2, sizes == 3)):
        left, right = starts[runs] + a, starts[runs] + b
        near = _distances(fps[left], fps[right]) <= radius
        links.extend(zip(left[near], right[near], strict=True))
    for start, size in zip(starts[sizes > 3], sizes[sizes > 3], strict=True):
        found = forest(fps[start : start + size], radius)
        links.extend((start + a, start + b) for a, b in found)
    return links


def in_blocks(rows: DataFrame, key: str, name: str, columns: list[str]) -> DataFrame:
    """(key, a, b) and columns: a key of many rows is cut into pairs of blocks."""
    hot = settle(rows.groupBy(key).count().where(F.col("count") > BLOCK))
    if hot.isEmpty():
        return rows.select(key, F.lit(0).alias("a"), F.lit(0).alias("b"), *columns)
    # each row meets every block of its value once
    blocks = F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(name), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    met = rows.join(hot, key, "left").select(key, own.alias("_own"), other.alias("_other"), *columns)
    return met.select(
        key, F.least("_own", "_other").alias("a"), F.greatest("_own", "_other").alias("b"), *columns
    )


def verified_links(rows: DataFrame, words: int, radii: Sequence[int]) -> DataFrame:
    """(u, v, within): forest links between different fingerprints that share a key.

    For each radius, a forest of the links within it.
    """
    spark = rows.sparkSession
    grouped = in_blocks(rows, "key", "fp", ["fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros((0, 3), np.int64), np.zeros((0, words), np.uint64)
        for batch in batches:
            new = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns[:3]], axis=1)
            keys = np.concatenate([keys, new])
            fps = np.concatenate([fps, _matrix(batch.column(3), words).copy().view(np.uint64)])
            # the last run may go on in the next batch
            differs = np.flatnonzero((keys != keys[-1]).any(axis=1))
            cut = int(differs[-1]) + 1 if len(differs) else 0
            if cut:
                yield from out(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield from out(keys, fps)

    def out(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        for radius in radii:
            pairs = np.array(_group_links(keys, fps, radius), dtype=np.int64).reshape(-1, 2)
            ends = [pa.array([fps[i].tobytes() for i in pairs[:, k]], pa.binary()) for k in (0, 1)]
            within = pa.array(np.full(len(pairs), radius, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*ends, within], ["u", "v", "within"])

    return (
        grouped.repartition(task_count(spark), "key", "a", "b")
        .sortWithinPartitions("key", "a", "b")
        .mapInArrow(link, "u binary, v binary, within int")
    )


def link_fingerprints(
    distinct: DataFrame,
    radius: int,
    choices: Sequence[int],
    words: int = 1,
    radii: Sequence[int] | None = None,
) -> DataFrame:
    """(u, v, within): links that connect all fingerprints within ``radius`` bits.

    ``radii`` asks for forests beyond the radius up to which finding every link is
    guaranteed.
    """
    rows, together = bit_statistics(distinct, words)
    plan = plan_parts(rows, together, radius, choices)
    found = verified_links(probes(distinct, plan, words), words, radii or (radius,))
    return found.groupBy("u", "v").agg(F.min("within").alias("within"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = 3, choices: Sequence[int] = (2, 3, 4)
) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id (its least doc_id) of every row."""
    marked = written(fingerprints(docs, shingle), "fingerprints")
    distinct = settle(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(link_fingerprints(distinct, radius, choices))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(named, "root").select("fp", "component_id")
    return marked.join(labels, "fp").select(
        "doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id"
    )


#: Texts are similar when (OVER + UNDER) * shared >= OVER * (one + other): a Jaccard
#: similarity of 0.8 of their distinct shingles.
OVER, UNDER, SIMILAR_SHINGLE = 4, 5, 5
#: Counters that tell common shingles from rare ones, and how many travel as one row.
COUNTERS, COUNTER_BLOCK = 1 << 20, 1 << 14
#: Buckets of the widest sketch of a shingle set.
MOST_BUCKETS = 4096
#: Texts of other groups that a text meets in one round, and the share of such pairs
#: that must be similar for another round.
NEXT, LEAST_GAIN = 16, 0.04


def gram_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles of a text in lower case."""
    lower = (text or b"").decode("utf-8", "replace").lower().encode()
    hashes = shingle_hashes(lower, SIMILAR_SHINGLE)
    if not len(hashes):  # texts without words equal each other
        hashes = np.array([xxhash.xxh64_intdigest(b"", SEED)], dtype=np.uint64)
    return np.unique(hashes)


def commonness(texts: DataFrame) -> np.ndarray:
    """Level of each counter: shingles that many texts hold have a high one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.int64)
        for piece in slices(batches):
            held = np.concatenate([gram_set(t) for t in text_bytes(piece.column(0))])
            counts += np.bincount((held % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        lines = [x.tobytes() for x in counts.reshape(-1, COUNTER_BLOCK)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(lines)), pa.int32()), pa.array(lines, pa.binary())], ["i", "line"]
        )

    found = summed_lines(texts.select("text").mapInArrow(count, "i int, line binary"))
    if not found:
        return np.zeros(COUNTERS, dtype=np.uint8)
    counts = np.concatenate([found[i] for i in range(COUNTERS // COUNTER_BLOCK)])
    return np.round(4 * np.log2(1 + counts)).astype(np.uint8)


def prefixes(texts: DataFrame, levels: np.ndarray) -> DataFrame:
    """(token, node, size, pos): the shingles of which similar texts share one.

    All texts order their shingles alike, rare ones first; any order will do. Of n
    shingles, all but n - ceil(0.8 n) + 1 can be left out: texts that share none of
    these are not similar.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            tokens, sizes, used = [], [], []
            for text in text_bytes(piece.column(1)):
                own = gram_set(text)
                order = np.argsort(levels[own % np.uint64(COUNTERS)], kind="stable")
                need = -(-OVER * len(own) // UNDER)
                tokens.append(own[order[: len(own) - need + 1]].view(np.int64))
                sizes.append(len(own))
                used.append(len(tokens[-1]))
            row = np.repeat(np.arange(len(used)), used)
            pos = np.concatenate([np.arange(n, dtype=np.int32) for n in used])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens)),
                    piece.column(0).take(pa.array(row)),
                    pa.array(np.array(sizes, dtype=np.int32)[row]),
                    pa.array(pos),
                ],
                ["token", "node", "size", "pos"],
            )

    return texts.select("_row", "text").mapInArrow(send, "token long, node long, size int, pos int")


def _possible(size: np.ndarray, pos: np.ndarray, other: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether texts can be similar whose first shared shingle stands at these places.

    Similar texts pass at the first shingle that they share.
    """
    return (OVER + UNDER) * np.minimum(size - pos, other - at) >= OVER * (size + other)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[np.ndarray]:
    """Rows of long columns, cut only where the first ``keys`` columns change."""
    held = None
    for batch in batches:
        new = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)
        held = new if held is None else np.concatenate([held, new])
        differs = np.flatnonzero((held[:, :keys] != held[-1:, :keys]).any(axis=1))
        cut = int(differs[-1]) + 1 if len(differs) else 0
        if cut:
            yield held[:cut]
            held = held[cut:]
    if held is not None and len(held):
        yield held


def fingerprint_links(
    prints: DataFrame, radius: int = 3, choices: Sequence[int] = (2, 3, 4)
) -> DataFrame:
    """(u, v): links that connect all nodes whose fingerprints ``fp`` are within the radius."""
    distinct = settle(
        prints.groupBy("fp").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n"))
    )
    several = broadcast_if_small(settle(distinct.where("n > 1").select("fp", "least")))
    equal = prints.join(several, "fp").where("node != least").select("least", "node")
    ends = [distinct.select(F.col("fp").alias(k), F.col("least").alias(f"_{k}")) for k in "uv"]
    found = link_fingerprints(distinct, radius, choices).join(ends[0], "u").join(ends[1], "v")
    both = equal.toDF("u", "v").unionByName(found.select(F.col("_u").alias("u"), F.col("_v").alias("v")))
    return both.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))


def shared_tokens(rows: DataFrame) -> DataFrame:
    """Prefix rows whose token several texts hold.

    ``before`` is the text before it in the order of sizes if both can be similar:
    links of neighbours join most of what is similar, at the cost of one each.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _runs(batches, 1):
            same = found[1:, 0] == found[:-1, 0]
            kept = np.r_[False, same] | np.r_[same, False]
            close = same & _possible(found[1:, 1], found[1:, 3], found[:-1, 1], found[:-1, 3])
            before = pa.array(np.r_[found[:1, 2], found[:-1, 2]], mask=~np.r_[False, close])
            kinds = (np.int64, np.int32, np.int64, np.int32)
            columns = [pa.array(found[kept, k].astype(kind)) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [*columns, before.filter(pa.array(kept))], ["token", "size", "node", "pos", "before"]
            )

    return (
        rows.select("token", "size", "node", "pos")
        .repartition(task_count(rows.sparkSession), "token")
        .sortWithinPartitions("token", "size", "node")
        .mapInArrow(of, "token long, size int, node long, pos int, before long")
    )


def neighbours(rows: DataFrame) -> DataFrame:
    """(u, v): texts and the next of other groups that share a token and can be similar."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _runs(batches, 1):
            token, size, node, pos, group = found.T
            new = np.r_[True, (token[1:] != token[:-1]) | (group[1:] != group[:-1])]
            after = np.r_[np.flatnonzero(new)[1:], len(token)][np.cumsum(new) - 1]
            for step in range(NEXT):
                own = np.flatnonzero(after + step < len(token))
                other = after[own] + step
                met = (token[own] == token[other]) & (group[own] != group[other])
                met &= _possible(size[own], pos[own], size[other], pos[other])
                one, two = node[own[met]], node[other[met]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], ["u", "v"]
                )

    return (
        rows.select("token", "size", "node", "pos", "group")
        .repartition(task_count(rows.sparkSession), "token")
        .sortWithinPartitions("token", "size", "node")
        .mapInArrow(of, "u long, v long")
        .distinct()
    )


def pairs_between(rows: DataFrame) -> DataFrame:
    """(u, v): texts of different groups that share a token and can be similar."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _runs(batches, 3):
            differs = (found[1:, :3] != found[:-1, :3]).any(axis=1)
            starts = np.flatnonzero(np.r_[True, differs])
            for start, stop in zip(starts, np.r_[starts[1:], len(found)], strict=True):
                _, _, _, size, node, pos, group = found[start:stop].T
                if (group == group[0]).all():
                    continue
                for i in range(len(node) - 1):
                    last = np.searchsorted(size, UNDER * size[i] // OVER, "right")
                    rest = slice(i + 1, last)
                    close = _possible(size[i], pos[i], size[rest], pos[rest]) & (group[rest] != group[i])
                    met = node[rest][close]
                    if len(met):
                        one = np.full(len(met), node[i])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.minimum(one, met)), pa.array(np.maximum(one, met))], ["u", "v"]
                        )

    columns = ["token", "a", "b", "size", "node", "pos", "group"]
    return (
        in_blocks(rows, "token", "node", columns[3:])
        .select(*columns)
        .repartition(task_count(rows.sparkSession), "token", "a", "b")
        .sortWithinPartitions("token", "a", "b", "size", "node")
        .mapInArrow(of, "u long, v long")
        .distinct()
    )


def sketch(own: np.ndarray) -> bytes:
    """How many of a set's hashes fall into each of some buckets, one byte each.

    There are one to two buckets a hash until there are ``MOST_BUCKETS``; a count of 255
    stands for any higher one.
    """
    width = min(max(64, 1 << len(own).bit_length()), MOST_BUCKETS)
    counts = np.bincount((own % np.uint64(width)).astype(np.int64), minlength=width)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def sketches_allow(size: int, one: bytes, other_size: int, other: bytes) -> bool:
    """Whether sets of these sizes and sketches can be similar; never False if they are.

    A bucket holds no more shared hashes than the lesser of its counts. Buckets of
    the wider sketch are summed into those of the narrower.
    """
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    if a.max() == 255 or b.max() == 255:
        return True
    width = min(len(a), len(b))
    a, b = (x.reshape(-1, width).sum(axis=0, dtype=np.int64) for x in (a, b))
    return (OVER + UNDER) * int(np.minimum(a, b).sum()) >= OVER * (size + other_size)


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(_row, size, sketch, set) of every text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            sets = [gram_set(t) for t in text_bytes(rows.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array([len(x) for x in sets], pa.int32()),
                    pa.array([sketch(x) for x in sets], pa.binary()),
                    pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())),
                ],
                ["_row", "size", "sketch", "set"],
            )

    return texts.select("_row", "text").mapInArrow(
        of, "_row long, size int, sketch binary, set array<long>"
    )


def _both_ends(pairs: DataFrame, rows: int, sets: DataFrame, *columns: str) -> DataFrame:
    """So many settled (u, v) with columns of both texts, named u_ and v_; only sets that pairs name move."""
    firsts = sets.select(F.col("_row").alias("u"), *[F.col(c).alias(f"u_{c}") for c in columns])
    seconds = sets.select(F.col("_row").alias("v"), *[F.col(c).alias(f"v_{c}") for c in columns])
    named = broadcast_if_small(settle(fewer_tasks(pairs.select("v").distinct(), rows)))
    return firsts.join(broadcast_if_small(pairs), "u").join(
        seconds.join(named, "v", "left_semi"), "v"
    )


def allowed_pairs(pairs: DataFrame, number: int, sets: DataFrame) -> DataFrame:
    """Those of so many settled (u, v) that their sketches do not rule out."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 4096):
            told = zip(*[c.to_pylist() for c in rows.columns[2:]], strict=True)
            kept = pa.array([sketches_allow(*x) for x in told], pa.bool_())
            yield rows.select(["u", "v"]).filter(kept)

    met = _both_ends(pairs, number, sets, "size", "sketch")
    return met.select("u", "v", "u_size", "u_sketch", "v_size", "v_sketch").mapInArrow(of, "u long, v long")


def similar_pairs(docs: DataFrame, pairs: DataFrame, number: int) -> tuple[DataFrame, int]:
    """Those of so many settled (u, v), named by their rows, whose texts are similar; their number.

    Sketches, a small part of a set in bytes, rule most other pairs out; the whole
    sets of those left decide.
    """
    ends = pairs.select(F.col("u").alias("_row")).union(pairs.select("v")).distinct()
    ends = broadcast_if_small(settle(fewer_tasks(ends, 2 * number)))
    texts = docs.select(row_key(), "text").join(ends, "_row", "left_semi").dropDuplicates(["_row"])
    sets = written(shingle_sets(texts), "shingle-sets")
    likely, left = settle_counted(allowed_pairs(pairs, number, sets))
    shared = F.size(F.array_intersect("u_set", "v_set"))
    return settle_counted(
        _both_ends(likely, left, sets, "set")
        .where((OVER + UNDER) * shared >= OVER * (F.size("u_set") + F.size("v_set")))
        .select("u", "v")
    )


def similar_links(docs: DataFrame, texts: DataFrame, prints: DataFrame) -> DataFrame:
    """(u, v): links that connect all similar texts; every link is decided exactly.

    First texts whose fingerprints (node, fp) are within the radius are compared, and
    neighbours under a shared shingle. Then neighbours of different groups are, in
    rounds, as long as they join many. What is left in different groups at last is
    compared with all it shares a shingle with, so that a large group never costs
    all its pairs.
    """
    rows = written(shared_tokens(prefixes(texts, commonness(docs))), "shared-shingles")
    near = rows.where(F.col("before").isNotNull())
    near = near.select(F.least("node", "before").alias("u"), F.greatest("node", "before").alias("v"))
    first = settle_counted(fingerprint_links(prints).unionByName(near).distinct())
    links, _ = similar_pairs(docs, *first)

    def grouped() -> DataFrame:
        roots = broadcast_if_small(settle(components(links)))
        return rows.join(roots, "node", "left").withColumn("group", F.coalesce("root", "node"))

    gained = True
    while gained:
        met, compared = settle_counted(neighbours(grouped()))
        more, found = similar_pairs(docs, met, compared)
        gained = found > LEAST_GAIN * compared
        links = links.unionByName(more)
    last, _ = similar_pairs(docs, *settle_counted(pairs_between(grouped())))
    return links.unionByName(last)


def row_key() -> Column:
    """Names a row by its document and text."""
    return F.xxhash64(F.col("doc_id"), F.col("text")).alias("_row")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the least doc_id.

    Groups are chained: texts are linked at a Jaccard similarity of 0.8 or more of
    their distinct five-word shingles. Links come from SimHash fingerprints, found as
    in ``near_duplicates`` and decided exactly; similar texts whose fingerprints are
    farther apart are found by their shingles. Equal rows count as one. Columns are kept.
    """
    keyed = docs.select("doc_id", "text", row_key())

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            texts = text_bytes(rows.column(1))
            same = [xxhash.xxh3_128_digest(gram_set(t).tobytes()) for t in texts]
            prints = [fingerprint(shingle_hashes(t, SHINGLE)) for t in texts]
            columns = [rows.column(0), rows.column(2), pa.array(same, pa.binary()), pa.array(prints, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "_row", "same", "fp"])

    # texts of equal sets share a name, and the least of their rows stands for them
    marked = written(keyed.mapInArrow(of, "doc_id long, _row long, same binary, fp binary"), "fingerprints")
    named = marked.groupBy("same").agg(F.min(F.struct("_row", "fp")).alias("_least"), F.count(F.lit(1)).alias("n"))
    named, _ = settle_counted(
        named.select("same", F.col("_least._row").alias("node"), F.col("_least.fp").alias("fp"), "n")
    )
    several = named.where("n > 1")
    copies, _ = settle_counted(marked.join(several, "same", "left_semi").select("_row").distinct())
    copies = broadcast_if_small(copies)
    stand = broadcast_if_small(settle(several.select(F.col("node").alias("_row"))))
    texts = keyed.select("_row", "text")
    texts = texts.join(copies, "_row", "left_anti").unionByName(
        texts.join(stand, "_row", "left_semi").dropDuplicates(["_row"])
    )
    roots = components(similar_links(docs, texts, named.select("node", "fp")))
    rooted = named.join(roots, "node", "left").select("same", F.coalesce("root", "node").alias("root"))
    grouped = marked.join(rooted, "same").select("doc_id", "_row", "root")
    grouped = written(grouped, "groups")
    order = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_row")
    winners = grouped.groupBy("root").agg(F.min(order).alias("_best"))
    winners = winners.select(F.col("_best._row").alias("_row"))
    losers = broadcast_if_small(
        settle(grouped.select("_row").distinct().join(winners, "_row", "left_anti"))
    )
    repeated = broadcast_if_small(
        settle(grouped.groupBy("_row").count().where(F.col("count") > 1).select("_row"))
    )
    own = boxed(docs, row_key())
    left = own.join(losers, "_row", "left_anti")
    once = left.join(repeated, "_row", "left_anti")
    again = left.join(repeated, "_row", "left_semi").dropDuplicates(["_row"])
    return unboxed(once.unionByName(again), docs.columns)
