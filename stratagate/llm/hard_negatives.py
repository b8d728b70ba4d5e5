"""Hard negatives by a multiway tree of split points with distance ranges.

Vectors are whole numbers, scores are inner products. The tree is laid on a bounded
sample: every node has FANOUT split points, a vector goes to the nearest one, so
that the children are parted by hyperplanes. Every row is then sent down the tree,
and each split point keeps the range of its distances to the rows below each of its
siblings, and of their squared norms.

A window of scores (low to high) around an anchor is an annulus of distances,
since d(a, x)^2 = |a|^2 + |x|^2 - 2 a.x. A sibling is eliminated when, by the
triangle inequality, no distance to its rows can lie in the annulus. What
remains are leaves, whose rows are scored exactly, in blocks, by matrix products.

An anchor is first scored in the leaf it falls into. The scores found there bound
the window from below, so the second pass meets only leaves that may hold better
rows. Positives are searched first; each of them then gives a window for negatives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratagate.llm.tables import slices
from stratagate.session import settings, written

SCALE = 256
FANOUT = 8
#: Rows of the sample the tree is laid on, and those of a leaf there.
SAMPLED, LEAF_SAMPLE = 4096, 64
#: Rows, and anchors, of a leaf that are multiplied at once.
BLOCK_ROWS, BLOCK_ANCHORS = 1024, 128
POSITIVES, NEGATIVES = 5, 10
#: Window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Products of whole numbers below this size are exact in doubles.
EXACT = 2.0**53


@dataclass
class Node:
    """Split points of one node, and its children: numbers of nodes, or ~leaf."""

    points: np.ndarray
    children: list[int]
    #: (points x children): least and largest distance of a point to a child's rows.
    near: np.ndarray = None
    far: np.ndarray = None
    #: Least and largest squared norm of each child's rows.
    thin: np.ndarray = None
    thick: np.ndarray = None


@dataclass
class Tree:
    nodes: list[Node] = field(default_factory=list)
    leaves: int = 0


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squared = (rows**2).sum(1)[:, None] + (points**2).sum(1) - 2 * rows @ points.T
    return np.sqrt(np.maximum(squared, 0))


def lay_tree(sample: np.ndarray) -> Tree:
    """Split points from a sample; a group of few or of equal vectors is a leaf."""
    tree = Tree()

    def grow(rows: np.ndarray) -> int:
        points = spread(rows) if len(rows) > LEAF_SAMPLE else rows[:0]
        if len(points) < 2:
            tree.leaves += 1
            return ~(tree.leaves - 1)
        at = len(tree.nodes)
        tree.nodes.append(Node(points, []))
        nearest = distances(rows, points).argmin(1)
        tree.nodes[at].children = [grow(rows[nearest == i]) for i in range(len(points))]
        return at

    grow(sample)
    return tree


def spread(rows: np.ndarray) -> np.ndarray:
    """Up to FANOUT rows, each the farthest from those before it."""
    picked = [0]
    away = distances(rows, rows[:1])[:, 0]
    while len(picked) < FANOUT and away.max() > 0:
        picked.append(int(away.argmax()))
        away = np.minimum(away, distances(rows, rows[picked[-1:]])[:, 0])
    return rows[picked]


def descend(tree: Tree, rows: np.ndarray):
    """Leaf of every row, and (node, child, rows, distances) for every step down."""
    leaf = np.zeros(len(rows), dtype=np.int64)
    steps = []
    todo = [(0, np.arange(len(rows)))] if tree.nodes else []
    while todo:
        at, members = todo.pop()
        if not len(members):
            continue
        if at < 0:
            leaf[members] = ~at
            continue
        node = tree.nodes[at]
        away = distances(rows[members], node.points)
        nearest = away.argmin(1)
        for i, child in enumerate(node.children):
            here = nearest == i
            if here.any():
                steps.append((at, i, members[here], away[here]))
                todo.append((child, members[here]))
    return leaf, steps


def surviving(tree: Tree, anchor: np.ndarray, low: float, high: float) -> list[int]:
    """Leaves that may hold a row scoring from low to high."""
    if not tree.nodes:
        return [0]
    own, found, todo = float((anchor**2).sum()), [], [0]
    while todo:
        at = todo.pop()
        if at < 0:
            found.append(~at)
            continue
        node = tree.nodes[at]
        away = distances(anchor[None], node.points)[0][:, None]
        # rounding may not eliminate anything
        slack = 1e-6 * (1 + own + np.where(np.isfinite(node.thick), node.thick, 0))
        inner = own + node.thin - 2 * high - slack
        outer = own + node.thick - 2 * low + slack
        nearest = np.maximum(0, np.maximum(away - node.far, node.near - away)).max(0)
        farthest = (away + node.far).min(0)
        kept = (outer >= 0) & (nearest**2 - slack <= outer) & (farthest**2 + slack >= inner)
        todo += [c for c, keep, thick in zip(node.children, kept, node.thick, strict=True) if keep and thick >= 0]
    return found


# ------------------------------------------------------------------ rows


def vectors(table: DataFrame) -> DataFrame:
    """(vec_id, label, vector): rows with a label and whole, finite vectors.

    Components become floor(SCALE * x) of x as a double. Where vec_id is divisible
    by 7 the label is (label + 1) % 10. Rows of a NULL vec_id take no part either.
    """
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    label = F.col("label").cast("long")
    return table.where(F.col("vec_id").isNotNull() & label.isNotNull() & x.isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * SCALE).cast("double")).alias("vector"),
    )


def padded(rows: DataFrame, dimension: int) -> DataFrame:
    """Shorter vectors end in zeros."""
    fill = F.array_repeat(F.lit(0.0), F.lit(dimension) - F.size("vector"))
    return rows.withColumn("vector", F.concat("vector", fill))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), dimension)


def tree_of(rows: DataFrame, count: int, dimension: int) -> Tree:
    """Lay a tree on about SAMPLED rows, measure its ranges on all of them."""
    share = int(min(1.0, SAMPLED / max(1, count)) * (1 << 31))
    picked = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(1 << 31)) <= share
    sample = rows.where(picked).select("vec_id", "vector").limit(2 * SAMPLED).collect()
    tree = lay_tree(np.array([r.vector for r in sorted(sample)]).reshape(len(sample), dimension))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = {}
        for batch in batches:
            x = _matrix(batch.column("vector"), dimension)
            squared = (x**2).sum(1)
            for at, child, members, away in descend(tree, x)[1]:
                new = (away.min(0), away.max(0), squared[members].min(), squared[members].max())
                old = ranges.get((at, child), new)
                ranges[at, child] = tuple(f(a, b) for f, a, b in zip(_ENDS, old, new, strict=True))
        rows = [
            {"node": at, "child": child, "point": i, "near": r[0][i], "far": r[1][i], "thin": r[2], "thick": r[3]}
            for (at, child), r in ranges.items()
            for i in range(len(r[0]))
        ]
        yield pa.RecordBatch.from_pylist(rows, schema=_RANGE)

    ends = (
        rows.select("vector")
        .mapInArrow(measured, "node int, child int, point int, near double, far double, thin double, thick double")
        .groupBy("node", "child", "point")
        .agg(*[f(c).alias(c) for f, c in ((F.min, "near"), (F.max, "far"), (F.min, "thin"), (F.max, "thick"))])
        .collect()
    )
    for node in tree.nodes:
        n = len(node.children)
        node.near, node.far = np.full((n, n), np.inf), np.full((n, n), -np.inf)
        node.thin, node.thick = np.full(n, np.inf), np.full(n, -np.inf)
    for r in ends:
        node = tree.nodes[r.node]
        node.near[r.point, r.child], node.far[r.point, r.child] = r.near, r.far
        node.thin[r.child], node.thick[r.child] = r.thin, r.thick
    return tree


_ENDS = (np.minimum, np.maximum, min, max)
_RANGE = pa.schema(
    [("node", pa.int32()), ("child", pa.int32()), ("point", pa.int32())]
    + [(c, pa.float64()) for c in ("near", "far", "thin", "thick")]
)


def leaf_blocks(rows: DataFrame, tree: Tree, dimension: int) -> DataFrame:
    """(leaf, block, ids, labels, values): the rows of each leaf in blocks.

    The size of a block does not depend on that of its leaf, however many rows
    of one vector there are.
    """

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = descend(tree, _matrix(batch.column("vector"), dimension))[0]
            yield batch.append_column("leaf", pa.array(leaf))

    columns = "vec_id long, label long, vector array<double>, leaf long"
    placed = written(rows.mapInArrow(dealt, columns), "leaves")
    sizes = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("_blocks"))
    # one row per leaf; leaves are fewer than sampled rows
    spread_over = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.col("_blocks"))
    packed = (
        placed.join(F.broadcast(sizes), "leaf")
        .withColumn("block", spread_over)
        .groupBy("leaf", "block")
        .agg(F.collect_list(F.struct("vec_id", "label", "vector")).alias("_rows"))
        .select(
            "leaf",
            "block",
            F.col("_rows.vec_id").alias("ids"),
            F.col("_rows.label").alias("labels"),
            F.flatten("_rows.vector").alias("values"),
        )
    )
    return written(packed, "blocks")


# --------------------------------------------------------------- searches

#: One list wanted of an anchor: for which positive, with which score, and the
#: least score that can still matter (NULL: any).
_WINDOWS = "array<struct<positive_id:bigint,positive_score:bigint,low:bigint>>"
_ASKED = f"vec_id long, label long, vector array<double>, windows {_WINDOWS}, leaf long"
_FOUND = (
    "anchor_id long, positive_id long, positive_score long, found_id long, score long"
)
_FOUND_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in _FOUND.split(", ")])
_MOST = (1 << 63) - 1


def bounds(window: dict) -> tuple[int, int]:
    """Lowest and highest score of a window, in whole numbers."""
    p, low = window["positive_score"], window["low"]
    if p is None:
        return (-_MOST - 1 if low is None else low), _MOST
    least = -((-LOW * p) // 100)
    return (least if low is None else max(low, least)), HIGH * p // 100


def routed(anchors: DataFrame, tree: Tree, dimension: int, home: bool) -> DataFrame:
    """Anchors once for each leaf to look at: the own one, or the others that survive."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = _matrix(batch.column("vector"), dimension)
            own = descend(tree, x)[0]
            at, leaves = [], []
            for i, windows in enumerate(batch.column("windows").to_pylist()):
                if home:
                    wanted = {int(own[i])}
                else:
                    wanted = set()
                    for low, high in map(bounds, windows):
                        if low <= high:
                            # a score at either end stands for all beyond
                            least = float(low) if low > -_MOST - 1 else -np.inf
                            most = float(high) if high < _MOST else np.inf
                            wanted.update(surviving(tree, x[i], least, most))
                    wanted.discard(int(own[i]))
                at += [i] * len(wanted)
                leaves += sorted(wanted)
            yield batch.take(pa.array(at, pa.int64())).append_column("leaf", pa.array(leaves, pa.int64()))

    return anchors.select("vec_id", "label", "vector", "windows").mapInArrow(route, _ASKED)


def exact_products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; beyond 64 bits the nearest long."""
    if np.sqrt((a**2).sum(1).max(initial=0) * (x**2).sum(1).max(initial=0)) < EXACT:
        return (a @ x.T).astype(np.int64)
    whole = [[[int(v) for v in row] for row in m] for m in (a, x)]
    sums = [[sum(p * q for p, q in zip(r, s, strict=True)) for s in whole[1]] for r in whole[0]]
    return np.array([[min(max(v, -_MOST - 1), _MOST) for v in r] for r in sums], dtype=np.int64).reshape(len(a), len(x))


def first_of(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most``, higher scores first, ties by smaller id."""
    if len(scores) > most:
        least = np.partition(scores, len(scores) - most)[len(scores) - most]
        kept = np.flatnonzero(scores >= least)
    else:
        kept = np.arange(len(scores))
    # the negative of a long may not be one
    return kept[np.lexsort((ids[kept], ~scores[kept]))][:most]


def searched(asked: DataFrame, blocks: DataFrame, anchors: int, dimension: int, same: bool, most: int) -> DataFrame:
    """The first rows of every window in every block that its anchor looks at.

    Anchors of a leaf travel in chunks, each meets every block of the leaf, and a
    block is scored against a chunk by one matrix product.
    """
    spark = blocks.sparkSession
    chunks = -(-anchors // BLOCK_ANCHORS) or 1
    packed = (
        asked.groupBy("leaf", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).alias("_chunk"))
        .agg(F.collect_list(F.struct("vec_id", "label", "vector", "windows")).alias("asked"))
        .join(F.broadcast(blocks.groupBy("leaf").agg(F.max("block").alias("_last"))), "leaf")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), "_last")))
    )
    met = packed.join(blocks, ["leaf", "block"]).select("asked", "ids", "labels", "values")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            asked = batch.column("asked").to_pylist()[0]
            ids, labels, values = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("ids", "labels", "values"))
            a = np.array([q["vector"] for q in asked], dtype=float).reshape(len(asked), dimension)
            products = exact_products(a, values.reshape(len(ids), dimension))
            out = {c: [] for c in _FOUND_ARROW.names}
            for q, scores in zip(asked, products, strict=True):
                fit = (labels == q["label"]) & (ids != q["vec_id"]) if same else labels != q["label"]
                for w in q["windows"]:
                    low, high = bounds(w)
                    if low > high:
                        continue
                    here = np.flatnonzero(fit & (scores >= max(low, -_MOST - 1)) & (scores <= min(high, _MOST)))
                    top = here[first_of(scores[here], ids[here], most)]
                    out["anchor_id"] += [q["vec_id"]] * len(top)
                    out["positive_id"] += [w["positive_id"]] * len(top)
                    out["positive_score"] += [w["positive_score"]] * len(top)
                    out["found_id"] += ids[top].tolist()
                    out["score"] += scores[top].tolist()
            yield pa.RecordBatch.from_pydict(out, schema=_FOUND_ARROW)

    # a row holds a whole block and a chunk of anchors
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="16"):
        return written(met.mapInArrow(score, _FOUND), "found")


def ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def best(anchors: DataFrame, tree: Tree, blocks: DataFrame, count: int, dimension: int, same: bool, most: int) -> DataFrame:
    """First rows of every window: the own leaf first, then what may hold better ones."""
    at_home = searched(routed(anchors, tree, dimension, True), blocks, count, dimension, same, most)
    # the last of a full list bounds the window from below
    full = ranked(at_home, most).where(F.col("rank") == most)
    full = full.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "score")).alias("_full"))
    raised = F.transform(
        "windows",
        lambda w: w.withField(
            "low",
            F.coalesce(
                F.get(F.filter("_full", lambda f: f["positive_id"].eqNullSafe(w["positive_id"])), F.lit(0))["score"],
                w["low"],
            ),
        ),
    )
    narrowed = anchors.join(full, F.col("vec_id") == F.col("anchor_id"), "left").select(
        "vec_id", "label", "vector", raised.alias("windows")
    )
    away = searched(routed(narrowed, tree, dimension, False), blocks, count, dimension, same, most)
    return ranked(at_home.unionByName(away), most)


def hard_negatives(table: DataFrame, every: int = 100) -> DataFrame:
    """Negatives just below each positive, for anchors with vec_id divisible by ``every``.

    Rows without a vec_id or label, and vectors that are NULL or hold anything but
    finite numbers, take no part; shorter vectors end in zeros, an empty one is all
    zeros. Components and scores beyond 64 bits are the nearest long. A row is
    another one if its vec_id differs. Repeated rows count as often as they are
    there; of several rows with an anchor's vec_id the one of smallest label and vector
    is the anchor, and a positive met twice gives one list. Anchors without a
    positive, and positives without a negative, have no row; nor has an empty table.
    Other columns are not looked at.
    """
    spark = table.sparkSession
    rows = written(vectors(table), "vectors")
    count, dimension = rows.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    dimension = max(1, dimension or 0)
    rows = padded(rows, dimension)
    tree = tree_of(rows, count, dimension)
    blocks = leaf_blocks(rows, tree, dimension)
    any_score = F.from_json(F.lit("[{}]"), _WINDOWS)
    anchors = (
        rows.where(F.col("vec_id") % every == 0)
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "vector")).alias("_row"))
        .select("vec_id", "_row.label", "_row.vector", any_score.alias("windows"))
    )
    anchors = written(anchors, "anchors")
    number = anchors.count()
    positives = best(anchors, tree, blocks, number, dimension, True, POSITIVES)
    windows = positives.groupBy("anchor_id").agg(
        F.collect_set(
            F.struct(
                F.col("found_id").alias("positive_id"),
                F.col("score").alias("positive_score"),
                F.lit(None).cast("long").alias("low"),
            )
        ).alias("windows")
    )
    asked = anchors.drop("windows").join(windows, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id")
    negatives = best(written(asked, "asked"), tree, blocks, number, dimension, False, NEGATIVES)
    return negatives.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("found_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
