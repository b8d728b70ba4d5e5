"""Benchmark decontamination: SimHash of item-sized windows, then exact similarity.

A document is contaminated by an item when some window of as many word shingles
as the item has is similar to it: weighted shingle similarity, the sum of the
least over the sum of the greatest counts per shingle, of at least ``similarity``.

1. A window that similar shares shingles with its item, so places where a shingle
   of an item occurs are looked up, and windows start at such places if enough of
   them follow within the item's length. This leaves out nothing that can pass.
2. Every such window gets a 64-bit SimHash of its shingles, and so does each item.
   Fingerprints are cut into ``radius + 1`` blocks; a window meets its items through
   equal blocks (a multi-index), which by the pigeonhole principle finds every
   pair within the radius, and the distance is verified.
3. The exact weighted similarity of window and item decides.

All of it is DataFrame work. Text is not exchanged but for rows that have windows;
the benchmark is broadcast only when its measured size allows it.

Words are runs of letters and digits, in lower case. A shingle has five words; an
item of fewer words is one shingle of its own length.

Defined cases: NULL text and items without words match nothing; repeated rows get
equal verdicts; of equally similar items the least item_id is named; an empty
table of documents gives no rows, an empty benchmark no contamination; other
columns are ignored, ``decontaminated`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagate.llm.tables import boxed, let, unboxed
from stratagate.operators.sizing import broadcast_if_small
from stratagate.session import settle

SHINGLE = 5
SIMILARITY = 0.8
#: At similarity 0.8 fingerprints differ in about 10 of 64 bits, deviation 3.
RADIUS = 23
BITS = 64


def _words(text: Column) -> Column:
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1)
    return F.filter(found, lambda w: w != "")


def _shingles(words: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` words."""
    return let(
        words,
        lambda ws: F.slice(
            F.transform(
                ws, lambda w, i: F.xxhash64(F.lit(size), w, *[F.get(ws, i + k) for k in range(1, size)])
            ),
            1,
            F.greatest(F.size(ws) - (size - 1), F.lit(0)),
        ),
    )


def _simhash(hashes: Column) -> Column:
    """Bits set in over half of the hashes."""

    def bit(b: Column) -> Column:
        found = F.filter(hashes, lambda h: F.call_function("shiftrightunsigned", h, b) % 2 != 0)
        return F.when(F.size(found) * 2 > F.size(hashes), F.lit(1)).otherwise(F.lit(0))

    text = F.transform(F.sequence(F.lit(BITS - 1), F.lit(0), F.lit(-1)), lambda b: bit(b).cast("string"))
    return F.array_join(text, "")


def _numbered(hashes: Column) -> Column:
    """A multiset as a set: every hash with the number of its repetition."""
    return let(
        F.sort_array(hashes),
        lambda s: F.transform(s, lambda h, i: F.xxhash64(h, i - F.array_position(s, h))),
    )


def _block(fingerprint: Column, block: Column, blocks: int) -> Column:
    """The block-th part of a fingerprint written as bits."""
    start = F.floor(block * BITS / blocks).cast("int")
    end = F.floor((block + 1) * BITS / blocks).cast("int")
    return F.substr(fingerprint, start + 1, end - start)


def _blocked(rows: DataFrame, fingerprint: str, radius: int) -> DataFrame:
    """One row per block of the fingerprint."""
    blocks = radius + 1
    return rows.withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    ).withColumn("_bits", _block(F.col(fingerprint), F.col("_block"), blocks))


def _distance(one: Column, other: Column) -> Column:
    """Differing bits of two fingerprints written as bits."""
    places = F.sequence(F.lit(1), F.lit(BITS))
    return F.size(F.filter(places, lambda i: F.substr(one, i, F.lit(1)) != F.substr(other, i, F.lit(1))))


def _row_key() -> Column:
    """Names a row's text; rows of one document and text are alike anyway."""
    return F.xxhash64(F.col("doc_id"), F.col("text"), F.length("text"))


def items_of(benchmark: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Items with their shingles, in the shared folder."""
    words = benchmark.select("item_id", _words(F.col("text")).alias("_w")).where(F.size("_w") > 0)
    size = F.least(F.size("_w"), F.lit(SHINGLE))
    shingles = F.lit(None)
    for k in range(1, SHINGLE + 1):
        shingles = F.when(size == k, _shingles(F.col("_w"), k)).otherwise(shingles)
    return settle(
        words.select("item_id", size.alias("size"), shingles.alias("shingles"))
        .withColumn("m", F.size("shingles"))
        .withColumn("item_fp", _simhash(F.col("shingles")))
    )


def similarities(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS
) -> DataFrame:
    """(_key, item_id, similarity) of every contaminated text and item."""
    items = items_of(benchmark, radius)
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most five
    keyed = docs.select(_row_key().alias("_key"), "text")
    grams = broadcast_if_small(
        settle(items.select("item_id", "size", "m", F.explode("shingles").alias("gram")).distinct())
    )
    pairs = []
    for size in sizes:
        own = grams.where(F.col("size") == size)
        placed = keyed.select("_key", F.posexplode(_shingles(_words(F.col("text")), size)).alias("at", "gram"))
        hits = placed.join(own, "gram").groupBy("_key", "item_id", "m").agg(
            F.array_sort(F.collect_set("at")).alias("at")
        )
        # so many shared shingles must stand within the item's length
        need = F.ceil(similarity * F.col("m")).cast("int")
        starts = F.filter(
            "at", lambda p, i: F.coalesce(F.get(F.col("at"), i + need - 1) - p < F.col("m"), F.lit(False))
        )
        pairs.append(hits.select("_key", "item_id", F.lit(size).alias("size"), F.explode(starts).alias("at")))
    if not pairs:
        return docs.sparkSession.createDataFrame([], "_key long, item_id long, similarity double")
    starts = pairs[0]
    for more in pairs[1:]:
        starts = starts.unionByName(more)
    starts = settle(starts)
    suspects = broadcast_if_small(settle(starts.select("_key").distinct()))
    texts = keyed.join(suspects, "_key", "left_semi").dropDuplicates(["_key"])
    by_size = F.create_map(
        *[x for k in sizes for x in (F.lit(k), _shingles(F.col("_w"), k))]
    )
    texts = texts.select("_key", _words(F.col("text")).alias("_w")).select("_key", by_size.alias("_all"))
    first = F.greatest(F.least(F.col("at"), F.size("_own") - F.col("m")), F.lit(0))
    windows = (
        starts.join(texts, "_key")
        .join(items.select("item_id", "m"), "item_id")
        .select("_key", "item_id", "m", "at", F.element_at("_all", F.col("size")).alias("_own"))
        .select("_key", "item_id", F.slice("_own", first + 1, F.col("m")).alias("window"))
        .withColumn("window_fp", _simhash(F.col("window")))
    )
    near = (
        _blocked(windows, "window_fp", radius)
        .join(_blocked(items.select("item_id", "item_fp"), "item_fp", radius), ["item_id", "_block", "_bits"])
        .dropDuplicates(["_key", "item_id", "window_fp", "window"])
        .where(_distance(F.col("window_fp"), F.col("item_fp")) <= radius)
    )
    shared = F.size(F.array_intersect(_numbered(F.col("window")), _numbered(F.col("shingles"))))
    exact = shared / (F.size("window") + F.size("shingles") - shared)
    return (
        near.select("_key", "item_id", "window")
        .join(items.select("item_id", "shingles"), "item_id")
        .select("_key", "item_id", exact.alias("similarity"))
        .where(F.col("similarity") >= similarity)
        .groupBy("_key", "item_id")
        .agg(F.max("similarity").alias("similarity"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, contaminated, n_items, item_id (most similar) and similarity of every row."""
    own = docs.select("doc_id", "text")
    found = settle(similarities(own, benchmark, similarity))
    best = found.groupBy("_key").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.max(F.struct("similarity", (-F.col("item_id")).alias("_least"))).alias("_best"),
    )
    return (
        own.select("doc_id", _row_key().alias("_key"))
        .join(best, "_key", "left")
        .select(
            "doc_id",
            F.col("n_items").isNotNull().alias("contaminated"),
            F.coalesce("n_items", F.lit(0)).alias("n_items"),
            (-F.col("_best._least")).alias("item_id"),
            F.col("_best.similarity").alias("similarity"),
        )
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    found = similarities(docs.select("doc_id", "text"), benchmark, similarity)
    keys = broadcast_if_small(settle(found.select("_key").distinct()))
    rows = boxed(docs, _row_key().alias("_key"))
    return unboxed(rows.join(keys, "_key", "left_anti"), docs.columns)
