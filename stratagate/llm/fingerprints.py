"""Order-independent fingerprints of documents: a homomorphic multiset hash.

A text is the multiset of its paragraphs (lines), cut again behind sentence marks
and after CHARS characters of a sentence, so that an edit inside a long paragraph
leaves the rest of it alone. White space before a piece counts for nothing, nor
does the order of pieces.

Every piece is hashed to a wide vector of LANES bits, seeded 64-bit hashes of its
SHA-256. The fingerprint is the sum of these vectors beside the number of pieces,
every lane modulo 2**32, two lanes in one word. So pieces can be inserted into a
fingerprint or deleted from it without the text (:func:`inserted`,
:func:`deleted`), and fingerprints of parts add up to that of the whole.

A lane holds how many pieces have its bit set; twice that, less the number of
pieces, is a sum of random signs. The inner product of two such vectors estimates
that of the two multisets; the likeness is twice the product over the sum of the
two squares, within 0 and 1: the share of common pieces, for distinct ones. With
256 lanes its standard error is about 0.07 where half is common.

Everything is a DataFrame expression. Texts move once, to the range of documents
in which they meet the next one; pieces are counted there without another exchange.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratagate.llm.tables import task_count

CHARS = 128
#: Seeded hashes of a piece, and the words that two of their bits each make.
PARTS, LANE_BITS = 4, 32
LANES = 64 * PARTS
WORDS = [f"w{i}" for i in range(LANES // 2)]
_LANE = (1 << LANE_BITS) - 1
_BOTH = 1 | 1 << LANE_BITS
#: Digits of a word as text.
DIGITS = 16
#: One piece, from a character that is no white space.
_PIECE = rf"[^\s.!?][^\n.!?]{{0,{CHARS - 1}}}+[.!?]*+|[.!?]++"

#: Ranges of documents per task, rows looked at to lay them, and their largest number.
RANGES_PER_TASK = 8
SAMPLED_PER_RANGE = 20
MOST_RANGES = 4096


def pieces(text: Column) -> Column:
    """Pieces of a text; none for NULL, an empty text or white space."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_PIECE), 0)


def summed(rows: DataFrame, piece: str, by: list[str]) -> DataFrame:
    """Number of pieces (``n``) and words of the fingerprint of every group.

    A NULL piece counts for nothing, so a group of no piece has zeros. A text
    below 2 GiB has too few pieces for a sum to leave its word.
    """
    digest = F.sha2(F.col(piece).cast("binary"), 256)
    hashed = rows.select(
        *by,
        piece,
        *[
            F.when(F.col(piece).isNotNull(), F.xxhash64(F.lit(i), digest)).alias(f"_p{i}")
            for i in range(PARTS)
        ],
    )
    words = [
        F.coalesce(
            F.sum(F.shiftrightunsigned(f"_p{i}", j).bitwiseAND(F.lit(_BOTH))), F.lit(0).cast("long")
        )
        for i in range(PARTS)
        for j in range(LANE_BITS)
    ]
    return hashed.groupBy(*by).agg(
        F.count(piece).alias("n"), *[w.alias(name) for w, name in zip(words, WORDS, strict=True)]
    )


def as_text(words: list[Column]) -> Column:
    """Number of pieces and words as hexadecimal digits, DIGITS each."""
    return F.lower(F.concat(*[F.lpad(F.hex(w), DIGITS, "0") for w in words]))


def words_of(fingerprint: Column) -> Column:
    """Inverse of :func:`as_text`: the number and the words as an array."""
    starts = F.sequence(F.lit(0), F.lit(len(WORDS)))
    digits = F.transform(starts, lambda i: F.substr(fingerprint, i * DIGITS + 1, F.lit(DIGITS)))
    return F.transform(digits, lambda d: F.conv(d, 16, 10).cast("long"))


def _by_lane(one: Column, other: Column, change) -> Column:
    def word(a: Column, b: Column) -> Column:
        low = change(a.bitwiseAND(F.lit(_LANE)), b.bitwiseAND(F.lit(_LANE)))
        high = change(F.shiftrightunsigned(a, LANE_BITS), F.shiftrightunsigned(b, LANE_BITS))
        # a lane stays below 2**31, as a text has fewer pieces
        return F.shiftleft(high.bitwiseAND(F.lit(_LANE)), LANE_BITS).bitwiseOR(
            low.bitwiseAND(F.lit(_LANE))
        )

    both = F.zip_with(words_of(one), words_of(other), word)
    return F.array_join(F.transform(both, lambda w: F.lower(F.lpad(F.hex(w), DIGITS, "0"))), "")


def inserted(fingerprint: Column, more: Column) -> Column:
    """Fingerprint of both multisets together, from the two as text."""
    return _by_lane(fingerprint, more, lambda a, b: a + b)


def deleted(fingerprint: Column, less: Column) -> Column:
    """Fingerprint without the pieces of another, which it is meant to hold."""
    return _by_lane(fingerprint, less, lambda a, b: a - b)


def signs() -> Column:
    """The lanes as sums of signs: pieces with the bit less pieces without."""
    lanes = [
        lane
        for w in WORDS
        for lane in (F.col(w).bitwiseAND(F.lit(_LANE)), F.shiftrightunsigned(w, LANE_BITS))
    ]
    return F.array(*[(lane * 2 - F.col("n")).cast("double") for lane in lanes])


def product(one: Column, other: Column) -> Column:
    both = F.zip_with(one, other, lambda x, y: x * y)
    return F.aggregate(both, F.lit(0.0), lambda total, x: total + x)


def likeness(common: Column, one: Column, other: Column) -> Column:
    """From an inner product and two squares; no piece is like no piece."""
    near = common * 2 / F.nullif(one + other, F.lit(0.0))
    bounded = F.least(F.greatest(near, F.lit(0.0)), F.lit(1.0))
    return F.when(one + other > 0, bounded).otherwise(1.0)


def _range_of(key: Column, bounds: Column, number: int) -> Column:
    """How many bounds lie at or below the key, by bisection."""
    low, high = F.lit(0), F.lit(number)

    def step(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        open_, below = state["low"] < state["high"], F.get(bounds, middle) <= key
        return F.struct(
            F.when(open_ & below, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(open_ & ~below, middle).otherwise(state["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(0), F.lit(max(number, 1).bit_length()))
    found = F.aggregate(steps, F.struct(low.alias("low"), high.alias("high")), step)
    return found["low"]


_KEY = "struct<doc_id:bigint,h:bigint,row:bigint>"


def _in_ranges(rows: DataFrame) -> DataFrame:
    """The rows dealt to ranges of ``_key``, each range with the row that follows it.

    A bounded sample lays the ranges, so it only decides how even they are. The
    first row of each range is also sent to the range before it, as a ``_guest``
    behind that one's last row; the very first is the guest of the last range.
    """
    spark = rows.sparkSession
    ranges = min(MOST_RANGES, RANGES_PER_TASK * task_count(spark))
    # about so many rows by a hash that differs between repeated rows too
    share = min(1.0, ranges * SAMPLED_PER_RANGE / max(1, rows.count()))
    keys = rows.select("_key").where(F.pmod(F.xxhash64("_key"), F.lit(1 << 31)) <= int(share * (1 << 31)))
    sample = sorted(
        ((r[0][0] is not None, *r[0]) for r in keys.collect()), key=lambda k: (k[0], k[1] or 0, *k[2:])
    )
    picked = list(dict.fromkeys(sample[i * len(sample) // ranges] for i in range(1, ranges) if sample))
    # at most MOST_RANGES bounds, a literal of the plan
    listed = json.dumps([dict(zip(("doc_id", "h", "row"), p[1:], strict=True)) for p in picked])
    bounds = F.from_json(F.lit(listed), f"array<{_KEY}>")
    dealt = rows.withColumn("_range", _range_of(F.col("_key"), bounds, len(picked)))
    firsts = sorted(tuple(r) for r in dealt.groupBy("_range").agg(F.min("_key")).collect())
    guests = spark.createDataFrame(
        [(first[1], firsts[i - 1][0]) for i, first in enumerate(firsts)],
        f"_key {_KEY}, _before int",
    )
    home = F.struct(F.col("_range").alias("_range"), F.lit(False).alias("_guest"))
    away = F.struct(F.col("_before").alias("_range"), F.lit(True).alias("_guest"))
    here = F.inline(F.array_compact(F.array(home, F.when(F.col("_before").isNotNull(), away))))
    return dealt.join(F.broadcast(guests), "_key", "left").select(*rows.columns, here)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents and of their edited texts.

    The edited text has its last half (rounded down, in code points) replaced by
    as many code points from the start of the next document, or by all of it.
    Documents follow each other by doc_id, NULL first; among equal ones by a hash
    of the text, and repeated rows in any order. Behind the last comes the first,
    so a single document is its own next one. A NULL text is empty. An empty table
    gives no row; other columns are not looked at.

    Rows are numbered as they are read, more than once: ``docs`` is a table, or a
    frame that was checkpointed.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    key = F.struct(
        "doc_id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row")
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    placed = _in_ranges(rows.select(key.alias("_key"), "text"))
    order = Window.partitionBy("_range").orderBy("_guest", "_key")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    met = placed.select(
        "*", F.lead("text").over(order).alias("_next"), n.alias("n_chars"), half.alias("_half")
    ).select(
        "_range",
        "_guest",
        "_key",
        "n_chars",
        "text",
        F.concat(
            F.substr("text", F.lit(1), F.col("n_chars") - F.col("_half")),
            F.substr("_next", F.lit(1), F.col("_half")),
        ).alias("edited"),
    )
    by = ["_range", "_guest", "_key", "n_chars", "edited_sha256", "kind"]
    texts = F.inline(
        F.array(
            F.struct(F.lit(0).alias("kind"), F.col("text").alias("_text")),
            F.struct(F.lit(1).alias("kind"), F.col("edited").alias("_text")),
        )
    )
    parted = (
        met.select(*by[:4], F.sha2(F.col("edited").cast("binary"), 256).alias(by[4]), texts)
        .where("kind = 0 OR NOT _guest")
        .select(*by, F.explode_outer(pieces(F.col("_text"))).alias("piece"))
    )
    lanes = summed(parted, "piece", by).select(
        *by,
        as_text([F.col("n"), *[F.col(w) for w in WORDS]]).alias("fingerprint"),
        signs().alias("signs"),
    )
    # a document's own row, its edited text's, then the next one's own
    places = Window.partitionBy("_range").orderBy("_guest", "_key", "kind")
    squared = lanes.withColumn("square", product(F.col("signs"), F.col("signs")))
    beside = squared.select(
        "*",
        *[F.lead(c).over(places).alias(f"edited_{c}") for c in ("fingerprint", "signs", "square")],
        *[F.lead(c, 2).over(places).alias(f"next_{c}") for c in ("signs", "square")],
    ).where("kind = 0 AND NOT _guest")
    return beside.select(
        F.col("_key.doc_id").alias("doc_id"),
        F.col("n_chars").cast("long").alias("n_chars"),
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        *[
            likeness(
                product(F.col("signs"), F.col(f"{other}_signs")), F.col("square"), F.col(f"{other}_square")
            ).alias(f"near_{other}")
            for other in ("edited", "next")
        ],
    )
