"""Personal data by fixed patterns and by bootstrapped contexts.

Base kinds (email, ip, card, phone) are found by their regular expressions. They
are the seeds of a bootstrap: what stands before a seed is a lexical pattern, and
a pattern that is trusted discovers further identifiers, of kind ``id``, that no
fixed pattern knows. On the graph of patterns and instances,

1. a pattern can be trusted when its last word does not stand before many
   identifiers without the first (it is prose, not a label), and when most places of
   the corpus where its words stand, followed by an identifier or not, hold one;
2. of these, a pattern is trusted when enough of its different instances are known;
3. the instances of trusted patterns become known, wherever else they occur, and
   step 2 is taken again until it trusts nothing new.

All of it is DataFrame work. Patterns and instances stay tables of any size. How
often words stand anywhere is counted over the whole corpus, for those patterns that
a count over a part of it, which is never the larger one, has not ruled out.
A pattern is at most ``_CONTEXT`` characters long, other identifiers included.

The regular expressions are the contract's with possessive repeats and a test of
what stands before, which keeps them linear on long runs and finds the same.

Defined cases: NULL text is empty; repeated rows have equal spans; an empty table
gives no rows; other columns are ignored, ``masked`` keeps them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagate.llm.tables import boxed, let, unboxed
from stratagate.operators.sizing import broadcast_if_small
from stratagate.session import settle, written

#: Order of the kinds in a list of spans; ``id`` is what the bootstrap finds.
KINDS = ("email", "ip", "card", "phone")
DISCOVERED = "id"

_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: An identifier of unknown kind: letters and a digit, then groups of both.
IDENTIFIER = r"(?<![A-Za-z0-9])[A-Za-z]*+[0-9][A-Za-z0-9]*+(?:[-_][A-Za-z0-9]++)*+"
LEAST_LENGTH, LEAST_DIGITS = 8, 3

#: A pattern needs so many different known instances, and so many of its places
#: in the corpus must hold an identifier.
LEAST_KNOWN, LEAST_PRECISION = 3, 0.8
#: Of the instances behind a pattern's last word, the share behind the pattern.
LEAST_SHARE = 0.2
#: Up to so many trusted patterns are looked up as constants, more are joined.
CONSTANTS = 500
#: Up to so many pairs of words are broadcast, at most 256 bytes each; for more, all
#: pairs of the corpus are summed before they meet them.
BROADCAST = 100_000
#: Patterns are first held against one of so many parts of the corpus.
PARTS = 16
_CONTEXT = 64
_BLOCK = 256


def _running(lengths: Column) -> Column:
    """Sums of all earlier elements, in blocks so that no long array is copied per step."""

    def sums(values: Column) -> Column:
        return F.aggregate(
            values,
            F.array(F.lit(0).cast("long")),
            lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)),
        )

    def joined(blocks: Column) -> Column:
        inner = F.transform(blocks, sums)
        outer = sums(F.transform(inner, lambda x: F.element_at(x, -1)))

        def put(parts: Column) -> Column:
            return F.flatten(
                F.transform(
                    parts["inner"],
                    lambda block, i: F.transform(
                        F.slice(block, 1, F.size(block) - 1), lambda x: x + F.get(parts["outer"], i)
                    ),
                )
            )

        return let(F.struct(inner.alias("inner"), outer.alias("outer")), put)

    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * _BLOCK + 1, _BLOCK),
    )
    return let(cut, joined)


def _context(parts: Column, i: Column) -> Column:
    """The last two words before match ``i`` and what is attached to it, in lower case.

    A match and the gap before it have two characters or more, so half as many pairs
    as a context has characters reach back far enough.
    """
    pairs = _CONTEXT // 2
    gap = F.get(parts["p"], i)
    start = F.greatest(i - pairs, F.lit(0)) + 1
    earlier = F.zip_with(
        F.slice(parts["p"], start, F.least(i, F.lit(pairs))),
        F.slice(parts["m"], start, F.least(i, F.lit(pairs))),
        lambda p, m: F.concat(p, m),
    )
    before = F.when(F.length(gap) >= _CONTEXT, gap).otherwise(
        F.concat(F.array_join(earlier, ""), gap)
    )
    near = F.right(before, F.lit(_CONTEXT))
    return F.lower(
        F.regexp_replace(F.regexp_extract(near, r"(\S+\s+\S+\s+\S*)$", 1), r"\s+", " ")
    )


def _matches(
    text: Column, pattern: str, kind: str, valid: Callable[[Column], Column] | None = None
) -> Column:
    """Structs (kind, start, end, token, context) of valid matches, code points."""

    def placed(parts: Column) -> Column:
        lengths = F.transform(
            parts["m"],
            lambda m, i: F.struct(
                F.length(F.get(parts["p"], i)).cast("long").alias("gap"),
                F.length(m).cast("long").alias("own"),
            ),
        )

        def build(x: Column) -> Column:
            ahead = _running(F.transform(x, lambda y: y["gap"] + y["own"]))

            def found(start: Column) -> Column:
                bare = F.transform(
                    x,
                    lambda y, i: F.struct(
                        (F.get(start, i) + y["gap"]).alias("start"),
                        (F.get(start, i) + y["gap"] + y["own"]).alias("end"),
                        F.get(parts["m"], i).alias("token"),
                        i.alias("i"),
                    ),
                )
                return F.transform(
                    bare if valid is None else F.filter(bare, lambda y: valid(y["token"])),
                    lambda y: F.struct(
                        F.lit(kind).alias("kind"),
                        y["start"].alias("start"),
                        y["end"].alias("end"),
                        y["token"].alias("token"),
                        _context(parts, y["i"]).alias("context"),
                    ),
                )

            return let(ahead, found)

        return let(lengths, build)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast(
        "array<struct<kind:string,start:bigint,end:bigint,token:string,context:string>>"
    )
    return let(
        found,
        lambda m: F.when(F.size(m) == 0, none).otherwise(
            let(F.struct(m.alias("m"), F.split(text, pattern, -1).alias("p")), placed)
        ),
    )


def _digits(token: Column) -> Column:
    return F.regexp_replace(token, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Digits from the right, every second one doubled; the sum ends in 0."""

    def value(i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when(i % 2 == 1, doubled).otherwise(digit)

    values = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), value)
    return F.aggregate(values, F.lit(0), lambda total, x: total + x) % 10 == 0


def _small_parts(token: Column) -> Column:
    parts = F.transform(F.split(token, r"\.", -1), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(
        parts,
        lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (F.substr(p, F.lit(1), F.lit(3)) <= "255")),
    )


def _base(text: Column) -> Column:
    """Base spans of a text, by kind and then by start."""
    none = F.filter(_matches(F.lit(""), EMAIL, "email"), lambda _: F.lit(False))
    emails = F.when(F.contains(text, F.lit("@")), _matches(text, EMAIL, "email")).otherwise(none)
    ips = _matches(text, IP, "ip", _small_parts)
    cards = _matches(
        text,
        CARD,
        "card",
        lambda token: F.when(
            F.length(_digits(token)).between(13, 19), _luhn(_digits(token))
        ).otherwise(False),
    )
    phones = _matches(text, PHONE, "phone", lambda token: F.length(_digits(token)).between(9, 15))
    plus = F.when(F.contains(text, F.lit("+")), phones).otherwise(none)
    return F.when(F.rlike(text, F.lit("[0-9]")), F.concat(emails, ips, cards, plus)).otherwise(emails)


def _candidates(text: Column) -> Column:
    """Identifiers of unknown kind."""
    found = _matches(
        text,
        IDENTIFIER,
        DISCOVERED,
        lambda token: (F.length(token) >= LEAST_LENGTH)
        & (F.length(_digits(token)) >= LEAST_DIGITS),
    )
    none = F.filter(_matches(F.lit(""), IDENTIFIER, DISCOVERED), lambda _: F.lit(False))
    return F.when(F.rlike(text, F.lit("[0-9]")), found).otherwise(none)


def _overlaps(spans: Column, x: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"]))


def find(docs: DataFrame) -> DataFrame:
    """Add ``_base`` and ``_found`` (identifiers of unknown kind) to every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("_base", _base(text)).withColumn("_found", _candidates(text))


def graph_of(found: DataFrame) -> DataFrame:
    """Edges (context, token) with their places, and whether the token is known."""
    seeds = found.select(F.explode("_base").alias("x"), F.lit(True).alias("known"))
    others = found.select("_base", F.explode("_found").alias("x")).select(
        "x", _overlaps(F.col("_base"), F.col("x")).alias("known")
    )
    edges = (
        seeds.unionByName(others)
        .select("x.context", "x.token", "known")
        .where("context <> ''")
        .groupBy("context", "token")
        .agg(F.count(F.lit(1)).alias("places"), F.max("known").alias("known"))
    )
    return edges


def _head(context: str = "context") -> Column:
    return F.regexp_extract(context, r"^(\S+ \S+) ", 1)


def head_counts(docs: DataFrame, heads: DataFrame, broadcast: int = BROADCAST) -> DataFrame:
    """How often the two words of each head follow each other, anywhere in ``docs``."""
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+", -1)
    pairs = let(
        words,
        lambda ws: F.transform(ws, lambda w, i: F.concat(w, F.lit(" "), F.get(ws, i + 1))),
    )
    found = docs.select(F.explode(pairs).alias("head")).where(F.length("head") <= _CONTEXT)
    few = heads.count() <= broadcast
    if few:
        found = found.join(F.broadcast(heads), "head", "left_semi")
    counted = found.groupBy("head").agg(F.count(F.lit(1)).alias("all"))
    return counted if few else counted.join(heads, "head", "left_semi")


def eligible(docs: DataFrame, graph: DataFrame, broadcast: int = BROADCAST) -> DataFrame:
    """Contexts that are labels, most of whose places in the corpus hold an identifier."""
    counted = (
        graph.groupBy("context")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("places").alias("places"))
        .withColumn("tail", F.regexp_extract("context", r"^\S+ (.*)$", 1))
    )
    tails = counted.groupBy("tail").agg(F.sum("n").alias("_all"))
    labels = settle(
        counted.where(F.col("n") >= LEAST_KNOWN)
        .join(tails, "tail")
        .where(F.col("n") >= LEAST_SHARE * F.col("_all"))
        .select("context", "places", _head().alias("head"))
    )
    part = F.pmod(F.xxhash64("text"), F.lit(PARTS)) == 0
    for counted_in, kept in ((docs.where(part), "left"), (docs, "inner")):
        if labels.isEmpty():
            break
        # a head that a part does not hold is not ruled out by it
        counts = head_counts(counted_in, labels.select("head").distinct(), broadcast)
        labels = settle(
            labels.join(counts, "head", kept)
            .where(F.col("places") >= LEAST_PRECISION * F.coalesce("all", F.lit(0)))
            .select("context", "places", "head")
        )
    return labels.select("context")


def bootstrap(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Trusted contexts; ``found`` holds _base and _found of every row of ``docs``."""
    graph = settle(graph_of(found))
    labels = settle(eligible(docs, graph))
    # an instance known in one context is known in all
    known = graph.where("known").select("token").distinct()
    edges = settle(
        graph.select("context", "token")
        .join(labels, "context", "left_semi")
        .join(known.withColumn("known", F.lit(True)), "token", "left")
        .select("context", "token", F.coalesce("known", F.lit(False)).alias("known"))
    )
    trusted = labels.limit(0)
    n_trusted = 0
    while True:
        trusted = settle(
            edges.groupBy("context")
            .agg(F.count_if("known").alias("n_known"))
            .where(F.col("n_known") >= LEAST_KNOWN)
            .select("context")
        )
        n = trusted.count()
        if n == n_trusted:
            return trusted
        n_trusted = n
        fresh = edges.join(trusted, "context", "left_semi").select("token").distinct()
        edges = settle(
            edges.join(fresh.withColumn("fresh", F.lit(True)), "token", "left").select(
                "context", "token", (F.col("known") | F.col("fresh").isNotNull()).alias("known")
            )
        )


def _beside(test: Callable[[Column], Column]) -> Column:
    """Identifiers outside of base spans whose context passes."""
    return F.filter("_found", lambda x: test(x["context"]) & ~_overlaps(F.col("_base"), x))


def with_accepted(
    marked: DataFrame,
    trusted: DataFrame,
    key: Column,
    constants: int = CONSTANTS,
    keyed: DataFrame | None = None,
) -> DataFrame:
    """Add ``_ids``: identifiers a trusted pattern stands before, outside of base spans.

    A few patterns are constants of the plan. More are joined: contexts meet
    patterns, and rows that hold a trusted one get their list by ``key``, which
    rows with equal spans may share. Whole rows move only if these lists are too
    large to be broadcast. ``keyed`` has _key and _found of the rows, if at hand.
    """
    few = [r["context"] for r in trusted.take(constants + 1)]
    if not few:
        return marked.withColumn("_ids", _beside(lambda _: F.lit(False)))
    if len(few) <= constants:
        return marked.withColumn("_ids", _beside(lambda context: context.isin(few)))
    marked = marked.withColumn("_key", key)
    contexts = (marked if keyed is None else keyed).select("_key", F.explode("_found.context").alias("context"))
    # no context holds a line break
    held = settle(
        contexts.join(broadcast_if_small(trusted), "context", "left_semi")
        .groupBy("_key")
        .agg(F.array_join(F.collect_set("context"), "\n").alias("_trusted"))
        .withColumn("_trusted", F.concat(F.lit("\n"), "_trusted", F.lit("\n")))
    )
    listed = lambda c: F.contains(F.col("_trusted"), F.concat(F.lit("\n"), c, F.lit("\n")))
    return (
        marked.join(broadcast_if_small(held), "_key", "left")
        .withColumn("_ids", _beside(lambda c: F.coalesce(listed(c), F.lit(False))))
        .drop("_key", "_trusted")
    )


def _text_of(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("_base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def personal_data(docs: DataFrame, constants: int = CONSTANTS) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans."""
    own = docs.select("doc_id", "text")
    row = F.monotonically_increasing_id().alias("_row")
    found = written(find(own).select(row, "doc_id", "_base", "_found"), "spans")
    trusted = bootstrap(own, found)
    return with_accepted(found, trusted, F.col("_row"), constants).select(
        "doc_id",
        *[_count(kind) for kind in KINDS],
        F.sha2(_text_of(F.col("_base")), 256).alias("base_sha256"),
        _text_of(F.concat("_base", "_ids")).alias("spans"),
    )


def masked(docs: DataFrame, constants: int = CONSTANTS) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets.

    Of overlapping spans the first names the mask, which covers them all.
    """
    own, key = docs.select("text"), F.sha2(F.col("text"), 256)
    found = written(find(own).select(key.alias("_key"), "_base", "_found"), "spans")
    trusted = bootstrap(own, found)

    def merged(spans: Column) -> Column:
        start = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")

        def add(done: Column, x: Column) -> Column:
            last = F.element_at(done, -1)
            longer = F.struct(
                last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"), last["kind"].alias("kind")
            )
            meets = (F.size(done) > 0) & F.coalesce(F.try_element_at(done, F.lit(-1))["end"] > x["start"], F.lit(False))
            return F.when(meets, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
                F.concat(done, F.array(x))
            )

        return F.aggregate(spans, start, add)

    def replaced(spans: Column) -> Column:
        pieces = F.transform(
            spans,
            lambda x, i: F.concat(
                F.substr(
                    F.col("text"),
                    (F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)) + 1).cast("int"),
                    (x["start"] - F.coalesce(F.get(spans, i - 1)["end"], F.lit(0))).cast("int"),
                ),
                F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")),
            ),
        )
        tail = F.substr(
            F.col("text"), (F.element_at(spans, -1)["end"] + 1).cast("int"), F.length("text")
        )
        return F.concat(F.array_join(pieces, ""), tail)

    spans = F.transform(
        F.concat("_base", "_ids"),
        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")),
    )
    marked = with_accepted(
        find(boxed(docs, F.col("text"))), trusted, key, constants, found
    ).withColumn("_spans", F.sort_array(spans))
    clean = F.when(F.size("_spans") == 0, F.col("text")).otherwise(
        let(merged(F.col("_spans")), replaced)
    )
    return unboxed(marked, docs.columns, text=clean)
