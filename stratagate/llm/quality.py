"""Quality rules that vote, weighed by expectation-maximisation.

Every rule looks at a few counts of a whole text and votes good, bad or not at
all. The rules' accuracies are not known and no labels are used: a text's quality
is a hidden variable, and expectation-maximisation estimates the share of good
texts and, per rule, how often its votes are right on good and on bad texts. A
text is kept when its posterior probability of being good reaches ``keep_from``.

All of it is DataFrame work. Texts with equal votes are alike, so the estimation
runs over the counts of vote patterns, at most 3 ** rules of them whatever the
corpus holds; the driver sees one row of sums per round.

Counts of a text (words are runs of characters other than 0x20 and 0x09-0x0D):
n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, as named below.

Defined cases: NULL and empty text have zero counts and fail the base rules;
repeated rows are judged alike; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratagate.llm.tables import let
from stratagate.session import settle, written

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
SPACE = "[ \\t-\\r]+"
#: Function words of the corpus languages (fixed values).
FUNCTION_WORDS = (
    "the of and to in is that for it with as on be this by from or are at was"
    " der die und das von mit ein den zu ist nicht auf für des im dem sich"
    " le la les de et un une dans que qui pour est pas sur avec par au du"
    " el los las y en se por con una para del su al lo como"
).split()

ROUNDS = 30
#: Pseudo-votes that keep an accuracy away from 0 and 1, and its starting value.
SMOOTHING, START = 2.0, 0.75


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five that occur twice or more in the text."""

    def place(hashes: Column) -> Column:
        marked = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return let(marked, starts)

    def starts(marked: Column) -> Column:
        twice = F.filter(
            marked,
            lambda x, i: (F.get(marked, i - 1)["h"] == x["h"]) | (F.get(marked, i + 1)["h"] == x["h"]),
        )
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda x, i: F.least(F.get(at, i + 1) - x, F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + F.coalesce(gap, F.lit(WINDOW)))

    windows = F.transform(
        words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)])
    )
    hashes = F.slice(windows, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    # most texts repeat no window; counting distinct ones tells without a sort
    counted = let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(place(h)),
    )
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(counted)


def counts(docs: DataFrame) -> DataFrame:
    """The counts of every text, one pass over the table and no exchange."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split("_text", SPACE, -1), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.rlike(line, F.lit("[^ \\t-\\r]")))
    functional = F.filter("_words", lambda w: F.lower(w).isin(FUNCTION_WORDS))
    cut = docs.select("doc_id", text.alias("_text")).select("doc_id", "_text", words.alias("_words"))
    return cut.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.regexp_count("_text", F.lit(f"{SYMBOLS}+")).cast("long").alias("n_symbol_runs"),
        let(lines, F.size).cast("long").alias("n_lines"),
        F.size(functional).cast("long").alias("n_function_words"),
        F.size(F.array_distinct(functional)).cast("long").alias("n_function_kinds"),
        F.regexp_count("_text", F.lit("(?m)[.!?\"]\\s*$")).cast("long").alias("n_closed_lines"),
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(0)).when(good, F.lit(1)).cast("int")


def votes() -> dict[str, Column]:
    """The rules: 1 votes good, 0 votes bad, NULL abstains."""
    n, chars = F.col("n_words"), F.col("word_chars")
    symbols, lines = F.col("n_symbols"), F.col("n_lines")
    mean = chars / F.nullif(n, F.lit(0))
    return {
        "length": _vote(n >= 50, n < 20),
        "word_length": _vote(mean.between(3, 9), (mean < 2.5) | (mean > 12)),
        "symbols": _vote(100 * symbols <= n, 10 * symbols > n),
        "symbol_share": _vote(200 * symbols <= chars, 25 * symbols > chars),
        "symbol_runs": _vote(
            100 * F.col("n_symbol_runs") <= n, 10 * F.col("n_symbol_runs") > n
        ),
        "lines": F.when(lines >= 2, _vote(F.col("n_dup_lines") == 0, 10 * F.col("n_dup_lines") > 3 * lines)),
        "repeats": F.when(
            n >= 20, _vote(50 * F.col("n_repeat_words") <= n, 10 * F.col("n_repeat_words") > n)
        ),
        "function_words": _vote(
            (10 * F.col("n_function_words") >= n) & (F.col("n_function_kinds") >= 2),
            (F.col("n_function_kinds") == 0) & (n >= 10),
        ),
        "closed_lines": F.when(lines > 0, _vote(2 * F.col("n_closed_lines") >= lines, F.col("n_closed_lines") == 0)),
    }


def _posterior(rules: list[str], share: float, right: dict[str, tuple[float, float]]) -> Column:
    """Probability of a good text given its votes, as an expression of constants."""
    score = F.lit(log(share / (1 - share)))
    for rule in rules:
        on_good, on_bad = right[rule]
        score = score + F.when(F.col(rule) == 1, log(on_good / (1 - on_bad))).when(
            F.col(rule) == 0, log((1 - on_good) / on_bad)
        ).otherwise(0.0)
    return 1 / (1 + F.exp(-score))


def estimate(patterns: DataFrame, rules: list[str], rounds: int = ROUNDS):
    """Share of good texts and (accuracy on good, accuracy on bad) of every rule.

    ``patterns`` has one row per combination of votes and its number ``n``.
    """
    share, right = 0.5, {rule: (START, START) for rule in rules}
    for _ in range(rounds):
        good = F.col("n") * F.col("_p")
        bad = F.col("n") * (1 - F.col("_p"))
        sums = [F.sum("n").alias("n"), F.sum(good).alias("good")]
        for rule in rules:
            vote = F.col(rule)
            sums += [
                F.sum(F.when(vote == 1, good)).alias(f"{rule}_good_right"),
                F.sum(F.when(vote.isNotNull(), good)).alias(f"{rule}_good"),
                F.sum(F.when(vote == 0, bad)).alias(f"{rule}_bad_right"),
                F.sum(F.when(vote.isNotNull(), bad)).alias(f"{rule}_bad"),
            ]
        row = patterns.withColumn("_p", _posterior(rules, share, right)).agg(*sums).first()
        if not row["n"]:
            break

        def rate(hits: float | None, all_votes: float | None) -> float:
            return ((hits or 0.0) + SMOOTHING * START) / ((all_votes or 0.0) + SMOOTHING)

        before = share
        share = (row["good"] + 1) / (row["n"] + 2)
        right = {
            r: (
                rate(row[f"{r}_good_right"], row[f"{r}_good"]),
                rate(row[f"{r}_bad_right"], row[f"{r}_bad"]),
            )
            for r in rules
        }
        if abs(share - before) < 1e-6:
            break
    return share, right


def judge(docs: DataFrame, keep_from: float = 0.5) -> DataFrame:
    """Counts, base verdict, posterior quality and final verdict of every row."""
    rules = list(votes())
    counted = written(counts(docs).select("*", *[v.alias(k) for k, v in votes().items()]), "counts")
    patterns = settle(counted.groupBy(*rules).agg(F.count(F.lit(1)).alias("n")))
    share, right = estimate(patterns, rules)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    quality = _posterior(rules, share, right)
    return counted.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (quality >= keep_from)).alias("kept"),
        quality.alias("quality"),
    )
