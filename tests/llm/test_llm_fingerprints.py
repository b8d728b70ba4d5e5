"""Multiset fingerprints against a version in plain Python."""

import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stratagate.llm import fingerprints as fp

SF_DIR = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\f\r"
PIECE = re.compile(rf"[^{BLANK}.!?][^\n.!?]{{0,{fp.CHARS - 1}}}[.!?]*|[.!?]+")
SEEDS = [xxhash.xxh64_intdigest(struct.pack("<i", i), 42) for i in range(fp.PARTS)]


def lanes(text):
    found = PIECE.findall(text)
    words = [0] * len(fp.WORDS)
    for piece in found:
        digest = hashlib.sha256(piece.encode()).hexdigest().encode()
        for i, seed in enumerate(SEEDS):
            bits = xxhash.xxh64_intdigest(digest, seed)
            for j in range(fp.LANE_BITS):
                words[fp.LANE_BITS * i + j] += (bits >> j) & (1 | 1 << 32)
    return [len(found), *words]


def written(words):
    return "".join(f"{w:016x}" for w in words)


def signs(words):
    n = words[0]
    return [2 * x - n for w in words[1:] for x in (w & 0xFFFFFFFF, w >> 32)]


def near(one, other):
    a, b = signs(one), signs(other)
    size = sum(x * x for x in a) + sum(x * x for x in b)
    common = sum(x * y for x, y in zip(a, b, strict=True))
    return min(max(2 * common / size, 0.0), 1.0) if size else 1.0


def expected(rows):
    """Rows (doc_id, text) in the order of the operator."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed = lanes(text), lanes(edited)
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(own),
            written(changed), round(near(own, changed), 9), round(near(own, lanes(following)), 9),
        ))
    return sorted(out, key=repr)


def found(df):
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in df.collect()), key=repr)


def prose(seed, sentences):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdeéß😀", k=draw.randint(1, 7)))
    return "".join(
        " ".join(word() for _ in range(draw.randint(1, 12))) + draw.choice([". ", "!\n", "?\n\n", " ", ".\t"])
        for _ in range(sentences)
    )


@pytest.fixture(scope="module")
def rows():
    return [
        (None, "without an id.\nsecond"),
        (-5, None),
        (0, ""),
        (3, " \n\t "),
        (4, "word"),
        (5, "x" * 3000),
        (7, prose(1, 400)),
        (8, prose(2, 30)),
        (9, prose(2, 30)),
        (10, "😀é" * 400),
        (11, "..."),
        (12, "the same line.\n" * 5000),
        (13, prose(3, 3)),
        (14, "tie"),
        (14, "tie"),
        (14, "tie"),
        (2**62, prose(4, 10)),
    ]


def table(spark, rows):
    names = "doc_id long, text string, _key string, _range int, n long, w0 long, kind int, edited string"
    return spark.createDataFrame([(*r, "k", 1, 2, 3, 4, "e") for r in rows], names)


def test_awkward_rows_and_clashing_columns(spark, rows):
    mixed = random.Random(3).sample(rows, len(rows))
    docs = table(spark, mixed).repartition(5).checkpoint()
    assert found(fp.fingerprints(docs)) == expected(rows)


def test_a_single_document_is_its_own_next_one(spark):
    rows = [(1, "one line.\nand another one")]
    assert found(fp.fingerprints(table(spark, rows))) == expected(rows)


def test_empty_table(spark):
    assert fp.fingerprints(table(spark, [])).collect() == []


def test_rows_of_one_id_follow_a_hash_of_the_text(spark):
    texts = [f"text {i}. more of it" for i in range(40)]
    docs = table(spark, [(7, t) for t in texts])
    order = docs.orderBy(F.xxhash64("text")).select("text").collect()
    assert found(fp.fingerprints(docs)) == expected([(7, r.text) for r in order])


def test_the_registered_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(entry.queries()["op11_fingerprint"](spark, SF_DIR)) == expected(rows)


def test_order_of_paragraphs_does_not_count_and_edits_add_up(spark):
    lines = prose(5, 60).split("\n")
    turned = lines[::-1]
    some, rest = "\n".join(lines[:20]), "\n".join(lines[20:])
    rows = [(1, "\n".join(lines)), (2, "\n".join(turned)), (3, some), (4, rest), (5, "")]
    got = {r[0]: r[3] for r in fp.fingerprints(table(spark, rows)).collect()}
    assert got[1] == got[2] != got[3]
    one = spark.createDataFrame([(got[1], got[3], got[4], got[5])], "whole string, some string, rest string, none string")
    sums = one.select(
        fp.inserted(F.col("some"), F.col("rest")).alias("both"),
        fp.deleted(F.col("whole"), F.col("rest")).alias("left"),
        fp.deleted(F.col("whole"), F.col("whole")).alias("nothing"),
        fp.inserted(F.col("none"), F.col("some")).alias("same"),
    ).first()
    assert tuple(sums) == (got[1], got[3], got[5], got[3])


def test_likeness_tells_the_share_of_common_pieces(spark):
    lines = [f"line number {i} of a text" for i in range(400)]
    other = [f"another line {i}" for i in range(400)]
    mixed = [(i, "\n".join(lines[: 40 * i] + other[40 * i :])) for i in range(11)]
    whole = lanes("\n".join(lines))
    for i, text in mixed:
        assert abs(near(whole, lanes(text)) - i / 10) < 0.2
