"""Operators on single texts against brute force, over awkward rows."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stratagate.llm.langid import accepted, languages
from stratagate.llm.packing import pack, pack_documents, reduce_instance
from stratagate.llm.pii import head_counts, masked, personal_data
from stratagate.llm.quality import judge
from stratagate.llm.rendering import render, rendered
from stratagate.llm.token_files import BlockReader, token_documents, write_blocks
from stratagate.llm.tokens import PieceEncoder
from stratagate.operators import sizing
from stratagate.session import new_folder, settings

WORDS = "the of and house river stone über straße maison forêt casa niño el la".split()
LONG = " ".join(WORDS[i * i % 14] + str(i % 7) for i in range(20_000))
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\r\n "),
    (4, "one"),
    (5, "a  b\n\n c\td"),
    (6, "The river and the stone. The river and the stone.\nline\nline\n \nline"),
    (7, "call +1 (555) 123-4567 or mail a.b%c@x-y.example.com, a@b@c.de; 10.0.0.255 10.0.0.256"),
    (8, "card 4111 1111 1111 1111, 4111-1111-1111-1112 1.2.3.4.5.6.7.8 x" + "9" * 30),
    (9, "+49 30 1234567 + 5 +1 2 é😀 ü@ä.de x@y.zz 4111111111111111"),
    (10, "don't y'all 's 12 3² ½ ΑΣ é́ 日本 <|endoftext|> &&& %%% ### $$$"),
    (10, "don't y'all 's 12 3² ½ ΑΣ é́ 日本 <|endoftext|> &&& %%% ### $$$"),
    (None, "no id here, but words enough to be counted as a text of some length"),
    (12, LONG),
    (13, "1234 5678 !!!"),
]
#: Extra columns named like those the operators use inside.
SCHEMA = "doc_id long, text string, _base string, _whole string, count long, shard int, x string, length int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*row, "a", "b", 1, 2, "c", 3) for row in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def in_order(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=repr)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_the_library(name):
    known = PieceEncoder(public_tokenizers.path(name))
    library = Tokenizer.from_file(public_tokenizers.path(name))
    odd = ["a \n b", "x\x1cy z", "\n a", "a\nB c", " a 's b", "İstanbul ẞ", "a b", "\r\n", "A.\nB! C"]
    special = [t["content"] for t in json.loads(library.to_str())["added_tokens"]]
    assert special
    for token in special:
        odd += [token, f"a {token} b", f"a{token}b\n{token} {token}", token.upper(), token[:-1], f"a\n {token}\n b" * 50]
    for text in [t or "" for _, t in TEXTS] + odd:
        expected = library.encode(text, add_special_tokens=False).ids
        for _ in range(2):  # the second time from memory
            assert np.frombuffer(known.encode(text), "<u4").tolist() == expected, repr(text[:50])


def test_pieces_share_the_ids_of_a_word(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library, known, seen = Tokenizer.from_file(path), PieceEncoder(path), []
    tokenize = known.pieces.tokenize
    monkeypatch.setattr(known.pieces, "tokenize", lambda word: seen.append(word) or tokenize(word))
    text = "a zorbel Zorbel zorbel, ZORBEL.\nzorbel\nZorbel! été ÉTÉ; Été"
    expected = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(known.encode(text), "<u4").tolist() == expected
    assert len(seen) == 2
    monkeypatch.setattr("stratagate.llm.tokens.REMEMBERED_WORDS", 1)
    assert np.frombuffer(known.encode(f"a plumvet {text}"), "<u4").tolist()[-len(expected) + 1 :] == expected[1:]
    assert len(known.pieces.words) == 2


def test_token_files_read_back(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = sorted(token_documents(docs, path, end_id=2).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10, 12, 13]
    texts = dict(TEXTS)
    start = 0
    for row in got:
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids + [2]
        packed = np.array(ids, "<u4").tobytes()
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(packed))
        start += len(ids)
    assert token_documents(empty, path, end_id=2).count() == 0


def test_one_document_is_read_by_its_id(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = new_folder(spark, "token-files")
    write_blocks(docs, path, 2, 2, folder)
    dictionary = bytes(spark.read.parquet(f"{folder}/dictionary").first()["bytes"])
    blocks = [bytes(r["data"]) for r in spark.read.parquet(f"{folder}/blocks").collect()]
    found = [BlockReader(b, dictionary).document(4) for b in blocks]
    assert [x.tolist()[-1] for x in found if x is not None] == [2]
    with pytest.raises(ValueError, match="another dictionary"):
        BlockReader(blocks[0], b"another")


def test_equal_sizes_are_packed_together():
    """A million equal pieces take as many patterns as a few, and as many sequences as due."""
    for size in (1, 700, 900, 1024, 2000):
        counts = np.zeros(2049, dtype=np.int64)
        counts[size] = 1_000_001
        patterns = pack(counts, 2048)
        assert len(patterns) <= 4
        assert sum(p.times * sum(n for _, n in p.runs) for p in patterns) == 1_000_001
        assert sum(p.times for p in patterns) == -(-1_000_001 // (2048 // size))


@pytest.mark.parametrize("capacity", [2048, 37])
def test_packing_is_whole_and_no_worse_than_first_fit(docs, empty, capacity):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = pack_documents(docs, path, 0, capacity).collect()
    expected = []
    for doc_id, text in TEXTS:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or capacity
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
            data = np.array(ids[a:b], "<u4").tobytes()
            expected.append((doc_id, piece, a, b - a, zlib.crc32(data)))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert in_order(rows, *columns) == sorted(expected, key=repr)
    sequences = {}
    for row in rows:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    rooms = []
    for size in sorted((r["length"] for r in rows), reverse=True):
        for i, room in enumerate(rooms):
            if room >= size:
                rooms[i] -= size
                break
        else:
            rooms.append(capacity - size)
    assert len(sequences) <= len(rooms)
    assert pack_documents(empty, path, 0, capacity).count() == 0


def _least_sequences(sizes, capacity):
    """Exact number of sequences, by trying every place."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= sizes[i]}.values():
            place(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


def test_the_reduction_keeps_an_optimum():
    rng = np.random.default_rng(7)
    for _ in range(150):
        capacity = int(rng.integers(6, 40))
        sizes = rng.integers(1, capacity + 1, int(rng.integers(1, 10)))
        counts = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
        left = counts.copy()
        fixed = sum(p.times for p in reduce_instance(left, capacity))
        rest = [s for s, n in enumerate(left) for _ in range(n)]
        least = _least_sequences(sizes.tolist(), capacity)
        assert fixed + (_least_sequences(rest, capacity) if rest else 0) == least
        patterns = pack(counts, capacity)
        held = Counter()
        for pattern in patterns:
            assert sum(s * c for s, c in pattern.runs) + pattern.room == capacity
            for size, copies in pattern.runs:
                held[size] += copies * pattern.times
        assert held == Counter(sizes.tolist())


def test_quality_counts_and_base_rules(docs, empty):
    texts = dict(TEXTS)
    rows = judge(docs).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        text = texts[row["doc_id"]] or ""
        words = re.findall("[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered, seen, doubled = set(), set(), 0
        for i in range(len(words) - 4):
            if windows[tuple(words[i : i + 5])] > 1:
                covered.update(range(i, i + 5))
        for line in text.split("\n"):
            if re.search("[^\x20\x09-\x0D]", line):
                doubled += line in seen
                seen.add(line)
        symbols = len(re.findall(r"[#*$%&|<>]", text))
        expected = (len(words), sum(map(len, words)), symbols, doubled, len(covered))
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        assert tuple(row[c] for c in names) == expected
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        assert row["base_failed"] == failed and not (failed and row["kept"])
    assert judge(empty).count() == 0


def test_quality_finds_the_hidden_classes(spark):
    draw = random.Random(3)
    good = [(i, " ".join(draw.choices(WORDS, k=80)) + ".") for i in range(60)]
    bad = [(100 + i, " ".join(w + "%%%" for w in t.split())) for i, t in good[:15]]
    rows = judge(spark.createDataFrame(good + bad, "doc_id long, text string")).collect()
    kept = {r["doc_id"]: r["kept"] for r in rows if not r["base_failed"]}
    assert all(kept[i] == (i < 100) for i in kept) and len(kept) > 50


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def _spans(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in KINDS.items()
        for m in re.finditer(pattern, text or "")
        if _valid(kind, m.group())
    ]


def test_base_spans(spark, docs, empty):
    more = ["a@b.c-d%x@y.z", "1.2.3.4.5", "000255.1.1.1", "+1" * 20 + "23456789", "7 " * 700, "a@b.c " * 600]
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    rows = personal_data(docs.select("doc_id", "text").unionByName(extra)).collect()
    texts = dict(TEXTS) | {100 + i: t for i, t in enumerate(more)}
    assert len(rows) == len(TEXTS) + len(more)
    for row in rows:
        spans = _spans(texts[row["doc_id"]])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row["base_sha256"] == hashlib.sha256(written.encode()).hexdigest(), row
        assert row["spans"].startswith(written)
        assert [row[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS]
    assert personal_data(docs).count() == len(TEXTS)
    assert personal_data(empty).count() == 0


def test_contexts_of_seeds_discover_identifiers(spark):
    seeds = [(i, f"words {i} member number 41111111111111{i:02d}11{(7 * i) % 10} end") for i in range(40)]
    others = [(100 + i, f"member number QX{i}77{i}88Z end") for i in range(5)]
    plain = [(200, "a river AB123456789C stands alone")]
    known = [(i, t) for i, t in seeds if _spans(t)]
    assert len(known) >= 3
    table = spark.createDataFrame(known + others + plain, "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in personal_data(table).collect()}
    assert all(spans[100 + i].startswith("id:14:") for i in range(5))
    assert spans[200] == ""


def _valid_cards():
    """Card numbers that pass the check digit, one after the other."""
    number = 4111111111110000
    while True:
        digits = [int(d) for d in str(number)]
        doubled = [d * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        if sum(x - 9 * (x > 9) for x in doubled) % 10 == 0:
            yield number
        number += 1


@pytest.mark.parametrize("constants", [500, 0])
def test_every_precise_pattern_is_found(spark, constants):
    """300 patterns, three known instances each, and one that stands in prose."""
    cards = _valid_cards()
    rows = []
    for k in range(300):
        rows += [(f"see 7 of 12345678 field{k} 0{k} key={next(cards)}", None) for _ in range(3)]
        rows.append((f"so 7 of field{k} 0{k} key=QX{k}77-88Z", "key=") )
        rows += [(f"a river runs by {next(cards)} here", None), ("a river runs by itself", None)]
    rows += [("a river runs by itself", None)] * 3000 + [("it runs by AB123456789C", None)]
    table = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in personal_data(table, constants).collect()}
    for i, (text, mark) in enumerate(rows):
        if mark:
            start = text.index(mark) + len(mark)
            assert spans[i] == f"id:{start}:{len(text)}", text
    assert spans[len(rows) - 1] == ""
    hidden = {r["doc_id"]: r["text"] for r in masked(table, constants).collect()}
    assert all(hidden[i].endswith("key=[ID]") for i, (_, mark) in enumerate(rows) if mark)


@pytest.mark.parametrize("broadcast", [100, 0])
def test_heads_are_counted_in_every_text(spark, broadcast):
    texts = ["See  see the\nRiver", "the river the river", None, "", "see the", " the river "] * 3
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    heads = spark.createDataFrame([("the river",), ("see the",), ("no such",)], "head string")
    got = {r["head"]: r["all"] for r in head_counts(table, heads, broadcast).collect()}
    assert got == {"the river": 12, "see the": 6}


def test_trust_spreads_until_nothing_new(spark):
    """Each label is known only by what the label before it discovered."""
    cards = _valid_cards()
    rows = [f"alpha label0 no={next(cards)}" for _ in range(3)]
    for k in range(5):
        rows += [f"alpha label{k} no=ID{k}00{i}99" for i in range(3)]
        rows += [f"alpha label{k + 1} no=ID{k}00{i}99" for i in range(3)]
    rows.append("alpha label5 no=UNSEEN1234")
    table = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in personal_data(table).collect()}
    assert spans[len(rows) - 1] == f"id:{len('alpha label5 no=')}:{len(rows[-1])}"


def test_masking_keeps_rows_and_columns(docs):
    rows = masked(docs)
    assert rows.columns == docs.columns and rows.count() == len(TEXTS)
    found = {r["doc_id"]: r["text"] for r in rows.collect()}
    assert found[1] is None and found[4] == "one" and found[12] == LONG
    assert found[9].startswith("[PHONE] + 5") and "[EMAIL]" in found[9] and "[CARD]" in found[9]
    assert "example.com" not in found[7] and "[IP] 10.0.0.256" in found[7]


def test_every_label_is_learned(spark):
    """90 labels, each with words of its own; the rarest has two texts."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [letters[k % 26] + letters[(k // 26 + 3 * k) % 26] + letters[(5 * k + 1) % 26] for k in range(90)]
    rows = [(100 * k + i, f"{words[k]} " * (5 + i), f"l{k}") for k in range(90) for i in range(12 if k else 3)]
    got = {r["doc_id"]: r for r in languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert len(set(words)) == 90
    right = sum(got[i]["lang_pred"] == lang for i, _, lang in rows)
    assert right >= 0.95 * len(rows) and {r["lang_pred"] for r in got.values()} >= {f"l{k}" for k in range(1, 90)}


def test_languages(spark, docs, empty):
    english = "the river and the house of the stone were old when they came".split()
    german = "der fluss und das haus aus stein waren alt als sie kamen über".split()
    rows = [
        (i, " ".join(words[(i * k + k) % 12] for k in range(1, 30)), lang)
        for i in range(200)
        for words, lang in [(english, "en") if i % 2 else (german, "de")]
    ]
    odd = [(500, None, "en"), (501, "", "de"), (502, "123 !!", None), (503, "der fluss und das haus", None)]
    table = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in languages(table).collect()}
    assert len(got) == len(rows) + len(odd)
    for doc_id, _, lang in rows:
        assert got[doc_id]["lang_pred"] == lang and 0.5 < got[doc_id]["score"] <= 1
        assert got[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
    assert [got[i]["lang_pred"] for i in (500, 501, 502, 503)] == ["und", "und", "und", "de"]
    assert got[502]["score"] == 0
    assert {r["doc_id"] for r in accepted(table).collect()} == set(got) - {500, 501, 502}
    # no labels at all, and nothing at all
    bare = docs.selectExpr("*", "CAST(NULL AS string) AS lang", "1 AS held_out", "2.0 AS score")
    assert {r["lang_pred"] for r in languages(bare).collect()} == {"und"}
    assert languages(empty.selectExpr("*", "'en' AS lang")).count() == 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<html><head><title>t</title><p>text", "text"),
        ("<head><meta charset=utf-8><script>x</script> plain <b>text</b>", "plain text"),
        ("<head><title>t</title><template>no<p>no</template><div>a</div></head>b", "a\nb"),
        ("<head><style>p{}</style><noscript><link rel=x></noscript></head><body>a", "a"),
        ("a<head>b", "ab"),
        ('<p>a <span aria-hidden="true">b</span>', "a b"),
        ("<p>x <math><mi>y</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math>", "x y=2"),
        ("<svg><title>no</title><defs><text>no</text></defs><desc/><text>label</text></svg> a", "label a"),
        ("<svg><style/><text>b</text></svg>", "b"),
        ("<svg><defs><path/><p>out", "out"),
    ],
)
def test_rendering_keeps_all_visible_text(page, text):
    assert render(page) == text


def test_rendering(spark):
    page = """<!DOCTYPE html><head><title>x</title><style>p{}</style></head><body><h1>A &amp; B</h1>
<p>one<p class=a">two <b>bold</b> x<br>y</p><ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>
<table><caption>cap</caption><tr><th>Name<th>Qty<tr><td>apple<td>10<tr><td>kiwi fruit<td>2</table>
<pre> x\n   y</pre><div style="display: none">no</div><p hidden>no</p><script>if(a<b){"</p>"}</script>
end <!-- c --> text</i> <a href="x>y">link</a> 1 < 2"""
    assert render(page) == (
        "A & B\n\none\n\ntwo bold x\ny\n\n- a\n- b\n  3. c\n  4. d\n- e\n\ncap\nName        Qty\n"
        "apple       10\nkiwi fruit  2\n\n x\n   y\n\nend text link 1 < 2"
    )
    assert render(None) == render("") == render("<!-- open") == ""
    assert render("<div>" * 20_000 + "x") == "x"
    assert "x" in render("<table><tr><td>" * 3000 + "x")
    rows = [(1, None, "u"), (2, "<p>a", "u"), (2, "<p>a", "u"), (None, "b", None)]
    table = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert in_order(rendered(table).collect(), "page_id", "text") == sorted(
        [(1, ""), (2, "a"), (2, "a"), (None, "b")], key=repr
    )
    assert rendered(table.limit(0)).count() == 0


@pytest.mark.parametrize("few", [True, False])
def test_whole_rows_stay_where_joined_patterns_are_few(spark, monkeypatch, few):
    if not few:
        monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    cards = _valid_cards()
    rows = [(i, f"see 7 of 12345678 field 0 key={next(cards)}") for i in range(4)]
    rows += [(4, "so 7 of field 0 key=QX177-88Z"), (5, None), (6, "no identifier")]
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):  # as for a large table
        clean = masked(spark.createDataFrame(rows, "doc_id long, text string"), constants=0)
        plan = clean._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in plan) != few
    hidden = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert hidden[4] == "so 7 of field 0 key=[ID]" and hidden[5] is None and hidden[6] == rows[6][1]
