"""Operators over whole corpora against brute force, over awkward rows."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
import corpus_pipeline
from stratagate.llm import queries, repeats, simhash
from stratagate.llm.archive import parse_record, read_archive, write_archive
from stratagate.llm.components import components
from stratagate.llm.decontaminate import contamination, decontaminated
from stratagate.llm.repeats import remove_repeats
from stratagate.llm.simhash import deduplicated, forest, near_duplicates
from stratagate.session import new_folder, settings

SF_DIR = "/root/testdata/sf0.001"
#: Extra columns named like those the operators use inside.
SCHEMA = "doc_id long, text string, fp string, u long, v long, tid long, _row string, _key string, count int"
EXTRA = ("f", 1, 2, 3, "r", "k", 4)


def prose(seed, words):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdeéß", k=draw.randint(1, 7))) for _ in range(words))


def table(spark, rows):
    return spark.createDataFrame([(*row, *EXTRA) for row in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    shared = prose(1, 70)
    rows = [
        (1, None),
        (2, ""),
        (3, " \n\t"),
        (4, "word"),
        (5, "two words"),
        (6, "a" * 5000),
        (7, "ab" * 400 + "x" + "ab" * 300),
        (8, prose(2, 60) + " " + shared + " " + prose(3, 60)),
        (9, prose(4, 20) + " " + shared),
        (10, shared + prose(5, 10)),
        (11, prose(6, 4000)),
        (12, prose(7, 300)),
        (12, prose(7, 300)),
        (13, prose(7, 300)),
        (14, prose(7, 299) + " other"),
        (15, "A " + prose(7, 300)),
        (None, prose(8, 50)),
        (17, "é" * 150),
        (18, "x" + "é" * 150),
    ]
    edited = prose(9, 200).split()
    for i in range(40):  # one large group of near copies
        words = list(edited)
        words[i * 5] = "changed"
        rows.append((100 + i, " ".join(words)))
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, texts)


def fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(count, linked):
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(count):
        for j in range(i):
            if linked(i, j):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(count)]


def components_by_force(texts):
    prints = [fingerprint(t) for _, t in texts]
    roots = groups(len(texts), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    least = {}
    for (doc_id, _), root in zip(texts, roots, strict=True):
        if doc_id is not None:
            least[root] = min(doc_id, least.get(root, doc_id))
    return [
        (doc_id, f"{p:016x}", least.get(root))
        for (doc_id, _), p, root in zip(texts, prints, roots, strict=True)
    ]


@pytest.mark.parametrize("choices", [(2, 3, 4), (2,), (3,)])
def test_near_duplicates(docs, texts, choices):
    got = [tuple(r) for r in near_duplicates(docs, choices=choices).collect()]
    assert sorted(got, key=repr) == sorted(components_by_force(texts), key=repr)


def test_large_groups_are_met_in_blocks(docs, texts, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    got = [tuple(r) for r in near_duplicates(docs, choices=(4,)).collect()]
    assert sorted(got, key=repr) == sorted(components_by_force(texts), key=repr)


def test_a_forest_connects_what_is_linked():
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 2**64, (1, 1), dtype=np.uint64) ^ (
        np.uint64(1) << rng.integers(0, 12, (300, 1), dtype=np.uint64)
    ) ^ (np.uint64(1) << rng.integers(0, 40, (300, 1), dtype=np.uint64))
    near = lambda i, j: int(fps[i, 0] ^ fps[j, 0]).bit_count() <= 2
    links = forest(fps, 2)
    assert len(links) < 300 and all(near(a, b) for a, b in links)
    pairs = {frozenset(p) for p in links}
    assert groups(300, near) == groups(300, lambda i, j: frozenset((i, j)) in pairs)


def test_thresholds_keep_the_guarantee():
    rng = np.random.default_rng(2)
    bits = (rng.random((500, 64)) < rng.random(64)).astype(np.int64)
    for radius, choices in [(3, (2, 3, 4)), (5, (3,)), (0, (1, 2))]:
        plan = simhash.plan_parts(500, bits.T @ bits, radius, choices)
        used = sum(len(b) for b, _ in plan)
        assert used <= 64 and sum(t + 1 for _, t in plan) == radius + 1


def test_components_of_awkward_edges(spark):
    edges = [(1, 2), (2, 1), (2, 3), (5, 5), (None, 4), (9, 8), (8, 7), (7, 20), (20, 21), (3, 2)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 20: 7, 21: 7}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_few_edges_take_few_tasks(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i % 10], "u long, v long")
    expected = {i: 10 * ((i - 1) // 10) + 1 for i in range(1, 41)}
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    with settings(
        spark,
        spark__sql__shuffle__partitions="64",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    ):
        for limit in (1_000_000, 0):  # the second as if the edges were many
            monkeypatch.setattr("stratagate.llm.components.BROADCAST_ROWS", limit, raising=False)
            context.setJobGroup(f"components-{limit}", "")
            got = {r["node"]: r["root"] for r in components(edges).collect()}
            assert got == expected
    context.setLocalProperty("spark.jobGroup.id", None)
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("components-1000000")]
    tasks = [tracker.getStageInfo(s).numTasks for job in jobs for s in job.stageIds if tracker.getStageInfo(s)]
    # the edges are dealt and counted over all partitions, then each round takes a few tasks
    assert sum(n >= 64 for n in tasks) <= 4


def test_deduplicated_keeps_one_of_each_group(docs, texts):
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    runs = []
    for _, text in texts:
        words = (text or "").lower().split()
        runs.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)})
    roots = groups(len(texts), lambda i, j: len(runs[i] & runs[j]) >= 0.8 * len(runs[i] | runs[j]))
    least = {}
    for (doc_id, _), root in zip(texts, roots, strict=True):
        least[root] = min(least.get(root, 10**9), 10**9 if doc_id is None else doc_id)
    expected = sorted(None if x == 10**9 else x for x in least.values() if x != 10**9)
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == expected
    assert got.count(None) == 1


def five_grams(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def kept_by_force(rows):
    runs = [five_grams(text) for _, text in rows]
    roots = groups(len(rows), lambda i, j: len(runs[i] & runs[j]) >= 0.8 * len(runs[i] | runs[j]))
    return sorted({root: rows[root][0] for root in roots}.values())


@pytest.mark.parametrize("buckets", [4096, 64, 2])
def test_sketches_never_rule_out_similar_sets(monkeypatch, buckets):
    monkeypatch.setattr(simhash, "MOST_BUCKETS", buckets)
    rng, ruled_out = np.random.default_rng(7), 0
    for _ in range(600):
        size = int(rng.choice([1, 2, 9, 60, 300, 2100, 9000]))
        held = rng.integers(0, 2**64, size, dtype=np.uint64)
        mine, theirs = held[rng.random(size) < rng.choice([0.5, 0.9, 0.97, 1.0])], held
        theirs = np.r_[theirs, rng.integers(0, 2**64, int(rng.integers(0, size)), dtype=np.uint64)]
        mine = mine if len(mine) else held
        a, b = np.unique(mine), np.unique(theirs)
        shared = len(np.intersect1d(a, b))
        similar = shared >= 0.8 * (len(a) + len(b) - shared)
        allowed = simhash.sketches_allow(len(a), simhash.sketch(a), len(b), simhash.sketch(b))
        assert allowed or not similar
        ruled_out += not allowed
    assert ruled_out > 100


@pytest.mark.parametrize("block", [20_000, 5])
def test_links_behind_a_dissimilar_hub_are_found(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows, base = [], prose(100, 200).split()
    for pair in range(60):  # texts near all others; only the two of a pair are similar
        at = random.Random(pair).sample(range(2, 198, 5), 6)
        for own in (at[:4], at[2:]):
            words = list(base)
            for i in own:
                words[i] = f"new{pair}"
            rows.append((len(rows), " ".join(words)))
    expected = kept_by_force(rows)
    assert len(expected) <= 60
    assert sorted(r["doc_id"] for r in deduplicated(table(spark, rows)).collect()) == expected


def test_repeated_passages_count_once(spark):
    rows = []
    for i in range(10):
        text, footer, passage = prose(200 + i, 300), prose(300 + i, 20), prose(400, 20)
        rows += [(4 * i, text), (4 * i + 1, " ".join([text] + [footer] * 20))]  # similar
        rows += [
            (4 * i + 2 + k, " ".join([prose(500 + 2 * i + k, 150)] + [passage] * 80)) for k in range(2)
        ]  # not similar
    expected = kept_by_force(rows)
    assert len(expected) == 30
    assert sorted(r["doc_id"] for r in deduplicated(table(spark, rows)).collect()) == expected


def removed_by_force(texts):
    data = [(t or "").encode() for _, t in texts]
    seen = Counter(b[p : p + 200] for b in data for p in range(len(b) - 199))
    rows = []
    for (doc_id, _), b in zip(texts, data, strict=True):
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                gone[p : p + 200] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        left = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        rows.append((doc_id, len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return rows


def test_repeated_strings_are_removed(spark, docs, texts):
    got = [tuple(r) for r in remove_repeats(docs).collect()]
    assert sorted(got, key=repr) == sorted(removed_by_force(texts), key=repr)
    assert remove_repeats(docs.limit(0)).count() == 0


def test_repeats_of_few_letters(spark):
    draw = random.Random(11)
    rows = [(i, "".join(draw.choices("ab", k=6)) * draw.randint(1, 90)) for i in range(60)]
    rows += [(100 + i, "".join(draw.choices("ab", k=700))) for i in range(5)]
    rows += [(200 + i, rows[60 + i][1][i * 40 : 450]) for i in range(5)]
    got = [tuple(r) for r in remove_repeats(table(spark, rows)).collect()]
    assert sorted(got) == sorted(removed_by_force(rows))


def test_triggers_hang_on_the_string_alone():
    draw = random.Random(4)
    common = bytes(draw.choices(b"abcdef", k=700))
    places = []
    for ahead in (0, 13, 250):
        data = bytes(draw.choices(b"abcdef", k=ahead)) + common
        at, first, last = repeats.triggers(repeats.Hashed(data), len(data))
        own = {p: int(t) for t, a, b in zip(at, first, last, strict=True) for p in range(a, b + 1)}
        assert sorted(own) == list(range(len(data) - 199))
        places.append([own[ahead + p] - ahead for p in range(501)])
    assert places[0] == places[1] == places[2]


PAGES = "page_id long, url string, html string, sha256 string, answer long, number int"


def test_archive_round_trip(spark):
    large, larger = "ä" * 600, "<p>x" * 300
    rows = [
        (1, "http://a/", large), (2, None, large), (5, "u", large), (3, "u", "small"), (4, "u", "small"),
        (6, "u", None), (7, "u", ""), (8, "u", larger), (8, "u", larger), (8, "v", larger),
        (None, "u", large), (9, "line\r\nbreak", "é" * 499), (10, "u", "é" * 500), (11, "u", "é" * 500),
    ]
    pages = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], PAGES)
    folder = new_folder(spark, "archive")
    write_archive(pages, folder)
    got = [tuple(r)[:5] for r in read_archive(spark, folder).collect()]
    expected = []
    answered = set()
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "").encode() == data and r[0] is not None]
        answer = max(same)
        response = len(data) < 1000 or (page_id == answer and data not in answered)
        if page_id == answer:
            answered.add(data)
        digest = hashlib.sha1(data).hexdigest()
        kind = ("response", None) if response else ("revisit", answer)
        expected.append((page_id, len(data), digest, *kind))
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert spark.read.parquet(f"{folder}/payloads").count() == len({(r[2] or "") for r in rows})
    empty = new_folder(spark, "archive")
    write_archive(pages.limit(0), empty)
    assert read_archive(spark, empty).count() == 0
    with pytest.raises(ValueError, match="not a WARC record"):
        parse_record(b"nothing")


def test_archive_against_sql(spark):
    got = entry.queries()["op4_archive"](spark, SF_DIR)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_DIR}/pages.parquet'")
    names = sorted(got.columns)
    expected = con.sql(f"SELECT {', '.join(names)} FROM ({entry.oracle_sql()['op4_archive']})").fetchall()
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(repr, expected))


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs_of(words, size):
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def leaks_by_force(texts, items):
    found = {}
    for at, (_, text) in enumerate(texts):
        for item_id, item in items:
            own = words_of(item)
            if not own:
                continue
            size = min(5, len(own))
            wanted, runs = Counter(runs_of(own, size)), runs_of(words_of(text), size)
            m, best = sum(wanted.values()), 0.0
            for p in range(max(len(runs) - m, 0) + 1):
                window = Counter(runs[p : p + m])
                shared = sum((window & wanted).values())
                best = max(best, shared / max(sum(window.values()) + m - shared, 1))
            if best >= 0.8:
                found.setdefault(at, {})[item_id] = best
    return found


def test_contamination(spark, texts):
    items = [(i, prose(50 + i, 40)) for i in range(4)] + [(10, "Tiny Item"), (11, None), (12, "..."), (13, "ra ra " * 20)]
    long_item = items[0][1].split()
    one_changed = " ".join(["other", *long_item[1:]])
    middle_changed = " ".join([*long_item[:20], "other", *long_item[21:]])
    rows = texts[:12] + [
        (30, "before " + items[0][1] + " after it"),
        (31, items[1][1].replace("e", "E").replace(" ", ",\n ")),
        (32, prose(60, 30) + " " + one_changed),
        (33, middle_changed),
        (34, "a tiny, item here; " + items[2][1] + " and " + items[3][1]),
        (35, "ra ra " * 45),
        (36, " ".join(long_item[:25])),
        (36, "before " + items[0][1]),
        (36, "before " + items[0][1]),
        (None, items[2][1]),
    ]
    docs = table(spark, rows)
    benchmark = spark.createDataFrame([(*i, "x", 1) for i in items], "item_id long, text string, gram string, m int")
    expected = leaks_by_force(rows, items)
    assert {rows[i][0] for i in expected} == {30, 31, 32, 34, 35, 36, None}
    wanted = []
    for at, (doc_id, _) in enumerate(rows):
        own = expected.get(at, {})
        best = max(own.values(), default=None)
        item = min((i for i, x in own.items() if x == best), default=None)
        wanted.append((doc_id, bool(own), len(own), item, best))
    got = [tuple(r) for r in contamination(docs, benchmark).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    clean = decontaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert clean.count() == len(rows) - len(expected)
    assert not any(r["contaminated"] for r in contamination(docs, benchmark.limit(0)).collect())
    assert contamination(docs.limit(0), benchmark).count() == 0
    assert decontaminated(docs, benchmark.limit(0)).count() == len(rows)


def test_pipeline_over_given_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        folder = new_folder(spark, name)
        stage(spark, kept, SF_DIR).write.parquet(folder)
        after = spark.read.parquet(folder)
        assert after.columns == docs.columns
        before_ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
        assert {r["doc_id"] for r in after.select("doc_id").collect()} <= before_ids
        kept = after
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    runs = {i: set(runs_of(t.lower().split(), 5)) or {tuple(t.lower().split())} for i, t in texts.items()}
    ids = sorted(texts)
    roots = groups(
        len(ids),
        lambda i, j: len(runs[ids[i]] & runs[ids[j]]) >= 0.8 * len(runs[ids[i]] | runs[ids[j]]),
    )
    first = [ids[r] for r in sorted(set(roots))]
    leaked = leaks_by_force([(i, texts[i]) for i in first], items)
    expected = {i for at, i in enumerate(first) if at not in leaked}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == expected
    masked = " ".join(r["text"] for r in kept.collect())
    assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", masked)
    assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in rows.select("doc_id").distinct().collect()} == expected


def test_every_numbered_query_is_registered():
    numbers = {int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES}
    assert numbers == set(range(1, 11))
    assert "pipeline" in entry.queries()


def near_copies(count, edits):
    base, rows = prose(600, 150).split(), []
    for i in range(count):  # every text is similar to many others, hardly one to all
        words, draw = list(base), random.Random(i)
        for at in draw.sample(range(30), edits):
            words[at * 5] = f"own{i}"
        rows.append((i, " ".join(words)))
    return rows


def test_fingerprint_links_connect_all_within_three_bits(spark, texts):
    prints = [fingerprint(t) for _, t in texts]
    rows = [(i, p.to_bytes(8)) for i, p in enumerate(prints)]
    found = simhash.fingerprint_links(spark.createDataFrame(rows, "node long, fp binary")).collect()
    assert all((prints[r["u"]] ^ prints[r["v"]]).bit_count() <= 3 for r in found)
    linked = {(r["u"], r["v"]) for r in found}
    expected = groups(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    assert groups(len(rows), lambda i, j: (j, i) in linked) == expected
    empty = spark.createDataFrame([], "node long, fp binary")
    assert simhash.fingerprint_links(empty).count() == 0


def test_deduplicated_compares_what_fingerprints_link(spark, monkeypatch):
    rows, told = near_copies(12, 1), []
    links = simhash.link_fingerprints
    monkeypatch.setattr(simhash, "link_fingerprints", lambda *a, **b: told.append(links(*a, **b)) or told[-1])
    assert sorted(r["doc_id"] for r in deduplicated(table(spark, rows)).collect()) == kept_by_force(rows)
    assert told and told[0].count() > 0
    assert deduplicated(table(spark, rows).limit(0)).count() == 0


def test_a_group_of_near_copies_never_costs_all_its_pairs(spark, monkeypatch):
    rows, met = near_copies(160, 2) + [(200, prose(601, 150))], []
    between = simhash.pairs_between
    monkeypatch.setattr(simhash, "pairs_between", lambda x: met.append(between(x)) or met[-1])
    assert sorted(r["doc_id"] for r in deduplicated(table(spark, rows)).collect()) == kept_by_force(rows)
    assert met[0].count() < 160
