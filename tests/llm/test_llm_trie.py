"""The trie of conversation prefixes against one built in plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from math import fmod

import duckdb
import pytest

import __spark_entry__ as entry
from stratagate.llm import prefix_trie
from stratagate.llm.prefix_trie import nodes, rebuilt

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, n long, place long, total long, _h int"


def sequences(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        if conv is not None:
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()[:32]
            turns[conv].append((turn is not None, turn or 0, digest, (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(c - int(fmod(c, 100)), [])[:h]) + tuple(ts[h:])
    return out


def expected(rows):
    paths = sequences(rows)
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        gain = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += gain
            leaves[p[:d]] += p not in children
    return sorted(
        (
            m[0], len(p), members[p[:-1]][0] if p else -(10**9), len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in m if len(paths[c]) == len(p)).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def found(df):
    return sorted((*r[:2], -(10**9) if r[2] is None else r[2], *r[3:]) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA)


def talk(seed, convs, variants, longest):
    """Conversations that share first turns, some of them whole."""
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(draw.randint(1, longest)):
            rows.append((c, turn, "user" if turn % 2 else None, f"{turn} {draw.randrange(variants)} é😀"))
    return rows


@pytest.mark.parametrize(("convs", "variants", "longest"), [(60, 1, 14), (150, 2, 9)])
def test_shared_starts(spark, convs, variants, longest):
    rows = talk(convs, convs, variants, longest)
    got = found(prefix_trie.prefix_trie(table(spark, random.Random(1).sample(rows, len(rows)))))
    assert got == expected(rows)


def test_awkward_rows(spark):
    rows = [
        (None, 1, "user", "nobody's"),
        (0, None, None, None),
        (0, None, None, None),
        (0, 2, "user", ""),
        (0, 2, "user", "tie"),
        (0, 2, "a", "tie"),
        (1, 5, "user", "long " * 20000),
        (-3, 1, "user", "negative"),
        (-150, 1, "user", "below"),
        (-150, 2, "user", "below"),
        (2**62, 1, "x", "far"),
        (3, 1, "ab", "c"),
        (4, 1, "a", "bc"),
        *[(700 + i, 0, "user", "one turn") for i in range(60)],
    ]
    rows += rows[5:9]
    assert found(prefix_trie.prefix_trie(table(spark, rows))) == expected(rows)


def test_one_conversation_holds_most_turns(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 16)
    hot = [(8, t, "user", f"turn {t % 7}") for t in range(150)]
    twin = [(9, t, "user", f"turn {t % 7}") for t in range(130)]
    rows = hot + twin + [(8, 1, "user", "turn 1")] * 40 + talk(5, 30, 2, 6)
    assert found(prefix_trie.prefix_trie(table(spark, rows))) == expected(rows)


def test_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "broadcast_if_small", lambda rows: rows)
    rows = talk(3, 120, 2, 12)
    assert found(prefix_trie.prefix_trie(table(spark, rows))) == expected(rows)


def test_many_ids_end_in_one_node(spark):
    rows = [(c, 0, "user", "the same") for c in range(0, 15000, 3)]
    assert found(prefix_trie.prefix_trie(table(spark, rows))) == expected(rows)


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(table(spark, [])).collect() == []


def test_conversations_as_they_are(spark):
    """Without the workload's rebuilding: any numbered turns will do."""
    own = prefix_trie.numbered(prefix_trie.turns(table(spark, talk(7, 20, 2, 5)))).checkpoint()
    lengths = own.groupBy("conv_id").agg({"place": "max"}).withColumnRenamed("max(place)", "n")
    got = nodes(lengths, own.join(lengths, "conv_id").select("conv_id", "n", "place", "digest", "tokens"))
    tops = [r for r in got.collect() if r.depth == 0]
    assert [(r.conv_id, r.n_convs) for r in tops] == [(0, 20)]
    assert rebuilt(own)[0].count() == 20


def test_the_registered_query_and_its_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = found(entry.queries()["op12_trie"](spark, SF_DIR))
    assert got == expected(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_DIR}/conversations.parquet')")
    sql = con.execute(entry.oracle_sql()["op12_trie"]).fetchall()
    assert sorted((*r[:2], -(10**9) if r[2] is None else r[2], *r[3:]) for r in sql) == got
