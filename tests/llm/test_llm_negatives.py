"""Hard negatives against all inner products in plain Python."""

import random

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from stratagate.llm import hard_negatives as hn

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, leaf long, block long, score long, windows string"


def quantised(rows):
    out = []
    for vec_id, x, label in rows:
        if vec_id is None or x is None or label is None or any(v is None or not np.isfinite(v) for v in x):
            continue
        whole = [min(max(int(np.floor(256 * float(np.float32(v)))), -(2**63)), 2**63 - 1) for v in x]
        out.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, whole))
    return out


def expected(rows):
    rows = quantised(rows)
    anchors = {}
    for vec_id, label, x in sorted(rows):
        if vec_id % 100 == 0:
            anchors.setdefault(vec_id, (label, x))
    out = []
    for a, (label, x) in anchors.items():
        scored = [
            (-min(max(sum(p * q for p, q in zip(x, y)), -(2**63)), 2**63 - 1), i, other == label)  # noqa: B905
            for i, other, y in rows
        ]
        scored.sort()
        first = [s for s in scored if s[2] and s[1] != a][: hn.POSITIVES]
        for p, pid in dict.fromkeys((s[0], s[1]) for s in first):
            fit = [s for s in scored if not s[2] and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(a, pid, r, s[1], -p, -s[0]) for r, s in enumerate(fit[: hn.NEGATIVES], 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "w") for r in rows], SCHEMA)


def found(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def cloud(seed, n, dimension=6, labels=3):
    draw = np.random.default_rng(seed)
    return [(i, [float(v) for v in draw.normal(size=dimension) * 0.3], int(draw.integers(labels))) for i in range(n)]


@pytest.fixture()
def small(monkeypatch):
    """Many leaves, blocks and chunks from few rows."""
    for name, value in {"SAMPLED": 300, "LEAF_SAMPLE": 12, "FANOUT": 4, "BLOCK_ROWS": 16, "BLOCK_ANCHORS": 3}.items():
        monkeypatch.setattr(hn, name, value)


def test_a_cloud_of_vectors(spark, small):
    rows = cloud(1, 900)
    assert found(hn.hard_negatives(table(spark, rows))) == expected(rows)


def test_awkward_rows(spark, small):
    nan, inf = float("nan"), float("inf")
    rows = cloud(2, 420)
    rows += [
        (None, [0.1] * 6, 1), (1000, None, 1), (1001, [0.1] * 6, None), (1002, [0.1, nan], 1),
        (1003, [inf] * 6, 1), (1004, [None] * 6, 2), (1100, [], 1), (1200, [0.5, 0.5], 0),
        (1300, [0.0] * 6, 1), (1400, [-0.7] * 6, 2), (-100, [0.4] * 6, 1), (1500, [0.1] * 6, 1),
    ]
    rows += [(2000 + i, [0.3, 0.2, 0.1, 0.0, 0.0, 0.3], i % 2) for i in range(300)]  # one vector
    rows += [(2600, [0.3, 0.2, 0.1, 0.0, 0.0, 0.3], 1)] * 9  # one row, again and again
    mixed = random.Random(1).sample(rows, len(rows))
    assert found(hn.hard_negatives(table(spark, mixed))) == expected(rows)


def test_scores_beyond_doubles(spark, small):
    rows = [(i, [float(2.0 ** (20 + i % 15) + i), float(3 * i), -1.0], i % 2) for i in range(0, 1200, 13)]
    rows += [(100 * i, [3e38, 1.0, float(i)], i % 2) for i in range(20, 24)]
    assert found(hn.hard_negatives(table(spark, rows))) == expected(rows)


@pytest.mark.parametrize("rows", [[], [(0, [0.1], 1)], [(0, [0.1], 1), (1, [0.2], 1)], [(3, [0.1], 1)]])
def test_too_few_rows(spark, rows):
    assert found(hn.hard_negatives(table(spark, rows))) == []


def test_the_registered_query_and_its_sql(spark):
    df = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label")
    got = found(entry.queries()["op13_hard_negatives"](spark, SF_DIR))
    assert got == expected([tuple(r) for r in df.collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_DIR}/embeddings.parquet')")
    assert sorted(con.execute(entry.oracle_sql()["op13_hard_negatives"]).fetchall()) == got


def test_elimination_loses_no_row_and_spares_leaves(spark):
    """Around a far window of clustered vectors most leaves are eliminated."""
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(30, 8)) * 200
    x = np.floor(np.concatenate([c + draw.normal(size=(60, 8)) * 6 for c in centres]))
    rows = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, vector array<double>")
    tree = hn.tree_of(rows, len(x), 8)
    leaf = hn.descend(tree, x)[0]
    seen = 0
    for i in range(0, len(x), 50):
        scores = x @ x[i]
        low, high = np.sort(scores)[-20], scores.max()
        kept = hn.surviving(tree, x[i], low, high)
        assert set(leaf[(scores >= low) & (scores <= high)]) <= set(kept)
        seen += len(kept)
    assert seen < 0.5 * tree.leaves * len(range(0, len(x), 50))
