import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratagate.operators import groups, sizing
from stratagate.session import settings


@pytest.fixture(params=["broadcast", "hot and cold", "all cold"])
def limits(request, monkeypatch):
    if request.param == "hot and cold":
        monkeypatch.setattr(sizing, "BROADCAST_ROWS", 3)
    if request.param == "all cold":
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    return request.param


def test_group_size_counts_every_row(spark, limits):
    rng = random.Random(7)
    # one key holds a third of the rows, another third has no key at all
    keys = ["hot"] * 100 + [None] * 100 + [f"k{rng.randrange(60)}" for _ in range(100)]
    rows = [(k, rng.randrange(2), i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "a string, b int, id int")
    expected = Counter((a, b) for a, b, _ in rows)
    got = groups.with_group_size(df, ["a", "b"], "n").collect()
    assert sorted(r.id for r in got) == list(range(300))
    assert all(r.n == expected[(r.a, r.b)] for r in got)


@pytest.mark.parametrize("chunk", [100_000, 7])
def test_copies_are_numbered_without_gaps(spark, monkeypatch, chunk):
    monkeypatch.setattr(groups, "CHUNK", chunk)
    rng = random.Random(3)
    rows = [("same", rng.choice("xyz")) for _ in range(100)]
    rows += [(f"h{rng.randrange(20)}", rng.choice("xy")) for _ in range(60)]
    got = groups.number_copies(spark.createDataFrame(rows, "h string, p string"), "h", "p", "i")
    found = {(r.h, r.p, r.i) for r in got.collect()}
    expected = set()
    for h in {h for h, _ in rows}:
        for i, p in enumerate(sorted(p for g, p in rows if g == h), start=1):
            expected.add((h, p, i))
    assert found == expected and got.count() == len(rows)


def test_hot_copies_are_written_by_several_tasks(spark):
    many = spark.range(4 * groups.CHUNK).selectExpr("'h' AS hash", "'p' AS part")
    numbered = groups.number_copies(many, "hash", "part", "copy")
    found = numbered.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(found) > 1 and sum(r["count"] for r in found) == 4 * groups.CHUNK
    assert numbered.agg(F.countDistinct("copy"), F.max("copy")).first()[:] == (4 * groups.CHUNK,) * 2


def test_large_branch_reads_the_rows_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 3)
    data = [("hot", i) for i in range(400)] + [(None, i) for i in range(90)] + [(f"k{i % 70}", i) for i in range(150)]
    spark.createDataFrame([*data, ("single", 0)], "k string, n int").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    sized = groups.with_group_size(rows, ["k"], "size")
    plan = sized._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    expected = Counter(k for k, _ in data) + Counter(["single"])
    got = sized.select("k", "n", "size").collect()
    assert len(got) == len(data) + 1
    assert all(r["size"] == expected[r.k] for r in got)


def test_many_repeated_keys_need_one_exchange(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 50)
    data = [(f"k{i % 3000}", i) for i in range(6000)] + [(None, i) for i in range(300)]
    data += [("hot", i) for i in range(900)] + [(f"single{i}", i) for i in range(500)]
    spark.createDataFrame(data, "k string, n int").repartition(4).write.parquet(str(tmp_path / "rows"))
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        sized = groups.with_group_size(spark.read.parquet(str(tmp_path / "rows")), ["k"], "size")
        plan = sized._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
        got = sized.select("k", "n", "size", F.spark_partition_id().alias("task")).collect()
    expected = Counter(k for k, _ in data)
    assert Counter((r.k, r.n) for r in got) == Counter(data)
    assert all(r["size"] == expected[r.k] for r in got)
    # rows of a hot key, and those without any, are spread
    assert all(len({r.task for r in got if r.k == k}) > 1 for k in ("hot", None))
