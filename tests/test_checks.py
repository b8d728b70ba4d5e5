from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.operators import checks, references, runlog, schema, upsert

from items import HEADER, ITEMS


def told(df):
    return sorted(r.problem for r in df.collect())


def log(spark, *rows):
    base = dict(identificador="e", status=v.SUCCESS, competencia="2026-09", versao_contrato=1,
                hash_leitura="h1", hash_contrato="c1", tipo=v.BRONZE)
    names = spark.createDataFrame([], v.RUN_LOG_DDL).schema
    data = []
    for i, row in enumerate(rows):
        row = {**base, "id_execucao": f"r{i}", "iniciado_em": datetime(2026, 1, i + 1), **row}
        data.append(tuple(row.get(c) for c in names.names))
    return spark.createDataFrame(data, names)


def request(spark, **values):
    row = dict(identificador="e", tipo=v.BRONZE, competencia="2026-09", versao_contrato=1,
               estado_contrato=v.DRAFT, hash_leitura="h1", hash_contrato="c1") | values
    return spark.createDataFrame([tuple(row.values())], ", ".join(
        f"{c} {'int' if c == 'versao_contrato' else 'string'}" for c in row))


def test_parts(spark):
    want = spark.createDataFrame([("a",), ("b",)], "part string")
    physical = spark.createDataFrame([("a", 11), ("b", 6)], "part string, physical bigint")
    read = "part string, read bigint, malformed bigint"
    fine = spark.createDataFrame([("a", 10, 1), ("b", 5, 0)], read)
    assert told(checks.parts(want, physical, fine, True)) == []
    off = spark.createDataFrame([("a", 60, 60), ("x", 1, 0)], read)
    assert told(checks.parts(want, physical, off, True)) == [
        "10 physical lines, 60 rows read", "5 physical lines, 0 rows read",
        "no valid row", "no valid row", "not a contracted part",
    ]


@pytest.mark.parametrize("bad,total,limit,passes", [
    (1, 1000, 0.001, True), (2, 1000, 0.001, False), (1, 10, 0.0, False), (0, 0, 0.0, True),
])
def test_tolerance(spark, bad, total, limit, passes):
    read = spark.createDataFrame([("a", total, bad)], "part string, read bigint, malformed bigint")
    assert checks.tolerance(read, limit, "e").isEmpty() == passes


def test_declared_total(spark):
    read = spark.createDataFrame([("a", 10), ("b", 10)], "part string, read bigint")
    rows = lambda *x: spark.createDataFrame([(i,) for i in x], "total string")
    total = lambda *x: checks.total_from_file(rows(*x), "total")
    assert told(checks.declared_total(read, total(" 20 "), "e")) == []
    assert told(checks.declared_total(read, total("21"), "e")) == ["declared 21, read 20"]
    for refused in (("x",), ("1", "2"), ()):
        assert told(checks.declared_total(read, total(*refused), "e")) == ["declared nothing, read 20"]


@pytest.mark.parametrize("line,problems", [
    (HEADER.strip(), []),
    ("﻿ CODIGO ;\"VALOR\";DATA;SITUACAO", []),
    ("CODIGO;DATA;VALOR;SITUACAO", ["column DATA at position 2, declared 3", "column VALOR at position 3, declared 2"]),
    ("CODIGO;VALOR;DATA", ["3 columns, declared 4", "missing column SITUACAO"]),
    ("CODIGO;VALOR;DATA;OUTRA", ["missing column SITUACAO", "undeclared column OUTRA"]),
])
def test_header(spark, line, problems):
    first = spark.createDataFrame([("p", line)], "part string, value string")
    assert told(checks.header(first, ITEMS)) == problems


def test_period_format(spark):
    df = spark.createDataFrame([("2026-09",), ("2026-13",), ("202609",), ("26-09",), (None,)], "p string")
    assert [r[0] for r in df.select(checks.period_valid(F.col("p"))).collect()] == [True, False, False, False, False]


def test_period_never_goes_back(spark):
    runs = log(spark, {})
    for period, allow, passes in [("2026-09", False, True), ("2026-10", False, True), ("2026-08", False, False), ("2026-08", True, True)]:
        assert checks.period(request(spark, competencia=period), runs, allow).isEmpty() == passes
    failed = log(spark, {"status": v.FAILED})
    assert checks.period(request(spark, competencia="2026-08"), failed, False).isEmpty()


def test_version(spark):
    runs = log(spark, {})
    assert checks.version(request(spark), runs).isEmpty()
    assert checks.version(request(spark, versao_contrato=2, hash_contrato="c2"), runs).isEmpty()
    assert not checks.version(request(spark, hash_contrato="c2"), runs).isEmpty()


def test_provenance(spark):
    runs = log(spark, {})
    assert told(checks.provenance(request(spark), runs)) == []
    assert told(checks.provenance(request(spark), runs.where("false"))) == ["no effective Bronze"]
    other = request(spark, competencia="2026-10", hash_leitura="h2")
    assert told(checks.provenance(other, runs)) == ["Bronze is of 2026-09", "Bronze was read under another hash"]


def test_snapshot(spark):
    layout = f"{v.RUN_COL} string, {v.PERIOD_COL} string"
    one = spark.createDataFrame([("r1", "2026-09")] * 10, layout)
    check = lambda df, n: told(checks.snapshot(checks.snapshot_composition(df), "r1", "2026-09", n, "e"))
    assert check(one, 10) == []
    assert check(one, 11) == ["10 rows, run logged 11"]
    mixed = one.union(spark.createDataFrame([("r2", "2026-09")], layout))
    assert check(mixed, 11) == ["2 publications in the table, 1 expected one"]
    assert len(check(one.where("false"), 10)) == 2


def test_evidence(spark):
    runs = log(
        spark,
        {"tipo": v.INSPECTION, "resultado": v.COMPATIBLE},
        {"tipo": v.APPROVAL, "resultado": v.RESULT_APPROVED},
    )
    ask = lambda **x: told(checks.evidence(request(spark, **x), runs))
    assert ask() == ask(estado_contrato=v.VALIDATED) == ask(estado_contrato=v.APPROVED) == []
    assert ask(estado_contrato=v.OBSOLETE) == ["obsolete contract"]
    assert ask(estado_contrato=v.APPROVED, hash_leitura="h2", hash_contrato="c2") == [
        "no approval for this contract hash", "no compatible inspection for this read hash",
    ]


def test_latest_runs(spark):
    runs = log(spark, {}, {"status": v.FAILED}, {"tipo": v.SILVER}, {"finalizado_em": datetime(2027, 1, 1)}, {})
    assert {(r.tipo, r.id_execucao) for r in runlog.latest_effective(runs).collect()} == {(v.BRONZE, "r3"), (v.SILVER, "r2")}


def test_current_takes_the_end_row(spark):
    rows = log(spark, {"id_execucao": "x", "status": v.RUNNING}, {"id_execucao": "x", "finalizado_em": datetime(2026, 5, 1)}, {"id_execucao": "y", "status": v.RUNNING})
    assert {(r.id_execucao, r.status) for r in runlog.current(rows).collect()} == {("x", v.SUCCESS), ("y", v.RUNNING)}


def test_schema_diff_and_change(spark):
    rows = lambda *x: schema.schema_rows(spark, "t", list(x))
    before = rows(("a", "string"), ("b", "int"), ("c", "date"))
    after = rows(("b", "bigint"), ("a", "string"), ("d", "string"))
    diff = schema.schema_diff(before, after)
    assert {(r.change, r.name) for r in diff.collect()} == {
        ("added", "d"), ("removed", "c"), ("retyped", "b"), ("reordered", None),
    }
    assert schema.schema_diff(before, before).isEmpty()
    for version, published, passes in [(2, 1, True), (1, 1, False), (2, None, False)]:
        versions = spark.createDataFrame([("t", version, published)], "entity string, version int, published int")
        assert schema.schema_change(diff, versions).isEmpty() == passes


def test_verdict_is_the_worst(spark):
    def worst(*results):
        df = spark.createDataFrame([(r,) for r in results], "resultado string")
        return references.verdict(df).first()[0]

    assert worst() == worst(v.REFERENCE_OK) == v.REFERENCE_OK
    assert worst(v.REFERENCE_OK, v.REFERENCE_ORPHANS) == v.REFERENCE_ORPHANS
    assert worst(v.REFERENCE_MISSING, v.REFERENCE_ORPHANS) == v.REFERENCE_MISSING


def test_upsert_updates_only_what_it_may(spark):
    target = spark.createDataFrame([(1, None, "a", "kept"), (2, "k", "b", "kept")], "id int, k2 string, x string, note string")
    source = spark.createDataFrame([(1, None, "A", "new"), (3, "k", "C", "new"), (2, "k", None, "new")], target.schema)
    got = {tuple(r) for r in upsert.upsert(target, source, ["id", "k2"], ["x"]).collect()}
    assert got == {(1, None, "A", "kept"), (2, "k", None, "kept"), (3, "k", "C", "new")}


def test_landed_and_relanded(spark):
    layout = "part string, sha256 string"
    files = spark.createDataFrame([("a", "1"), ("b", "2"), ("b", "2")], layout)
    wanted = spark.createDataFrame([("a",), ("c",)], "part string")
    assert told(checks.landed(wanted, files)) == ["declared but not landed", "landed 2 times"]
    again = spark.createDataFrame([("a", "1"), ("b", "3")], layout)
    assert [r.subject for r in checks.relanded(files.distinct(), again).collect()] == ["b"]


def test_a_doubled_source_key_stops_an_upsert(spark):
    target = spark.createDataFrame([(1, "a")], "k int, x string")
    source = spark.createDataFrame([(1, "b"), (1, "c"), (None, "d")], "k int, x string")
    with pytest.raises(checks.PublicationBlocked, match='key {"k":1} in 2 source rows'):
        upsert.upsert(target, source, ["k"], ["x"])


def test_all_problems_are_kept(spark):
    many = spark.range(3000).selectExpr("'check' AS check", "CAST(id AS string) AS subject", "'wrong' AS problem")
    with pytest.raises(checks.PublicationBlocked, match="3000 problems in ") as stopped:
        checks.require(many)
    folder = str(stopped.value).rsplit(" in ", 1)[1].rstrip(")")
    assert spark.read.parquet(folder).count() == 3000
    assert len(str(stopped.value)) <= v.ERROR_CHARS + 300


@pytest.mark.parametrize("period", ["2026-13", "2026", None])
def test_a_period_is_year_and_month(spark, period):
    rows = spark.createDataFrame([("e", period)], "identificador string, competencia string")
    assert checks.period_format(rows).count() == 1
