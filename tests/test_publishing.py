import threading
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Field, Reference
from stratagate.operators import quarantine
from stratagate.operators.checks import PublicationBlocked
from stratagate.plans.acquire import acquire, fingerprint_of, selected_parts
from stratagate.plans.bronze import publish_bronze
from stratagate.plans.inspect import diagnose_references, inspect_delivery, sync_catalog
from stratagate.plans.runs import compact_closed
from stratagate.plans.silver import publish_silver
from stratagate.sinks.store import Store
from stratagate.workload import publishing

from items import DIRTY, GOOD, ITEMS, write

BASE = ITEMS.base_identifier


@pytest.fixture
def lake(spark, tmp_path):
    tag = tmp_path.name.replace("-", "_")
    return Store(spark, str(tmp_path / "lake"), f"bronze_{tag}", f"silver_{tag}", f"ctl_{tag}").prepare()


def bronze(lake, tmp_path, contract=ITEMS, data=DIRTY, period="2026-09", **options):
    folder = tmp_path / f"in-{period}"
    if not folder.exists():
        write(folder, "itens.csv", data)
        acquire(lake, BASE, period, str(folder), ["itens.csv"])
    parts = selected_parts(lake, BASE, period, contract.file_pattern)
    return publish_bronze(lake, contract, period, parts, str(folder), fingerprint_of(parts), **options)


def last(lake):
    ended = lake.spark.table(lake.run_log).where("finalizado_em is not null")
    return ended.orderBy(F.desc("finalizado_em")).first()


def test_reconciled_and_repeatable(lake, tmp_path):
    spark = lake.spark
    bronze(lake, tmp_path)
    publish_silver(lake, ITEMS, "2026-09")
    silver = spark.table(f"{lake.silver}.{ITEMS.identifier}")
    assert sorted(r.codigo for r in silver.collect()) == ["1", "2", "5"]
    ids = {r[0] for r in spark.table(lake.quarantine).select("id_quarentena").collect()}
    assert len(ids) == 8
    # publishing the same period again changes neither quarantine nor content
    bronze(lake, tmp_path)
    run = publish_silver(lake, ITEMS, "2026-09")
    assert (run.values["linhas_origem"], run.values["linhas_publicadas"], run.values["linhas_quarentena"]) == (8, 3, 5)
    again = [r[0] for r in spark.table(lake.quarantine).select("id_quarentena").collect()]
    assert set(again) == ids and len(again) == 8
    table = spark.table(f"{lake.silver}.{ITEMS.identifier}")
    assert {r[v.RUN_COL] for r in table.collect()} == {run.id}
    assert table.groupBy("codigo").count().where("count > 1").isEmpty()
    assert table.schema["situacao_descricao"].metadata["comment"] == "Label of situacao."
    assert run.values["status"] == v.SUCCESS_WITH_ALERT


def test_blocked_publication_leaves_the_snapshot(lake, tmp_path):
    bronze(lake, tmp_path)
    first = publish_silver(lake, ITEMS, "2026-09")
    strict = replace(ITEMS, version=2, full_hash="full-2", actions={**ITEMS.actions, v.CONVERSION: v.BLOCK})
    with pytest.raises(PublicationBlocked):
        publish_silver(lake, strict, "2026-09")
    table = lake.spark.table(f"{lake.silver}.{ITEMS.identifier}")
    assert {r[v.RUN_COL] for r in table.collect()} == {first.id}
    row = last(lake)
    assert row.status == v.BLOCKED and "exemplos_bloqueio" in row.detalhes
    versions = Path(lake.folder(f"{lake.silver}.{ITEMS.identifier}"))
    assert [p.name for p in versions.iterdir()] == [first.id]


def test_malformed_over_tolerance_blocks(lake, tmp_path):
    strict = replace(ITEMS, dialect=replace(ITEMS.dialect, tolerance=0.1))
    with pytest.raises(PublicationBlocked, match="tolerance"):
        bronze(lake, tmp_path, strict)
    assert not lake.exists(f"{lake.bronze}.{ITEMS.identifier}")
    assert last(lake).status == v.BLOCKED
    assert lake.spark.table(lake.quarantine).isEmpty()


def test_declared_total_must_match(lake, tmp_path):
    declared = lake.spark.createDataFrame([(12,)], "declared_total bigint")
    with pytest.raises(PublicationBlocked, match="declared 12, read 11"):
        bronze(lake, tmp_path, declared_total=declared)


def test_period_and_provenance(lake, tmp_path):
    bronze(lake, tmp_path, data=GOOD, period="2026-09")
    with pytest.raises(PublicationBlocked, match="period"):
        bronze(lake, tmp_path, data=GOOD, period="2026-08")
    with pytest.raises(PublicationBlocked, match="provenance"):
        publish_silver(lake, ITEMS, "2026-10")
    bronze(lake, tmp_path, period="2026-08", allow_earlier=True)


def test_schema_change_needs_a_version(lake, tmp_path):
    bronze(lake, tmp_path, data=GOOD)
    publish_silver(lake, ITEMS, "2026-09")
    wider = replace(
        ITEMS,
        full_hash="full-2",
        fields=(*ITEMS.fields[:1], replace(ITEMS.fields[1], precision=12), *ITEMS.fields[2:]),
    )
    with pytest.raises(PublicationBlocked, match="version"):
        publish_silver(lake, wider, "2026-09")
    publish_silver(lake, replace(wider, version=2), "2026-09")
    assert dict(lake.spark.table(f"{lake.silver}.{ITEMS.identifier}").dtypes)["valor"] == "decimal(12,2)"


def test_failure_is_logged(lake, tmp_path):
    broken = replace(ITEMS, rules=(replace(ITEMS.rules[0], expression="no_such_column > 0"),))
    bronze(lake, tmp_path, broken, data=GOOD)
    with pytest.raises(Exception):
        publish_silver(lake, broken, "2026-09")
    assert last(lake).status == v.FAILED


def test_known_period_is_not_landed_again(lake, tmp_path):
    write(tmp_path / "in", "itens.csv", GOOD)
    first = acquire(lake, BASE, "2026-09", str(tmp_path / "in"))
    assert acquire(lake, BASE, "2026-09", str(tmp_path / "in")).values["resultado"] == v.EXISTING
    assert acquire(lake, BASE, "2026-09", str(tmp_path / "in"), force=True).values["resultado"] == v.ACQUIRED
    write(tmp_path / "in", "itens.csv", DIRTY)
    with pytest.raises(PublicationBlocked, match="content differs"):
        acquire(lake, BASE, "2026-09", str(tmp_path / "in"), force=True)
    with pytest.raises(PublicationBlocked, match="not landed"):
        acquire(lake, BASE, "2026-10", str(tmp_path / "in"), ["other.csv"])
    assert first.values["resultado"] == v.ACQUIRED


def test_inspection_and_diagnosis(lake, tmp_path):
    write(tmp_path / "in", "itens.csv", GOOD)
    write(tmp_path / "in", "other.txt", "not;of\nthis;entity\n")
    with pytest.raises(PublicationBlocked, match="no acquisition"):
        inspect_delivery(lake, ITEMS, "2026-09")
    for plan in (inspect_delivery, diagnose_references):
        with pytest.raises(PublicationBlocked, match="not YYYY-MM"):
            plan(lake, ITEMS, "2026-13")
    landed = acquire(lake, BASE, "2026-08", str(tmp_path / "in"))
    run = inspect_delivery(lake, replace(ITEMS, file_pattern="itens*"), "2026-08")
    assert run.values["resultado"] == v.COMPATIBLE
    assert run.values["id_execucao_origem"] == landed.id and run.values["publication_fingerprint"]
    parts = lake.spark.read.parquet(f"{run.details['relatorio']}/parts").collect()
    assert [(p._part, p.terminator, p.problems) for p in parts] == [("itens.csv", "LF", 0)]
    coded = replace(
        ITEMS,
        fields=(replace(ITEMS.fields[0], domain=Reference("org_base_codes", "codigo")), *ITEMS.fields[1:]),
    )
    with pytest.raises(PublicationBlocked):
        diagnose_references(lake, coded, "2026-09")
    bronze(lake, tmp_path, coded, data=GOOD)
    publish_silver(lake, coded, "2026-09")
    assert diagnose_references(lake, coded, "2026-09").values["resultado"] == v.REFERENCE_MISSING
    lake.spark.createDataFrame([("1",)], "codigo string").write.saveAsTable(
        f"{lake.silver}.org_base_codes", path=str(tmp_path / "codes")
    )
    run = diagnose_references(lake, coded, "2026-09")
    assert run.values["resultado"] == v.REFERENCE_ORPHANS
    assert run.details["referencias"][0]["exemplos"] == ["2"]


def test_catalog_keeps_curation(lake):
    spark = lake.spark
    name = "catalogo_colunas"
    rows = lambda *x: spark.createDataFrame(
        list(x), "ativo string, coluna string, ordem int, tipo string, nulavel boolean, chave boolean, dominio string, descricao string"
    )
    sync_catalog(lake, name, rows(("t", "a", 1, "int", True, False, None, "x")))
    table = f"{lake.control}.{name}"
    assert spark.table(table).first().descricao_organizacional == v.TO_CONFIRM
    curated = spark.table(table).withColumn("descricao_organizacional", F.lit("ours"))
    folder = lake.folder(table, "curated")
    curated.write.parquet(folder)
    lake.point(table, folder, curated.dtypes)
    sync_catalog(lake, name, rows(("t", "a", 2, "bigint", True, False, None, "y"), ("t", "b", 3, "int", True, False, None, "z")))
    got = {r.coluna: (r.ordem, r.tipo, r.descricao_organizacional) for r in spark.table(table).collect()}
    assert got == {"a": (2, "bigint", "ours"), "b": (3, "int", v.TO_CONFIRM)}


def versions_of(spark, lake, table, schemas):
    """Point a table at one version after the other, with these schemas."""
    for i, ddl in enumerate(schemas):
        names = [c.split()[0] for c in ddl.split(", ")]
        rows = spark.createDataFrame([tuple([i] * len(names))] * 3, ddl)
        folder = lake.folder(table, f"run-{i}")
        rows.write.parquet(folder)
        yield folder, rows.dtypes


def test_readers_never_miss_a_table_whose_schema_changes(lake):
    spark, table = lake.spark, f"{lake.silver}.changing"
    schemas = ["a int, b int", "b int, a int, c int", "a bigint", "c int, a int", "a int, b int"]
    made = list(versions_of(spark, lake, table, schemas))
    lake.point(table, *made[0])
    seen, failed, over = set(), [], threading.Event()

    def poll():
        while not over.is_set():
            try:
                rows = spark.table(table)
                seen.add((tuple(rows.columns), len(rows.collect())))
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    reader = threading.Thread(target=poll)
    reader.start()
    for _ in range(3):
        for folder, dtypes in made:
            lake.point(table, folder, dtypes)
    over.set()
    reader.join()
    assert not failed
    assert {n for _, n in seen} == {3}
    assert {c for c, _ in seen} <= {("a", "b"), ("b", "a", "c"), ("a",), ("c", "a")}


def test_old_versions_are_kept_or_retired(lake):
    spark, table = lake.spark, f"{lake.silver}.kept"
    made = list(versions_of(spark, lake, table, ["a int", "a int, b int", "a int"]))
    for folder, dtypes in made:
        lake.point(table, folder, dtypes)
    assert len(lake.versions(table)) == 3
    older = spark.table(lake.versions(table)[1])
    assert (older.columns, older.count()) == (["a", "b"], 3)
    assert len(lake.retire(table, 2)) == 1 and len(lake.versions(table)) == 2
    assert not Path(made[0][0]).exists() and Path(made[1][0]).exists()
    assert lake.retire(table, 0) and len(lake.versions(table)) == 1
    assert [r.a for r in spark.table(table).collect()] == [2, 2, 2]


def test_a_table_of_an_earlier_release_gives_way(lake):
    spark, table = lake.spark, f"{lake.silver}.older"
    (folder, dtypes), = versions_of(spark, lake, table, ["a int"])
    spark.sql(f"CREATE TABLE {table} (a int) USING parquet LOCATION '{folder}'")
    lake.point(table, folder, dtypes, "text", {"a": "a column's"})
    assert spark.table(table).count() == 3
    assert spark.table(table).schema["a"].metadata["comment"] == "a column's"
    assert lake.comment(table, "text", {"a": "a column's"}) == []
    assert lake.comment(table, "other", {"a": "x", "gone": "y"}) == [table, "a"]
    assert spark.table(table).schema["a"].metadata["comment"] == "x" and spark.table(table).count() == 3


def test_closed_periods_are_compacted_beside_their_readers(lake, tmp_path):
    spark = lake.spark
    for period in ("2026-07", "2026-08", "2026-09"):
        bronze(lake, tmp_path, period=period, allow_earlier=True)
        publish_silver(lake, ITEMS, period)
    log, kept = spark.table(lake.run_log), spark.table(lake.quarantine)
    before = sorted(map(repr, log.collect())), sorted(map(repr, kept.collect()))
    changed = compact_closed(lake, "2026-09")
    # of both identifiers in the log, both periods; bronze and silver share a quarantine
    assert changed[lake.run_log] == 4 and changed[lake.quarantine] == 2
    log, kept = spark.table(lake.run_log), spark.table(lake.quarantine)
    assert (sorted(map(repr, log.collect())), sorted(map(repr, kept.collect()))) == before
    for table in (log, kept):
        files = table.where("competencia < '2026-09'").groupBy("identificador", "competencia")
        assert {r.n for r in files.agg(F.count_distinct("_metadata.file_path").alias("n")).collect()} == {1}
    # again: nothing to do; a publication goes on as before
    assert set(compact_closed(lake, "2026-09").values()) == {0}
    ids = spark.table(lake.quarantine).count()
    bronze(lake, tmp_path, period="2026-09")
    assert publish_silver(lake, ITEMS, "2026-09").values["linhas_quarentena"] == 5
    assert spark.table(lake.quarantine).count() == ids


def test_large_partitions_become_ranges(lake):
    spark, table = lake.spark, f"{lake.control}.ids"
    lake.ensure(table, "id bigint, p string", ("p",))
    for start in (0, 5000):
        lake.append(table, spark.range(start, start + 5000).selectExpr("(id * 7919) % 10007 AS id", "'x y/z' AS p"))
    size = sum(r.file_size for r in spark.table(table).select("_metadata.file_path", "_metadata.file_size").distinct().collect())
    total = spark.table(table).agg(F.sum("id"), F.count("id")).first()
    files = spark.table(table).select("_metadata.file_path").distinct().count()
    assert lake.compact(table, ["p"], "p < 'z'", ["id"], file_bytes=size // min(files - 1, 4) + 1) == 1
    assert spark.table(table).agg(F.sum("id"), F.count("id")).first() == total
    spans = spark.table(table).groupBy("_metadata.file_path").agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").collect()
    assert 1 < len(spans) < files and all(x.b < y.a for x, y in zip(spans, spans[1:], strict=False))


def test_total_is_found_by_its_contract(lake, tmp_path):
    totals = replace(
        ITEMS, entity="totais", fields=(Field("itens", header="ITENS"), Field("outros", header="OUTROS")), key=(),
        rules=(), file_pattern="tot*", part_count=1,
    )
    told = replace(ITEMS, declared_total=(totals, "itens"), file_pattern="itens*")
    rows = GOOD.strip().count("\n")

    def publish(period, files, contract=told):
        folder = tmp_path / f"in-{period}"
        for name, data in {"itens.csv": GOOD, **files}.items():
            write(folder, name, data)
        acquire(lake, BASE, period, str(folder))
        parts = selected_parts(lake, BASE, period, contract.file_pattern)
        return publish_bronze(
            lake, contract, period, parts, str(folder), fingerprint_of(parts), allow_earlier=True
        )

    run = publish("2026-01", {"tot.csv": f"ITENS;OUTROS\n{rows};7\n"})
    assert run.details["total_declarado"] == rows
    refused = {
        "2026-02": ({"tot.csv": "ITENS;OUTROS\n99;7\n"}, "declared 99, read"),
        "2026-03": ({}, "0 parts found, expected 1"),
        "2026-04": ({"tot.csv": "ITENS;OUTROS\n1;7\n", "tot2.csv": "ITENS;OUTROS\n1;7\n"}, "2 parts found"),
        "2026-05": ({"tot.csv": "OUTROS;ITENS\n1;7\n"}, "header tot.csv"),
        "2026-06": ({"tot.csv": f"ITENS;OUTROS\n{rows};\xe9\n".encode("latin-1")}, "does not decode"),
        "2026-07": ({"tot.csv": f"ITENS;OUTROS\n{rows};1\n{rows};1\n"}, "declared nothing"),
    }
    for period, (files, why) in refused.items():
        with pytest.raises(PublicationBlocked, match=why):
            publish(period, files)
    elsewhere = replace(told, declared_total=(replace(totals, base="other"), "itens"))
    with pytest.raises(PublicationBlocked, match="is not of"):
        publish("2026-08", {"tot.csv": f"ITENS;OUTROS\n{rows};7\n"}, elsewhere)


def test_quarantine_ids_never_meet_at_the_driver(spark):
    store, layout, present = publishing.stored_twice(spark, "/root/testdata/sf0.001")
    assert layout.inputFiles() and present == layout.count()  # evaluated once, then read
    stored = spark.table(store.quarantine)
    for join in (quarantine.new_rows, quarantine.present_rows):
        for ids in (layout, stored):
            plan = join(stored, ids)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Broadcast" not in plan
