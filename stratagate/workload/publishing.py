"""Whole publications: delivery -> Bronze -> Silver, with quarantine and log."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Contract, Dialect, Field, Labels
from stratagate.operators import checks, quarantine, runlog
from stratagate.operators.checks import PublicationBlocked
from stratagate.operators.evaluate import evaluate
from stratagate.plans.acquire import acquire
from stratagate.plans.bronze import publish_bronze
from stratagate.plans.inspect import inspect_delivery
from stratagate.plans.publish import append_quarantine
from stratagate.plans.runs import compact_closed
from stratagate.plans.silver import publish_silver, write_and_measure
from stratagate.session import new_folder, written
from stratagate.sinks.store import Store
from stratagate.workload.contracts import DELIVERED, ITEMS
from stratagate.workload.delivery import CTE as DELIVERY_CTE
from stratagate.workload.delivery import delivered, write_once
from stratagate.workload.inputs import from_sql
from stratagate.workload.registry import query
from stratagate.workload.rows import (
    EVALUATED,
    GROUP_SQL,
    PUBLICATION,
    orders_evaluation,
    quarantine_layout,
    withdrawn_rows,
)

PERIOD = "2026-09"


def new_store(spark: SparkSession) -> Store:
    """Schemas and folders of their own for one query."""
    tag = uuid.uuid4().hex[:10]
    store = Store(
        spark,
        new_folder(spark, "store"),
        bronze=f"bronze_{tag}",
        silver=f"silver_{tag}",
        control=f"controle_{tag}",
    )
    return store.prepare()


def manifest(spark, sf_dir, folder: str) -> DataFrame:
    """The parts of the delivery: one folder each."""
    parts = from_sql(
        spark,
        sf_dir,
        "SELECT DISTINCT 'source_part=part-' || CAST(o_orderkey % 4 AS STRING) AS part FROM orders",
    )
    return parts.select("part", F.concat(F.lit(folder + "/"), "part").alias("path"))


def deliver(spark, sf_dir, store: Store, contract: Contract = DELIVERED, **options):
    folder = delivered(spark, sf_dir)
    return publish_bronze(
        store, contract, PERIOD, manifest(spark, sf_dir, folder), folder, "delivery-1", **options
    )


@query(
    "bronze_pipeline",
    DELIVERY_CTE
    + """SELECT order_id, cust_id, status, amount, order_date, note, CAST(NULL AS STRING) AS legacy_code,
                '2026-09' AS competencia, 'source_part=' || source_part AS _arquivo_origem
         FROM delivery WHERE NOT malformed""",
)
def bronze_pipeline(spark, sf_dir):
    store = new_store(spark)
    deliver(spark, sf_dir, store)
    return spark.table(f"{store.bronze}.{DELIVERED.identifier}").drop(v.RUN_COL)


INSPECTED = (
    "_part", "terminator", "bom", "separator", "decodes_declared", "looks_utf8", "records", "other_width", "problems",
    "verdict",
)


@query(
    "inspection_report",
    DELIVERY_CTE
    + """,
    marks AS (
      SELECT source_part, m.pos, m.mark, length(line) - length(replace(line, m.mark, '')) AS n
      FROM delivery, (VALUES (0, ';'), (1, ','), (2, '|'), (3, chr(9))) AS m(pos, mark)),
    modes AS (SELECT source_part, pos, mark, n, count(*) AS lines FROM marks GROUP BY ALL),
    stable AS (SELECT source_part, pos, mark, min(n) AS least, max(lines) AS lines FROM modes GROUP BY ALL HAVING min(n) > 0),
    likely AS (
      SELECT s.source_part, s.mark AS separator FROM stable s
      JOIN modes m ON m.source_part = s.source_part AND m.pos = s.pos AND m.lines = s.lines
      QUALIFY row_number() OVER (PARTITION BY s.source_part ORDER BY s.lines DESC, m.n DESC, s.pos) = 1),
    parts AS (
      SELECT source_part, count(*) AS records, count(*) FILTER (malformed) AS other_width,
             CASE WHEN bool_or(crlf) AND (NOT bool_and(crlf) OR bool_or(malformed)) THEN 'mixed'
                  WHEN bool_or(crlf) THEN 'CRLF' ELSE 'LF' END AS terminator
      FROM delivery GROUP BY source_part)
    SELECT 'source_part=' || source_part AS _part, terminator, false AS bom, separator, true AS decodes_declared,
           false AS looks_utf8, records, CAST(other_width AS BIGINT) AS other_width,
           CAST((other_width > 0) AS BIGINT) + CAST((separator <> ';') AS BIGINT) AS problems,
           CASE WHEN other_width > 0 OR separator <> ';' THEN 'INCOMPATIVEL' ELSE 'COMPATIVEL' END AS verdict
    FROM parts JOIN likely USING (source_part)""",
)
def inspection_report(spark, sf_dir):
    """Report of an inspection, tied to the acquisition whose files it read."""
    store = new_store(spark)
    folder = delivered(spark, sf_dir)
    acquired = acquire(store, DELIVERED.base_identifier, PERIOD, folder)
    run = inspect_delivery(store, DELIVERED, PERIOD)
    assert run.values["id_execucao_origem"] == acquired.id
    return spark.read.parquet(f"{run.details['relatorio']}/parts").select(*INSPECTED)


SILVER_SQL = (
    DELIVERY_CTE
    + """,
    typed AS (
      SELECT *, TRY_CAST(trim(order_id) AS BIGINT) AS v_id, TRY_CAST(cust_id AS BIGINT) AS v_cust, upper(status) AS v_status,
             TRY_CAST(replace(amount, ',', '.') AS DECIMAL(15,2)) AS v_amount,
             CAST(try_strptime(order_date, '%Y%m%d') AS DATE) AS v_date
      FROM delivery WHERE NOT malformed),
    judged AS (
      SELECT *, v_id IS NULL OR count(*) OVER (PARTITION BY v_id) > 1 AS bad_key,
             v_date IS NULL AS bad_date, v_status NOT IN ('F', 'O', 'P') AS bad_status FROM typed)
    """
)


@query(
    "silver_pipeline",
    SILVER_SQL
    + """SELECT v_id AS order_id, v_cust AS cust_id, v_status AS status,
                CASE v_status WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial' END AS status_label,
                v_amount AS amount, v_date AS order_date, note, CAST(NULL AS STRING) AS legacy_code,
                '2026-09' AS competencia, 'source_part=' || source_part AS _arquivo_origem
         FROM judged WHERE NOT (bad_key OR bad_date OR bad_status)""",
)
def silver_pipeline(spark, sf_dir):
    store = new_store(spark)
    deliver(spark, sf_dir, store)
    publish_silver(store, DELIVERED, PERIOD)
    return spark.table(f"{store.silver}.{DELIVERED.identifier}").drop(v.RUN_COL)


@query(
    "publish_reconciled",
    SILVER_SQL
    + """SELECT 'BRONZE' AS tipo, 'SUCESSO' AS status, (SELECT count(*) FROM delivery) AS linhas_origem,
                (SELECT count(*) FROM typed) AS linhas_publicadas, (SELECT count(*) FROM delivery WHERE malformed) AS linhas_quarentena
         UNION ALL SELECT 'SILVER', 'SUCESSO', (SELECT count(*) FROM typed),
                (SELECT count(*) FROM judged WHERE NOT (bad_key OR bad_date OR bad_status)),
                (SELECT count(*) FROM judged WHERE bad_key OR bad_date OR bad_status)
         UNION ALL SELECT 'BRONZE', 'BLOQUEADA', (SELECT count(*) FROM delivery), NULL, NULL""",
)
def publish_reconciled(spark, sf_dir):
    """Bronze and Silver publish; a stricter tolerance is then blocked."""
    store = new_store(spark)
    deliver(spark, sf_dir, store)
    publish_silver(store, DELIVERED, PERIOD)
    strict = replace(DELIVERED, dialect=replace(DELIVERED.dialect, tolerance=0.0))
    try:
        deliver(spark, sf_dir, store, strict)
    except PublicationBlocked:
        pass
    return runlog.current(spark.table(store.run_log)).select(
        "tipo", "status", "linhas_origem", "linhas_publicadas", "linhas_quarentena"
    )


@query(
    "snapshot_composition",
    DELIVERY_CTE
    + """SELECT true AS one_run, '2026-09' AS competencia, count(*) AS rows FROM delivery WHERE NOT malformed""",
)
def snapshot_composition(spark, sf_dir):
    """Publishing the period twice leaves the rows of the second run only."""
    store = new_store(spark)
    deliver(spark, sf_dir, store)
    run = deliver(spark, sf_dir, store)
    found = checks.snapshot_composition(
        spark.table(f"{store.bronze}.{DELIVERED.identifier}")
    )
    return found.select(
        (F.col(v.RUN_COL) == run.id).alias("one_run"), v.PERIOD_COL, "rows"
    )


@query(
    "chk_snapshot",
    EVALUATED
    + """SELECT 'snapshot' AS "check", 'two runs' AS subject, '2 publications in the table, 1 expected one' AS problem
         UNION ALL SELECT 'snapshot', 'two runs', CAST(count(*) + count(*) FILTER (NOT withdraw) AS STRING) || ' rows, run logged -1' FROM evaluated""",
)
def chk_snapshot(spark, sf_dir):
    """A table holding rows of two runs, against what one run logged."""
    raw = orders_evaluation(spark, sf_dir).rows
    lineage = [F.lit(PERIOD).alias(v.PERIOD_COL), F.lit("run-1").alias(v.RUN_COL)]
    mixed = raw.select(*lineage).union(
        raw.where("not _withdraw").select(lineage[0], F.lit("run-0"))
    )
    found = checks.snapshot_composition(mixed)
    return checks.snapshot(found, "run-1", PERIOD, -1, "two runs")


# ------------------------------------------------------------ quarantine


def stored_twice(spark, sf_dir) -> tuple[Store, DataFrame, int]:
    """The same publication's withdrawn rows, evaluated once, appended twice."""
    store = new_store(spark)
    layout = quarantine_layout(
        withdrawn_rows(orders_evaluation(spark, sf_dir)), PUBLICATION
    )
    layout = written(layout, "layout")
    append_quarantine(store, layout, PUBLICATION)
    present = append_quarantine(store, layout, PUBLICATION)
    return store, layout, present


@query(
    "quarantine_idempotent",
    EVALUATED
    + """SELECT count(*) AS stored, count(*) AS distinct_ids, count(*) AS present FROM evaluated WHERE withdraw""",
)
def quarantine_idempotent(spark, sf_dir):
    store, _, present = stored_twice(spark, sf_dir)
    return spark.table(store.quarantine).agg(
        F.count(F.lit(1)).alias("stored"),
        F.count_distinct("id_quarentena").alias("distinct_ids"),
        F.lit(present).cast("bigint").alias("present"),
    )


@query(
    "quarantine_present",
    EVALUATED
    + """SELECT source_part AS arquivo_origem, count(*) AS linhas FROM evaluated WHERE withdraw GROUP BY 1""",
)
def quarantine_present(spark, sf_dir):
    store, layout, _ = stored_twice(spark, sf_dir)
    stored = quarantine.of_publication(spark.table(store.quarantine), PUBLICATION)
    return (
        quarantine.present_rows(stored, layout)
        .groupBy("arquivo_origem")
        .agg(F.count(F.lit(1)).alias("linhas"))
    )


@query(
    "quarantine_by_group",
    EVALUATED
    + f"""SELECT 'shop_sales_orders' AS identificador, 'silver' AS camada, {GROUP_SQL} AS grupo_problema, count(*) AS linhas
          FROM evaluated WHERE withdraw GROUP BY ALL""",
)
def quarantine_by_group(spark, sf_dir):
    store, _, _ = stored_twice(spark, sf_dir)
    return runlog.by_problem_group(spark.table(store.quarantine))


@query(
    "quarantine_duplicates",
    EVALUATED
    + """SELECT count(*) AS ids, CAST(sum(1 + CAST(dup_key AS INTEGER)) AS BIGINT) AS linhas
         FROM evaluated WHERE withdraw AND dup_key""",
)
def quarantine_duplicates(spark, sf_dir):
    """Rows of duplicated keys stored once more on purpose: each id shows twice."""
    layout = quarantine_layout(
        withdrawn_rows(orders_evaluation(spark, sf_dir)), PUBLICATION
    )
    again = layout.where(F.col("grupo_problema").contains(v.KEY_DUPLICATE))
    found = runlog.duplicate_ids(layout.union(again))
    return found.agg(F.count(F.lit(1)).alias("ids"), F.sum("linhas").alias("linhas"))


# ----------------------------------------------------------- large table

RAW_ITEMS = """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(l_linenumber AS STRING) AS line_number,
       CASE WHEN l_partkey % 97 = 0 THEN '' ELSE CAST(l_partkey AS STRING) END AS part_id,
       CAST(CAST(CASE WHEN l_suppkey % 41 = 0 THEN -l_quantity ELSE l_quantity END AS DECIMAL(15,2)) AS STRING) AS quantity,
       CASE WHEN l_partkey % 89 = 0 THEN 'n/a' ELSE CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) END AS price,
       CASE WHEN l_suppkey % 53 = 0 THEN 'X' ELSE l_returnflag END AS flag,
       substring(CAST(l_shipdate AS STRING), 1, 10) AS ship_date, 'supplier-' || CAST(l_suppkey % 8 AS STRING) AS source_part
FROM lineitem
"""


@query(
    "items_published",
    f"""
    WITH judged AS (
      SELECT *, count(*) OVER (PARTITION BY order_id, line_number) > 1 OR part_id = '' OR price = 'n/a'
               OR flag = 'X' OR quantity LIKE '-%' OR CAST(quantity AS DECIMAL(15,2)) = 0 AS bad FROM ({RAW_ITEMS}))
    SELECT CAST(order_id AS BIGINT) AS order_id, CAST(line_number AS INTEGER) AS line_number, CAST(part_id AS BIGINT) AS part_id,
           CAST(quantity AS DECIMAL(15,2)) AS quantity, CAST(price AS DECIMAL(15,2)) AS price, flag,
           CASE flag WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'New' WHEN 'R' THEN 'Returned' END AS flag_label,
           CAST(ship_date AS DATE) AS ship_date, '2026-09' AS competencia, source_part AS _arquivo_origem, 'run-1' AS _id_execucao
    FROM judged WHERE NOT bad
    """,
)
def items_published(spark, sf_dir):
    """Items evaluated, written and measured in one pass, then read back."""
    raw = from_sql(spark, sf_dir, RAW_ITEMS).withColumnRenamed("source_part", v.PART_COL)
    folder = new_folder(spark, "items")
    write_and_measure(evaluate(raw, ITEMS), PERIOD, "run-1", folder)
    return spark.read.parquet(folder)


LOGGED = """
SELECT o_orderkey AS k, 'shop_' || substring(o_orderpriority, 1, 1) AS identificador,
       substring(CAST(o_orderdate AS STRING), 1, 4) || '-01' AS competencia
FROM orders
"""


@query(
    "run_log_compacted",
    f"""SELECT identificador, competencia, count(*) AS execucoes, CAST(sum(k) AS BIGINT) AS chaves,
               competencia >= '1998' OR NULL AS aberta,
               CASE WHEN competencia < '1998' THEN 1 END AS arquivos
        FROM ({LOGGED}) GROUP BY identificador, competencia""",
)
def run_log_compacted(spark, sf_dir):
    """A log of many small files, its closed periods compacted to one file each."""
    store = new_store(spark)
    logged = from_sql(spark, sf_dir, LOGGED)
    columns = spark.table(store.run_log).schema
    known = {"id_execucao": F.col("k").cast("string"), "linhas_origem": F.col("k")}
    known |= {c: F.col(c) for c in (v.PARTITION_COL, v.PERIOD_COL)}
    rows = logged.repartition(4, "k").select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in columns]
    )
    store.append(store.run_log, rows)
    compact_closed(store, "1998")
    closed = F.col(v.PERIOD_COL) < "1998"
    log = spark.table(store.run_log)
    return log.groupBy(v.PARTITION_COL, v.PERIOD_COL).agg(
        F.count(F.lit(1)).alias("execucoes"), F.sum("linhas_origem").alias("chaves"),
        F.count_distinct("_metadata.file_path").alias("_n"),
    ).select(
        v.PARTITION_COL, v.PERIOD_COL, "execucoes", "chaves",
        F.when(~closed, F.lit(True)).alias("aberta"), F.when(closed, F.col("_n").cast("int")).alias("arquivos"),
    )


NOTES = Contract(
    "shop", "sales", "notes",
    fields=(
        Field("order_id", v.LONG, nullable=False, description="Number of the order; it's the key."),
        Field("status", domain=Labels({"F": "Filled", "O": "Open", "P": "Partial"}, "status_label"), description="State of the order."),
    ),
    key=("order_id",), dialect=Dialect(header=False, tolerance=1.0), split_parts=True,
    description="Orders with notes.",
)

# some lines carry a long note and two fields too many
NOTED = """
SELECT o_orderkey AS k, o_orderkey % 97 = 0 AS malformed,
       CAST(o_orderkey AS STRING) || ';' || CASE WHEN o_orderkey % 97 = 0
         THEN repeat(o_orderstatus || 'é' || o_orderpriority, 40) || ';x;y' ELSE o_orderstatus END AS line
FROM orders
"""


@query(
    "publication_told",
    f"""WITH noted AS ({NOTED})
    SELECT 'evidence' AS what, CAST(k AS STRING) AS name, substring(line, 1, 200) AS told FROM noted WHERE malformed
    UNION ALL SELECT 'rows', 'BRONZE', CAST(count(*) AS STRING) || ' = ' || CAST(count(*) FILTER (NOT malformed) AS STRING)
              || ' + ' || CAST(count(*) FILTER (malformed) AS STRING) FROM noted
    UNION ALL SELECT 'rows', 'SILVER', CAST(count(*) AS STRING) || ' = ' || CAST(count(*) AS STRING) || ' + 0'
              FROM noted WHERE NOT malformed
    UNION ALL SELECT 'load time', 'quarantine', 'within its run' FROM noted WHERE malformed
    UNION ALL VALUES
      ('comment', 'order_id', 'Number of the order; it''s the key.'), ('comment', 'status', 'State of the order.'),
      ('comment', 'status_label', 'Label of status.'), ('comment', 'competencia', 'Period of the publication (YYYY-MM).'),
      ('comment', '_arquivo_origem', 'Delivered file the row came from.'), ('comment', '_id_execucao', 'Run that published the row.'),
      ('table', 'silver', 'Orders with notes. Silver: types, domains and rules of the contract applied. Contract shop_sales_notes version 1.'),
      ('table', 'bronze', 'Orders with notes. Bronze: text as delivered. Contract shop_sales_notes version 1.')""",
)
def publication_told(spark, sf_dir):
    """What a publication leaves behind to be read: comments, evidence, load times, totals."""
    store = new_store(spark)
    lines = from_sql(spark, sf_dir, NOTED).select(F.col("line").alias("value"), F.lit("notes").alias("source_part"))
    folder = write_once(spark, sf_dir, "notes", lines)
    part = spark.createDataFrame([("source_part=notes", f"{folder}/source_part=notes")], "part string, path string")
    publish_bronze(store, NOTES, PERIOD, part, folder, "notes-1")
    publish_silver(store, NOTES, PERIOD)
    silver, bronze = (f"{layer}.{NOTES.identifier}" for layer in (store.silver, store.bronze))
    listed = [("comment", f.name, f.metadata.get("comment")) for f in spark.table(silver).schema]
    listed += [("table", n, spark.catalog.getTable(t).description) for n, t in (("silver", silver), ("bronze", bronze))]
    told = spark.createDataFrame(listed, "what string, name string, told string")
    kept = spark.table(store.quarantine)
    log = spark.table(store.run_log).where("finalizado_em IS NOT NULL")
    evidence = kept.select(
        F.lit("evidence"), F.substring_index("registro", ";", 1), F.get_json_object("motivos", "$[0].valor")
    )
    rows = log.select(
        F.lit("rows"), "tipo", F.format_string("%d = %d + %d", "linhas_origem", "linhas_publicadas", "linhas_quarentena")
    )
    inside = F.col("registrado_em").between(F.col("iniciado_em"), F.col("finalizado_em"))
    times = kept.join(log.select("id_execucao", "iniciado_em", "finalizado_em"), "id_execucao").select(
        F.lit("load time"), F.lit("quarantine"), F.when(inside, "within its run").otherwise("outside its run")
    )
    return told.union(evidence).union(rows).union(times)
