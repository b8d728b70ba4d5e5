"""Run-log queries over a log derived from orders: one run per order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.operators import checks, runlog
from stratagate.workload.inputs import from_sql, table
from stratagate.workload.registry import query

RUNS = """
SELECT 'run-' || CAST(k AS STRING) AS id_execucao, 'shop_' || CAST(o_custkey AS STRING) AS identificador,
       CASE p WHEN '1' THEN 'AQUISICAO' WHEN '2' THEN 'INSPECAO' WHEN '3' THEN 'BRONZE'
              WHEN '4' THEN 'SILVER' ELSE 'APROVACAO' END AS tipo,
       CASE WHEN k % 13 = 0 THEN 'FALHA' WHEN k % 11 = 0 THEN 'BLOQUEADA' WHEN k % 17 = 0 THEN 'EM_EXECUCAO'
            WHEN o_orderstatus = 'F' THEN 'SUCESSO_COM_ALERTA' ELSE 'SUCESSO' END AS status,
       CASE WHEN k % 59 = 0 THEN '2026-13' WHEN k % 53 = 0 THEN NULL
            ELSE substring(CAST(o_orderdate AS STRING), 1, 7) END AS competencia,
       CAST(1 + k % 3 AS INTEGER) AS versao_contrato,
       CASE k % 4 WHEN 0 THEN 'PROVISORIO_DOCUMENTAL' WHEN 1 THEN 'VALIDADO_FISICO'
                  WHEN 2 THEN 'APROVADO' ELSE 'OBSOLETO' END AS estado_contrato,
       'h' || CAST(k % 2 AS STRING) AS hash_leitura, 'c' || CAST(k % 5 AS STRING) AS hash_contrato,
       'run-' || CAST(k - k % 7 AS STRING) AS id_execucao_origem,
       k AS linhas_origem, k - k % 10 AS linhas_publicadas,
       CASE WHEN k % 17 = 0 THEN k % 10 + 1 ELSE k % 10 END AS linhas_quarentena,
       CASE WHEN p = '1' THEN CASE WHEN k % 3 = 0 THEN 'EXISTENTE' ELSE 'ADQUIRIDA' END
            WHEN p = '2' THEN CASE WHEN k % 3 = 0 THEN 'INCOMPATIVEL' ELSE 'COMPATIVEL' END
            WHEN p = '5' THEN 'APROVADA' END AS resultado,
       '{"total_declarado": ' || CAST(k AS STRING) || '}' AS detalhes,
       o_orderdate AS iniciado_em,
       CASE WHEN k % 29 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END AS finalizado_em
FROM (SELECT *, o_orderkey AS k, substring(o_orderpriority, 1, 1) AS p FROM orders)
"""

CTE = f"""WITH runs AS ({RUNS}),
effective AS (SELECT * FROM runs WHERE status IN ('SUCESSO', 'SUCESSO_COM_ALERTA')),
latest AS (SELECT * FROM effective QUALIFY row_number() OVER (PARTITION BY identificador, tipo
           ORDER BY coalesce(finalizado_em, iniciado_em) DESC, id_execucao DESC) = 1)
"""


def runs(spark, sf_dir) -> DataFrame:
    return from_sql(spark, sf_dir, RUNS)


@query(
    "latest_effective",
    CTE + "SELECT identificador, tipo, id_execucao, competencia FROM latest",
)
def latest_effective(spark, sf_dir):
    return runlog.latest_effective(runs(spark, sf_dir)).select(
        "identificador", "tipo", "id_execucao", "competencia"
    )


@query(
    "latest_acquisition",
    CTE
    + """SELECT identificador, competencia, id_execucao FROM effective
         WHERE tipo = 'AQUISICAO' AND resultado = 'ADQUIRIDA'
         QUALIFY row_number() OVER (PARTITION BY identificador, competencia
                 ORDER BY coalesce(finalizado_em, iniciado_em) DESC, id_execucao DESC) = 1""",
)
def latest_acquisition(spark, sf_dir):
    return runlog.latest_acquisition(runs(spark, sf_dir)).select(
        "identificador", "competencia", "id_execucao"
    )


@query(
    "current_runs",
    CTE + "SELECT id_execucao, status, finalizado_em IS NULL AS open_ended FROM runs",
)
def current_runs(spark, sf_dir):
    """Start and end rows of every run; a run that never ended has only its start."""
    logged = runs(spark, sf_dir)
    started = logged.where("finalizado_em IS NOT NULL").withColumns(
        {"status": F.lit(v.RUNNING), "finalizado_em": F.lit(None).cast("timestamp")}
    )
    present = runlog.current(started.unionByName(logged))
    return present.select("id_execucao", "status", F.col("finalizado_em").isNull().alias("open_ended"))


@query(
    "runs_newest_first",
    CTE
    + """SELECT identificador, tipo, id_execucao FROM runs
         ORDER BY coalesce(finalizado_em, iniciado_em) DESC, id_execucao DESC""",
)
def runs_newest_first(spark, sf_dir):
    return runlog.newest_first(runs(spark, sf_dir)).select(
        "identificador", "tipo", "id_execucao"
    )


@query(
    "runs_by_status",
    CTE + "SELECT tipo, status, count(*) AS execucoes FROM runs GROUP BY ALL",
)
def runs_by_status(spark, sf_dir):
    return runlog.by_type_and_status(runs(spark, sf_dir))


@query(
    "evidence_sets",
    CTE
    + """SELECT DISTINCT 'inspection' AS kind, identificador, hash_leitura AS hash FROM effective
         WHERE tipo = 'INSPECAO' AND resultado = 'COMPATIVEL'
         UNION ALL SELECT DISTINCT 'approval', identificador, hash_contrato FROM effective
         WHERE tipo = 'APROVACAO' AND resultado = 'APROVADA'""",
)
def evidence_sets(spark, sf_dir):
    log = runs(spark, sf_dir)
    inspected = runlog.compatible_inspections(log).toDF("identificador", "hash")
    approved = runlog.approvals(log).toDF("identificador", "hash")
    return inspected.select(F.lit("inspection").alias("kind"), "*").union(
        approved.select(F.lit("approval"), "*")
    )


@query(
    "version_hashes",
    CTE
    + """SELECT identificador, versao_contrato, string_agg(DISTINCT hash_contrato, ',' ORDER BY hash_contrato) AS hashes
         FROM effective WHERE tipo IN ('BRONZE', 'SILVER') GROUP BY ALL""",
)
def version_hashes(spark, sf_dir):
    return checks.version_hashes(runs(spark, sf_dir)).withColumn(
        "hashes", F.array_join("hashes", ",")
    )


@query(
    "provenance",
    CTE
    + """SELECT s.identificador, s.id_execucao_origem, b.id_execucao AS bronze_execucao, b.hash_leitura AS bronze_hash_leitura
         FROM effective s JOIN runs b ON b.id_execucao = s.id_execucao_origem WHERE s.tipo = 'SILVER'""",
)
def provenance(spark, sf_dir):
    return runlog.silver_provenance(runs(spark, sf_dir))


@query(
    "json_detail",
    """SELECT event_id, regexp_extract(props, '"k": ([0-9]+)', 1) AS k FROM events""",
)
def json_detail(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k")
    )


@query(
    "run_detail",
    CTE
    + "SELECT identificador, id_execucao, CAST(linhas_origem AS STRING) AS total_declarado FROM runs",
)
def run_detail(spark, sf_dir):
    return runlog.detail(runs(spark, sf_dir), "total_declarado")


@query(
    "period_valid",
    CTE
    + """SELECT id_execucao, competencia,
                coalesce(regexp_full_match(competencia, '[0-9]{4}-(0[1-9]|1[0-2])'), false) AS valid FROM runs""",
)
def period_valid(spark, sf_dir):
    return runs(spark, sf_dir).select(
        "id_execucao",
        "competencia",
        checks.period_valid(F.col("competencia")).alias("valid"),
    )


# -------------------------------------------------------- governance

# What each customer asks to publish next.
REQUESTS = """
SELECT 'shop_' || CAST(c_custkey AS STRING) AS identificador,
       CASE WHEN c_nationkey % 2 = 0 THEN 'BRONZE' ELSE 'SILVER' END AS tipo,
       '199' || CAST(c_nationkey % 10 AS STRING) || '-06' AS competencia,
       CAST(1 + c_custkey % 3 AS INTEGER) AS versao_contrato,
       CASE c_nationkey % 4 WHEN 0 THEN 'PROVISORIO_DOCUMENTAL' WHEN 1 THEN 'VALIDADO_FISICO'
            WHEN 2 THEN 'APROVADO' ELSE 'OBSOLETO' END AS estado_contrato,
       'h' || CAST(c_custkey % 2 AS STRING) AS hash_leitura,
       'c' || CAST(c_custkey % 5 AS STRING) AS hash_contrato
FROM customer
"""

ASKED = CTE + f", requests AS ({REQUESTS}) "


def requests(spark, sf_dir) -> DataFrame:
    return from_sql(spark, sf_dir, REQUESTS)


@query(
    "chk_reconciliation",
    CTE
    + """SELECT 'reconciliation' AS "check", id_execucao AS subject,
                'source ' || CAST(linhas_origem AS STRING) || ', published ' || CAST(linhas_publicadas AS STRING) ||
                ', quarantined ' || CAST(linhas_quarentena AS STRING) AS problem
         FROM runs WHERE linhas_origem <> linhas_publicadas + linhas_quarentena""",
)
def chk_reconciliation(spark, sf_dir):
    return checks.reconciliation(runs(spark, sf_dir))


@query(
    "chk_period",
    ASKED
    + """SELECT 'period' AS "check", identificador AS subject,
                r.competencia || ' is before ' || l.competencia AS problem
         FROM requests r JOIN latest l USING (identificador, tipo) WHERE r.competencia < l.competencia""",
)
def chk_period(spark, sf_dir):
    log, asked = runs(spark, sf_dir), requests(spark, sf_dir)
    allowed = checks.period(asked, log, allow_earlier=True)
    return allowed.union(checks.period(asked, log, allow_earlier=False))


@query(
    "chk_version",
    ASKED
    + """SELECT DISTINCT 'version' AS "check", r.identificador AS subject,
                'version ' || CAST(r.versao_contrato AS STRING) || ' was published with another hash' AS problem
         FROM requests r JOIN effective e ON e.identificador = r.identificador AND e.versao_contrato = r.versao_contrato
         WHERE e.tipo IN ('BRONZE', 'SILVER') AND e.hash_contrato <> r.hash_contrato""",
)
def chk_version(spark, sf_dir):
    return checks.version(requests(spark, sf_dir), runs(spark, sf_dir))


@query(
    "chk_provenance",
    ASKED
    + """, b AS (SELECT identificador, id_execucao, competencia, hash_leitura FROM latest WHERE tipo = 'BRONZE'),
    both_ AS (SELECT r.identificador, b.id_execucao, r.competencia, r.hash_leitura, b.competencia AS bc, b.hash_leitura AS bh
              FROM requests r LEFT JOIN b USING (identificador))
    SELECT 'provenance' AS "check", identificador AS subject, 'no effective Bronze' AS problem FROM both_ WHERE bh IS NULL
    UNION ALL SELECT 'provenance', identificador, 'Bronze is of ' || coalesce(bc, 'no period') FROM both_
              WHERE bh IS NOT NULL AND (bc IS NULL OR bc <> competencia)
    UNION ALL SELECT 'provenance', identificador, 'Bronze was read under another hash' FROM both_ WHERE bh <> hash_leitura""",
)
def chk_provenance(spark, sf_dir):
    return checks.provenance(requests(spark, sf_dir), runs(spark, sf_dir))


@query(
    "chk_evidence",
    ASKED
    + """, inspected AS (SELECT DISTINCT identificador, hash_leitura FROM effective WHERE tipo = 'INSPECAO' AND resultado = 'COMPATIVEL'),
    approved AS (SELECT DISTINCT identificador, hash_contrato FROM effective WHERE tipo = 'APROVACAO' AND resultado = 'APROVADA')
    SELECT 'evidence' AS "check", identificador AS subject, 'obsolete contract' AS problem FROM requests WHERE estado_contrato = 'OBSOLETO'
    UNION ALL SELECT 'evidence', identificador, 'no compatible inspection for this read hash' FROM requests r
      WHERE estado_contrato IN ('VALIDADO_FISICO', 'APROVADO') AND NOT EXISTS
        (SELECT 1 FROM inspected i WHERE i.identificador = r.identificador AND i.hash_leitura = r.hash_leitura)
    UNION ALL SELECT 'evidence', identificador, 'no approval for this contract hash' FROM requests r
      WHERE estado_contrato = 'APROVADO' AND NOT EXISTS
        (SELECT 1 FROM approved a WHERE a.identificador = r.identificador AND a.hash_contrato = r.hash_contrato)""",
)
def chk_evidence(spark, sf_dir):
    return checks.evidence(requests(spark, sf_dir), runs(spark, sf_dir))
