"""Queries over published tables: references, schema changes, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagate.operators import references, schema, upsert
from stratagate.workload.contracts import CUSTOMERS
from stratagate.workload.inputs import from_sql, table
from stratagate.workload.registry import query

# ---------------------------------------------------------- references


def _supplied(spark, sf_dir):
    used = table(spark, sf_dir, "lineitem").select("l_suppkey")
    official = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select("s_suppkey")
    return used, official


@query(
    "orphans",
    """SELECT DISTINCT l_suppkey AS value FROM lineitem
       WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
)
def orphans(spark, sf_dir):
    return references.orphans(*_supplied(spark, sf_dir))


@query(
    "orphan_count",
    """SELECT count(DISTINCT l_suppkey) AS orphans FROM lineitem
       WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
)
def orphan_count(spark, sf_dir):
    found = references.orphans(*_supplied(spark, sf_dir))
    return found.agg(F.count(F.lit(1)).alias("orphans"))


@query(
    "orphan_examples",
    """SELECT DISTINCT l_suppkey AS value FROM lineitem
       WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) ORDER BY 1 LIMIT 10""",
)
def orphan_examples(spark, sf_dir):
    return references.orphan_examples(*_supplied(spark, sf_dir))


@query(
    "reference_diagnosis",
    """
    WITH a AS (SELECT DISTINCT c_nationkey AS value FROM customer
               WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)),
         b AS (SELECT DISTINCT c_mktsegment AS value FROM customer
               WHERE c_mktsegment NOT IN (SELECT p_brand FROM part))
    SELECT 'c_nationkey' AS coluna, 'shop_sales_nations' AS referencia, 'n_nationkey' AS coluna_referenciada,
           count(*) AS orfaos_distintos, coalesce((SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT CAST(value AS STRING) AS s FROM a ORDER BY value LIMIT 10)), '') AS exemplos,
           CASE WHEN count(*) = 0 THEN 'CONFERIDA' ELSE 'COM_ORFAOS' END AS resultado FROM a
    UNION ALL
    SELECT 'c_mktsegment', 'shop_sales_brands', 'p_brand', count(*),
           (SELECT string_agg(value, ',' ORDER BY value) FROM (SELECT value FROM b ORDER BY value LIMIT 10)), 'COM_ORFAOS' FROM b
    UNION ALL SELECT 'c_name', 'shop_sales_names', 'name', NULL, NULL, 'REFERENCIA_AUSENTE'
    """,
)
def reference_diagnosis(spark, sf_dir):
    tables = {
        "shop_sales_nations": table(spark, sf_dir, "nation").where("n_regionkey <> 2"),
        "shop_sales_brands": table(spark, sf_dir, "part"),
    }
    found = references.diagnose(table(spark, sf_dir, "customer"), CUSTOMERS, tables)
    return found.withColumn("exemplos", F.array_join("exemplos", ","))


RESULTS = """
SELECT c_nationkey AS entity, CASE WHEN c_acctbal > 9990 THEN 'REFERENCIA_AUSENTE'
       WHEN c_acctbal < -900 THEN 'COM_ORFAOS' ELSE 'CONFERIDA' END AS resultado FROM customer
"""


@query(
    "reference_verdict",
    f"""SELECT entity, CASE max(CASE resultado WHEN 'CONFERIDA' THEN 0 WHEN 'COM_ORFAOS' THEN 1 ELSE 2 END)
               WHEN 0 THEN 'CONFERIDA' WHEN 1 THEN 'COM_ORFAOS' ELSE 'REFERENCIA_AUSENTE' END AS resultado
        FROM ({RESULTS}) GROUP BY entity""",
)
def reference_verdict(spark, sf_dir):
    return references.verdict(from_sql(spark, sf_dir, RESULTS), "entity")


# ------------------------------------------------------- schema changes

# A table per nation: its columns are the market segments its customers are in.
COLUMNS = """
SELECT CAST(c_nationkey AS STRING) AS entity, c_mktsegment AS name,
       CASE WHEN count(*) % 2 = 0 THEN 'string' ELSE 'int' END AS type,
       CAST(rank() OVER (PARTITION BY c_nationkey ORDER BY count(*), c_mktsegment) AS INTEGER) AS pos
FROM customer WHERE CONDITION GROUP BY c_nationkey, c_mktsegment
"""
CURRENT = COLUMNS.replace("CONDITION", "c_acctbal < 7000 AND (c_acctbal < 3000 OR c_mktsegment <> 'BUILDING' OR c_nationkey > 9)")
PLANNED = COLUMNS.replace("CONDITION", "c_acctbal > -500 AND (c_mktsegment <> 'MACHINERY' OR c_nationkey < 15)")

DIFF = f"""
WITH current_ AS ({CURRENT}), planned AS ({PLANNED}),
common AS (SELECT c.entity, c.name, rank() OVER (PARTITION BY c.entity ORDER BY c.pos) AS a,
                  rank() OVER (PARTITION BY c.entity ORDER BY p.pos) AS b
           FROM current_ c JOIN planned p ON p.entity = c.entity AND p.name = c.name),
diff AS (
  SELECT entity, 'added' AS change, name FROM planned p WHERE NOT EXISTS (SELECT 1 FROM current_ c WHERE c.entity = p.entity AND c.name = p.name)
  UNION ALL SELECT entity, 'removed', name FROM current_ c WHERE NOT EXISTS (SELECT 1 FROM planned p WHERE c.entity = p.entity AND c.name = p.name)
  UNION ALL SELECT c.entity, 'retyped', c.name FROM current_ c JOIN planned p ON p.entity = c.entity AND p.name = c.name WHERE c.type <> p.type
  UNION ALL SELECT DISTINCT entity, 'reordered', NULL FROM common WHERE a <> b)
"""

VERSIONS = """
SELECT CAST(c_nationkey AS STRING) AS entity, CAST(count(*) % 3 AS INTEGER) AS version,
       CASE WHEN count(*) % 4 > 0 THEN CAST(1 AS INTEGER) END AS published FROM customer GROUP BY c_nationkey
"""


def _diff(spark, sf_dir):
    return schema.schema_diff(
        from_sql(spark, sf_dir, CURRENT), from_sql(spark, sf_dir, PLANNED)
    )


@query("schema_diff", DIFF + "SELECT entity, change, name FROM diff")
def schema_diff(spark, sf_dir):
    return _diff(spark, sf_dir)


@query(
    "chk_schema_change",
    DIFF
    + f"""SELECT 'schema_change' AS "check", entity AS subject,
                 CAST(count(*) AS STRING) || ' schema changes without a version above ' ||
                 coalesce(CAST(any_value(published) AS STRING), 'none') AS problem
          FROM diff JOIN ({VERSIONS}) USING (entity)
          WHERE published IS NULL OR version <= published GROUP BY entity""",
)
def chk_schema_change(spark, sf_dir):
    return schema.schema_change(_diff(spark, sf_dir), from_sql(spark, sf_dir, VERSIONS))


# --------------------------------------------------------------- upserts

INCOMING = """
SELECT c_custkey, c_name || '*' AS c_name, c_nationkey + 100 AS c_nationkey, c_acctbal * 2 AS c_acctbal, 'NEW' AS c_mktsegment
FROM customer WHERE c_acctbal > 5000
UNION ALL
SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier
"""


@query(
    "upsert_subset",
    f"""
    SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(t.c_name, s.c_name) AS c_name,
           CASE WHEN s.c_custkey IS NOT NULL THEN s.c_nationkey ELSE t.c_nationkey END AS c_nationkey,
           CASE WHEN s.c_custkey IS NOT NULL THEN s.c_acctbal ELSE t.c_acctbal END AS c_acctbal,
           coalesce(t.c_mktsegment, s.c_mktsegment) AS c_mktsegment
    FROM customer t FULL JOIN ({INCOMING}) s ON t.c_custkey = s.c_custkey
    """,
)
def upsert_subset(spark, sf_dir):
    return upsert.upsert(
        table(spark, sf_dir, "customer"),
        from_sql(spark, sf_dir, INCOMING),
        ["c_custkey"],
        ["c_nationkey", "c_acctbal"],
    )


# Orders delivered twice under one key.
DOUBLED = """
SELECT o_orderkey, o_totalprice FROM orders
UNION ALL SELECT o_orderkey, o_totalprice + 1 FROM orders WHERE o_orderkey % 71 = 0
"""


@query(
    "chk_upsert_source",
    f"""
    SELECT 'upsert_source' AS "check", 'orders' AS subject,
           'key {{"o_orderkey":' || CAST(o_orderkey AS STRING) || '}} in ' || CAST(count(*) AS STRING)
             || ' source rows' AS problem
    FROM ({DOUBLED}) GROUP BY o_orderkey HAVING count(*) > 1
    """,
)
def chk_upsert_source(spark, sf_dir):
    return upsert.doubled_source(from_sql(spark, sf_dir, DOUBLED), ["o_orderkey"], "orders")


# A catalogue of columns: one entry per part, curated for the large ones.
CURATED = """
SELECT 'silver.' || lower(replace(p_brand, '#', '_')) AS ativo, p_name || ' ' || CAST(p_partkey AS STRING) AS coluna,
       CAST(p_size AS INTEGER) AS ordem, 'string' AS tipo, p_size > 10 AS nulavel, false AS chave, p_type AS dominio,
       CAST(NULL AS STRING) AS descricao,
       CASE WHEN p_size > 40 THEN 'kept by ' || p_type ELSE 'A_CONFIRMAR' END AS descricao_organizacional
FROM part WHERE p_retailprice < 1500
"""
DESCRIBED = """
SELECT 'silver.' || lower(replace(p_brand, '#', '_')) AS ativo, p_name || ' ' || CAST(p_partkey AS STRING) AS coluna,
       CAST(p_size + 1 AS INTEGER) AS ordem, 'int' AS tipo, true AS nulavel, true AS chave, p_type AS dominio,
       'about ' || p_name AS descricao
FROM part WHERE p_retailprice > 1000
"""


@query(
    "catalog_sync",
    f"""
    SELECT coalesce(t.ativo, s.ativo) AS ativo, coalesce(t.coluna, s.coluna) AS coluna,
           coalesce(s.ordem, t.ordem) AS ordem, coalesce(s.tipo, t.tipo) AS tipo,
           coalesce(s.nulavel, t.nulavel) AS nulavel, coalesce(s.chave, t.chave) AS chave,
           coalesce(s.dominio, t.dominio) AS dominio,
           CASE WHEN s.ativo IS NOT NULL THEN s.descricao ELSE t.descricao END AS descricao,
           coalesce(t.descricao_organizacional, 'A_CONFIRMAR') AS descricao_organizacional
    FROM ({CURATED}) t FULL JOIN ({DESCRIBED}) s ON t.ativo = s.ativo AND t.coluna = s.coluna
    """,
)
def catalog_sync(spark, sf_dir) -> DataFrame:
    return upsert.catalog_sync(
        "catalogo_colunas",
        from_sql(spark, sf_dir, CURATED),
        from_sql(spark, sf_dir, DESCRIBED),
    )
