"""Manifest queries: the parts of a publication, one per month of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagate.operators import checks
from stratagate.sources import landing
from stratagate.workload.inputs import from_sql
from stratagate.workload.registry import query

# Files landed: a part per month, its hash over counts and keys of its rows.
MANIFEST = """
SELECT period, 'K' || replace(month, '-', '') || suffix AS part,
       '/landing/' || period || '/K' || replace(month, '-', '') || suffix AS path,
       SUM_BYTES AS bytes, SHA(CAST(n AS STRING) || ':' || CAST(keys AS STRING)) AS sha256
FROM (
  SELECT substring(day, 1, 4) AS period, substring(day, 1, 7) AS month,
         CASE WHEN CAST(substring(day, 6, 2) AS INTEGER) % 3 = 0 THEN '.EmpreCsv'
              WHEN CAST(substring(day, 6, 2) AS INTEGER) % 3 = 1 THEN '.SIMPLES.CSV.zip' ELSE '.sociocsv' END AS suffix,
         count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(sum(length(o_orderpriority)) AS BIGINT) AS size
  FROM (SELECT *, CAST(o_orderdate AS STRING) AS day FROM orders WHERE CONDITION)
  GROUP BY 1, 2, 3)
""".replace("SUM_BYTES", "size")

# Parts the publisher lists: a part per month of shipped items.
SHIPPED_PARTS = """
SELECT DISTINCT 'K' || replace(substring(CAST(l_shipdate AS STRING), 1, 7), '-', '') ||
       CASE WHEN month(l_shipdate) % 3 = 0 THEN '.EmpreCsv' WHEN month(l_shipdate) % 3 = 1
            THEN '.SIMPLES.CSV.zip' ELSE '.sociocsv' END AS part FROM lineitem
"""


def manifest_sql(condition: str = "true") -> str:
    return MANIFEST.replace("CONDITION", condition).replace("SHA(", "sha256(")


def manifest(spark, sf_dir, condition: str = "true") -> DataFrame:
    text = MANIFEST.replace("CONDITION", condition)
    made = from_sql(spark, sf_dir, text.replace("SHA(", "concat('', ").replace("AS sha256", "AS told"))
    return made.select(
        "period", "part", "path", "bytes", F.sha2("told", 256).alias("sha256")
    )


@query(
    "select_parts",
    f"""SELECT 'first' AS selection, part, path, bytes, sha256 FROM ({manifest_sql()})
        WHERE regexp_matches(lower(part), '^.*[.]emprecsv$')
        UNION ALL SELECT 'second', part, path, bytes, sha256 FROM ({manifest_sql()})
        WHERE regexp_matches(lower(part), '^k199[0-5]..[.]simples[.]csv.*$')""",
)
def select_parts(spark, sf_dir):
    files = manifest(spark, sf_dir)
    shown = ("selection", "part", "path", "bytes", "sha256")
    first = landing.select_parts(files, "*.EMPRECSV").withColumn("selection", F.lit("first"))
    second = landing.select_parts(files, "K199[0-5]??.SIMPLES.CSV*").withColumn(
        "selection", F.lit("second")
    )
    return first.select(*shown).union(second.select(*shown))


@query(
    "publication_fingerprint",
    f"""SELECT period, sha256(string_agg(part || '|' || sha256, chr(10) ORDER BY part, sha256)) AS publication_fingerprint
        FROM ({manifest_sql()}) GROUP BY period""",
)
def publication_fingerprint(spark, sf_dir):
    return landing.publication_fingerprint(manifest(spark, sf_dir), "period")


@query(
    "chk_part_count",
    f"""SELECT 'part_count' AS "check", 'companies' AS subject,
               CAST(count(*) AS STRING) || ' parts found, expected 3' AS problem
        FROM ({manifest_sql()}) WHERE lower(part) LIKE '%.emprecsv' HAVING count(*) <> 3
        UNION ALL SELECT 'part_count', 'countries', '0 parts found, expected at least 1'""",
)
def chk_part_count(spark, sf_dir):
    files = manifest(spark, sf_dir)
    return checks.all_problems(
        checks.part_count(landing.select_parts(files, "*.EMPRECSV"), 3, "companies"),
        checks.part_count(landing.select_parts(files, "*.PAISCSV"), None, "countries"),
        checks.part_count(landing.select_parts(files, "*.SOCIOCSV"), None, "partners"),
    )


@query(
    "unexpected_parts",
    f"""SELECT part FROM ({SHIPPED_PARTS}) EXCEPT SELECT part FROM ({manifest_sql()})""",
)
def unexpected_parts(spark, sf_dir):
    return checks.unexpected_parts(
        manifest(spark, sf_dir),
        from_sql(spark, sf_dir, SHIPPED_PARTS),
        manifest(spark, sf_dir, "o_totalprice > 1000"),
    )


@query(
    "chk_landed",
    f"""SELECT 'landed' AS "check", part AS subject, 'declared but not landed' AS problem
        FROM ({SHIPPED_PARTS}) WHERE part NOT IN (SELECT part FROM ({manifest_sql()}))
        UNION ALL SELECT 'landed', part, 'landed 2 times'
        FROM ({manifest_sql("o_totalprice > 499000")})""",
)
def chk_landed(spark, sf_dir):
    files = manifest(spark, sf_dir)
    again = manifest(spark, sf_dir, "o_totalprice > 499000")
    return checks.landed(from_sql(spark, sf_dir, SHIPPED_PARTS), files.union(again))


@query(
    "chk_relanded",
    f"""SELECT 'relanded' AS "check", a.part AS subject, 'content differs' AS problem
        FROM ({manifest_sql()}) a JOIN ({manifest_sql("o_totalprice <= 499000")}) b
        ON a.part = b.part WHERE a.sha256 <> b.sha256""",
)
def chk_relanded(spark, sf_dir):
    return checks.relanded(
        manifest(spark, sf_dir), manifest(spark, sf_dir, "o_totalprice <= 499000")
    )
