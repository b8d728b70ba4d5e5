"""Delivery queries: orders written as delimited files, then read back."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Contract, Dialect, Field
from stratagate.operators import checks, profile
from stratagate.session import new_folder
from stratagate.sources import delimited, landing
from stratagate.sources.delimited import LINE, PART
from stratagate.workload.contracts import DELIVERED
from stratagate.workload.inputs import from_sql, table
from stratagate.workload.registry import query

# One line per order: six fields, some lines short or long, some blank; part-1
# ends its lines with CRLF and part-2 mixes both terminators.
DELIVERY = """
SELECT p AS source_part, malformed,
       CASE WHEN malformed THEN NULL ELSE nullif(order_id, '') END AS order_id,
       CASE WHEN malformed THEN NULL ELSE cust_id END AS cust_id,
       CASE WHEN malformed THEN NULL ELSE status END AS status,
       CASE WHEN malformed THEN NULL ELSE amount END AS amount,
       CASE WHEN malformed THEN NULL ELSE order_date END AS order_date,
       CASE WHEN malformed THEN NULL ELSE nullif(note, '') END AS note,
       CASE WHEN k % 61 = 0 AND k % 4 <> 3 THEN order_id || ';' || cust_id
            WHEN k % 67 = 0 AND k % 4 <> 3 THEN order_id || ';' || cust_id || ';' || status || ';' || amount || ';' || order_date || ';' || quoted || ';extra'
            ELSE order_id || ';' || cust_id || ';' || status || ';' || amount || ';' || order_date || ';' || quoted END AS line,
       p = 'part-1' OR (p = 'part-2' AND k % 8 = 2) AS crlf
FROM (
  SELECT *, (k % 61 = 0 OR k % 67 = 0) AND k % 4 <> 3 AS malformed,
         CASE WHEN k % 7 = 0 THEN '"' || replace(note, '"', '""') || '"' ELSE note END AS quoted
  FROM (
    SELECT o_orderkey AS k, 'part-' || CAST(o_orderkey % 4 AS STRING) AS p,
           CASE WHEN o_orderkey % 79 = 0 THEN '' ELSE ' ' || CAST(o_orderkey AS STRING) || ' ' END AS order_id,
           CAST(o_custkey AS STRING) AS cust_id, lower(o_orderstatus) AS status,
           replace(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING), '.', ',') AS amount,
           CASE WHEN o_orderkey % 97 = 0 THEN '20261332'
                ELSE replace(substring(CAST(o_orderdate AS STRING), 1, 10), '-', '') END AS order_date,
           CASE WHEN o_orderkey % 7 = 0 THEN 'a;b "' || o_orderpriority || '"'
                WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority END AS note
    FROM orders))
"""

CTE = f"WITH delivery AS ({DELIVERY}) "

_written: dict[tuple[str, str, str], str] = {}


def write_once(spark: SparkSession, sf_dir: str, name: str, lines: DataFrame) -> str:
    """Write (value, source_part) as text files, one folder per part.

    Every task writes its share of a part, so no part passes one task.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        folder = new_folder(spark, name)
        lines.select("value", "source_part").write.partitionBy("source_part").text(folder)
        _written[key] = folder
    return _written[key]


def delivered(spark: SparkSession, sf_dir: str) -> str:
    made = from_sql(spark, sf_dir, DELIVERY)
    ended = F.when(F.col("crlf"), F.concat("line", F.lit("\r"))).otherwise(F.col("line"))
    lines = made.select(ended.alias("value"), "source_part")
    blank = made.where("malformed").select(F.lit("   ").alias("value"), "source_part")
    return write_once(spark, sf_dir, "delivery", lines.unionByName(blank))


def delivered_rows(spark, sf_dir) -> DataFrame:
    folder = delivered(spark, sf_dir)
    return delimited.scan_rows(spark, DELIVERED, folder, folder)


def delivered_lines(spark, sf_dir) -> DataFrame:
    folder = delivered(spark, sf_dir)
    return delimited.scan_lines(spark, folder, folder, split=True)


def part_name(part: str = PART):
    return F.replace(part, F.lit("source_part="), F.lit(""))


FIELDS = ("order_id", "cust_id", "status", "amount", "order_date", "note")


@query(
    "scan_csv_text",
    CTE
    + f"""SELECT {', '.join(FIELDS)}, CASE WHEN malformed THEN line END AS malformed_line,
                 source_part FROM delivery""",
)
def scan_csv_text(spark, sf_dir):
    rows = delivered_rows(spark, sf_dir)
    whole = F.col(LINE).isNull()
    return rows.select(
        *[F.when(whole, F.col(c)).alias(c) for c in FIELDS],
        F.col(LINE).alias("malformed_line"),
        part_name().alias("source_part"),
    )


@query(
    "malformed_split",
    CTE
    + """SELECT source_part, count(*) FILTER (NOT malformed) AS well_formed,
                count(*) FILTER (malformed) AS malformed,
                CAST(sum(length(line)) FILTER (malformed) AS BIGINT) AS malformed_chars
         FROM delivery GROUP BY source_part""",
)
def malformed_split(spark, sf_dir):
    rows = delivered_rows(spark, sf_dir)
    good = delimited.well_formed(rows).select(PART, F.lit(0).alias("chars"), F.lit(1).alias("ok"))
    bad = delimited.malformed(rows).select(PART, F.length(LINE), F.lit(0))
    return (
        good.union(bad)
        .groupBy(part_name().alias("source_part"))
        .agg(
            F.count_if(F.col("ok") == 1).alias("well_formed"),
            F.count_if(F.col("ok") == 0).alias("malformed"),
            F.sum(F.when(F.col("ok") == 0, F.col("chars").cast("bigint"))).alias("malformed_chars"),
        )
    )


@query(
    "bronze_rows",
    CTE
    + f"""SELECT {', '.join(FIELDS)}, CAST(NULL AS STRING) AS legacy_code, '2026-09' AS competencia,
                 'source_part=' || source_part AS _arquivo_origem, 'run-1' AS _id_execucao
          FROM delivery WHERE NOT malformed""",
)
def bronze_rows(spark, sf_dir):
    return delimited.bronze_rows(delivered_rows(spark, sf_dir), DELIVERED, "2026-09", "run-1")


@query(
    "physical_lines",
    CTE + "SELECT source_part, line FROM delivery",
)
def physical_lines(spark, sf_dir):
    return delivered_lines(spark, sf_dir).select(
        part_name().alias("source_part"), F.col("value").alias("line")
    )


@query(
    "part_counts",
    CTE
    + """SELECT 'source_part=' || source_part AS part, count(*) AS read,
                count(*) FILTER (malformed) AS malformed FROM delivery GROUP BY source_part""",
)
def part_counts(spark, sf_dir):
    return delimited.part_counts(delivered_rows(spark, sf_dir))


@query(
    "physical_counts",
    CTE
    + """SELECT 'source_part=' || source_part AS part, count(*) AS physical
         FROM delivery GROUP BY source_part""",
)
def physical_counts(spark, sf_dir):
    return delimited.physical_counts(delivered_lines(spark, sf_dir))


@query(
    "source_rows",
    CTE
    + """SELECT CAST(sum(n - 1) AS BIGINT) AS source_rows
         FROM (SELECT count(*) AS n FROM delivery GROUP BY source_part)""",
)
def source_rows(spark, sf_dir):
    counts = delimited.physical_counts(delivered_lines(spark, sf_dir))
    return delimited.source_rows(counts, header=True)


@query(
    "landing_manifest",
    CTE
    + """SELECT source_part,
                CAST(sum(length(line) + CASE WHEN crlf THEN 2 ELSE 1 END + CASE WHEN malformed THEN 4 ELSE 0 END) AS BIGINT) AS bytes,
                true AS all_hashed
         FROM delivery GROUP BY source_part""",
)
def landing_manifest(spark, sf_dir):
    folder = delivered(spark, sf_dir)
    files = landing.landing_manifest(spark, folder, folder)
    return (
        files.where(F.col("part").contains("source_part="))
        .groupBy(F.regexp_extract("part", "^source_part=([^/]+)/", 1).alias("source_part"))
        .agg(
            F.sum("bytes").alias("bytes"),
            F.bool_and(F.length("sha256") == 64).alias("all_hashed"),
        )
    )


LANDED = """
SELECT o_orderkey AS k, 'bucket-' || CAST(CAST(floor(o_orderkey / 5000) AS BIGINT) AS STRING) AS source_part,
       CAST(o_orderkey AS STRING) || ';' || o_orderstatus || ';' || o_orderpriority || ';"é"'
       || CASE WHEN o_orderkey % 3 = 0 THEN ';' ELSE '' END
       || CASE WHEN floor(o_orderkey / 5000) % 2 = 1 THEN chr(13) ELSE '' END AS value
FROM orders
"""


@query(
    "landed_digests",
    f"""SELECT source_part, CAST(sum(octet_length(encode(value)) + 1) AS BIGINT) AS bytes,
               sha256(string_agg(value || chr(10), '' ORDER BY k)) AS sha256
        FROM ({LANDED}) GROUP BY source_part""",
)
def landed_digests(spark, sf_dir):
    """Size and hash of files in a known order, one per range of orders."""
    lines = from_sql(spark, sf_dir, LANDED)
    folder = new_folder(spark, "landed")
    lines.repartition("source_part").sortWithinPartitions("source_part", "k").select(
        "value", "source_part"
    ).write.partitionBy("source_part").text(folder)
    files = landing.landing_manifest(spark, folder, folder)
    return files.select(
        F.regexp_extract("part", "^source_part=([^/]+)/part-", 1).alias("source_part"), "bytes", "sha256"
    ).where("source_part <> ''")


# ---------------------------------------------------------- totals


TOTALS = Contract(
    "shop", "sales", "totals", fields=(Field("orders_total"), Field("parts_total")),
    dialect=Dialect(separator=",", header=False), split_parts=True,
)


def totals_rows(spark, sf_dir) -> DataFrame:
    """The source's own totals file, one row off what it delivers."""
    total = from_sql(spark, sf_dir, DELIVERY).agg(
        F.concat_ws(
            ",", F.count(F.lit(1)) + 1, F.count_distinct("source_part")
        ).alias("value")
    )
    folder = write_once(
        spark, sf_dir, "totals", total.withColumn("source_part", F.lit("totals"))
    )
    return delimited.scan_rows(spark, TOTALS, folder, folder)


@query("declared_total", "SELECT count(*) + 1 AS declared_total FROM orders")
def declared_total(spark, sf_dir):
    return checks.total_from_file(totals_rows(spark, sf_dir), "orders_total")


# ---------------------------------------------------------- checks


def contracted(spark, sf_dir) -> DataFrame:
    """Parts the contract selects: two delivered, one never delivered."""
    parts = from_sql(
        spark,
        sf_dir,
        "SELECT DISTINCT 'source_part=part-' || CAST(o_orderkey % 4 + 2 AS STRING) AS part FROM orders",
    )
    return parts.where("part <> 'source_part=part-5'")


@query(
    "chk_parts",
    CTE
    + """, counts AS (SELECT 'source_part=' || source_part AS part, count(*) AS n FROM delivery GROUP BY 1)
    SELECT 'parts' AS "check", part AS subject,
           CASE WHEN part IN ('source_part=part-2', 'source_part=part-3')
                THEN CAST(n - 1 AS STRING) || ' physical lines, ' || CAST(n AS STRING) || ' rows read'
                ELSE 'not a contracted part' END AS problem FROM counts
    UNION ALL SELECT 'parts', 'source_part=part-4', 'no valid row'
    """,
)
def chk_parts(spark, sf_dir):
    """A header is expected here and the files have none, so counts are one off."""
    return checks.parts(
        contracted(spark, sf_dir),
        delimited.physical_counts(delivered_lines(spark, sf_dir)),
        delimited.part_counts(delivered_rows(spark, sf_dir)),
        has_header=True,
    )


@query(
    "chk_tolerance",
    CTE
    + """SELECT 'tolerance' AS "check", 'orders' AS subject,
                CAST(count(*) FILTER (malformed) AS STRING) || ' of ' || CAST(count(*) AS STRING) || ' lines malformed' AS problem
         FROM delivery HAVING count(*) FILTER (malformed) / count(*) > 0.001""",
)
def chk_tolerance(spark, sf_dir):
    read = delimited.part_counts(delivered_rows(spark, sf_dir))
    within = checks.tolerance(read, 0.9, "orders")
    return within.union(checks.tolerance(read, 0.001, "orders"))


@query(
    "chk_malformed_blocks",
    CTE
    + """SELECT 'malformed_blocks' AS "check", 'orders' AS subject,
                CAST(count(*) FILTER (malformed) AS STRING) || ' malformed lines under a blocking action' AS problem
         FROM delivery""",
)
def chk_malformed_blocks(spark, sf_dir):
    read = delimited.part_counts(delivered_rows(spark, sf_dir))
    passed = checks.malformed_blocks(read, v.QUARANTINE, "orders")
    return passed.union(checks.malformed_blocks(read, v.BLOCK, "orders"))


@query(
    "chk_declared_total",
    """SELECT 'declared_total' AS "check", 'orders' AS subject,
              'declared ' || CAST(count(*) + 1 AS STRING) || ', read ' || CAST(count(*) AS STRING) AS problem
       FROM orders""",
)
def chk_declared_total(spark, sf_dir):
    read = delimited.part_counts(delivered_rows(spark, sf_dir))
    declared = checks.total_from_file(totals_rows(spark, sf_dir), "orders_total")
    return checks.declared_total(read, declared, "orders")


HEADED = Contract(
    "shop",
    "sales",
    "headed",
    fields=(
        Field("order_id", header="ORDER"),
        Field("cust_id", header="CUSTOMER", aliases=("CLIENT",)),
        Field("status", header="STATUS"),
    ),
    dialect=Dialect(header=True),
)

# A header per market segment; each segment spoils it in its own way.
HEADERS = """
SELECT c_mktsegment AS source_part,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'ORDER;CLIENT;STATUS'
            WHEN 'BUILDING' THEN ' ORDER ;"STATUS";CUSTOMER'
            WHEN 'FURNITURE' THEN 'ORDER;CUSTOMER'
            WHEN 'MACHINERY' THEN 'ORDER;CUSTOMER;STATUS;"a;b"'
            ELSE 'ORDER;CUSTOMER;STATE' END AS header,
       CAST(c_custkey AS STRING) || ';' || CAST(c_nationkey AS STRING) || ';x' AS line
FROM customer
"""


def headed_first_lines(spark, sf_dir) -> DataFrame:
    """First line of each part; every file of a part opens with the header."""
    made = from_sql(spark, sf_dir, HEADERS)
    folder = write_once(
        spark,
        sf_dir,
        "headed",
        made.select(F.concat("header", F.lit("\n"), "line").alias("value"), "source_part"),
    )
    first = delimited.first_lines(spark, folder, folder)
    return first.select(
        F.regexp_extract(PART, "^source_part=([^/]+)/", 1).alias(PART), "value"
    ).distinct()


@query(
    "first_lines",
    f"SELECT DISTINCT source_part, header FROM ({HEADERS})",
)
def first_lines(spark, sf_dir):
    return headed_first_lines(spark, sf_dir).select(
        F.col(PART).alias("source_part"), F.col("value").alias("header")
    )


@query(
    "chk_header",
    f"""
    WITH found AS (SELECT DISTINCT source_part AS subject FROM ({HEADERS})),
    problems AS (SELECT * FROM (VALUES
      ('BUILDING', 'column STATUS at position 2, declared 3'), ('BUILDING', 'column CUSTOMER at position 3, declared 2'),
      ('FURNITURE', '2 columns, declared 3'), ('FURNITURE', 'missing column STATUS'),
      ('MACHINERY', '4 columns, declared 3'), ('MACHINERY', 'undeclared column a;b'),
      ('HOUSEHOLD', 'undeclared column STATE'), ('HOUSEHOLD', 'missing column STATUS')) AS t(subject, problem))
    SELECT 'header' AS "check", subject, problem FROM found JOIN problems USING (subject)
    """,
)
def chk_header(spark, sf_dir):
    return checks.header(headed_first_lines(spark, sf_dir), HEADED)


# ---------------------------------------------------------- profile


def delivered_bytes(spark, sf_dir) -> DataFrame:
    folder = delivered(spark, sf_dir)
    return profile.byte_lines(spark, folder, folder, split=True)


@query(
    "profile_terminator",
    CTE
    + """SELECT source_part,
                CASE WHEN bool_or(crlf) AND (NOT bool_and(crlf) OR bool_or(malformed)) THEN 'mixed'
                     WHEN bool_or(crlf) THEN 'CRLF' ELSE 'LF' END AS terminator, false AS bom
         FROM delivery GROUP BY source_part""",
)
def profile_terminator(spark, sf_dir):
    return profile.terminators(delivered_bytes(spark, sf_dir)).select(
        part_name().alias("source_part"), "terminator", "bom"
    )


SEPARATOR_SQL = """,
counted AS (
  SELECT {by} AS part, m.pos, m.mark, length(line) - length(replace(line, m.mark, '')) AS n
  FROM {lines}, (VALUES (0, ';'), (1, ','), (2, '|'), (3, chr(9))) AS m(pos, mark)),
modes AS (SELECT part, pos, mark, n, count(*) AS lines FROM counted GROUP BY ALL),
stable AS (
  SELECT part, pos, mark, min(n) AS least, max(lines) AS lines FROM modes GROUP BY ALL HAVING min(n) > 0),
scored AS (
  SELECT s.part, s.pos, s.mark, s.lines, max(m.n) AS n FROM stable s
  JOIN modes m ON m.part = s.part AND m.pos = s.pos AND m.lines = s.lines GROUP BY ALL)
SELECT part, mark AS separator FROM scored
QUALIFY row_number() OVER (PARTITION BY part ORDER BY lines DESC, n DESC, pos) = 1
"""


@query(
    "profile_separator",
    CTE + SEPARATOR_SQL.format(by="source_part", lines="delivery"),
)
def profile_separator(spark, sf_dir):
    lines = delivered_lines(spark, sf_dir).select(part_name().alias("part"), "value")
    return profile.likely_separator(lines, "part")


@query(
    "profile_separator_pages",
    "WITH texts AS (SELECT url || ';' || html AS line, regexp_extract(url, 'example[.]com/([^/]*)', 1) AS site FROM pages)"
    + SEPARATOR_SQL.format(by="site", lines="texts"),
)
def profile_separator_pages(spark, sf_dir):
    """Whole web pages as lines: long texts, many distinct counts."""
    pages = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "example[.]com/([^/]*)", 1).alias("part"),
        F.concat("url", F.lit(";"), "html").alias("value"),
    )
    return profile.likely_separator(pages, "part")


@query(
    "profile_widths",
    CTE
    + """SELECT source_part, CAST(CASE WHEN NOT malformed THEN 6 WHEN line LIKE '%;extra' THEN 7 ELSE 2 END AS INTEGER) AS width,
                count(*) AS lines FROM delivery GROUP BY ALL""",
)
def profile_widths(spark, sf_dir):
    found = profile.widths(delivered_lines(spark, sf_dir), DELIVERED.dialect, PART)
    return found.select(part_name().alias("source_part"), "width", "lines")


def _samples_sql() -> str:
    one = """SELECT source_part, '{c}' AS "column", v, min(v) OVER w AS lo, max(v) OVER w AS hi
             FROM (SELECT DISTINCT source_part, substring({c}, 1, 60) AS v FROM delivery WHERE NOT malformed AND {c} <> '')
             WINDOW w AS (PARTITION BY source_part)"""
    every = " UNION ALL ".join(one.format(c=c) for c in FIELDS)
    return (
        CTE
        + f"""SELECT source_part, "column",
                     concat_ws(' / ', min(lo), min(v) FILTER (v > lo AND v < hi), CASE WHEN min(hi) > min(lo) THEN min(hi) END) AS samples
              FROM ({every}) GROUP BY ALL"""
    )


@query("profile_samples", _samples_sql())
def profile_samples(spark, sf_dir):
    rows = delimited.well_formed(delivered_rows(spark, sf_dir))
    found = profile.samples(rows, FIELDS, PART)
    return found.select(
        part_name().alias("source_part"),
        "column",
        F.array_join("samples", " / ").alias("samples"),
    )


@query(
    "profile_encoding",
    """SELECT lang, true AS decodes_declared, true AS decodes_utf8,
              bool_or(regexp_matches(text, '[^\\x00-\\x7F]')) AS looks_utf8
       FROM documents GROUP BY lang""",
)
def profile_encoding(spark, sf_dir):
    """Documents written as UTF-8 files while the contract says ISO-8859-1."""
    texts = table(spark, sf_dir, "documents").select(
        F.col("text").alias("value"), F.col("lang").alias("source_part")
    )
    folder = write_once(spark, sf_dir, "documents", texts)
    lines = profile.byte_lines(spark, folder, folder, split=True)
    return profile.encoding(
        lines.withColumn("lang", part_name()), "iso-8859-1", "lang"
    )


@query(
    "profile_verdict",
    CTE
    + SEPARATOR_SQL.format(by="source_part", lines="delivery").replace(
        "SELECT part, mark AS separator", ", likely AS (SELECT part, mark AS separator"
    )
    + """), shape AS (SELECT source_part AS part, bool_or(malformed) AS off FROM delivery GROUP BY 1),
    judged AS (SELECT part, CASE WHEN off THEN 1 ELSE 0 END + CASE WHEN separator <> ';' THEN 1 ELSE 0 END AS problems
               FROM shape LEFT JOIN likely USING (part))
    SELECT part AS source_part, CAST(problems AS BIGINT) AS problems,
           CASE WHEN problems > 0 THEN 'INCOMPATIVEL' ELSE 'COMPATIVEL' END AS verdict FROM judged""",
)
def profile_verdict(spark, sf_dir):
    lines = delivered_lines(spark, sf_dir)
    bare = replace(DELIVERED, dialect=replace(DELIVERED.dialect, header=False))
    problems = profile.part_problems(
        lines, delivered_bytes(spark, sf_dir), lines, bare
    )
    found = profile.verdict(lines.select(PART).distinct(), problems)
    return found.select(part_name().alias("source_part"), "problems", "verdict")
