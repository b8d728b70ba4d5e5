"""Row-level queries: cleaning, conversion, checks, routing, copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratagate import vocabulary as v
from stratagate.contract import Contract, Field, Rule
from stratagate.functions import convert, text
from stratagate.operators import evaluate as ev
from stratagate.operators.groups import number_copies, with_group_size
from stratagate.operators.quarantine import (
    Origin,
    quarantine_layout,
    withdrawn_rows,
)
from stratagate.workload.contracts import ORDERS, SHIPMENTS, STATUS, STRICT_ORDERS
from stratagate.workload.inputs import RAW_ORDERS, from_sql, table
from stratagate.workload.registry import query

# The same evaluation written as SQL, for the oracles.
EVALUATED = f"""
WITH raw_orders AS ({RAW_ORDERS}),
cleaned AS (
  SELECT *, nullif(trim(order_id), '') AS t_id, nullif(trim(cust_id), '') AS t_cust,
         upper(nullif(trim(status), '')) AS v_status, nullif(trim(amount), '') AS t_amount,
         CASE WHEN nullif(trim(order_date), '') NOT IN ('0', '00000000')
              THEN nullif(trim(order_date), '') END AS t_date,
         nullif(trim(priority), '') AS v_priority
  FROM raw_orders),
typed AS (
  SELECT *,
         CASE WHEN regexp_full_match(t_id, '[0-9]+') THEN TRY_CAST(t_id AS BIGINT) END AS v_id,
         CASE WHEN regexp_full_match(t_cust, '[0-9]+') THEN TRY_CAST(t_cust AS BIGINT) END AS v_cust,
         CASE WHEN regexp_full_match(replace(t_amount, ',', '.'), '-?[0-9]+([.][0-9]+)?')
              THEN TRY_CAST(replace(t_amount, ',', '.') AS DECIMAL(15,2)) END AS v_amount,
         CASE WHEN regexp_full_match(t_date, '[0-9]{{8}}')
              THEN CAST(try_strptime(t_date, '%Y%m%d') AS DATE) END AS v_date
  FROM cleaned),
flags AS (
  SELECT *,
         t_amount IS NOT NULL AND v_amount IS NULL AS bad_amount,
         t_date IS NOT NULL AND v_date IS NULL AS bad_date,
         v_date IS NULL AS no_date,
         coalesce(v_status NOT IN ('F', 'O', 'P'), false) AS bad_status,
         v_id IS NULL AS no_key,
         v_id IS NOT NULL AND count(*) OVER (PARTITION BY v_id) > 1 AS dup_key,
         NOT coalesce(v_amount IS NULL OR v_amount >= 0, false) AS negative
  FROM typed),
evaluated AS (
  SELECT *, bad_amount OR bad_date OR no_date OR bad_status OR no_key OR dup_key AS withdraw,
         bad_status OR negative AS alert
  FROM flags)
"""

REASONS = EVALUATED + """,
reasons AS (
  SELECT order_id, source_part, 1 AS at, 'dominio' AS classe, NULL AS regra, 'status' AS coluna,
         status AS valor, 'QUARENTENA_E_ALERTA' AS acao FROM evaluated WHERE bad_status
  UNION ALL SELECT order_id, source_part, 2, 'conversao', NULL, 'amount', amount, 'QUARENTENA' FROM evaluated WHERE bad_amount
  UNION ALL SELECT order_id, source_part, 3, 'conversao', NULL, 'order_date', order_date, 'QUARENTENA' FROM evaluated WHERE bad_date
  UNION ALL SELECT order_id, source_part, 4, 'nulidade', NULL, 'order_date', order_date, 'QUARENTENA' FROM evaluated WHERE no_date
  UNION ALL SELECT order_id, source_part, 5, 'chave_nula', NULL, 'order_id', order_id, 'QUARENTENA' FROM evaluated WHERE no_key
  UNION ALL SELECT order_id, source_part, 6, 'chave_duplicada', NULL, 'order_id', order_id, 'QUARENTENA_GRUPO' FROM evaluated WHERE dup_key
  UNION ALL SELECT order_id, source_part, 7, 'regra', 'amount_not_negative', 'amount', amount, 'ALERTA' FROM evaluated WHERE negative)
"""


def raw_orders(spark, sf_dir):
    return from_sql(spark, sf_dir, RAW_ORDERS).withColumnRenamed(
        "source_part", v.PART_COL
    )


def orders_evaluation(spark, sf_dir, contract: Contract = ORDERS) -> ev.Evaluation:
    return ev.evaluate(raw_orders(spark, sf_dir), contract)


# ------------------------------------------------ scalar transformations


@query(
    "text_transforms",
    f"""
    SELECT order_id AS original, source_part, nullif(trim(order_id), '') AS cleaned,
           upper(trim(status)) AS status,
           regexp_replace(source_part || order_date, '[^0-9]', '', 'g') AS digits,
           CASE WHEN order_date NOT IN ('0', '00000000') THEN order_date END AS known_date,
           CASE WHEN length(trim(order_id)) < 4 THEN lpad(trim(order_id), 4, '0')
                ELSE trim(order_id) END AS padded
    FROM ({RAW_ORDERS})
    """,
)
def text_transforms(spark, sf_dir):
    raw = raw_orders(spark, sf_dir)
    code, day = F.col("order_id"), F.col("order_date")
    return raw.select(
        code.alias("original"),
        F.col(v.PART_COL).alias("source_part"),
        text.apply_all(code, ORDERS.default_transforms).alias("cleaned"),
        text.apply_all(F.col("status"), [text.trim_ends, text.upper_case]).alias("status"),
        text.digits_only(F.concat(v.PART_COL, "order_date")).alias("digits"),
        text.null_if("0", "00000000")(day).alias("known_date"),
        text.apply_all(code, [text.trim_ends, text.pad_left(4, "0")]).alias("padded"),
    )


NUMBERS = """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_orderkey AS STRING)
       WHEN o_orderkey % 5 = 1 THEN CAST(o_orderkey AS STRING) || '000000000'
       WHEN o_orderkey % 5 = 2 THEN CAST(o_orderkey AS STRING) || '.5'
       WHEN o_orderkey % 5 = 3 THEN '-' || CAST(o_orderkey AS STRING)
       ELSE o_orderpriority END AS number
FROM orders
"""


@query(
    "convert_int",
    f"""
    SELECT o_orderkey, number,
           CASE WHEN regexp_full_match(number, '[+-]?[0-9]+') THEN TRY_CAST(number AS INTEGER) END AS as_int,
           CASE WHEN regexp_full_match(number, '[+-]?[0-9]+') THEN TRY_CAST(number AS BIGINT) END AS as_long
    FROM ({NUMBERS})
    """,
)
def convert_int(spark, sf_dir):
    number = F.col("number")
    return from_sql(spark, sf_dir, NUMBERS).select(
        "o_orderkey",
        "number",
        convert.to_number(number, "int").alias("as_int"),
        convert.to_number(number, "bigint").alias("as_long"),
    )


@query(
    "convert_decimal",
    EVALUATED
    + "SELECT order_id, source_part, amount, v_amount AS as_decimal FROM evaluated",
)
def convert_decimal(spark, sf_dir):
    amount = text.apply_all(F.col("amount"), ORDERS.default_transforms)
    return raw_orders(spark, sf_dir).select(
        "order_id",
        F.col(v.PART_COL).alias("source_part"),
        "amount",
        convert.to_number(amount, "decimal(15,2)", ",").alias("as_decimal"),
    )


@query(
    "convert_date",
    EVALUATED
    + """
    SELECT order_id, source_part, order_date, v_date AS compact,
           CAST(try_strptime(CASE WHEN length(order_date) = 8 THEN substring(order_date, 1, 4) || '-' ||
             substring(order_date, 5, 2) || '-' || substring(order_date, 7, 2) END, '%Y-%m-%d') AS DATE) AS dashed
    FROM evaluated
    """,
)
def convert_date(spark, sf_dir):
    day = F.col("order_date")
    dashed = F.concat_ws(
        "-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2)
    )
    return raw_orders(spark, sf_dir).select(
        "order_id",
        F.col(v.PART_COL).alias("source_part"),
        "order_date",
        convert.to_date(text.null_if("0", "00000000")(day), "AAAAMMDD").alias("compact"),
        convert.to_date(dashed, "AAAA-MM-DD").alias("dashed"),
    )


@query(
    "domain_label",
    EVALUATED
    + """
    SELECT order_id, source_part, v_status AS status,
           CASE v_status WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial' END AS label
    FROM evaluated
    """,
)
def domain_label(spark, sf_dir):
    status = text.apply_all(F.col("status"), [*ORDERS.default_transforms, text.upper_case])
    return raw_orders(spark, sf_dir).select(
        "order_id",
        F.col(v.PART_COL).alias("source_part"),
        status.alias("status"),
        convert.label_of(status, STATUS).alias("label"),
    )


# ---------------------------------------------------------- row checks


def reasons_of(spark, sf_dir, *kinds):
    """Reasons of the given classes beside the row they speak against."""
    found = orders_evaluation(spark, sf_dir)
    listed = ev.reasons(found.checks)
    return (
        found.rows.select(
            ev.delivered("order_id").alias("order_id"),
            F.col(v.PART_COL).alias("source_part"),
            ev.delivered("amount").alias("amount"),
            F.inline(listed),
        )
        .where(F.col("classe").isin(*kinds))
    )


def _check_sql(kind: str) -> str:
    return (
        REASONS
        + f"SELECT order_id, source_part, coluna, valor, acao FROM reasons WHERE classe = '{kind}'"
    )


def _check_rows(spark, sf_dir, kind):
    return reasons_of(spark, sf_dir, kind).select(
        "order_id", "source_part", "coluna", "valor", "acao"
    )


@query("check_conversion", _check_sql(v.CONVERSION))
def check_conversion(spark, sf_dir):
    return _check_rows(spark, sf_dir, v.CONVERSION)


@query("check_not_null", _check_sql(v.NOT_NULL))
def check_not_null(spark, sf_dir):
    return _check_rows(spark, sf_dir, v.NOT_NULL)


@query("check_domain", _check_sql(v.DOMAIN))
def check_domain(spark, sf_dir):
    return _check_rows(spark, sf_dir, v.DOMAIN)


@query("check_key_null", _check_sql(v.KEY_NULL))
def check_key_null(spark, sf_dir):
    return _check_rows(spark, sf_dir, v.KEY_NULL)


@query("check_key_duplicate", _check_sql(v.KEY_DUPLICATE))
def check_key_duplicate(spark, sf_dir):
    return _check_rows(spark, sf_dir, v.KEY_DUPLICATE)


@query(
    "check_rule",
    REASONS
    + "SELECT order_id, source_part, regra, coluna, valor AS amount, acao FROM reasons WHERE classe = 'regra'",
)
def check_rule(spark, sf_dir):
    return reasons_of(spark, sf_dir, v.RULE).select(
        "order_id", "source_part", "regra", "coluna", "amount", "acao"
    )


@query(
    "reasons",
    EVALUATED
    + """
    SELECT order_id, source_part, amount,
           concat_ws(' ', CASE WHEN bad_status THEN 'dominio:status:QUARENTENA_E_ALERTA' END,
                     CASE WHEN bad_amount THEN 'conversao:amount:QUARENTENA' END,
                     CASE WHEN bad_date THEN 'conversao:order_date:QUARENTENA' END,
                     CASE WHEN no_date THEN 'nulidade:order_date:QUARENTENA' END,
                     CASE WHEN no_key THEN 'chave_nula:order_id:QUARENTENA' END,
                     CASE WHEN dup_key THEN 'chave_duplicada:order_id:QUARENTENA_GRUPO' END,
                     CASE WHEN negative THEN 'regra:amount_not_negative:ALERTA' END) AS reasons,
           CAST(bad_status AS INT) + CAST(bad_amount AS INT) + CAST(bad_date AS INT)
             + CAST(no_date AS INT) + CAST(no_key AS INT) + CAST(dup_key AS INT)
             + CAST(negative AS INT) AS reason_count
    FROM evaluated
    """,
)
def reasons(spark, sf_dir):
    found = orders_evaluation(spark, sf_dir)
    listed = ev.reasons(found.checks)
    told = F.transform(
        listed,
        lambda m: F.concat_ws(":", m["classe"], F.coalesce(m["regra"], m["coluna"]), m["acao"]),
    )
    return found.rows.select(
        ev.delivered("order_id").alias("order_id"),
        F.col(v.PART_COL).alias("source_part"),
        ev.delivered("amount").alias("amount"),
        F.array_join(told, " ").alias("reasons"),
        F.size(listed).cast("bigint").alias("reason_count"),
    )


@query(
    "row_destination",
    EVALUATED
    + """
    SELECT order_id, source_part, amount,
           CASE WHEN bad_amount OR bad_date THEN 'BLOQUEIO' WHEN withdraw THEN 'QUARENTENA'
                ELSE 'PUBLICAR' END AS destination
    FROM evaluated
    """,
)
def row_destination(spark, sf_dir):
    found = orders_evaluation(spark, sf_dir, STRICT_ORDERS)
    return found.rows.select(
        ev.delivered("order_id").alias("order_id"),
        F.col(v.PART_COL).alias("source_part"),
        ev.delivered("amount").alias("amount"),
        ev.destination().alias("destination"),
    )


GROUP_SQL = """concat_ws('|',
             CASE WHEN dup_key THEN 'chave_duplicada:order_id' END,
             CASE WHEN no_key THEN 'chave_nula:order_id' END,
             CASE WHEN bad_amount THEN 'conversao:amount' END,
             CASE WHEN bad_date THEN 'conversao:order_date' END,
             CASE WHEN bad_status THEN 'dominio:status' END,
             CASE WHEN no_date THEN 'nulidade:order_date' END,
             CASE WHEN negative THEN 'regra:amount_not_negative' END)"""


@query(
    "problem_group",
    EVALUATED
    + f"""SELECT {GROUP_SQL} AS problem_group, count(*) AS row_count
          FROM evaluated WHERE withdraw GROUP BY 1""",
)
def problem_group(spark, sf_dir):
    found = orders_evaluation(spark, sf_dir)
    named = ev.problem_group(found.checks)
    return (
        found.rows.where(ev.WITHDRAW)
        .groupBy(named.alias("problem_group"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


@query(
    "evaluation_totals",
    EVALUATED
    + """
    SELECT count(*) AS total, count(*) FILTER (withdraw) AS withdraw,
           count(*) FILTER (alert) AS alert, count(*) FILTER (false) AS block
    FROM evaluated
    """,
)
def evaluation_totals(spark, sf_dir):
    return ev.evaluation_totals(orders_evaluation(spark, sf_dir))


@query(
    "violation_histogram",
    REASONS
    + "SELECT classe, regra, coluna, acao, count(*) AS linhas FROM reasons GROUP BY ALL",
)
def violation_histogram(spark, sf_dir):
    return ev.violation_histogram(orders_evaluation(spark, sf_dir))


@query(
    "blocking_examples",
    REASONS
    + """SELECT classe, regra, coluna, valor FROM reasons WHERE classe = 'conversao'
         ORDER BY 1, 2, 3, 4 LIMIT 10""",
)
def blocking_examples(spark, sf_dir):
    return ev.blocking_examples(orders_evaluation(spark, sf_dir, STRICT_ORDERS))


@query(
    "silver_rows",
    EVALUATED
    + """
    SELECT v_id AS order_id, v_cust AS cust_id, v_status AS status,
           CASE v_status WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial' END AS status_label,
           v_amount AS amount, v_date AS order_date, v_priority AS priority,
           '2026-09' AS competencia, source_part AS _arquivo_origem, 'run-1' AS _id_execucao
    FROM evaluated WHERE NOT withdraw
    """,
)
def silver_rows(spark, sf_dir):
    return ev.published_rows(orders_evaluation(spark, sf_dir), "2026-09", "run-1")


PUBLICATION = Origin(ORDERS, "silver", "2026-09", "delivery-1", "run-1")


@query(
    "quarantine_rows",
    EVALUATED
    + f"""
    SELECT 'shop_sales_orders' AS identificador, 'silver' AS camada, '2026-09' AS competencia,
           CAST(v_id AS STRING) AS order_id, {GROUP_SQL} AS grupo_problema, v_status AS status,
           source_part AS arquivo_origem,
           CAST(row_number() OVER (PARTITION BY order_id, cust_id, status, amount, order_date, priority
                                   ORDER BY source_part) AS INTEGER) AS ocorrencia
    FROM evaluated WHERE withdraw
    """,
)
def quarantine_rows(spark, sf_dir):
    layout = quarantine_layout(
        withdrawn_rows(orders_evaluation(spark, sf_dir)), PUBLICATION
    )
    return layout.select(
        "identificador",
        "camada",
        "competencia",
        F.get_json_object("chave", "$.order_id").alias("order_id"),
        "grupo_problema",
        F.get_json_object("registro", "$.status").alias("status"),
        "arquivo_origem",
        "ocorrencia",
    )


SHIPPED = """
SELECT l_returnflag AS flag, l_linestatus AS line_status, CAST(l_linenumber AS STRING) AS line_number,
       'shipped-' || CAST(year(l_shipdate) AS STRING) AS source_part
FROM lineitem
"""


@query(
    "quarantine_copies",
    f"""
    SELECT flag, line_status, line_number, source_part AS arquivo_origem,
           CAST(row_number() OVER (PARTITION BY flag, line_status, line_number ORDER BY source_part) AS INTEGER) AS ocorrencia
    FROM ({SHIPPED}) WHERE flag = 'N'
    """,
)
def quarantine_copies(spark, sf_dir):
    """A third of the rows leave, nearly all of them copies of a few others."""
    raw = from_sql(spark, sf_dir, SHIPPED).withColumnRenamed("source_part", v.PART_COL)
    publication = Origin(SHIPMENTS, "silver", "2026-09", "delivery-1", "run-1")
    layout = quarantine_layout(withdrawn_rows(ev.evaluate(raw, SHIPMENTS)), publication)
    return layout.select(
        *[
            F.get_json_object("registro", f"$.{c}").alias(c)
            for c in ("flag", "line_status", "line_number")
        ],
        "arquivo_origem",
        "ocorrencia",
    )


# ------------------------------------------------------ groups and copies


@query(
    "key_group_size",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS key_rows FROM lineitem""",
)
def key_group_size(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return with_group_size(lines, ["l_orderkey", "l_linenumber"], "key_rows")


@query(
    "occurrence_index",
    """SELECT sha256(text) AS text_hash, source,
              row_number() OVER (PARTITION BY sha256(text) ORDER BY source) AS occurrence
       FROM documents""",
)
def occurrence_index(spark, sf_dir):
    texts = table(spark, sf_dir, "documents").select(
        F.sha2("text", 256).alias("text_hash"), "source"
    )
    return number_copies(texts, "text_hash", "source", "occurrence")


# ------------------------------------------------------- rule vocabulary

VOCABULARY = {
    "comparison": "quantity <> 7 AND price > quantity AND NOT price <= 1",
    "arithmetic": "(price - quantity) * 2 / 4 + line % 3 > 5000",
    "logic": "NOT (flag = 'N' AND line = 1) OR price >= 60000",
    "null_tests": "flag IS NOT NULL AND ship IS NULL OR note IS NULL",
    "in_list": "flag IN ('A', 'R') OR line IN (1, 2, 3)",
    "between": "line BETWEEN 2 AND 5",
    "like": "note LIKE '%A%' OR note LIKE '_O%'",
    "literals": "ship >= DATE '1998-01-01' AND TRUE OR FALSE",
    "case_when": "CASE WHEN flag = 'A' THEN quantity > 10 WHEN flag = 'R' THEN FALSE ELSE line > 1 END",
    "abs": "abs(quantity - 25) < 20",
    "coalesce": "coalesce(note, flag) = 'N'",
    "day": "day(ship) > 7",
    "length": "length(note) = 2",
    "lower": "lower(flag) = 'a'",
    "month": "month(ship) <> 12",
    "regexp_like": "regexp_like(note, '[AR]')",
    "round": "round(price / 1000, 1) > 30.5",
    "substring": "substring(note, 2, 1) = 'F'",
    "trim": "trim(note) = note",
    "upper": "upper(note) = note",
    "year": "year(ship) = 1998",
    "three_valued": "note <> 'NO'",
}

ITEM_TEXT = """
SELECT CAST(l_linenumber AS STRING) AS line, CAST(CAST(l_quantity AS DECIMAL(15,2)) AS STRING) AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS STRING) AS price, l_returnflag AS flag,
       substring(CAST(l_shipdate AS STRING), 1, 10) AS ship,
       CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 6 THEN 'n' || l_linestatus
            ELSE l_returnflag || l_linestatus END AS note
FROM lineitem
"""


def _vocabulary_sql() -> str:
    per_rule = " UNION ALL ".join(
        f"SELECT '{name}' AS regra, count(*) FILTER (NOT coalesce("
        f"{rule.replace('regexp_like', 'regexp_matches')}, false)) AS linhas FROM typed"
        for name, rule in VOCABULARY.items()
    )
    return f"""
    WITH typed AS (
      SELECT CAST(line AS INTEGER) AS line, CAST(quantity AS DECIMAL(15,2)) AS quantity,
             CAST(price AS DECIMAL(15,2)) AS price, flag, CAST(ship AS DATE) AS ship, nullif(note, '') AS note
      FROM ({ITEM_TEXT}))
    SELECT regra, linhas FROM ({per_rule}) WHERE linhas > 0
    """


RULED = Contract(
    "shop",
    "sales",
    "ruled",
    fields=(
        Field("line", v.INTEGER),
        Field("quantity", v.DECIMAL, precision=15, scale=2),
        Field("price", v.DECIMAL, precision=15, scale=2),
        Field("flag"),
        Field("ship", v.DATE, date_format="AAAA-MM-DD"),
        Field("note"),
    ),
    rules=tuple(
        Rule(name, expression, ("line",), v.ALERT, "Accuracy")
        for name, expression in VOCABULARY.items()
    ),
    default_transforms=(text.empty_to_null,),
)


@query("rule_vocabulary", _vocabulary_sql())
def rule_vocabulary(spark, sf_dir):
    raw = from_sql(spark, sf_dir, ITEM_TEXT).withColumn(v.PART_COL, F.lit("lineitem"))
    histogram = ev.violation_histogram(ev.evaluate(raw, RULED))
    return histogram.select("regra", "linhas")
