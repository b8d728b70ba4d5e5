"""Input views of the registered queries, as SQL text for Spark and the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Orders as delivered text, with planted defects.
RAW_ORDERS = """
SELECT CASE WHEN o_orderkey % 79 = 0 THEN '' ELSE ' ' || CAST(o_orderkey AS STRING) || ' ' END AS order_id,
       CAST(o_custkey AS STRING) AS cust_id,
       CASE WHEN o_orderkey % 83 = 0 THEN 'Z' ELSE lower(o_orderstatus) END AS status,
       CASE WHEN o_orderkey % 89 = 0 THEN 'n/a'
            WHEN o_orderkey % 103 = 0 THEN '-' || replace(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING), '.', ',')
            ELSE replace(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING), '.', ',') END AS amount,
       CASE WHEN o_orderkey % 97 = 0 THEN '20261332' WHEN o_orderkey % 101 = 0 THEN '00000000'
            ELSE replace(substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10), '-', '') END AS order_date,
       substring(o_orderpriority, 1, 1) AS priority,
       'part-' || CAST(o_orderkey % 4 AS STRING) AS source_part
FROM orders
UNION ALL
SELECT ' ' || CAST(o_orderkey AS STRING) || ' ', CAST(o_custkey AS STRING), lower(o_orderstatus),
       '1,00', '20000101', '9', 'part-dup'
FROM orders WHERE o_orderkey % 73 = 0
"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run a view's SQL over the parquet tables it names."""
    for name in TABLES:
        if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(text)
