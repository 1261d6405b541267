"""The three datasets derived from the test tables, see FIXTURES.md."""

import os

from pyspark.sql import DataFrame, SparkSession

from .readers import Datasets

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "labels"]

PROFILE = """
SELECT CAST(c_custkey AS STRING) id,
       CAST(CASE WHEN c_acctbal < 0 THEN 118 ELSE 18 + c_custkey * 5 % 84 END AS INT) age,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_custkey % 50 = 0 THEN 'O' WHEN c_custkey % 5 < 3 THEN 'M' ELSE 'F' END gender,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE round(30000 + c_acctbal * 9, 0) END income,
       CAST(date_format(date_add(DATE'2013-07-29', CAST(c_custkey * 37 % 1824 AS INT)), 'yyyyMMdd') AS INT) became_member_on
FROM {customer}
"""

PORTFOLIO = """
SELECT CAST(i AS STRING) id,
       CASE WHEN i % 5 IN (0,1) THEN 'bogo' WHEN i % 5 IN (2,3) THEN 'discount' ELSE 'informational' END offer_type,
       CAST(CASE WHEN i % 5 = 4 THEN 0 ELSE 5 + (s % 4) * 5 END AS INT) difficulty,
       CAST(CASE WHEN i % 5 = 4 THEN 0 WHEN i % 5 IN (0,1) THEN 5 + (s % 4) * 5 ELSE 2 + s % 4 END AS INT) reward,
       CAST(3 + s % 8 AS DOUBLE) duration,
       filter(array('email', CASE WHEN i % 5 <> 3 THEN 'mobile' END, CASE WHEN i % 2 = 0 THEN 'social' END,
                    CASE WHEN n % 3 <> 0 THEN 'web' END), x -> x IS NOT NULL) channels
FROM (SELECT CAST(substring(p_brand, 7) AS INT) - 1 i, sum(p_size) s, count(*) n FROM {part} GROUP BY p_brand) p
"""

TRANSCRIPT = """
SELECT CAST(user_id AS STRING) person,
       CASE event_type WHEN 'signup' THEN 'offer received' WHEN 'view' THEN 'offer viewed' WHEN 'click' THEN 'offer completed' WHEN 'purchase' THEN 'transaction' ELSE event_type END event,
       CAST(timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01', ts) AS INT) time,
       CASE WHEN event_type IN ('signup','view') THEN CAST(k % 25 AS STRING) END value_offer_id_space,
       CASE WHEN event_type = 'click' THEN CAST(k % 25 AS STRING) END value_offer_id,
       CASE WHEN event_type = 'purchase' THEN value END value_amount
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) k FROM {events}) e
UNION ALL
SELECT CAST(o_custkey AS STRING), 'transaction',
       CAST((datediff(CAST(o_orderdate AS DATE), DATE'1995-01-01') % 30) * 24 + o_orderkey % 24 AS INT), NULL, NULL, o_totalprice
FROM {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table: one Parquet file or a directory of them."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def load(spark: SparkSession, sf_dir: str) -> Datasets:
    return Datasets(
        spark.sql(PORTFOLIO, part=table(spark, sf_dir, "part")),
        spark.sql(PROFILE, customer=table(spark, sf_dir, "customer")),
        spark.sql(TRANSCRIPT, events=table(spark, sf_dir, "events"), orders=table(spark, sf_dir, "orders")),
    )
