"""Driver tables shaped into service-desk entities.

Portable SQL over the whole tables; the same text runs in Spark and in the SQL
check.  ``{TS}`` is the engine's timestamp type without time zone.
"""

from __future__ import annotations

import re
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

# Orders run to 2001-08-01, events to 2024-01-30.
ORDERS_AS_OF = datetime(2001, 8, 2)
EVENTS_AS_OF = datetime(2024, 1, 31)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

SHAPES: dict[str, str] = {}

SHAPES["company"] = """
SELECT CAST(s_suppkey AS STRING) AS sys_id, s_name AS name,
       CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS customer,
       CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END AS vendor,
       CASE WHEN s_suppkey % 7 = 0 THEN 1 ELSE 0 END AS manufacturer,
       concat('+55-', lpad(CAST(s_suppkey AS STRING), 8, '0')) AS phone,
       concat('https://c', CAST(s_suppkey AS STRING), '.example.com') AS website,
       concat('city_', CAST(s_nationkey AS STRING)) AS city,
       CAST(s_nationkey % 5 AS STRING) AS state,
       concat('NATION_', CAST(s_nationkey AS STRING)) AS country,
       CASE WHEN s_suppkey % 10 = 9 THEN 0 ELSE 1 END AS active,
       CAST(DATE '1995-01-01' + CAST(s_suppkey % 900 AS INT) AS {TS}) AS sys_created_on,
       CAST(DATE '2001-08-01' - CAST(s_suppkey % 60 AS INT) AS {TS}) AS sys_updated_on,
       CAST(DATE '2001-07-31' - CAST(s_suppkey % 90 AS INT) AS {TS}) AS etl_updated_at
FROM {supplier}
"""

# Company flags and dates as the source sends them: text, not always well formed.
SHAPES["company_raw"] = """
SELECT CASE WHEN s_suppkey % 41 = 40 THEN NULL ELSE CAST(s_suppkey AS STRING) END AS sys_id,
       CASE WHEN s_suppkey % 37 = 0 THEN repeat(s_name, 20) WHEN s_suppkey % 31 = 30 THEN NULL ELSE s_name END AS name,
       CASE s_suppkey % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '1' WHEN 3 THEN '0'
                          WHEN 4 THEN 'True' WHEN 5 THEN '' ELSE NULL END AS customer,
       CASE WHEN s_suppkey % 2 = 0 THEN 'true' ELSE 'false' END AS vendor,
       CASE WHEN s_suppkey % 3 = 0 THEN '1' ELSE NULL END AS manufacturer,
       CASE s_suppkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'maybe' WHEN 3 THEN NULL ELSE '1' END AS active,
       concat('+55-', repeat('9', CAST(s_suppkey % 45 AS INT))) AS phone,
       CASE WHEN s_suppkey % 11 = 3 THEN 'not a date' WHEN s_suppkey % 11 = 4 THEN NULL
            ELSE concat(CAST(DATE '2001-08-01' - CAST(s_suppkey % 60 AS INT) AS STRING), ' 10:30:00') END AS sys_updated_on
FROM {supplier}
"""

SHAPES["usr"] = """
SELECT CAST(c_custkey AS STRING) AS sys_id, lower(c_name) AS user_name, c_name AS name,
       concat(lower(c_name), '@example.com') AS email,
       CASE WHEN c_custkey % 20 = 0 THEN NULL
            WHEN c_custkey % 21 = 0 THEN 'ghost-co'
            WHEN c_custkey % 23 = 0 THEN ''
            ELSE CAST(c_nationkey AS STRING) END AS company,
       c_mktsegment AS department,
       CASE WHEN c_custkey % 6 = 0 THEN 0 ELSE 1 END AS active,
       split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name,
       concat('+55-', lpad(CAST(c_custkey AS STRING), 8, '0')) AS phone,
       lower(c_mktsegment) AS title,
       CASE WHEN c_custkey % 4 = 0 THEN NULL
            ELSE CAST(DATE '2001-07-31' - CAST(c_custkey % 400 AS INT) AS {TS}) END AS last_login,
       CAST(DATE '1995-01-01' + CAST(c_custkey % 900 AS INT) AS {TS}) AS sys_created_on,
       CAST(DATE '2001-08-01' - CAST(c_custkey % 60 AS INT) AS {TS}) AS sys_updated_on,
       CAST(DATE '2001-07-31' - CAST(c_custkey % 90 AS INT) AS {TS}) AS etl_updated_at
FROM {customer}
"""

SHAPES["incident"] = """
SELECT CAST(o_orderkey AS STRING) AS sys_id,
       concat('INC', lpad(CAST(o_orderkey AS STRING), 12, '0')) AS number,
       CASE o_orderstatus WHEN 'F' THEN '6' WHEN 'O' THEN '1' ELSE '2' END AS state,
       substr(o_orderpriority, 1, 1) AS priority,
       CAST(o_orderkey % 3 + 1 AS STRING) AS urgency,
       CAST(o_orderkey % 4 + 1 AS STRING) AS impact,
       concat('short ', o_orderpriority) AS short_description,
       concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' ',
              CASE o_orderkey % 4 WHEN 0 THEN '00:00:00' WHEN 1 THEN '09:30:15'
                                  WHEN 2 THEN '18:45:00' ELSE '23:59:59' END) AS opened_at,
       CASE WHEN o_orderstatus = 'F'
            THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 23:59:59') END AS closed_at,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL
            WHEN o_orderkey % 17 = 0 THEN 'ghost-co'
            ELSE CAST(o_orderkey % 10 AS STRING) END AS company,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS STRING) END AS resolved_by,
       CASE WHEN o_orderkey % 19 = 0 THEN concat('ghost-u', CAST(o_orderkey % 7 AS STRING))
            ELSE CAST(o_custkey AS STRING) END AS opened_by,
       CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END AS caller_id
FROM {orders}
"""

SHAPES["incident_task"] = """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS sys_id,
       CASE WHEN l_linenumber = 7 THEN '' WHEN l_linenumber = 6 THEN NULL
            ELSE CAST(l_orderkey AS STRING) END AS parent,
       concat(CAST(CAST(l_shipdate AS DATE) AS STRING), ' 12:00:00') AS opened_at,
       l_linestatus AS state, l_partkey AS seq1, l_suppkey AS seq2, l_extendedprice AS seq3
FROM {lineitem}
"""

SHAPES["task_sla"] = """
SELECT concat('sla-', CAST(l_orderkey AS STRING), '-', CAST(l_partkey AS STRING)) AS sys_id,
       CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 THEN ''
            ELSE CAST(l_orderkey AS STRING) END AS task,
       l_shipdate AS sys_created_on, l_returnflag AS stage, CAST(l_quantity AS INT) AS business_percentage
FROM {lineitem}
"""

SHAPES["task_time_worked"] = """
SELECT CAST(event_id AS STRING) AS sys_id,
       CASE WHEN event_id % 9 = 0 THEN '' WHEN event_id % 10 = 0 THEN NULL
            ELSE CAST(event_id % 1500 AS STRING) END AS task,
       ts AS sys_created_on, CAST(user_id AS STRING) AS sys_created_by,
       CAST(event_id % 3600 AS INT) AS time_in_seconds
FROM {events}
"""

# Time worked in the years of the incidents.
SHAPES["past_time_worked"] = """
SELECT CAST(event_id AS STRING) AS sys_id,
       CASE WHEN event_id % 9 = 0 THEN '' WHEN event_id % 10 = 0 THEN NULL
            ELSE CAST(event_id % 1500 AS STRING) END AS task,
       ts - INTERVAL 24 YEAR AS sys_created_on, CAST(user_id AS STRING) AS sys_created_by,
       CAST(event_id % 3600 AS INT) AS time_in_seconds
FROM {events}
"""

SHAPES["contract_sla"] = """
SELECT CAST(p_partkey AS STRING) AS sys_id, p_name AS name, p_brand AS vendor, p_type AS type,
       CAST(p_size AS STRING) AS duration, CAST(p_partkey AS INT) AS part_number
FROM {part}
"""

SHAPES["user_group"] = """
SELECT CAST(n_nationkey AS STRING) AS sys_id, n_name AS name, CAST(n_regionkey AS STRING) AS parent
FROM {nation}
"""

SHAPES["run_log"] = """
SELECT CAST(event_id AS STRING) AS execution_id,
       CASE event_type WHEN 'click' THEN 'daily' WHEN 'view' THEN 'range' WHEN 'signup' THEN 'today'
                       WHEN 'purchase' THEN 'config' ELSE 'backlog' END AS execution_type,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS start_date,
       CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN CAST(ts AS DATE)
            ELSE CAST(CAST(ts AS DATE) + INTERVAL 1 DAY AS DATE) END AS end_date,
       ts AS started_at,
       CASE WHEN event_id % 10 = 0 THEN 'failed' WHEN event_id % 10 = 1 THEN 'partial'
            WHEN event_id % 10 = 2 THEN 'running' ELSE 'success' END AS status,
       CAST(value AS DECIMAL(10,2)) AS duration_seconds,
       CAST(event_id % 40 AS INT) AS total_api_requests,
       CAST(event_id % 5000 AS INT) AS total_records_processed,
       CAST(event_id % 2 AS INT) AS json_storage_enabled,
       CASE WHEN event_id % 2 = 1 THEN CAST(event_id % 90 AS DECIMAL(5,2)) END AS compression_ratio,
       CASE WHEN event_id % 10 = 0 THEN concat('erro: ', props, ' ', repeat('x', CAST(event_id % 80 AS INT))) END AS error_message
FROM {events}
"""

SHAPES["request_log"] = """
SELECT event_type AS extractor, event_id AS page, value AS elapsed_seconds,
       CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS failed
FROM {events}
"""

SHAPES["archive_entry"] = """
SELECT event_id AS id, CAST(ts AS DATE) AS data_extraction,
       CASE event_type WHEN 'click' THEN 'daily' WHEN 'error' THEN 'backlog' ELSE 'range' END AS extraction_type,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS start_date,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS end_date,
       CAST(event_id % 700 AS INT) AS record_count,
       CAST(value AS DECIMAL(10,2)) AS json_size_kb,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 97 AS DECIMAL(10,2)) END AS compressed_size_kb,
       CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN CAST(0 AS DECIMAL(5,2))
            ELSE CAST(event_id % 95 AS DECIMAL(5,2)) END AS compression_ratio,
       ts AS created_at
FROM {events}
"""

# A change feed for usr: some users re-sent as they are, one edit per order (many
# per user, NULL overwrites included), new users, and rows without an id.
SHAPES["user_changes"] = """
SELECT CAST(c_custkey AS STRING) AS sys_id, c_name AS name, c_mktsegment AS department, CAST(0 AS BIGINT) AS seq
FROM {customer} JOIN {supplier} ON c_custkey = s_suppkey
UNION ALL
SELECT CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey AS STRING) ELSE concat('new-', CAST(o_custkey AS STRING)) END,
       concat('edit ', CAST(o_orderkey AS STRING)),
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END,
       CAST(o_orderkey + 1 AS BIGINT)
FROM {orders}
UNION ALL
SELECT CAST(NULL AS STRING), n_name, CAST(NULL AS STRING), CAST(0 AS BIGINT) FROM {nation}
"""

# Full read of the users in page order: every user comes twice, the second time
# renamed and with the opposite active flag.
SHAPES["user_feed"] = """
SELECT CAST(c_custkey AS STRING) AS sys_id, c_name AS name, c_mktsegment AS department,
       CASE WHEN c_custkey % 6 = 0 THEN 'false' ELSE 'true' END AS active,
       CAST(DATE '2001-08-01' - CAST(c_custkey % 60 AS INT) AS {TS}) AS sys_updated_on, 1 AS seq
FROM {customer}
UNION ALL
SELECT CAST(c_custkey AS STRING), concat(c_name, ' again'), c_mktsegment,
       CASE WHEN c_custkey % 6 = 0 AND c_custkey % 4 = 0 THEN 'true' ELSE 'false' END,
       CAST(DATE '2001-08-01' - CAST(c_custkey % 45 AS INT) AS {TS}), 2
FROM {customer}
"""


def shape_sql(name: str, tables: dict[str, str], timestamp: str) -> str:
    return SHAPES[name].format(TS=timestamp, **tables).strip()


def oracle(sql: str) -> str:
    """SQL for the check: the shapes it reads, as common table expressions, in front."""
    used = dict.fromkeys(n for n in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql) if n in SHAPES)
    plain = {t: t for t in TABLES}
    ctes = [f"{n} AS ({shape_sql(n, plain, 'TIMESTAMP')})" for n in used]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        ctes.append(body[5:])
        return "WITH " + ", ".join(ctes)
    return (f"WITH {', '.join(ctes)} " if ctes else "") + body


class Data:
    """Driver tables and shapes of one folder, as DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.dir}/{table}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def _refs(self) -> dict[str, str]:
        return {t: f"parquet.`{self.path(t)}`" for t in TABLES}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SHAPES:
            raise AttributeError(name)
        return self.spark.sql(shape_sql(name, self._refs, "TIMESTAMP_NTZ"))
