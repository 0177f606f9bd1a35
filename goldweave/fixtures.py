"""Party records and party events derived from the given tables.

The same SQL text runs in Spark and in DuckDB, so it feeds both the queries
and the checks against them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCE_PARTIES_SQL = """
WITH ent AS (
  SELECT 'internal_crm' AS source_system, 'CRM-' || CAST(10000 + c_custkey AS STRING) AS source_party_id,
         'INDIVIDUAL' AS party_type, c_custkey + 1 AS id,
         c_custkey AS seed, c_custkey AS tax_seed, CAST(NULL AS BIGINT) AS lei_seed, 0 AS variant
  FROM customer
  UNION ALL
  SELECT 'dnb_feed', 'DNB-' || CAST(20000 + s_suppkey AS STRING), 'ORGANIZATION', 10000000 + s_suppkey,
         CASE WHEN s_suppkey % 5 IN (0, 1) THEN s_suppkey ELSE 5000000 + s_suppkey * 7 END,
         CASE WHEN s_suppkey % 5 = 0 THEN s_suppkey ELSE 5000000 + s_suppkey * 7 END,
         CAST(NULL AS BIGINT), CASE WHEN s_suppkey % 5 = 1 THEN 2 ELSE 1 END
  FROM supplier
  UNION ALL
  SELECT 'markit_feed', 'MKT-' || CAST(30000 + p_partkey AS STRING), 'LEGAL_ENTITY', 20000000 + p_partkey,
         CASE WHEN p_partkey % 50 = 0 THEN p_partkey ELSE 9000000 + p_partkey * 11 END,
         CASE WHEN p_partkey % 50 = 0 THEN p_partkey ELSE 9000000 + p_partkey * 11 END,
         CASE WHEN p_partkey % 70 = 60 THEN p_partkey + 10 ELSE p_partkey END, 1
  FROM part
), h AS (
  SELECT *, md5(CAST(seed AS STRING)) AS hx, md5('t' || CAST(tax_seed AS STRING)) AS tx FROM ent
)
SELECT id, source_system, source_party_id, party_type,
  CASE variant WHEN 1 THEN upper(substr(hx,1,7) || ' ' || substr(hx,9,8)) || CASE WHEN source_system = 'dnb_feed' THEN ' LLC' ELSE '' END
               WHEN 2 THEN substr(hx,1,7) || ' ' || substr(hx,9,7)
               ELSE substr(hx,1,7) || ' ' || substr(hx,9,8) END AS full_name,
  CASE WHEN source_system = 'internal_crm' THEN substr(hx,1,7) END AS first_name,
  CASE WHEN source_system = 'internal_crm' THEN substr(hx,9,8) END AS last_name,
  CASE WHEN source_system = 'internal_crm' AND seed % 8 <> 5 THEN CAST('19' || CAST(50 + seed % 40 AS STRING) || '-0' || CAST(1 + seed % 9 AS STRING)
       || '-1' || CAST(seed % 9 AS STRING) AS DATE) END AS date_of_birth,
  CASE WHEN seed % 41 = 7 THEN '' WHEN seed % 43 = 9 THEN NULL ELSE substr(tx,1,2) || '-' || substr(tx,3,7) END AS tax_id,
  CASE WHEN source_system = 'markit_feed' THEN upper(substr(md5('l' || CAST(lei_seed AS STRING)),1,20)) END AS lei,
  CAST(seed % 999 + 1 AS STRING) || ' ' || substr(hx,17,6) || CASE WHEN variant = 0 THEN ' Street' ELSE ' St.' END AS address_line1,
  CASE WHEN seed % 4 = 0 THEN 'Apt ' || CAST(seed % 99 AS STRING) END AS address_line2,
  'City ' || CAST(seed % 97 AS STRING) AS city,
  'S' || CAST(seed % 9 AS STRING) AS state,
  CAST(10000 + (seed * 7919) % 90000 AS STRING) AS postal_code,
  'USA' AS country,
  CASE WHEN source_system = 'internal_crm' AND seed % 10 <> 3 THEN substr(hx,9,8) || '@x.org' END AS email,
  CASE WHEN source_system <> 'markit_feed' AND seed % 6 <> 1 THEN '555-' || substr(hx,25,4) END AS phone,
  CASE WHEN seed % 97 = 5 THEN 'BOGUS' WHEN seed % 4 = 3 THEN 'INACTIVE' ELSE 'ACTIVE' END AS entity_status
FROM h
"""

PARTY_EVENTS_SQL = """
SELECT event_id AS seq, 'EVT-' || CAST(event_id AS STRING) AS event_id, ts AS event_ts,
  CASE event_type WHEN 'click' THEN 'ADDRESS_CHANGE' WHEN 'view' THEN 'KYC_STATUS_UPDATE'
       WHEN 'signup' THEN 'NEW_PARTY' WHEN 'error' THEN 'STATUS_CHANGE'
       ELSE CASE WHEN event_id % 25 = 0 THEN 'ENTITY_MERGE' ELSE 'PURCHASE' END END AS event_type,
  CASE WHEN event_type IN ('click','view','error') AND event_id % 17 <> 0 THEN 'CRM-' || CAST(10000 + user_id * (CASE WHEN event_id % 19 = 0 THEN 1000000 ELSE 1 END) AS STRING) END AS party_ref,
  CASE WHEN event_type = 'purchase' THEN 'CRM-' || CAST(10000 + (user_id + 1 + event_id % 7) * (CASE WHEN event_id % 75 = 0 THEN 1000000 ELSE 1 END) AS STRING) END AS primary_ref,
  CASE WHEN event_type = 'purchase' AND event_id % 50 <> 0 THEN 'CRM-' || CAST(10000 + user_id AS STRING) END AS secondary_ref,
  CASE WHEN event_type = 'error' AND event_id % 13 <> 0 THEN CASE WHEN event_id % 2 = 0 THEN 'ACTIVE' ELSE 'INACTIVE' END END AS new_status,
  CASE WHEN event_type IN ('click','signup') THEN CAST(event_id % 999 + 1 AS STRING) || ' ' || substr(md5(CAST(event_id AS STRING)),1,6) || ' Street' END AS address_line1,
  CASE WHEN event_type IN ('click','signup') THEN 'City ' || CAST(event_id % 97 AS STRING) END AS city,
  CASE WHEN event_type IN ('click','signup') THEN 'S' || CAST(event_id % 9 AS STRING) END AS state,
  CASE WHEN event_type IN ('click','signup') AND event_id % 3 = 0 THEN 'Apt ' || CAST(event_id % 99 AS STRING) END AS address_line2,
  CASE WHEN event_type IN ('click','signup') AND event_id % 7 <> 2 THEN CAST(10000 + (event_id * 7919) % 90000 AS STRING) END AS postal_code,
  CASE WHEN event_type IN ('click','signup') AND event_id % 5 = 0 THEN 'CAN' END AS country,
  value AS risk_score, props AS raw_props
FROM events
"""

TABLES = ("customer", "supplier", "part", "events")

# Tables of which only the key is read.
KEYS = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}


def register(spark: SparkSession, sf_dir: str) -> None:
    """Registers the given tables the fixtures read.

    Millions of keys are few row groups of a small file, so a few tasks would
    make all records and write them as a few files. They are dealt out first.
    """
    tasks = spark.sparkContext.defaultParallelism
    for name in TABLES:
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if key := KEYS.get(name):
            rows = rows.select(key).repartition(tasks, key)
        rows.createOrReplaceTempView(name)


def source_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(SOURCE_PARTIES_SQL)


def party_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(PARTY_EVENTS_SQL)
