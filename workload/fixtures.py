"""Citation tables derived from the given tables.

The texts run unchanged in Spark SQL and DuckDB: ``{name}`` is the file of that table in
Spark and the view of that name in DuckDB. Defects are seeded by arithmetic on ``k``.

Orders grow with the citations, so the hint (a comment to DuckDB) asks for the join that
Spark picks at scale; without it a small run would broadcast them.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.sources.schemas import STAGE_VIOLATION, STAGING, conform

SQL: dict[str, str] = {}

SQL["stage_violation"] = """
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)
         || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(CAST(l_quantity AS INT) AS STRING) AS summons_number,
  CASE WHEN k%97=0 THEN NULL WHEN k%2=0 THEN 'pl' || CAST(o_custkey AS STRING) ELSE 'PL' || CAST(o_custkey AS STRING) END AS plate_id,
  CASE WHEN k%3=0 THEN 's' ELSE 'S' END || CAST(o_custkey%27 AS STRING) AS registration_state,
  substr(o_orderpriority,1,1) AS plate_type,
  CAST(l_shipdate AS DATE) AS issue_date,
  CAST(l_partkey%50+1 AS INT) AS violation_code,
  CASE WHEN k%11=0 THEN NULL ELSE 'BRAND#' || CAST(l_partkey%30+1 AS STRING) END AS vehicle_body_type,
  CASE WHEN k%13=0 THEN NULL ELSE 'MK' || CAST(l_suppkey AS STRING) END AS vehicle_make,
  l_linestatus AS issuing_agency,
  CAST(l_partkey%7 AS INT) AS street_code1,
  CASE WHEN k%101=0 THEN NULL ELSE CAST(l_suppkey%5 AS INT) END AS street_code2,
  l_linenumber AS street_code3,
  CASE WHEN k%7=0 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) + INTERVAL 30 DAY AS DATE) END AS vehicle_expiration_date,
  CAST(l_suppkey%10 AS INT) AS violation_precinct,
  CAST(l_partkey%5 AS INT) AS issuer_precinct,
  lpad(CAST((k%26)*100+(k*7)%65 AS STRING),4,'0') || substr('APapX',CAST(k%5+1 AS INT),1) AS violation_time,
  CASE WHEN k%4=0 THEN lpad(CAST((k%24)*100+(k*11)%60 AS STRING),4,'0') || substr('APap',CAST(k%3+1 AS INT),1) END AS time_first_observed,
  'r' || CAST(k%7 AS STRING) AS violation_county,
  substr('IFOifoX',CAST(k%7+1 AS INT),1) AS violation_in_front_of_or_opposite,
  CASE WHEN k%3=0 THEN NULL ELSE CAST(CAST(l_quantity AS INT)%4 AS STRING) END AS house_number,
  CASE WHEN k%17=0 THEN NULL WHEN k%23=0 THEN ' ' || chr(34) || 'A;B,C' || chr(34) || chr(92) WHEN k%2=0 THEN 'Street ' || CAST(l_partkey%4 AS STRING) ELSE 'STREET ' || CAST(l_partkey%4 AS STRING) END AS street_name,
  CASE WHEN k%2=0 THEN NULL ELSE 'Cross ' || CAST(l_suppkey%3 AS STRING) END AS intersecting_street,
  CASE WHEN k%5=0 THEN substr(dfo,1,2) || ',' || substr(dfo,3,2) || substr(dfo,6,1) || ',' || substr(dfo,7,1) || substr(dfo,9,2)
       ELSE '0' END AS date_first_observed,
  '408' AS law_section,
  CASE WHEN k%19=0 THEN NULL ELSE substr('abcdef',CAST(k%6+1 AS INT),1) END AS sub_division,
  'C' || CAST(k%9 AS STRING) AS vehicle_color,
  CAST(1850+k%200 AS INT) AS vehicle_year,
  CASE WHEN l_suppkey%10=0 THEN NULL ELSE CAST(l_suppkey%10 AS STRING) END AS violation_location,
  CASE WHEN k%29=0 THEN NULL WHEN k%6=0 THEN 0 ELSE CAST(300000+l_suppkey AS INT) END AS issuer_code,
  CASE WHEN k%31=0 THEN NULL ELSE 'T' || lpad(CAST(l_suppkey%400 AS STRING),3,'0') END AS issuer_command,
  CASE WHEN k%6=0 THEN NULL WHEN k%37=0 THEN '0000' ELSE substr('ABCDEFG',CAST(k%7+1 AS INT),1) END AS issuer_squad,
  CASE WHEN k%8=0 THEN 'T' WHEN k%59=0 THEN 'N' END AS violation_legal_code,
  CASE k%5 WHEN 0 THEN 'YYYYYYY' WHEN 1 THEN 'BBBBBYB' WHEN 2 THEN 'Y Y Y' END AS days_parking_in_effect,
  CASE WHEN k%9=0 THEN 'ALL' WHEN k%4=0 THEN '0' || CAST(k%3+7 AS STRING) || '00A' END AS from_hours_in_effect,
  CASE WHEN k%9=0 THEN 'ALL' WHEN k%4=0 THEN '0' || CAST(k%3+4 AS STRING) || '30P' END AS to_hours_in_effect,
  CASE WHEN k%10=0 THEN '0' WHEN k%83=0 THEN '1' END AS unregistered_vehicle,
  CASE WHEN k%15=0 THEN CAST(l_partkey%97 AS STRING) || '-' || lpad(CAST(k%1000 AS STRING),4,'0') WHEN k%16=0 THEN '-' END AS meter_number,
  CASE WHEN k%43=0 THEN NULL ELSE CAST(k%5 AS INT) END AS feet_from_curb,
  CASE WHEN k%3=0 THEN lpad(CAST(k%90 AS STRING),2,'0') END AS violation_post_code,
  CASE WHEN k%12=0 THEN NULL ELSE CAST(l_partkey%50+1 AS STRING) || '-No Standing' END AS violation_description,
  CASE WHEN k%503=0 THEN 'Y' END AS no_standing_or_stopping_violation,
  CASE WHEN k%509=0 THEN 'Y' END AS hydrant_violation,
  CASE WHEN k%521=0 THEN 'Y' END AS double_parking_violation
FROM (SELECT /*+ MERGE(o) */ l.*, o.o_custkey, o.o_orderpriority, l_orderkey*7+l_linenumber*3+l_partkey AS k,
             CAST(CAST(CAST(l_shipdate AS DATE) - INTERVAL 1 DAY AS DATE) AS STRING) AS dfo
      FROM {lineitem} l JOIN {orders} o ON l_orderkey=o_orderkey) q
"""

SQL["stage_state"] = """
SELECT 'S' AS record_type, 'S' || CAST(n_nationkey AS STRING) AS state_code, n_name AS description FROM {nation}
"""

SQL["stage_vehicle_plate_type"] = """
SELECT DISTINCT substr(o_orderpriority,1,1) AS code, substr(o_orderpriority,3) AS type FROM {orders} WHERE substr(o_orderpriority,1,1)<>'5'
"""

SQL["stage_violation_code"] = """
SELECT p_size AS code,
  min(p_type) || CASE p_size%4 WHEN 0 THEN ', say ' || chr(34) || 'stop' || chr(34) || ', now' WHEN 1 THEN '; ' || chr(92) ELSE '' END AS description, min(p_retailprice) AS manhattan_amount, max(p_retailprice) AS others_amount
FROM {part} WHERE p_size<=45 GROUP BY p_size
"""

SQL["stage_vehicle_body_type"] = """
SELECT DISTINCT p_brand AS code, 'Body ' || p_brand AS type FROM {part}
UNION ALL SELECT DISTINCT CAST(p_size AS STRING) AS code, 'Size ' || CAST(p_size AS STRING) AS type FROM {part} WHERE p_size<=10
"""

SQL["stage_county"] = """
SELECT 'R' || CAST(r_regionkey AS STRING) AS code, r_name AS county FROM {region}
"""

SQL["stage_issuing_agency"] = """
SELECT DISTINCT l_linestatus AS code, 'Agency ' || l_linestatus AS agency FROM {lineitem}
"""

SQL["stage_vehicle_color"] = """
SELECT 'c' || CAST(r_regionkey AS STRING) AS code, 'Color ' || r_name AS color FROM {region}
"""

# Citations as the raw file writes them: dates as text, and text that is no date where the
# expiration date is missing.
RAW_DATES = """
SELECT *,
  substr(CAST(issue_date AS STRING),6,2) || '/' || substr(CAST(issue_date AS STRING),9,2)
    || '/' || substr(CAST(issue_date AS STRING),1,4) AS issue_date_text,
  CASE street_code1
    WHEN 0 THEN CAST(CAST(substr(CAST(issue_date AS STRING),6,2) AS INT) AS STRING) || '/'
      || CAST(CAST(substr(CAST(issue_date AS STRING),9,2) AS INT) AS STRING) || '/' || substr(CAST(issue_date AS STRING),1,4)
    WHEN 1 THEN substr(CAST(issue_date AS STRING),6,2) || '-' || substr(CAST(issue_date AS STRING),9,2)
      || '-' || substr(CAST(issue_date AS STRING),1,4)
    WHEN 2 THEN substr(CAST(issue_date AS STRING),1,4) || '/' || substr(CAST(issue_date AS STRING),6,2)
      || '/' || substr(CAST(issue_date AS STRING),9,2)
    WHEN 3 THEN substr(CAST(issue_date AS STRING),9,2) || '-'
      || substr('JanFebMarAprMayJunJulAugSepOctNovDec',CAST(3*CAST(substr(CAST(issue_date AS STRING),6,2) AS INT)-2 AS INT),3)
      || '-' || substr(CAST(issue_date AS STRING),1,4)
    ELSE substr(CAST(issue_date AS STRING),6,2) || '/' || substr(CAST(issue_date AS STRING),9,2)
      || '/' || substr(CAST(issue_date AS STRING),1,4) || CASE street_code1 WHEN 4 THEN ' 12:00:00 AM' ELSE '' END
  END AS mixed_date_text,
  CASE WHEN vehicle_expiration_date IS NOT NULL
         THEN substr(CAST(vehicle_expiration_date AS STRING),1,4)
           || substr(CAST(vehicle_expiration_date AS STRING),6,2)
           || substr(CAST(vehicle_expiration_date AS STRING),9,2)
       WHEN street_code1%2=0 THEN '20191331' ELSE '0' END AS expiration_date_text
FROM {stage_violation}
"""

GIVEN_TABLES = ("lineitem", "orders", "nation", "part", "region")


def duckdb_text(template: str) -> str:
    """A text of this module with plain table names."""
    names = {name: name for name in (*GIVEN_TABLES, "stage_violation")}
    return template.format(**names)


@lru_cache(maxsize=None)
def staging_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived staging table, read straight from the given files it needs.

    The plan is kept per session, so that schemas are not looked up again; no data is.
    """
    files = {table: f"parquet.`{sf_dir}/{table}.parquet`" for table in GIVEN_TABLES}
    return spark.sql(SQL[name].format(**files))


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: staging_table(spark, sf_dir, name) for name in SQL}


def raw_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations with dates as text: issue dates in one layout and in several, expiration dates."""
    return spark.sql(RAW_DATES, stage_violation=staging_table(spark, sf_dir, "stage_violation"))


def raw_citations(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """All 43 columns in file order with dates as text."""
    rows = raw_dates(spark, sf_dir)
    if where is not None:
        rows = rows.filter(where)
    texts = {
        "issue_date": F.col("mixed_date_text"),
        "vehicle_expiration_date": F.col("expiration_date_text"),
    }

    return rows.select(*[texts.get(name, F.col(name)).alias(name) for name in STAGE_VIOLATION.names])


def full_staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The staging tables in declared order."""
    tables = staging(spark, sf_dir)
    return {name: conform(tables[name], STAGING[name]) for name in STAGING}
