"""Inputs for the queries, made from the driver's tables by SQL that Spark and DuckDB read alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tablesift.session import table

VARIABLES = (
    ("sl_no", "integer"),
    ("town_name", "string"),
    ("latrines", "integer"),
    ("electric", "integer"),
    ("night_soil_disposal_method", "categorical_string"),
    ("road_length_km", "float_or_string"),
    ("spare", "string"),
)

ROWS = """SELECT CAST(o_custkey % 50 AS BIGINT) AS table_id,
  CAST(row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) - 1 AS BIGINT) AS row_index,
  o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS v FROM orders"""

_DATA = {
    "latrines": "CASE k % 11 WHEN 0 THEN 'Nil' WHEN 1 THEN '—' WHEN 2 THEN '1,234' WHEN 3 THEN '1O2' WHEN 4 THEN CAST(v AS STRING) || ')' WHEN 5 THEN '7 0 8' WHEN 6 THEN '2-0' WHEN 7 THEN '-7' WHEN 8 THEN '' ELSE CAST(v AS STRING) END",
    "electric": "CASE k % 7 WHEN 0 THEN '...' WHEN 1 THEN '8,100)' WHEN 2 THEN ' 12 ' WHEN 3 THEN 'n.a.' ELSE CAST(v % 1000 AS STRING) END",
    "night_soil_disposal_method": "CASE k % 6 WHEN 0 THEN 'HC/MT/B' WHEN 1 THEN 'HC/MI/B' WHEN 2 THEN 'B' WHEN 3 THEN 'Nil' WHEN 4 THEN 'HC/' ELSE 'c/t' END",
    "road_length_km": "CASE k % 5 WHEN 0 THEN 'PR 14.50 KR 3.20' WHEN 1 THEN 'PUCCA: 3' WHEN 2 THEN 'Nil' WHEN 3 THEN 'KUTCHA-2.5 PR=1' ELSE '12.5' END",
    "spare": "CASE WHEN table_id % 5 = 0 THEN '' ELSE 'x' END",
}

WIDE = f"""SELECT table_id, row_index,
  CASE WHEN k % 97 = 0 THEN CAST(row_index AS STRING) WHEN k % 101 = 0 THEN '' ELSE CAST(row_index + 1 AS STRING) END AS sl_no,
  CASE k % 23 WHEN 0 THEN 'See Sl. No. ' || CAST(k % 7 AS STRING) || ' Agra (U.A.)' WHEN 1 THEN 'District Total'
    WHEN 2 THEN '(ii) Lines ' || CAST(k AS STRING) WHEN 3 THEN 'Agra (U.A.) ' || CAST(k AS STRING) WHEN 4 THEN 'Nil'
    WHEN 5 THEN 'Civil Lines ' || CAST(k % 1000 AS STRING) WHEN 6 THEN 'Town-' || CAST(k % 40 AS STRING)
    ELSE 'Town ' || CAST(k AS STRING) END AS town_name,
  {", ".join(f"CASE WHEN k % 211 = 0 THEN '' ELSE {e} END AS {v}" for v, e in _DATA.items())}
FROM ({ROWS}) r"""

#: DuckDB: the long cells, typed as the operators do.
CELLS = "cells AS (" + " UNION ALL ".join(f"SELECT table_id, row_index, {i + 1} AS column_no, '{v}' AS variable, '{t}' AS data_type, {v} AS raw_value FROM wide" for i, (v, t) in enumerate(VARIABLES)) + ")"
NULL_MARK = r"(?i)(?:nil|n\.?a\.?|none|[-–—.·…]+)"
CODES = "(?:HC|HL|MT|WB|B|C|T)"
TYPED = rf"""WITH wide AS ({WIDE}), {CELLS},
sq AS (SELECT *, trim(regexp_replace(raw_value, '\s+', ' ', 'g')) AS s FROM cells),
nm AS (SELECT *, CASE WHEN s = '' OR regexp_full_match(s, '{NULL_MARK}') THEN NULL ELSE s END AS val FROM sq),
nb AS (SELECT *, regexp_replace(replace(replace(replace(replace(val, ',', ''), 'O', '0'), 'o', '0'), ' ', ''), '[)\]}}]+$', '') AS num FROM nm),
ty AS (SELECT *, CASE WHEN data_type = 'integer' AND regexp_full_match(num, '[+-]?[0-9]+') THEN TRY_CAST(num AS BIGINT) END AS int_value,
  CASE WHEN data_type <> 'integer' THEN val END AS str_value,
  CASE WHEN data_type = 'integer' AND val IS NOT NULL AND NOT regexp_full_match(num, '[+-]?[0-9]+') THEN variable || ': expected integer for ''' || val || '''' END AS parse_error FROM nb),
typed AS (SELECT *, CASE WHEN parse_error IS NOT NULL THEN 'AMBIGUOUS_OCR'
  WHEN variable = 'night_soil_disposal_method' AND val IS NULL THEN NULL
  WHEN variable = 'night_soil_disposal_method' AND NOT regexp_full_match(val, '(?i){CODES}(?:/{CODES})*') THEN 'AMBIGUOUS_HISTORIC_CODE'
  WHEN data_type <> 'integer' OR val IS NULL THEN NULL
  ELSE nullif(concat_ws('|', CASE WHEN regexp_matches(raw_value, '\d\s+\d') THEN 'SPACED_DIGITS' END, CASE WHEN regexp_matches(raw_value, '[Oo]') THEN 'LETTER_O_AS_ZERO' END,
    CASE WHEN regexp_matches(raw_value, '[)\]}}]\s*$') THEN 'TRAILING_MARK_REMOVED' END), '') END AS flag FROM ty)"""

CLASS = r"""CASE WHEN regexp_matches(name, '(?i)\bse[ec]\b') THEN 'CROSS_REFERENCE'
  WHEN contains(lower(name), 'district total') OR lower(name) = 'total' OR ends_with(lower(name), ' total') THEN 'TOTAL'
  WHEN regexp_matches(name, '(?i)^\(?[ivxlcdm]+\)?[.)]?\s') OR regexp_full_match(number, '(?i)\(?[ivxlcdm]+\)?') THEN 'COMPONENT'
  WHEN contains(lower(name), 'urban agglomeration') OR contains(lower(name), '(u.a') OR contains(lower(name), '(ua') THEN 'AGGREGATE' ELSE 'ORDINARY' END"""
TARGET = r"CASE WHEN regexp_matches(name, '(?i)\bse[ec]\b') THEN coalesce(nullif(trim(regexp_extract(name, '(?i)\bse[ec]\b\s*(.*)', 1)), ''), name) END"
ROW_CLASSES = rf"""{TYPED},
ids AS (SELECT table_id, row_index, max(CASE WHEN variable = 'sl_no' THEN CAST(int_value AS VARCHAR) END) AS serial, max(CASE WHEN variable = 'town_name' THEN str_value END) AS identity FROM typed GROUP BY ALL),
named AS (SELECT *, trim(coalesce(identity, '')) AS name, CASE WHEN serial = '0' THEN '' ELSE coalesce(serial, '') END AS number FROM ids),
classed AS (SELECT table_id, row_index, serial, identity, {CLASS} AS row_type, {TARGET} AS reference_target FROM named),
valued AS (SELECT t.*, c.row_type, CASE WHEN c.row_type = 'CROSS_REFERENCE' AND t.variable NOT IN ('sl_no', 'town_name') THEN NULL ELSE coalesce(CAST(t.int_value AS VARCHAR), t.str_value) END AS value
  FROM typed t JOIN classed c USING (table_id, row_index))"""


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Runs shared SQL over the driver tables that it names."""
    names = {n for n in re.findall(r"\b(?:FROM|JOIN)\s+([a-z]+)\b", text) if n in TABLES}
    text = text.replace("{", "{{").replace("}", "}}")
    for name in names:
        text = re.sub(rf"\b(FROM|JOIN)\s+{name}\b", rf"\1 {{{name}}}", text)
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations", "benchmark")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sql(spark, sf_dir, WIDE)
