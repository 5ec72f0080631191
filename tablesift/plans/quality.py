"""Queries over typed cells: normalisation, rules, the gate and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.functions import text as T
from tablesift.operators import cells as C
from tablesift.operators import gate as G
from tablesift.operators import rules as R
from tablesift.plans.bindings import CELLS, ROW_CLASSES, TYPED, VARIABLES, WIDE, sql, wide
from tablesift.plans.registry import query
from tablesift.sources.sinks import export_types as typed_export
from tablesift.sources.sinks import routed

NAMES = [v for v, _ in VARIABLES]
_DATA = "variable NOT IN ('sl_no', 'town_name')"


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.to_long(wide(spark, sf_dir), VARIABLES)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.typed_cells(_long(spark, sf_dir))


def _all(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    typed = _typed(spark, sf_dir)
    rows = C.classified_rows(typed)
    return typed, rows, C.values(typed, rows)


@query("s_null_marker", TYPED + " SELECT table_id, row_index, variable, val AS value FROM typed")
def s_null_marker(spark, sf_dir):
    return _long(spark, sf_dir).select("table_id", "row_index", "variable", T.null_mark(F.col("raw_value")).alias("value"))


@query("s_number_clean", TYPED + " SELECT table_id, row_index, variable, num AS number FROM typed WHERE data_type = 'integer'")
def s_number_clean(spark, sf_dir):
    cells = _long(spark, sf_dir).filter("data_type = 'integer'")
    return cells.select("table_id", "row_index", "variable", T.clean_number(T.null_mark(F.col("raw_value"))).alias("number"))


@query("s_typed_cast", TYPED + " SELECT table_id, row_index, variable, int_value, str_value, parse_error FROM typed")
def s_typed_cast(spark, sf_dir):
    return _typed(spark, sf_dir).select("table_id", "row_index", "variable", "int_value", "str_value", "parse_error")


@query("s_review_flag", TYPED + " SELECT variable, coalesce(flag, 'none') AS flag, count(*) AS n FROM typed GROUP BY ALL")
def s_review_flag(spark, sf_dir):
    return _typed(spark, sf_dir).groupBy("variable", F.coalesce("flag", F.lit("none")).alias("flag")).agg(F.count("*").alias("n"))


@query("s_row_class", ROW_CLASSES + " SELECT * FROM classed")
def s_row_class(spark, sf_dir):
    return C.classified_rows(_typed(spark, sf_dir))


_ROAD = "SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 0 THEN 'PR 14.50 KR 3.20' WHEN 1 THEN 'Pucca: ' || CAST(p_size AS STRING) WHEN 2 THEN 'Nil' WHEN 3 THEN 'KUTCHA-2.5 PR=' || CAST(p_size AS STRING) || '.5' WHEN 4 THEN 'katcha ' || CAST(p_size AS STRING) ELSE CAST(p_size AS STRING) END AS raw FROM part"


@query("s_road_lengths", rf"WITH r AS ({_ROAD}), u AS (SELECT k, upper(CASE WHEN raw = 'Nil' THEN '' ELSE raw END) AS s FROM r) SELECT k, TRY_CAST(nullif(regexp_extract(s, '(?:PR|PUCCA)\s*[:=-]?\s*(\d+(?:\.\d+)?)', 1), '') AS DOUBLE) AS pucca_road_km, TRY_CAST(nullif(regexp_extract(s, '(?:KR|K[AU]TCH?A)\s*[:=-]?\s*(\d+(?:\.\d+)?)', 1), '') AS DOUBLE) AS kutcha_road_km FROM u")
def s_road_lengths(spark, sf_dir):
    return sql(spark, sf_dir, _ROAD).select("k", F.col("k").alias("__"), T.road_lengths(F.col("raw")).alias("r")).select("k", "r.pucca_road_km", "r.kutcha_road_km")


@query("cells_long", f"WITH wide AS ({WIDE}), {CELLS} SELECT * FROM cells")
def cells_long(spark, sf_dir):
    return _long(spark, sf_dir)


@query("cells_wide", f"SELECT * FROM ({WIDE}) w")
def cells_wide(spark, sf_dir):
    return C.wide(_long(spark, sf_dir), NAMES)


_FLAGS = ", ".join(f"max(CASE WHEN variable = '{v}' THEN raw_value END) AS {v}, max(CASE WHEN variable = '{v}' THEN flag END) AS {v}_flag" for v in NAMES)


@query("cells_flags_wide", TYPED + f" SELECT table_id, row_index, {_FLAGS}, bool_or(flag IS NOT NULL) AS requires_review FROM typed GROUP BY table_id, row_index")
def cells_flags_wide(spark, sf_dir):
    return C.flags_wide(_typed(spark, sf_dir), NAMES)


@query("cells_values", ROW_CLASSES + r""" SELECT table_id, row_index, variable, value,
  CASE WHEN variable = 'road_length_km' THEN TRY_CAST(nullif(regexp_extract(upper(coalesce(val, '')), '(?:PR|PUCCA)\s*[:=-]?\s*(\d+(?:\.\d+)?)', 1), '') AS DOUBLE) END AS pucca_road_km FROM valued""")
def cells_values(spark, sf_dir):
    return _all(spark, sf_dir)[2].select("table_id", "row_index", "variable", "value", "pucca_road_km")


def _finding(code: str, message: str, row: str = "row_index", variable: str = "variable") -> str:
    return f"SELECT table_id, '{code}' AS code, 'ERROR' AS severity, {message} AS message, CAST({row} AS BIGINT) AS row_index, CAST({variable} AS VARCHAR) AS variable"


_RULES = {
    "r_type_parse": _finding("type_parse", "parse_error") + " FROM typed WHERE parse_error IS NOT NULL",
    "r_ambiguous": _finding("ambiguous_ocr", "variable || ': ' || flag || ' for ''' || raw_value || ''''") + " FROM typed WHERE parse_error IS NULL AND flag IS NOT NULL",
    "r_negative": _finding("nonnegative", "'Negative count/value ' || int_value") + " FROM typed WHERE int_value < 0 AND variable <> 'sl_no'",
    "r_serial": _finding("serial_progression", "'Serial ' || number || ' follows ' || previous", variable="'sl_no'")
    + " FROM (SELECT *, coalesce(last_value(number IGNORE NULLS) OVER (PARTITION BY table_id ORDER BY row_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS previous FROM (SELECT *, CASE WHEN regexp_full_match(serial, '[0-9]+') AND serial <> '0' THEN TRY_CAST(serial AS BIGINT) END AS number FROM classed)) WHERE number <= previous",
    "r_identity": _finding("identity_missing", "'Row identity is blank'", variable="'town_name'") + " FROM classed WHERE trim(coalesce(identity, '')) = ''",
    "r_duplicate": _finding("duplicate_identity", "'Duplicate identity ''' || trim(identity) || ''''", variable="'town_name'")
    + r" FROM (SELECT *, count(*) OVER (PARTITION BY table_id, trim(regexp_replace(lower(identity), '[^\pL\pN_]+', ' ', 'g')) ORDER BY row_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM classed WHERE trim(coalesce(identity, '')) <> '') WHERE seen > 0 AND row_type = 'ORDINARY'",
    "r_xref_purity": "SELECT table_id, 'cross_reference_purity' AS code, 'ERROR' AS severity, 'Cross-reference has data in [''' || string_agg(variable, ''', ''' ORDER BY column_no) || ''']' AS message, row_index, CAST(NULL AS VARCHAR) AS variable FROM valued WHERE row_type = 'CROSS_REFERENCE' AND value IS NOT NULL AND " + _DATA + " GROUP BY table_id, row_index",
    "r_row_empty": _finding("ocr_completeness", "'Row has no transcribed data cells'")
    + f" FROM valued JOIN (SELECT table_id, row_index FROM valued WHERE row_type <> 'CROSS_REFERENCE' AND {_DATA} GROUP BY ALL HAVING NOT bool_or(trim(raw_value) <> '')) e USING (table_id, row_index) WHERE {_DATA}",
    "r_column_empty": f"SELECT table_id, 'column_ocr_completeness' AS code, 'ERROR' AS severity, 'Column ''' || variable || ''' has no transcribed values' AS message, CAST(NULL AS BIGINT) AS row_index, variable FROM valued WHERE row_type <> 'CROSS_REFERENCE' AND {_DATA} GROUP BY table_id, variable HAVING NOT bool_or(trim(raw_value) <> '')",
}
_ALL = " UNION ALL ".join(f"({s})" for s in _RULES.values())


def _register(name: str, build) -> None:
    @query(name, f"{ROW_CLASSES} {_RULES[name]}")
    def run(spark, sf_dir):
        return build(*_all(spark, sf_dir))


_register("r_type_parse", lambda typed, rows, valued: R.type_parse(typed))
_register("r_ambiguous", lambda typed, rows, valued: R.ambiguous(typed))
_register("r_negative", lambda typed, rows, valued: R.negative(typed))
_register("r_serial", lambda typed, rows, valued: R.serial_progression(rows))
_register("r_identity", lambda typed, rows, valued: R.identity_missing(rows))
_register("r_duplicate", lambda typed, rows, valued: R.duplicate_identity(rows))
_register("r_row_empty", lambda typed, rows, valued: R.row_completeness(valued))
_register("r_column_empty", lambda typed, rows, valued: R.column_completeness(valued))


#: Rows that come with data in a cross-reference: the values before blanking.
_SUPPLIED = ROW_CLASSES.replace("CASE WHEN c.row_type = 'CROSS_REFERENCE' AND t.variable NOT IN ('sl_no', 'town_name') THEN NULL ELSE coalesce(CAST(t.int_value AS VARCHAR), t.str_value) END", "coalesce(CAST(t.int_value AS VARCHAR), t.str_value)")


@query("r_xref_purity", f"{_SUPPLIED} {_RULES['r_xref_purity']}")
def r_xref_purity(spark, sf_dir):
    typed, rows, _ = _all(spark, sf_dir)
    supplied = typed.join(rows.select("table_id", "row_index", "row_type"), ["table_id", "row_index"]).withColumn("value", F.coalesce(F.col("int_value").cast("string"), F.col("str_value")))
    return R.reference_purity(supplied)


@query("findings_all", f"{ROW_CLASSES} {_ALL}")
def findings_all(spark, sf_dir):
    return R.all_findings(*_all(spark, sf_dir))


@query("x_retry_targets", f"{ROW_CLASSES}, f AS ({_ALL}) SELECT DISTINCT table_id, row_index, variable FROM f WHERE code IN ('type_parse', 'ambiguous_ocr', 'ocr_completeness', 'column_ocr_completeness') AND row_index IS NOT NULL AND variable IS NOT NULL")
def x_retry_targets(spark, sf_dir):
    return R.retry_targets(R.all_findings(*_all(spark, sf_dir)))


#: Totals: 25 tables of customers, most with a total row, every second total off by one.
TOTALS = """SELECT table_id, CAST(row_number() OVER (PARTITION BY table_id ORDER BY is_total, k) - 1 AS BIGINT) AS row_index,
  CASE WHEN is_total = 1 THEN 'DISTRICT TOTAL' ELSE 'Tahsil ' || CAST(k AS STRING) END AS town_name, CAST(n AS STRING) AS villages
  FROM (SELECT CAST(c_nationkey AS BIGINT) AS table_id, 0 AS is_total, c_custkey AS k, c_custkey % 100 AS n FROM customer
  UNION ALL SELECT CAST(c_nationkey AS BIGINT) AS table_id, 1 AS is_total, CAST(0 AS BIGINT) AS k, CAST(sum(c_custkey % 100) AS BIGINT) + c_nationkey % 2 AS n FROM customer WHERE c_nationkey % 5 <> 0 GROUP BY c_nationkey) x"""


def _totals(spark, sf_dir):
    typed = C.typed_cells(C.to_long(sql(spark, sf_dir, TOTALS), (("town_name", "string"), ("villages", "integer"))))
    rows = C.classified_rows(typed)
    return rows, C.values(typed, rows, with_roads=False)


@query("r_total_presence", f"WITH t AS ({TOTALS}), c AS (SELECT table_id, count(*) FILTER (town_name = 'DISTRICT TOTAL') AS n FROM t GROUP BY table_id) SELECT table_id, 'tahsil_total_presence' AS code, 'ERROR' AS severity, 'Expected one district total row; found ' || n AS message, CAST(NULL AS BIGINT) AS row_index, CAST(NULL AS VARCHAR) AS variable FROM c WHERE n <> 1")
def r_total_presence(spark, sf_dir):
    return R.total_presence(_totals(spark, sf_dir)[0])


@query(
    "r_total_sum",
    f"WITH t AS ({TOTALS}), c AS (SELECT table_id, sum(CAST(villages AS BIGINT)) FILTER (town_name <> 'DISTRICT TOTAL') AS parts, max(CAST(villages AS BIGINT)) FILTER (town_name = 'DISTRICT TOTAL') AS total, max(row_index) FILTER (town_name = 'DISTRICT TOTAL') AS row_index FROM t GROUP BY table_id) SELECT table_id, 'tahsil_total_sum' AS code, 'ERROR' AS severity, 'District total ' || total || ' != component sum ' || parts AS message, row_index, 'villages' AS variable FROM c WHERE total IS NOT NULL AND parts <> total",
)
def r_total_sum(spark, sf_dir):
    rows, valued = _totals(spark, sf_dir)
    return R.total_sum(valued, rows)


#: Table-level facts that come from layout and recognition.
TABLES = """SELECT table_id, 2 AS panels_expected, CASE WHEN table_id % 9 = 0 THEN 1 ELSE 2 END AS panels_found, n AS total_rows,
  CASE WHEN table_id % 7 = 0 THEN n - 1 ELSE n END AS aligned_min, n AS aligned_max, CASE WHEN table_id % 4 = 0 THEN 0.97 ELSE 1.0 END AS geometry_min,
  2 * n - table_id % 3 AS ocr_ok, 2 * n AS ocr_total
  FROM (SELECT CAST(o_custkey % 50 AS BIGINT) AS table_id, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_custkey % 50) t"""


def _tables(spark, sf_dir):
    return sql(spark, sf_dir, TABLES).withColumn("geometry_min", F.col("geometry_min").cast("double"))


@query("r_alignment", f"WITH t AS ({TABLES}) SELECT table_id, 'panel_discovery' AS code, 'ERROR' AS severity, 'One or more required panels were not discovered' AS message, CAST(NULL AS BIGINT) AS row_index, CAST(NULL AS VARCHAR) AS variable FROM t WHERE panels_found < panels_expected UNION ALL SELECT table_id, 'panel_alignment', 'ERROR', 'Panel row counts are not aligned: ' || aligned_min || '..' || aligned_max, NULL, NULL FROM t WHERE aligned_min <> total_rows OR aligned_max <> total_rows")
def r_alignment(spark, sf_dir):
    return R.panel_findings(_tables(spark, sf_dir))


#: The gate looks at the rules of minor harm too, so its tables are those where a third of the codes is left out.
_QUALITY = f"""{ROW_CLASSES}, t AS ({TABLES}), f AS ({_ALL}), p AS (SELECT table_id, count(DISTINCT row_index) AS total_rows, count(*) FILTER (trim(raw_value) <> '') AS cells, count(*) FILTER (parse_error IS NOT NULL) AS failures FROM typed GROUP BY table_id),
e AS (SELECT table_id, count(*) AS errors, count(*) FILTER (code NOT IN ('panel_discovery', 'panel_alignment', 'type_parse')) AS semantic_errors, count(DISTINCT row_index) AS error_rows, list_sort(list(DISTINCT row_index) FILTER (row_index IS NOT NULL))[1:10] AS first_failures FROM f GROUP BY table_id),
c AS (SELECT t.table_id, p.total_rows, greatest(p.total_rows - coalesce(error_rows, 0), 0) AS valid_rows, CAST(geometry_min AS DOUBLE) * CASE WHEN aligned_min = t.total_rows AND aligned_max = t.total_rows THEN 1.0 ELSE 0.5 END AS geometry,
  CAST(ocr_ok AS DOUBLE) / ocr_total AS ocr, 1 - CAST(failures AS DOUBLE) / cells AS parsing, greatest(0.0, 1 - CAST(coalesce(semantic_errors, 0) AS DOUBLE) / greatest(1, p.total_rows)) AS semantic, coalesce(errors, 0) AS errors, first_failures,
  panels_found >= panels_expected AND aligned_min = t.total_rows AND aligned_max = t.total_rows AS complete FROM t LEFT JOIN p USING (table_id) LEFT JOIN e USING (table_id)),
o AS (SELECT *, round(0.0 + CAST(0.30 AS DOUBLE) * geometry + CAST(0.35 AS DOUBLE) * ocr + CAST(0.15 AS DOUBLE) * parsing + CAST(0.20 AS DOUBLE) * semantic, 4) AS overall FROM c),
q AS (SELECT *, complete AND errors = 0 AND overall >= 0.95 AS is_valid, CASE WHEN complete AND errors = 0 AND overall >= 0.95 THEN 'CLEAN' ELSE 'QUARANTINED' END AS status FROM o)"""


def _gate_tables(spark, sf_dir):
    aligned = (F.col("aligned_min") == F.col("total_rows")) & (F.col("aligned_max") == F.col("total_rows"))
    return _tables(spark, sf_dir).select("table_id", (F.col("panels_found") >= F.col("panels_expected")).alias("panels_complete"), aligned.alias("aligned"), "geometry_min", "ocr_ok", "ocr_total")


def _quality(spark, sf_dir):
    typed, rows, valued = _all(spark, sf_dir)
    return G.quality(typed, R.all_findings(typed, rows, valued), _gate_tables(spark, sf_dir))


@query("q_components", _QUALITY + " SELECT table_id, round(geometry, 9) AS geometry, round(ocr, 9) AS ocr, round(parsing, 9) AS parsing, round(semantic, 9) AS semantic, overall FROM q")
def q_components(spark, sf_dir):
    return _quality(spark, sf_dir).select("table_id", *[F.round(c, 9).alias(c) for c in ("geometry", "ocr", "parsing", "semantic")], "overall")


@query("gate_status", _QUALITY + " SELECT table_id, total_rows, valid_rows, errors, first_failures, overall, is_valid, status FROM q")
def gate_status(spark, sf_dir):
    return _quality(spark, sf_dir).select("table_id", "total_rows", "valid_rows", "errors", "first_failures", "overall", "is_valid", "status")


#: A small clean world: tables of sound cells, some with one bad serial.
_SOUND = "SELECT CAST(o_custkey % 40 AS BIGINT) AS table_id, CAST(row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY o_orderkey) - 1 AS BIGINT) AS row_index, o_orderkey AS k FROM orders"
_SOUND_WIDE = f"SELECT table_id, row_index, CASE WHEN table_id % 10 = 3 AND row_index = 2 THEN '1' ELSE CAST(row_index + 1 AS STRING) END AS sl_no, 'Town ' || CAST(k AS STRING) AS town_name, CAST(k % 90 AS STRING) AS latrines FROM ({_SOUND}) r"


@query("route_export", f"WITH w AS ({_SOUND_WIDE}) SELECT *, CASE WHEN table_id % 10 = 3 THEN 'quarantine' ELSE 'clean' END AS area FROM w")
def route_export(spark, sf_dir):
    records = sql(spark, sf_dir, _SOUND_WIDE)
    typed = C.typed_cells(C.to_long(records, (("sl_no", "integer"), ("town_name", "string"), ("latrines", "integer"))))
    rows = C.classified_rows(typed)
    valued = C.values(typed, rows, with_roads=False)
    facts = records.groupBy("table_id").agg(F.lit(True).alias("panels_complete"), F.lit(True).alias("aligned"), F.lit(1.0).alias("geometry_min"), F.count("*").alias("ocr_ok"), F.count("*").alias("ocr_total"))
    return routed(records, G.quality(typed, R.all_findings(typed, rows, valued), facts))


_MANIFEST = "SELECT 'doc-' || CAST(user_id AS STRING) AS pdf_id, event_id AS completed_at, CASE event_id % 5 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'QUARANTINED' ELSE 'CLEAN' END AS status FROM events"
_LATEST = f"WITH m AS ({_MANIFEST}), l AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY pdf_id ORDER BY completed_at DESC) = 1)"


@query("manifest_latest", _LATEST + " SELECT * FROM l")
def manifest_latest(spark, sf_dir):
    return G.latest(sql(spark, sf_dir, _MANIFEST))


@query("status_counts", _LATEST + " SELECT s.status, count(l.pdf_id) AS n FROM (VALUES ('CLEAN'), ('QUARANTINED'), ('DRY_RUN'), ('ERROR')) s(status) LEFT JOIN l USING (status) GROUP BY s.status")
def status_counts(spark, sf_dir):
    return G.status_counts(G.latest(sql(spark, sf_dir, _MANIFEST)))


@query("exit_code", _LATEST + " SELECT CASE WHEN bool_or(status = 'ERROR') THEN 1 WHEN bool_or(status = 'QUARANTINED') THEN 2 ELSE 0 END AS exit_code FROM l")
def exit_code(spark, sf_dir):
    return G.exit_code(G.latest(sql(spark, sf_dir, _MANIFEST)))


_RESULTS = "SELECT CAST(user_id % 60 AS BIGINT) AS table_id, event_id % 3 = 0 AS cache_hit, CASE WHEN event_id % 5 <> 0 THEN event_id % 90 END AS prompt_tokens, event_id % 40 AS completion_tokens, event_id % 130 AS total_tokens, (event_id % 100) / CAST(100 AS DOUBLE) AS quality, CASE WHEN event_id % 9 = 0 THEN 'HTTP 500' END AS error, event_id % 2 = 0 AS usable, CASE WHEN event_id % 4 = 0 THEN ' ' ELSE 'x' END AS raw_text FROM events"


@query("q_usage", f"WITH r AS ({_RESULTS}) SELECT table_id, count(*) AS requests, count(*) FILTER (cache_hit) AS hits, count(*) FILTER (NOT cache_hit) AS misses, CAST(sum(coalesce(prompt_tokens, 0)) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, CAST(sum(total_tokens) AS BIGINT) AS total_tokens FROM r GROUP BY table_id")
def q_usage(spark, sf_dir):
    return G.usage(sql(spark, sf_dir, _RESULTS))


@query("q_ocr_success", f"WITH r AS ({_RESULTS}) SELECT table_id, count(*) FILTER (error IS NULL AND (usable OR trim(raw_text) <> '')) AS ocr_ok, count(*) AS ocr_total FROM r GROUP BY table_id")
def q_ocr_success(spark, sf_dir):
    return G.usable_results(sql(spark, sf_dir, _RESULTS))


@query("q_dry_run", f"WITH r AS ({_RESULTS}) SELECT table_id, min(quality) AS score FROM r GROUP BY table_id")
def q_dry_run(spark, sf_dir):
    return G.dry_run_score(sql(spark, sf_dir, _RESULTS))


_SECOND = "SELECT CAST(o_custkey % 50 AS BIGINT) AS table_id, CAST(row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) - 1 AS BIGINT) AS row_index, 'latrines' AS variable, CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE CAST(o_orderkey % 77 AS STRING) END AS raw_value FROM orders"


@query("x_retried_cells", f"WITH wide AS ({WIDE}), {CELLS}, s AS ({_SECOND}) SELECT c.table_id, c.row_index, c.column_no, c.variable, c.data_type, coalesce(nullif(CASE WHEN trim(s.raw_value) = '' THEN '' ELSE s.raw_value END, ''), c.raw_value) AS raw_value FROM cells c LEFT JOIN s USING (table_id, row_index, variable)")
def x_retried_cells(spark, sf_dir):
    return G.retried(_long(spark, sf_dir), sql(spark, sf_dir, _SECOND))


@query("manifest_errors", _LATEST + " SELECT pdf_id, CASE WHEN completed_at % 4 = 0 THEN NULL ELSE completed_at END AS completed_at, CASE WHEN completed_at % 4 = 0 THEN 'ERROR' ELSE status END AS status FROM l")
def manifest_errors(spark, sf_dir):
    latest = G.latest(sql(spark, sf_dir, _MANIFEST))
    errors = latest.filter("completed_at % 4 = 0").select("pdf_id", F.lit("broken").alias("error"))
    return G.with_errors(latest, errors)


@query("export_types", f"SELECT table_id, row_index, CAST(k AS VARCHAR) AS year_text, TRY_CAST(CAST(k % 3000 AS VARCHAR) AS BIGINT) AS year, TRY_CAST(CASE WHEN k % 2 = 0 THEN 'true' ELSE 'x' END AS BOOLEAN) AS requires_review, TRY_CAST(CASE WHEN k % 3 = 0 THEN 'n' ELSE '1.5' END AS DOUBLE) AS pucca_road_km FROM ({_SOUND}) r")
def export_types(spark, sf_dir):
    raw = sql(spark, sf_dir, f"SELECT table_id, row_index, k AS year_text, CAST(k % 3000 AS STRING) AS year, CASE WHEN k % 2 = 0 THEN 'true' ELSE 'x' END AS requires_review, CASE WHEN k % 3 = 0 THEN 'n' ELSE '1.5' END AS pucca_road_km FROM ({_SOUND}) r")
    return typed_export(raw, longs=("table_id", "row_index", "year"))
