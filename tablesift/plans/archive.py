"""Queries over volumes and pages, and over the coverage of the archive."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesift.functions import pages as P
from tablesift.operators import pages as O
from tablesift.operators import rollup as U
from tablesift.plans.bindings import sql
from tablesift.plans.registry import query

_NAMES = "SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN '1971 ' || p_name || '.pdf' WHEN 1 THEN ' 1971  ' || p_name || '.PDF' WHEN 2 THEN p_name || ' & Sons' WHEN 3 THEN '1971 Badha.pdf' ELSE p_name END AS name, CASE p_partkey % 4 WHEN 0 THEN '( ' || CAST(p_size AS STRING) || ' ) ' || p_name WHEN 1 THEN CAST(p_partkey AS STRING) || ' x' WHEN 2 THEN p_name || ' (' || CAST(p_size AS STRING) || ')' ELSE p_name END AS head FROM part"


@query("s_slug", f"WITH n AS ({_NAMES}) SELECT k, trim(regexp_replace(replace(lower(trim(name)), '&', 'and'), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM n")
def s_slug(spark, sf_dir):
    return sql(spark, sf_dir, _NAMES).select("k", P.slug(F.col("name")).alias("slug"))


_DISTRICT = r"trim(regexp_replace(regexp_replace(regexp_replace(name, '(?i)\.pdf$', ''), '(?i)^\s*1971\s+', ''), '\s+', ' ', 'g'))"


@query("s_district", f"WITH n AS ({_NAMES}) SELECT k, {_DISTRICT} AS district FROM n")
def s_district(spark, sf_dir):
    return sql(spark, sf_dir, _NAMES).select("k", P.district(F.col("name")).alias("district"))


@query("p_volumes", f"WITH n AS ({_NAMES}) SELECT lower({_DISTRICT}) AS district_key, max(name) AS file_name FROM n WHERE name <> '1971 Badha.pdf' GROUP BY 1")
def p_volumes(spark, sf_dir):
    return O.volumes(sql(spark, sf_dir, _NAMES).withColumnRenamed("name", "file_name"))


@query("s_category_file", f"WITH n AS ({_NAMES}) SELECT k, trim(regexp_replace(replace(lower(trim(name)), '&', 'and'), '[^a-z0-9]+', '_', 'g'), '_') || '_civic_1971.pdf' AS file FROM n")
def s_category_file(spark, sf_dir):
    return sql(spark, sf_dir, _NAMES).select("k", P.category_file(F.col("name"), "civic").alias("file"))


@query("s_page_no", rf"WITH n AS ({_NAMES}), h AS (SELECT k, trim(regexp_replace(substr(head, 1, 200), '\s+', ' ', 'g')) AS t FROM n) SELECT k, TRY_CAST(coalesce(nullif(regexp_extract(t, '^\(?\s*([0-9]{{1,4}})\s*\)?', 1), ''), nullif(regexp_extract(t, '\(\s*([0-9]{{1,4}})\s*\)', 1), '')) AS INTEGER) AS page_no FROM h")
def s_page_no(spark, sf_dir):
    return sql(spark, sf_dir, _NAMES).select("k", P.leading_page_number(F.col("head")).alias("page_no"))


@query("s_squash", "SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS squashed FROM documents")
def s_squash(spark, sf_dir):
    return sql(spark, sf_dir, "SELECT doc_id, text FROM documents").select("doc_id", P.squashed(F.col("text")).alias("squashed"))


#: Documents as pages of volumes, some of them with the words that tell a page's kind.
PAGES = """SELECT volume, CAST(page AS INT) AS page, CAST(count(*) OVER (PARTITION BY volume) AS INT) AS page_count,
  CASE WHEN page = 16 THEN 'MUNICIPAL  Finance' WHEN page = 17 + volume % 3 AND volume % 5 <> 0 THEN 'Number of Latrines; sewerage' WHEN page = 20 AND volume % 2 = 0 THEN 'Medical and Educational hospitals'
    WHEN page = 22 + volume % 4 THEN 'Cultural Facilities' WHEN page % 13 = 5 THEN 'Junior Basic School' WHEN page % 17 = 3 THEN NULL ELSE body END AS text
  FROM (SELECT lane + 30 * CAST(floor((n - 1) / (60 + lane)) AS BIGINT) AS volume, (n - 1) % (60 + lane) + 1 AS page, body
    FROM (SELECT CAST(o_custkey % 30 AS BIGINT) AS lane, row_number() OVER (PARTITION BY o_custkey % 30 ORDER BY o_orderkey) AS n, o_orderpriority AS body FROM orders) z) x"""
_T = r"trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g'))"
_SEEN = f"""WITH p AS ({PAGES}), n AS (SELECT volume, page, page_count, {_T} AS t FROM p WHERE page <= 45 OR page > page_count - 12),
s AS (SELECT *, contains(t, 'municipal') AS mu, regexp_matches(t, '\\b(la[tr]e?r)|sewer|sewel|\\bnight\\b|dight|road len|borne') AS ci,
  contains(t, 'medical') AND (contains(t, 'hospit') OR contains(t, 'dispensar') OR contains(t, 'nurs') OR contains(t, 'recrea') OR contains(t, 'educational')) AS me, contains(t, 'cultural facilities') AS cu,
  contains(t, 'junior basic') OR contains(t, 'senior basic') OR contains(t, 'abstract') OR contains(t, 'appendix') OR contains(t, 'district total') OR contains(t, 'name of tahsil') AS ap FROM n),
a AS (SELECT volume, max(page_count) AS pc, min(page) FILTER (ap AND page >= greatest(1, page_count - 11)) AS ap, min(page) FILTER (mu AND page BETWEEN 15 AND 45) AS mu FROM s GROUP BY volume),
c AS (SELECT a.volume, any_value(pc) AS pc, any_value(a.ap) AS ap, min(page) FILTER (ci AND page <= 45 AND page >= coalesce(a.mu, 0)) AS ci FROM a JOIN s USING (volume) GROUP BY a.volume),
m AS (SELECT c.volume, any_value(c.pc) AS pc, any_value(c.ap) AS ap, any_value(c.ci) AS ci, min(page) FILTER (me AND page <= 45 AND page >= c.ci) AS me, min(page) FILTER (cu AND page <= 45 AND page >= c.ci) AS cu FROM c JOIN s USING (volume) GROUP BY c.volume),
ranges AS (SELECT volume, ci AS civic_start, CASE WHEN ci IS NOT NULL THEN least(ci + 1, pc) END AS civic_end, coalesce(me, cu) AS medical_start,
  CASE WHEN me IS NOT NULL THEN least(CASE WHEN cu >= me THEN cu ELSE me + 1 END, pc) ELSE cu END AS medical_end,
  CASE WHEN ci IS NOT NULL THEN ap END AS appendix_start, CASE WHEN ci IS NOT NULL AND ap IS NOT NULL THEN least(pc, ap + 1) END AS appendix_end FROM m)"""


def _pages(spark, sf_dir):
    return O.read_pages(sql(spark, sf_dir, PAGES))


@query("s_page_class", _SEEN + " SELECT volume, page, mu AS municipal, ci AS civic, me AS medical, cu AS directory, ap AS appendix FROM s")
def s_page_class(spark, sf_dir):
    text = F.col("text")
    return _pages(spark, sf_dir).select("volume", "page", P.is_municipal(text).alias("municipal"), P.is_civic(text).alias("civic"), P.is_medical(text).alias("medical"), P.is_directory(text).alias("directory"), P.is_appendix(text).alias("appendix"))


@query("p_first_page", _SEEN + " SELECT volume, min(page) FILTER (ci) AS civic_page FROM s GROUP BY volume")
def p_first_page(spark, sf_dir):
    return _pages(spark, sf_dir).groupBy("volume").agg(F.min(F.when(P.is_civic(F.col("text")), F.col("page"))).alias("civic_page"))


@query("p_ranges", _SEEN + " SELECT * FROM ranges")
def p_ranges(spark, sf_dir):
    return O.ranges(_pages(spark, sf_dir))


@query(
    "p_page_set",
    _SEEN
    + " SELECT DISTINCT volume, unnest(range(civic_start, civic_end + 1)) AS page FROM ranges UNION SELECT volume, unnest(range(medical_start, greatest(medical_start, medical_end) + 1)) FROM ranges UNION SELECT volume, unnest(range(appendix_start, appendix_end + 1)) FROM ranges",
)
def p_page_set(spark, sf_dir):
    return O.page_set(O.ranges(_pages(spark, sf_dir))).select("volume", F.col("page").cast("long").alias("page"))


@query("p_has_text", f"WITH p AS ({PAGES}) SELECT volume, bool_or(trim(coalesce(text, '')) <> '') AS has_text FROM p GROUP BY volume")
def p_has_text(spark, sf_dir):
    return O.has_text(sql(spark, sf_dir, PAGES))


#: The archive: a nation is a state, a customer a district.
ARCHIVE = """SELECT ' ' || n_name AS state, CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_name END AS district, CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'No' WHEN 2 THEN '' ELSE 'Yes ' END AS available,
  CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'No' WHEN 2 THEN 'No PDF' WHEN 3 THEN 'other' ELSE 'Yes' END AS language, CAST(1971 + c_custkey % 2 * 10 AS INT) AS year FROM customer JOIN nation ON c_nationkey = n_nationkey"""
_CLEAN = f"WITH a AS ({ARCHIVE}), r AS (SELECT trim(state) AS state, trim(district) AS district, CASE WHEN coalesce(available, '') = '' THEN 'No' ELSE trim(available) END AS available, CASE WHEN coalesce(language, '') = '' THEN 'Unknown' ELSE trim(language) END AS language, year FROM a WHERE coalesce(state, '') <> '' AND coalesce(district, '') <> '')"
_COUNTS = "count(*) AS total, count(*) FILTER (available = 'Yes') AS available, count(*) FILTER (available <> 'Yes') AS not_available, count(*) FILTER (language = 'Yes') AS english, count(*) FILTER (language = 'No') AS hindi, count(*) FILTER (language = 'No PDF') AS no_pdf"
_PERCENT = "round(available / total * 100, 1) AS availability_pct"


def _rows(spark, sf_dir):
    return U.cleaned(sql(spark, sf_dir, ARCHIVE))


@query("d_rows", _CLEAN + " SELECT * FROM r")
def d_rows(spark, sf_dir):
    return _rows(spark, sf_dir)


@query("d_overall", _CLEAN + f", c AS (SELECT year, {_COUNTS}, count(*) FILTER (language NOT IN ('Yes', 'No', 'No PDF')) AS unknown, count(DISTINCT state) AS states_count FROM r GROUP BY year) SELECT *, {_PERCENT} FROM c")
def d_overall(spark, sf_dir):
    return U.overall(_rows(spark, sf_dir))


@query("d_state", _CLEAN + f", c AS (SELECT year, state, {_COUNTS} FROM r GROUP BY year, state) SELECT *, {_PERCENT} FROM c")
def d_state(spark, sf_dir):
    return U.by_state(_rows(spark, sf_dir))


@query("d_rollup", _CLEAN + f", c AS (SELECT year, {_COUNTS} FROM r GROUP BY GROUPING SETS ((year), ())) SELECT *, {_PERCENT} FROM c")
def d_rollup(spark, sf_dir):
    return U.all_years(_rows(spark, sf_dir))


@query("d_filter_sort", _CLEAN + f", c AS (SELECT year, state, {_COUNTS} FROM r WHERE contains(lower(state), 'a') OR contains(lower(district), 'a') GROUP BY year, state), p AS (SELECT *, {_PERCENT} FROM c) SELECT state, availability_pct, CASE WHEN availability_pct >= 80 THEN 'green' WHEN availability_pct >= 40 THEN 'amber' ELSE 'red' END AS colour FROM p WHERE year = 1971 ORDER BY availability_pct DESC, state")
def d_filter_sort(spark, sf_dir):
    states = U.by_state(U.matching(_rows(spark, sf_dir), state="A", year=1971))
    ordered = U.sort_states(states, "availability_pct", descending=True)
    return ordered.select("state", "availability_pct", U.colour(F.col("availability_pct")).alias("colour"))


@query("d_badges", _CLEAN + " SELECT CASE language WHEN 'Yes' THEN 'English' WHEN 'No' THEN 'Hindi' ELSE 'No PDF' END AS badge, count(*) AS n FROM r GROUP BY 1")
def d_badges(spark, sf_dir):
    return _rows(spark, sf_dir).groupBy(U.badge(F.col("language")).alias("badge")).agg(F.count("*").alias("n"))
