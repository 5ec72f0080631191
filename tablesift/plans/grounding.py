"""Queries over grounded answers, requests and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesift.functions import text as T
from tablesift.operators import tokens as K
from tablesift.plans.bindings import sql
from tablesift.plans.registry import query
from tablesift.sources.metadata import repeated_keys

_N = "CAST(event_id AS BIGINT)"
_X = f"{_N} * 37 % 900"
_Y = f"{_N} * 53 % 900"
#: Answers: a tagged reference with one or two boxes, shorthand, an unusable box, or no markup.
ANSWERS = f"""SELECT event_id AS id, CASE event_id % 6
  WHEN 0 THEN '<|ref|>' || event_type || ' ' || CAST(event_id AS STRING) || '<|/ref|><|det|>[[' || CAST({_X} AS STRING) || ', ' || CAST({_Y} AS STRING) || ', ' || CAST({_X} + 50 AS STRING) || ', ' || CAST({_Y} + 60 AS STRING) || ']]<|/det|>'
  WHEN 1 THEN '<|ref|>a<|/ref|><|det|>[[0, 0, 10, 10], [20, 0, ' || CAST({_X} + 21 AS STRING) || ', 10]]<|/det|> <|ref|>b<|/ref|> <|det|>[1, 2, 3, 4]<|/det|>'
  WHEN 2 THEN event_type || '[[' || CAST({_X} AS STRING) || ', 0, ' || CAST({_X} + 99 AS STRING) || ', 99]] Agra[[120, 0, 163, 111]]'
  WHEN 3 THEN '<|ref|>out<|/ref|><|det|>[[900, 0, ' || CAST(1001 + event_id % 50 AS STRING) || ', 50]]<|/det|>'
  WHEN 4 THEN 'no markup ' || CAST(event_id AS STRING)
  ELSE '<|ref|>p<|/ref|><|det|>[[1, 2, 3, 4]<|/det|>' END AS content FROM events"""
_BOX = r"\[\s*-?\d+(?:\.\d+)?\s*,\s*-?\d+(?:\.\d+)?\s*,\s*-?\d+(?:\.\d+)?\s*,\s*-?\d+(?:\.\d+)?\s*\]"
_SHORT = r"(?:^|\s)([^\[\r\n]+?)\s*(\[" + _BOX + r"\])"
_TOKENS = rf"""WITH a AS ({ANSWERS}),
r AS (SELECT id, content, regexp_extract_all(content, '(?s)<\|ref\|>(.*?)<\|/ref\|>\s*<\|det\|>(.*?)<\|/det\|>', 1) AS t, regexp_extract_all(content, '(?s)<\|ref\|>(.*?)<\|/ref\|>\s*<\|det\|>(.*?)<\|/det\|>', 2) AS b FROM a),
s AS (SELECT id, content, regexp_extract_all(content, '{_SHORT}', 1) AS t, regexp_extract_all(content, '{_SHORT}', 2) AS b FROM a),
e AS (SELECT id, 1 AS tagged, unnest(t) AS text, unnest(b) AS raw, generate_subscripts(t, 1) AS ref FROM r UNION ALL SELECT id, 0, unnest(t), unnest(b), generate_subscripts(t, 1) FROM s),
x AS (SELECT id, tagged, ref, trim(text) AS text, unnest(regexp_extract_all(raw, '{_BOX}')) AS box, generate_subscripts(regexp_extract_all(raw, '{_BOX}'), 1) AS n FROM e),
v AS (SELECT *, list_transform(string_split(regexp_replace(box, '[\[\]\s]', '', 'g'), ','), lambda z: CAST(z AS DOUBLE)) AS c FROM x),
g AS (SELECT * FROM v WHERE 0 <= c[1] AND c[1] < c[3] AND c[3] <= 1000 AND 0 <= c[2] AND c[2] < c[4] AND c[4] <= 1000),
k AS (SELECT *, max(tagged) OVER (PARTITION BY id) AS best FROM g),
tokens AS (SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY ref, n) - 1 AS INTEGER) AS token_idx, text, c[1] AS x0, c[2] AS y0, c[3] AS x1, c[4] AS y1 FROM k WHERE tagged = best)"""


def _tokens(spark, sf_dir):
    parsed = sql(spark, sf_dir, ANSWERS).select("id", F.posexplode(K.parse_tokens(F.col("content"))).alias("token_idx", "t"))
    box = F.col("t.box")
    return parsed.select("id", "token_idx", "t.text", *[F.get(box, F.lit(i)).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


@query("t_parse_tokens", _TOKENS + " SELECT * FROM tokens")
def t_parse_tokens(spark, sf_dir):
    return _tokens(spark, sf_dir)


@query("t_parse_boxes", _TOKENS + " SELECT id, count(*) AS boxes, sum(x1 - x0) AS width FROM tokens GROUP BY id")
def t_parse_boxes(spark, sf_dir):
    return _tokens(spark, sf_dir).groupBy("id").agg(F.count("*").alias("boxes"), F.sum(F.col("x1") - F.col("x0")).alias("width"))


@query("t_usable", _TOKENS + " SELECT a.id, count(tokens.id) > 0 AS usable FROM a LEFT JOIN tokens USING (id) GROUP BY a.id")
def t_usable(spark, sf_dir):
    return sql(spark, sf_dir, ANSWERS).select("id", K.is_usable(K.parse_tokens(F.col("content"))).alias("usable"))


@query("t_issues", _TOKENS + ", bad AS (SELECT e.id, count(*) AS n FROM e WHERE tagged = 1 AND NOT EXISTS (SELECT 1 FROM g WHERE g.id = e.id AND g.tagged = 1 AND g.ref = e.ref) GROUP BY e.id) SELECT a.id, CAST(coalesce(bad.n, 0) + CASE WHEN a.id NOT IN (SELECT id FROM tokens) THEN 1 ELSE 0 END AS INTEGER) AS issues FROM a LEFT JOIN bad USING (id)")
def t_issues(spark, sf_dir):
    return sql(spark, sf_dir, ANSWERS).select("id", F.size(K.parse_issues(F.col("content"))).alias("issues"))


@query("t_scale", _TOKENS + " SELECT id, token_idx, round(100 + x0 / 1000 * 500, 6) AS px0, round(10 + y0 / 1000 * 40, 6) AS py0, round(100 + x1 / 1000 * 500, 6) AS px1 FROM tokens")
def t_scale(spark, sf_dir):
    box = K.scaled(F.array("x0", "y0", "x1", "y1"), F.lit(100.0), F.lit(10.0), F.lit(600.0), F.lit(50.0))
    return _tokens(spark, sf_dir).withColumn("b", box).select("id", "token_idx", F.round("b.x0", 6).alias("px0"), F.round("b.y0", 6).alias("py0"), F.round("b.x1", 6).alias("px1"))


#: Tokens of cells: three rows of words in each table, and four column spans that share their edges.
PLACED = """SELECT CAST(user_id % 40 AS BIGINT) AS table_id, CAST(event_id % 5 AS BIGINT) AS row_index, event_id AS token_idx,
  CASE WHEN event_id % 13 = 0 THEN ' ' ELSE event_type || CAST(event_id % 10 AS STRING) END AS text, CAST(event_id * 41 % 480 AS DOUBLE) AS x0, CAST(event_id * 41 % 480 + 20 AS DOUBLE) AS x1 FROM events"""
SPANS = "SELECT CAST(r_regionkey AS BIGINT) AS column_no, CAST(r_regionkey * 100 + 10 AS INT) AS x_start, CAST(r_regionkey * 100 + 110 AS INT) AS x_end FROM region WHERE r_regionkey < 4"


@query(
    "t_assign",
    f"""WITH t AS ({PLACED}), s AS ({SPANS}), m AS (SELECT t.*, s.column_no, row_number() OVER (PARTITION BY token_idx ORDER BY column_no) AS n FROM t JOIN s ON (x0 + x1) / 2 BETWEEN x_start AND x_end)
SELECT table_id, row_index, column_no, coalesce(string_agg(nullif(trim(text), ''), ' ' ORDER BY x0, token_idx), '') AS raw_value FROM m WHERE n = 1 GROUP BY table_id, row_index, column_no""",
)
def t_assign(spark, sf_dir):
    spans = sql(spark, sf_dir, SPANS).withColumn("page", F.lit(1))
    placed = sql(spark, sf_dir, PLACED).withColumn("page", F.lit(1))
    return K.cell_text(K.assigned(placed, spans, ("page",)))


PANELS = """SELECT CAST(user_id % 30 AS BIGINT) AS table_id, CAST(event_id % 40 AS BIGINT) AS row_index, CAST(event_id % 3 AS INT) AS panel_order, event_id % 3 = 0 AS is_anchor,
  CASE event_id % 4 WHEN 0 THEN 'town_name' WHEN 1 THEN 'sl_no' WHEN 2 THEN 'roads' ELSE 'wells' END AS variable,
  max(CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 17 = 0 THEN 'See Agra' ELSE event_type || CAST(event_id % 100 AS STRING) END) AS raw_value FROM events GROUP BY 1, 2, 3, 4, 5"""


@query(
    "t_merge_anchor",
    rf"""WITH c AS ({PANELS}), x AS (SELECT DISTINCT table_id, row_index FROM c WHERE is_anchor AND variable IN ('sl_no', 'town_name') AND regexp_matches(raw_value, '(?i)\bse[ec]\b')),
k AS (SELECT * FROM c WHERE is_anchor UNION ALL SELECT * FROM c WHERE NOT is_anchor AND variable NOT IN ('sl_no', 'town_name') AND NOT EXISTS (SELECT 1 FROM x WHERE x.table_id = c.table_id AND x.row_index = c.row_index))
SELECT table_id, row_index, variable, raw_value FROM k QUALIFY row_number() OVER (PARTITION BY table_id, row_index, variable ORDER BY trim(raw_value) = '', panel_order) = 1""",
)
def t_merge_anchor(spark, sf_dir):
    return K.merged_panels(sql(spark, sf_dir, PANELS))


_LINES = "SELECT event_id AS id, CASE event_id % 3 WHEN 0 THEN '1 2 25 26' WHEN 1 THEN event_type || '  ' || CAST(event_id AS STRING) ELSE 'x' END AS line, CAST(event_id % 100 AS DOUBLE) AS x0, CAST(event_id % 100 + 401 AS DOUBLE) AS x1 FROM events"


@query(
    "t_words",
    rf"WITH l AS ({_LINES}), w AS (SELECT id, x0, x1, string_split(trim(regexp_replace(line, '\s+', ' ', 'g')), ' ') AS ws FROM l), u AS (SELECT id, x0, (x1 - x0) / len(ws) AS width, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM w) SELECT id, CAST(i AS INTEGER) AS word_idx, word, CAST(round_even(x0 + width * i, 0) AS INTEGER) AS x0, CAST(round_even(x0 + width * (i + 1), 0) AS INTEGER) AS x1 FROM u",
)
def t_words(spark, sf_dir):
    return sql(spark, sf_dir, _LINES).select("id", F.inline(K.words_of_line(F.col("line"), F.col("x0"), F.col("x1"))))


_PARTS = "SELECT p_partkey AS k, p_brand, CASE p_partkey % 6 WHEN 0 THEN 'HC/MT/B' WHEN 1 THEN 'HC/' WHEN 2 THEN p_brand WHEN 3 THEN 'nil' WHEN 4 THEN '--' ELSE 'n.a.' END AS code, '(' || CAST(p_size AS STRING) || ')' AS printed FROM part"


@query("s_code_list", rf"WITH p AS ({_PARTS}) SELECT k, regexp_full_match(code, '(?i)(?:|nil|[-–—.·…]+|(?:HC|HL|MT|WB|B|C|T)(?:/(?:HC|HL|MT|WB|B|C|T))*)') AS ok FROM p")
def s_code_list(spark, sf_dir):
    return sql(spark, sf_dir, _PARTS).select("k", T.is_code_list(F.col("code")).alias("ok"))


@query("s_printed_number", rf"WITH p AS ({_PARTS}), d AS (SELECT k, regexp_replace(trim(printed), '^[^0-9]+|[^0-9]+$', '', 'g') AS n FROM p) SELECT k, CASE WHEN regexp_full_match(n, '[0-9]{{1,2}}') AND CAST(n AS INTEGER) BETWEEN 1 AND 50 THEN CAST(n AS INTEGER) END AS number FROM d")
def s_printed_number(spark, sf_dir):
    return sql(spark, sf_dir, _PARTS).select("k", T.printed_number(F.col("printed")).alias("number"))


_TALK = "SELECT conv_id, turn, CASE (conv_id + turn) % 4 WHEN 0 THEN '<|ref|>' || text || '<|/ref|>[[1, 2, 3, 4]]' WHEN 1 THEN 'Possible printed forms ' || text WHEN 2 THEN role ELSE text END AS answer FROM conversations"
_STRIPPED = r"trim(regexp_replace(regexp_replace(regexp_replace(answer, '<\|/?(?:ref|det)\|>', ' ', 'g'), '(?s)\[\[.*?\]\]', ' ', 'g'), '\s+', ' ', 'g'))"


@query("s_markup_strip", f"WITH t AS ({_TALK}) SELECT conv_id, turn, {_STRIPPED} AS plain FROM t")
def s_markup_strip(spark, sf_dir):
    return sql(spark, sf_dir, _TALK).select("conv_id", "turn", T.strip_markup(F.col("answer")).alias("plain"))


_LEAKS = " OR ".join(f"contains(lower(s), '{m}')" for m in T.LEAK_MARKS)


@query("s_cell_guard", f"WITH t AS ({_TALK}), p AS (SELECT *, {_STRIPPED} AS s FROM t) SELECT conv_id, turn, CASE WHEN length(s) > 250 OR {_LEAKS} THEN '' ELSE s END AS text, CASE WHEN length(s) > 250 OR {_LEAKS} THEN 'probable schema or prompt leakage' END AS issue FROM p")
def s_cell_guard(spark, sf_dir):
    guarded = sql(spark, sf_dir, _TALK).withColumn("g", T.cell_guard(F.col("answer"), F.lit(None).cast("string")))
    return guarded.select("conv_id", "turn", "g.text", "g.issue")


@query("s_identity_key", r"SELECT doc_id, trim(regexp_replace(lower(text), '[^\pL\pN_]+', ' ', 'g')) AS key FROM documents")
def s_identity_key(spark, sf_dir):
    return sql(spark, sf_dir, "SELECT doc_id, text FROM documents").select("doc_id", T.identity_key(F.col("text")).alias("key"))


@query("s_title_words", "WITH w AS (SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN 'STATEMENT.' WHEN 1 THEN 'Notes:' WHEN 2 THEN '-Appendix' WHEN 3 THEN 'Source' ELSE p_name END AS word FROM part) SELECT k, trim(lower(word), '.,:-') IN ('statement', 'directory', 'appendix') AS is_title, regexp_replace(lower(word), '[^a-z]', '', 'g') IN ('note', 'notes', 'source', 'footnote') AS is_footer FROM w")
def s_title_words(spark, sf_dir):
    words = sql(spark, sf_dir, "SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN 'STATEMENT.' WHEN 1 THEN 'Notes:' WHEN 2 THEN '-Appendix' WHEN 3 THEN 'Source' ELSE p_name END AS word FROM part")
    return words.select("k", T.is_title_word(F.col("word")).alias("is_title"), T.is_footer_word(F.col("word")).alias("is_footer"))


_SCORES = "SELECT event_id AS id, event_id % 101 / CAST(100 AS DOUBLE) AS score FROM events"


@query("s_sequence_quality", f"WITH s AS ({_SCORES}) SELECT id, round(CAST(0.95 AS DOUBLE) + least(greatest((score - CAST(0.62 AS DOUBLE)) / CAST(0.38 AS DOUBLE), 0), 1) * CAST(0.05 AS DOUBLE), 4) AS quality FROM s")
def s_sequence_quality(spark, sf_dir):
    return sql(spark, sf_dir, _SCORES).select("id", T.sequence_quality(F.col("score")).alias("quality"))


_REQUESTS = "SELECT event_id AS id, CAST(user_id AS STRING) AS pdf, CAST(event_id % 50 AS STRING) AS row_no, CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN '' ELSE event_type END AS panel FROM events"
_KEY = """sha256('{"panel":' || coalesce('"' || panel || '"', 'null') || ',"pdf":"' || pdf || '","row_no":"' || row_no || '"}')"""


@query("c_request_keys", f"WITH r AS ({_REQUESTS}) SELECT id, {_KEY} AS cache_key FROM r")
def c_request_keys(spark, sf_dir):
    return sql(spark, sf_dir, _REQUESTS).select("id", K.cache_key(pdf=F.col("pdf"), row_no=F.col("row_no"), panel=F.col("panel")).alias("cache_key"))


@query("c_cache_miss", f"WITH r AS ({_REQUESTS}), k AS (SELECT id, {_KEY} AS cache_key FROM r), c AS (SELECT cache_key FROM k WHERE id % 4 = 0 AND id % 3 <> 0) SELECT id, cache_key FROM k WHERE cache_key NOT IN (SELECT cache_key FROM c)")
def c_cache_miss(spark, sf_dir):
    keyed = sql(spark, sf_dir, _REQUESTS).select("id", K.cache_key(pdf=F.col("pdf"), row_no=F.col("row_no"), panel=F.col("panel")).alias("cache_key"))
    cache = keyed.filter("id % 4 = 0").select("cache_key", F.lit("{}").alias("response"), (F.col("id") % 3 != 0).alias("ok"))
    return K.uncached(keyed, cache)


_RESPONSES = """SELECT event_id AS id, '{"id":' || CAST(event_id AS STRING) || ', "b":{"z":1,"a":"' || event_type || '"},"a":null}' AS response FROM events"""


@query("x_response_hash", f"""WITH r AS ({_RESPONSES}) SELECT event_id AS id, sha256('{{"a": null, "b": {{"a": "' || event_type || '", "z": 1}}, "id": ' || CAST(event_id AS VARCHAR) || '}}') AS response_hash FROM events""")
def x_response_hash(spark, sf_dir):
    return sql(spark, sf_dir, _RESPONSES).select("id", K.response_hash(F.col("response")).alias("response_hash"))


_ENVELOPES = """SELECT event_id AS id, CASE event_id % 6 WHEN 0 THEN '{"choices":[{"message":{"content":"' || event_type || '"}}]}' WHEN 1 THEN '{"choices":[{"message":{"content":12}}]}' WHEN 2 THEN '{"choices":[]}' WHEN 3 THEN '{"choices":[{"message":{"content":null}}]}' WHEN 4 THEN '{"choices":[{"message":{"content":["x"]}}]}' ELSE 'no json' END AS response FROM events"""


@query(
    "x_content",
    "SELECT event_id AS id, CASE WHEN event_id % 6 = 0 THEN event_type ELSE '' END AS content, CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'response content is not a string' WHEN 4 THEN 'response content is not a string' ELSE 'invalid response envelope' END AS error FROM events",
)
def x_content(spark, sf_dir):
    return sql(spark, sf_dir, _ENVELOPES).select("id", K.message_content(F.col("response")).alias("m")).select("id", "m.content", "m.error")


_PRINTED = "SELECT CAST(user_id AS BIGINT) AS page, event_id AS id, CAST(event_id * 37 % 1000 AS INT) AS x, CAST(event_id * 53 % 700 AS INT) AS y, event_type AS text FROM events"


@query(
    "t_embedded",
    f"WITH w AS ({_PRINTED}), c AS (SELECT * FROM w WHERE id % 2 = 0), o AS (SELECT * FROM w WHERE id % 2 = 1) SELECT c.page, c.id, coalesce(string_agg(o.text, ' ' ORDER BY o.y, o.x, o.text) FILTER (o.x >= c.x AND o.x + 60 <= c.x + 400 AND o.y < c.y + 100 AND o.y + 20 > c.y), '') AS embedded FROM c LEFT JOIN o ON o.page = c.page GROUP BY c.page, c.id",
)
def t_embedded(spark, sf_dir):
    printed = sql(spark, sf_dir, _PRINTED)
    cells = printed.filter("id % 2 = 0").select("page", "id", F.col("x").alias("x0"), F.col("y").alias("y0"), (F.col("x") + 400).alias("x1"), (F.col("y") + 100).alias("y1"))
    words = printed.filter("id % 2 = 1").select("page", "text", F.col("x").alias("wx0"), F.col("y").alias("wy0"), (F.col("x") + 60).alias("wx1"), (F.col("y") + 20).alias("wy1"))
    return K.embedded_text(cells, words, ["page"], "id")


_FILES = "SELECT CASE WHEN p_partkey % 10 = 0 THEN upper(p_name) ELSE p_name END AS file_name, 'id' || CAST(p_partkey % 1500 AS STRING) AS pdf_id FROM part"


@query("m_unique_keys", f"WITH f AS ({_FILES}) SELECT 'file_name' AS key_name, lower(file_name) AS key, count(*) AS n FROM f GROUP BY 2 HAVING count(*) > 1 UNION ALL SELECT 'pdf_id', lower(pdf_id), count(*) FROM f GROUP BY 2 HAVING count(*) > 1")
def m_unique_keys(spark, sf_dir):
    return repeated_keys(sql(spark, sf_dir, _FILES))


@query("m_lookup_miss", "SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0)")
def m_lookup_miss(spark, sf_dir):
    wanted = sql(spark, sf_dir, "SELECT DISTINCT l_partkey FROM lineitem")
    known = sql(spark, sf_dir, "SELECT p_partkey AS l_partkey FROM part WHERE p_partkey % 3 <> 0")
    return wanted.join(known, "l_partkey", "left_anti")
