"""Queries over page geometry: sequences, columns, rows and the pairing of panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesift.operators import geometry as G
from tablesift.plans.bindings import sql
from tablesift.plans.registry import query

PROFILE = "SELECT CAST(user_id % 20 AS BIGINT) AS page, CAST(event_id % 700 AS BIGINT) AS y, CAST(sum(CASE WHEN event_id % 7 = 0 THEN 0 ELSE 1 END) AS DOUBLE) AS ink FROM events GROUP BY 1, 2"
_SHARE = 0.3
_BANDS = f"""WITH p AS ({PROFILE}), d AS (SELECT *, max(ink) OVER (PARTITION BY page) AS most FROM p), k AS (SELECT page, y, y - row_number() OVER (PARTITION BY page ORDER BY y) AS island FROM d WHERE ink > most * CAST({_SHARE} AS DOUBLE)),
bands AS (SELECT page, min(y) AS start, max(y) + 1 AS stop FROM k GROUP BY page, island)"""


@query("g_islands", _BANDS + " SELECT * FROM bands")
def g_islands(spark, sf_dir):
    return G.ink_bands(sql(spark, sf_dir, PROFILE), ["page"], _SHARE)


#: Raw bands of 100 pages, some of them close together or overlapping.
RAW = "SELECT CAST(user_id % 100 AS BIGINT) AS page, CAST(event_id * 131 % 400000 AS BIGINT) AS start, CAST(event_id * 131 % 400000 + 12 + event_id % 30 AS BIGINT) AS stop, event_type AS text FROM events"


def _merged(source: str, gap: int) -> str:
    return f"""m0 AS (SELECT *, CASE WHEN start - max(stop) OVER (PARTITION BY page ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {gap} THEN 0 ELSE 1 END AS new FROM {source}),
m1 AS (SELECT *, sum(new) OVER (PARTITION BY page ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS island FROM m0),
merged AS (SELECT page, min(start) AS start, max(stop) AS stop FROM m1 GROUP BY page, island)"""


def _heights(source: str) -> str:
    return f"SELECT * FROM {source} WHERE stop - start BETWEEN 14 AND 220"


@query("g_merge", f"WITH r AS ({RAW}), {_merged('r', 6)} {_heights('merged')}")
def g_merge(spark, sf_dir):
    return G.row_heights(G.merged_bands(sql(spark, sf_dir, RAW).drop("text"), ["page"]))


_BODY_WORDS = f"SELECT page, text, CAST(start % 900 AS BIGINT) AS x0, CAST(start % 900 + 40 AS BIGINT) AS x1, start AS y0, stop AS y1 FROM ({RAW}) r"
_BODIES = f"SELECT DISTINCT page, 100 AS \"left\", 500 + page AS top, 800 AS \"right\", 380000 - page * 9 AS bottom FROM ({RAW}) r"


@query(
    "g_word_bands",
    f"WITH w AS ({_BODY_WORDS}), b AS ({_BODIES}), r AS (SELECT page, greatest(top, y0) - top AS start, least(bottom, y1) - top AS stop FROM w JOIN b USING (page) WHERE x1 >= b.left AND x0 <= b.right AND y1 >= top AND y0 <= bottom AND least(bottom, y1) > greatest(top, y0)), {_merged('r', 8)} {_heights('merged')}",
)
def g_word_bands(spark, sf_dir):
    bodies = sql(spark, sf_dir, _BODIES.replace('"', "`"))
    return G.word_bands(G.words_in_bodies(sql(spark, sf_dir, _BODY_WORDS), bodies, ["page"]), ["page"], 300)


@query("g_fallback", f"WITH r AS ({RAW}), ink AS (SELECT page, start, stop FROM r WHERE page % 3 <> 0) SELECT * FROM ink UNION ALL SELECT page, start, stop FROM r WHERE page NOT IN (SELECT page FROM ink)")
def g_fallback(spark, sf_dir):
    raw = sql(spark, sf_dir, RAW).drop("text")
    return G.with_fallback(raw.filter("page % 3 <> 0"), raw, ["page"])


#: Pages of up to 14 rows with an ordinary gap of 5, and on most pages one wide gap.
SECTIONS = "SELECT page, CAST(i * 30 + CASE WHEN i > 4 + page % 5 AND page % 4 <> 0 THEN 400 ELSE 0 END AS BIGINT) AS start, CAST(i * 30 + CASE WHEN i > 4 + page % 5 AND page % 4 <> 0 THEN 400 ELSE 0 END + 25 AS BIGINT) AS stop FROM (SELECT lane + 60 * CAST(floor((n - 1) / 14) AS BIGINT) AS page, (n - 1) % 14 + 1 AS i FROM (SELECT CAST(o_custkey % 60 AS BIGINT) AS lane, row_number() OVER (PARTITION BY o_custkey % 60 ORDER BY o_orderkey) AS n FROM orders) z) x"


@query(
    "g_gap_cut",
    f"""WITH b AS ({SECTIONS}), g AS (SELECT *, row_number() OVER w AS n, lead(start) OVER w - stop AS gap, count(*) OVER (PARTITION BY page) AS bands FROM b WINDOW w AS (PARTITION BY page ORDER BY start)),
t AS (SELECT page, list_sort(list(gap) FILTER (gap >= 0)) AS gaps FROM g GROUP BY page), l AS (SELECT g.*, greatest(150, coalesce(gaps[len(gaps) // 2 + 1], 0) * 4) AS cutoff FROM g JOIN t USING (page)),
c AS (SELECT page, min(n) FILTER (bands >= 4 AND n >= 2 AND gap > cutoff) AS cut FROM l GROUP BY page) SELECT page, start, stop FROM l JOIN c USING (page) WHERE cut IS NULL OR n <= cut""",
)
def g_gap_cut(spark, sf_dir):
    return G.before_section_gap(sql(spark, sf_dir, SECTIONS), ["page"])


@query("g_row_boxes", f"WITH b AS ({SECTIONS}) SELECT page, row_number() OVER (PARTITION BY page ORDER BY start, stop) - 1 AS row_index, 92 AS box_x0, greatest(0, 50 + start - 8) AS box_y0, 908 AS box_x1, least(700, 50 + stop + 8) AS box_y1, round((start + stop) / 2 / 900, 9) AS y_normalized FROM b")
def g_row_boxes(spark, sf_dir):
    body = sql(spark, sf_dir, SECTIONS).withColumns({"x0": F.lit(100), "x1": F.lit(900), "top": F.lit(50), "bottom": F.lit(950), "page_width": F.lit(1000), "page_height": F.lit(700)})
    return G.row_boxes(body, ["page"]).withColumn("y_normalized", F.round("y_normalized", 9))


OBSERVED = "SELECT CAST(user_id AS BIGINT) AS line, event_id % 9 + 1 AS value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events"


@query("g_lcs_score")
def g_lcs_score(spark, sf_dir):
    numbered = sql(spark, sf_dir, OBSERVED).withColumn("block", F.expr("(n - 1) div 9"))
    lines = numbered.groupBy("line", "block").agg(F.sort_array(F.collect_list(F.struct("n", F.col("value").cast("int").alias("value")))).alias("v"))
    return lines.select("line", "block", G.sequence_score(F.sequence(F.lit(1), F.lit(9)), F.col("v.value")).alias("score"))


@query("g_number_rows")
def g_number_rows(spark, sf_dir):
    tokens = sql(spark, sf_dir, "SELECT CAST(user_id AS BIGINT) AS page, CAST(event_id % 16 + 1 AS INT) AS value, CAST(event_id * 7 % 1000 AS DOUBLE) AS cx, CAST(event_id * 31 % 300 AS DOUBLE) AS cy FROM events")
    return G.number_rows(tokens, ["page"], 20)


_HEADS = ("Civic and other", "thon re", "x Statement V")
_PARTS = [["civic", "and", "other"], ["thon", "re"], ["statement"]]


@query(
    "g_heading",
    "SELECT doc_id, round((" + " + ".join("(" + " + ".join(f"CAST(contains(lower(text), '{p}') AS DOUBLE)" for p in parts) + f") / {len(parts)}" for parts in _PARTS) + ") / 3, 9) AS score FROM documents",
)
def g_heading(spark, sf_dir):
    return sql(spark, sf_dir, "SELECT doc_id, text FROM documents").select("doc_id", F.round(G.heading_score(F.col("text"), F.array(*map(F.lit, _HEADS))), 9).alias("score"))


CANDIDATES = "SELECT CAST(user_id % 40 AS BIGINT) AS table_id, 'p' || CAST(event_id % 3 AS STRING) AS panel_id, 1 + event_id % 2 AS page, CAST(event_id % 997 AS DOUBLE) AS cy, CAST(1000 AS DOUBLE) AS height, event_id % 101 / CAST(100 AS DOUBLE) AS score, event_id % 7 / CAST(6 AS DOUBLE) AS heading, event_id AS id FROM events"
_ACCEPTED = f"WITH c AS ({CANDIDATES}), k AS (SELECT * FROM c WHERE score >= 0.55 OR (score >= 0.35 AND heading >= 0.45))"
_ANCHORS = ", a AS (SELECT * FROM k WHERE panel_id = 'p0' QUALIFY row_number() OVER (PARTITION BY table_id ORDER BY heading DESC, score DESC, cy) = 1)"


def _candidates(spark, sf_dir):
    return sql(spark, sf_dir, CANDIDATES).filter(G.is_candidate(F.col("score"), F.col("heading")))


@query("g_candidates", _ACCEPTED + " SELECT table_id, panel_id, id FROM k")
def g_candidates(spark, sf_dir):
    return _candidates(spark, sf_dir).select("table_id", "panel_id", "id")


@query("g_anchor_pick", _ACCEPTED + _ANCHORS + " SELECT table_id, page, cy, score, heading FROM a")
def g_anchor_pick(spark, sf_dir):
    return G.anchor_choice(_candidates(spark, sf_dir).filter("panel_id = 'p0'"), ["table_id"]).select("table_id", "page", "cy", "score", "heading")


@query(
    "g_follow_pick",
    _ACCEPTED
    + _ANCHORS
    + """, f AS (SELECT k.*, CASE WHEN k.page <> a.page THEN abs(k.cy / k.height - a.cy / a.height) ELSE -k.score END AS first FROM k JOIN a USING (table_id) WHERE k.panel_id <> 'p0')
SELECT table_id, panel_id, page, cy, score, heading FROM f QUALIFY row_number() OVER (PARTITION BY table_id, panel_id ORDER BY first, heading DESC, score DESC, cy) = 1""",
)
def g_follow_pick(spark, sf_dir):
    found = _candidates(spark, sf_dir)
    anchors = G.anchor_choice(found.filter("panel_id = 'p0'"), ["table_id"])
    return G.follower_choice(found.filter("panel_id <> 'p0'"), anchors, ["table_id"]).select("table_id", "panel_id", "page", "cy", "score", "heading")


CENTRES = "SELECT line, CAST(n AS INT) AS idx, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(n * 50 + event_id % 7 AS DOUBLE) END AS centre FROM (SELECT lane * 100000 + CAST(floor((k - 1) / 10) AS BIGINT) AS line, event_id, (k - 1) % 10 + 1 AS n FROM (SELECT CAST(user_id AS BIGINT) AS lane, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events) z) x"
_FILLED = f"""WITH c AS ({CENTRES}), k AS (SELECT line, idx, centre FROM c WHERE centre IS NOT NULL),
p AS (SELECT c.line, c.idx, c.centre, (SELECT max(idx) FROM k WHERE k.line = c.line AND k.idx < c.idx) AS l, (SELECT min(idx) FROM k WHERE k.line = c.line AND k.idx > c.idx) AS r FROM c),
q AS (SELECT p.*, (SELECT max(idx) FROM k WHERE k.line = p.line AND k.idx < p.l) AS ll, (SELECT min(idx) FROM k WHERE k.line = p.line AND k.idx > p.r) AS rr FROM p),
v AS (SELECT q.*, kl.centre AS vl, kr.centre AS vr, kll.centre AS vll, krr.centre AS vrr FROM q LEFT JOIN k kl ON kl.line = q.line AND kl.idx = l LEFT JOIN k kr ON kr.line = q.line AND kr.idx = r LEFT JOIN k kll ON kll.line = q.line AND kll.idx = ll LEFT JOIN k krr ON krr.line = q.line AND krr.idx = rr),
filled AS (SELECT line, idx, coalesce(centre, CASE WHEN l IS NOT NULL AND r IS NOT NULL THEN vl + (vr - vl) * (idx - l) / (r - l) WHEN l IS NOT NULL AND ll IS NOT NULL THEN vl + (vl - vll) * (idx - l) / (l - ll)
  WHEN l IS NULL AND rr IS NOT NULL THEN vr - (vrr - vr) * (r - idx) / (rr - r) END) AS centre FROM v)"""


def _centres(spark, sf_dir):
    return G.interpolated(sql(spark, sf_dir, CENTRES), ["line"])


@query("g_interpolate", _FILLED + " SELECT line, idx, round(centre, 6) AS centre FROM filled")
def g_interpolate(spark, sf_dir):
    return _centres(spark, sf_dir).select("line", "idx", F.round("centre", 6).alias("centre"))


@query(
    "g_boundaries",
    _FILLED
    + """, e AS (SELECT line, idx, round(centre, 6) AS centre, lag(round(centre, 6)) OVER w AS lf, lead(round(centre, 6)) OVER w AS rt FROM filled WINDOW w AS (PARTITION BY line ORDER BY idx))
SELECT line, idx, CASE WHEN centre IS NOT NULL THEN coalesce(CAST(trunc((lf + centre) / 2) AS INTEGER), greatest(0, CAST(trunc(centre - coalesce(rt - centre, 30) / 2) AS INTEGER))) END AS x_start,
  CASE WHEN centre IS NOT NULL THEN coalesce(CAST(trunc((centre + rt) / 2) AS INTEGER), least(480, CAST(trunc(centre + coalesce(centre - lf, 30) / 2) AS INTEGER))) END AS x_end FROM e""",
)
def g_boundaries(spark, sf_dir):
    rounded = _centres(spark, sf_dir).withColumn("centre", F.round("centre", 6))
    return G.column_edges(rounded, ["line"], 480).select("line", "idx", "x_start", "x_end")


@query("g_monotone", f"WITH c AS ({CENTRES}), k AS (SELECT *, coalesce(centre > lag(centre) OVER (PARTITION BY line ORDER BY idx), true) AS up FROM c WHERE centre IS NOT NULL) SELECT line, count(*) AS known, bool_and(up) AS monotone FROM k GROUP BY line")
def g_monotone(spark, sf_dir):
    return G.ascending(sql(spark, sf_dir, CENTRES), ["line"])


_EDGES = "SELECT event_id AS id, CAST(event_id % 300 + 500 AS DOUBLE) AS a, CAST(event_id % 300 + 560 AS DOUBLE) AS b, CAST(event_id % 300 + 590 AS INT) AS edge, CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id % 400 + 550 AS INT) END AS word FROM events"


@query("g_last_edge", f"WITH e AS ({_EDGES}) SELECT id, least(900, greatest(edge, CAST(trunc(b + (b - a) * CAST(0.65 AS DOUBLE)) AS INTEGER), coalesce(word, edge) + 6)) AS x_end FROM e")
def g_last_edge(spark, sf_dir):
    edge = G.last_edge(F.lit(900), F.col("edge"), F.col("a"), F.col("b"), F.col("word"), F.lit(300))
    return sql(spark, sf_dir, _EDGES).select("id", edge.alias("x_end"))


_WORDS = "SELECT CAST(user_id AS BIGINT) AS page, CASE event_id % 40 WHEN 0 THEN 'Note:' WHEN 1 THEN 'STATEMENT' ELSE event_type END AS text, CAST(event_id * 17 % 3000 AS INT) AS y0, CAST(event_id * 17 % 3000 + 30 AS INT) AS y1, CASE WHEN user_id % 10 = 0 THEN 3090 ELSE 200 END AS top, 300 AS dpi, 3100 AS page_height FROM events"


@query(
    "g_body_bottom",
    f"""WITH w AS ({_WORDS}), f AS (SELECT page, any_value(top) AS top, coalesce(max(y1) FILTER (y1 > top), 3100) AS last, min(y0) FILTER (text = 'Note:' AND y1 > top AND y0 > top + 300 * CAST(0.4 AS DOUBLE)) AS footer FROM w GROUP BY page),
t AS (SELECT page, min(y0) AS title_y FROM w WHERE text = 'STATEMENT' AND y0 > top + 300 * CAST(0.35 AS DOUBLE) GROUP BY page)
SELECT f.page, greatest(top + 1, least(least(3085, last), coalesce(footer - 5, least(3085, last)))) AS bottom, title_y FROM f LEFT JOIN t USING (page)""",
)
def g_body_bottom(spark, sf_dir):
    words = sql(spark, sf_dir, _WORDS)
    bodies = words.select("page", "top", "dpi", "page_height").distinct()
    return G.body_bottom(bodies, words, ["page"]).join(G.next_title(words, ["page"]), "page", "left")


_BOXES = "SELECT event_id AS id, CAST(event_id % 90 AS DOUBLE) AS x0, CAST(event_id % 70 AS DOUBLE) AS y0, CAST(event_id % 90 + 20 AS DOUBLE) AS x1, CAST(event_id % 70 + 15 AS DOUBLE) AS y1, (event_id % 9 - 4) / CAST(2 AS DOUBLE) AS angle FROM events"
_TURN = [f"100 + ({x} - 100) * cos(radians(angle)) - ({y} - 100) * sin(radians(angle))" for x in ("x0", "x1") for y in ("y0", "y1")]
_TURN_Y = [f"100 + ({x} - 100) * sin(radians(angle)) + ({y} - 100) * cos(radians(angle))" for x in ("x0", "x1") for y in ("y0", "y1")]


@query("g_rotate", f"WITH b AS ({_BOXES}) SELECT id, round(least({', '.join(_TURN)}), 6) AS rx0, round(greatest({', '.join(_TURN_Y)}), 6) AS ry1 FROM b")
def g_rotate(spark, sf_dir):
    turned = G.rotated(*[F.col(c) for c in ("x0", "y0", "x1", "y1", "angle")], F.lit(100.0), F.lit(100.0))
    return sql(spark, sf_dir, _BOXES).withColumn("r", turned).select("id", F.round("r.x0", 6).alias("rx0"), F.round("r.y1", 6).alias("ry1"))


@query("g_project", f"WITH b AS ({_BOXES}), p AS (SELECT id, greatest(50, CAST(round_even(50 + y0 * 5, 0) AS INTEGER)) AS a, least(400, CAST(round_even(50 + y1 * 5, 0) AS INTEGER)) AS b FROM b) SELECT id, a AS y0, CASE WHEN b <= a THEN least(400, a + 14) ELSE b END AS y1 FROM p")
def g_project(spark, sf_dir):
    limited = G.projected(F.col("y0"), F.col("y1"), (F.lit(0), F.lit(70)), (F.lit(50), F.lit(400)))
    return sql(spark, sf_dir, _BOXES).select("id", limited.alias("p")).select("id", "p.y0", "p.y1")


_HALVES = _BOXES.replace("CAST(event_id % 90 AS DOUBLE)", "CAST(event_id % 90 + 0.5 AS DOUBLE)")
_BACK = [(f"50 + ({x} - 50) * cos(radians(-angle)) - ({y} - 40) * sin(radians(-angle))", f"40 + ({x} - 50) * sin(radians(-angle)) + ({y} - 40) * cos(radians(-angle))") for x in ("x0", "x1") for y in ("y0", "y1")]


@query(
    "g_straighten",
    f"""WITH b AS ({_HALVES}), t AS (SELECT *, {", ".join(f"CASE WHEN abs(angle) >= 0.25 THEN {f}({', '.join(c[k] for c in _BACK)}) ELSE {n} END AS t{n}" for n, f, k in (("x0", "least", 0), ("y0", "least", 1), ("x1", "greatest", 0), ("y1", "greatest", 1)))} FROM b)
SELECT id, {", ".join(f"{f}({limit}, CAST(round_even(t{n}, 0) AS INTEGER)) AS {n}" for n, f, limit in (("x0", "greatest", 0), ("y0", "greatest", 0), ("x1", "least", 100), ("y1", "least", 80)))} FROM t""",
)
def g_straighten(spark, sf_dir):
    box = G.straightened(*[F.col(c) for c in ("x0", "y0", "x1", "y1", "angle")], F.lit(100), F.lit(80))
    return sql(spark, sf_dir, _HALVES).select("id", box.alias("b")).select("id", "b.x0", "b.y0", "b.x1", "b.y1")


_CARRIED = f"WITH b AS ({SECTIONS}) SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY start, stop) - 1 AS INTEGER) AS row_index, start + 7 AS y0, stop + 7 AS y1 FROM b"


@query(
    "g_project_rows",
    f"""WITH r AS ({_CARRIED}), p AS (SELECT page, row_index, greatest(50, CAST(round_even(50 + (y0 - 7) * CAST(1250 AS DOUBLE) / 900, 0) AS INTEGER)) AS a, least(1300, CAST(round_even(50 + (y1 - 7) * CAST(1250 AS DOUBLE) / 900, 0) AS INTEGER)) AS b FROM r),
q AS (SELECT page, row_index, a, CASE WHEN b <= a THEN least(1300, a + 14) ELSE b END AS b FROM p) SELECT page, row_index, 0 AS box_x0, a AS box_y0, 998 AS box_x1, b AS box_y1, round(((a + b) / 2 - 50) / 1250, 9) AS y_normalized FROM q""",
)
def g_project_rows(spark, sf_dir):
    rows = sql(spark, sf_dir, _CARRIED)
    fixed = {"top": 7, "bottom": 907, "new_left": 5, "new_top": 50, "new_right": 990, "new_bottom": 1300, "page_width": 1000}
    bodies = rows.select("page").distinct().withColumns({k: F.lit(v) for k, v in fixed.items()})
    return G.projected_rows(rows, bodies, ["page"]).withColumn("y_normalized", F.round("y_normalized", 9))


_PLACED = "SELECT CAST(user_id AS BIGINT) AS page, event_id AS id, CAST(event_id * 37 % 3000 AS DOUBLE) AS y, event_type AS text FROM events"


@query(
    "g_context",
    f"WITH w AS ({_PLACED}), c AS (SELECT * FROM w WHERE id % 2 = 0), o AS (SELECT * FROM w WHERE id % 2 = 1) SELECT c.page, c.id, coalesce(string_agg(lower(o.text), ' ' ORDER BY o.id) FILTER (o.y + 10 >= c.y - 600 AND o.y + 10 < c.y), '') AS context FROM c LEFT JOIN o ON o.page = c.page GROUP BY c.page, c.id",
)
def g_context(spark, sf_dir):
    placed = sql(spark, sf_dir, _PLACED)
    candidates = placed.filter("id % 2 = 0").select("page", "id", F.col("y").alias("cy"), F.lit(300).alias("dpi"))
    words = placed.filter("id % 2 = 1").select("page", F.col("id").alias("place"), "text", F.col("y").alias("y0"), (F.col("y") + 20).alias("y1"))
    return G.heading_context(candidates, words, ["page"], "id")


@query("g_aligned")
def g_aligned(spark, sf_dir):
    numbered = sql(spark, sf_dir, OBSERVED).withColumn("block", F.expr("(n - 1) div 9"))
    lines = numbered.groupBy("line", "block").agg(F.sort_array(F.collect_list(F.struct("n", F.col("value").cast("int").alias("value")))).alias("v"))
    pairs = G.aligned_numbers(F.sequence(F.lit(1), F.lit(9)), F.col("v.value"))
    return lines.select("line", "block", F.inline(pairs))


_HISTOGRAM = "SELECT CAST(user_id % 20 AS BIGINT) AS page, CAST(event_id * event_id % 256 AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2"


@query(
    "g_otsu",
    f"""WITH h AS ({_HISTOGRAM}), m AS (SELECT *, CAST(sum(n) OVER u AS BIGINT) AS w0, CAST(sum(bin * n) OVER u AS BIGINT) AS m0, CAST(sum(n) OVER (PARTITION BY page) AS BIGINT) AS w, CAST(sum(bin * n) OVER (PARTITION BY page) AS BIGINT) AS m FROM h WINDOW u AS (PARTITION BY page ORDER BY bin)),
b AS (SELECT page, bin, CASE WHEN w0 > 0 AND w - w0 > 0 THEN round(CAST(w0 AS DOUBLE) * (w - w0) * pow(m0 / w0 - (m - m0) / (w - w0), 2), 6) ELSE 0 END AS between_classes FROM m)
SELECT page, bin AS threshold FROM b QUALIFY row_number() OVER (PARTITION BY page ORDER BY between_classes DESC, bin) = 1""",
)
def g_otsu(spark, sf_dir):
    return G.otsu(sql(spark, sf_dir, _HISTOGRAM), ["page"])


_SIDE = "SELECT CAST(user_id AS BIGINT) AS table_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INT) AS row_index, CAST(event_id * 7 % 1000 AS DOUBLE) / 1000 AS y FROM events WHERE event_id % 2 = {}"
_LEFT, _RIGHT = _SIDE.format(0), _SIDE.format(1)


@query(
    "j_positional",
    f"WITH a AS ({_LEFT}), b AS ({_RIGHT}), p AS (SELECT a.table_id, a.row_index, a.y AS anchor_y, b.y AS other_y, coalesce(abs(a.y - b.y), 1.0) AS distance FROM a LEFT JOIN b USING (table_id, row_index)) SELECT table_id, row_index, round(distance, 9) AS distance, round(CASE WHEN other_y IS NULL THEN 0 WHEN distance <= CAST(0.15 AS DOUBLE) THEN greatest(0, 1 - distance / CAST(0.15 AS DOUBLE)) ELSE 0.5 END, 6) AS confidence, other_y IS NOT NULL AND distance <= CAST(0.15 AS DOUBLE) AS is_aligned FROM p",
)
def j_positional(spark, sf_dir):
    pairs = G.positional(sql(spark, sf_dir, _LEFT), sql(spark, sf_dir, _RIGHT), ["table_id"], 0.15)
    return pairs.select("table_id", "row_index", F.round("distance", 9).alias("distance"), F.round("confidence", 6).alias("confidence"), "is_aligned")


@query("j_monotone")
def j_monotone(spark, sf_dir):
    sorted_y = "SELECT table_id, CAST(row_number() OVER (PARTITION BY table_id ORDER BY y, row_index) - 1 AS INT) AS row_index, y FROM ({}) s"
    return G.monotone(sql(spark, sf_dir, sorted_y.format(_LEFT)), sql(spark, sf_dir, sorted_y.format(_RIGHT)), ["table_id"], 0.15)


@query(
    "j_complete_or_project",
    f"WITH a AS ({_LEFT}), b AS ({_RIGHT}), p AS (SELECT a.table_id, a.row_index, a.y AS ay, b.y AS y FROM a LEFT JOIN b USING (table_id, row_index)), w AS (SELECT table_id, count(*) = count(y) AS whole FROM p GROUP BY table_id) SELECT table_id, row_index, CASE WHEN whole THEN y ELSE ay END AS y0, CASE WHEN whole THEN y ELSE ay END + 1 AS y1, NOT whole AS is_projected FROM p JOIN w USING (table_id)",
)
def j_complete_or_project(spark, sf_dir):
    left = sql(spark, sf_dir, _LEFT)
    matches = G.positional(left, sql(spark, sf_dir, _RIGHT), ["table_id"], 0.15).select("table_id", "row_index", F.col("other_y").alias("y0"), (F.col("other_y") + 1).alias("y1"))
    moved = left.select("table_id", "row_index", F.col("y").alias("y0"), (F.col("y") + 1).alias("y1"))
    return G.complete_or_projected(matches, moved, ["table_id"])


_ANGLED = "SELECT CAST(user_id % 20 AS BIGINT) AS page, CAST(event_id % 9 AS INT) AS ord, (event_id % 9 - 4) / CAST(2 AS DOUBLE) AS angle, CAST(event_id % 50 AS BIGINT) AS y, CAST(event_id * event_id % 23 AS DOUBLE) AS ink FROM events"


@query("g_skew", f"WITH p AS ({_ANGLED}), v AS (SELECT page, ord, angle, round(var_pop(ink), 6) AS spread FROM p GROUP BY page, ord, angle) SELECT page, angle FROM v QUALIFY row_number() OVER (PARTITION BY page ORDER BY spread DESC, ord) = 1")
def g_skew(spark, sf_dir):
    return G.skew(sql(spark, sf_dir, _ANGLED).withColumnRenamed("ord", "order"), ["page"])


_EXTENTS = "SELECT event_id AS id, CAST(event_id % 500 AS INT) AS header, CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 500 + 700 AS DOUBLE) END AS later, 2000 AS content, CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 900 + 100 AS INT) END AS title FROM events"


@query(
    "g_body_extent",
    f"WITH e AS ({_EXTENTS}), b AS (SELECT id, least(450, header + 5) AS top, coalesce(CAST(trunc(later - CAST(0.35 AS DOUBLE) * 300) AS INTEGER), content) AS below, title FROM e), c AS (SELECT id, top, least(below, coalesce(title - 10, below)) AS bottom FROM b) SELECT *, CASE WHEN bottom <= top THEN 'Empty body' END AS error FROM c",
)
def g_body_extent(spark, sf_dir):
    extent = G.body_extent(F.col("header"), F.col("later"), F.col("content"), F.col("title"), F.lit(300), F.lit(450))
    return sql(spark, sf_dir, _EXTENTS).select("id", extent.alias("e")).select("id", "e.top", "e.bottom", "e.error")


_CROPS = "SELECT event_id AS id, CAST(event_id % 400 + 500 AS INT) AS right_edge, CAST(event_id % 100 AS INT) AS a, CAST(event_id % 100 + 60 AS INT) AS b, CAST(event_id % 300 + 200 AS INT) AS c, CAST(event_id % 300 + 900 AS INT) AS d FROM events"


@query("g_crop_right", f"WITH e AS ({_CROPS}) SELECT id, CASE WHEN id % 5 = 0 THEN right_edge ELSE least(right_edge, c + (b - a) + 8) END AS x1 FROM e")
def g_crop_right(spark, sf_dir):
    spans = F.array(F.struct(F.col("a").alias("x_start"), F.col("b").alias("x_end")), F.struct(F.col("c").alias("x_start"), F.col("d").alias("x_end")))
    spans = F.when(F.col("id") % 5 == 0, F.slice(spans, 1, 1)).otherwise(spans)
    return sql(spark, sf_dir, _CROPS).select("id", G.crop_right(F.col("right_edge"), spans).alias("x1"))


@query(
    "g_cell_crop",
    f"WITH e AS ({_CROPS}), p AS (SELECT id, a, d, greatest(8, CAST(floor((d - a) * CAST(0.08 AS DOUBLE)) AS INTEGER)) AS pad FROM e), q AS (SELECT id, greatest(0, a - pad) AS x0, least(1000, d + pad) AS x1 FROM p) SELECT id, x0, x1, (x1 - x0) * 2 AS width FROM q",
)
def g_cell_crop(spark, sf_dir):
    crop = G.cell_crop(F.col("a"), F.lit(100), F.col("d"), F.lit(140), F.lit(1000), F.lit(1000))
    return sql(spark, sf_dir, _CROPS).select("id", crop.alias("c")).select("id", "c.x0", "c.x1", "c.width")


_NEEDED = "SELECT CAST(user_id AS BIGINT) AS table_id, 'p' || CAST(event_id % 4 AS STRING) AS panel_id, CAST(event_id % 2 + 1 AS INT) AS page, event_id AS id FROM events"


@query(
    "g_missing_panels",
    f"""WITH e AS ({_NEEDED}), p AS (SELECT DISTINCT table_id, panel_id, page FROM e), c AS (SELECT DISTINCT table_id, panel_id FROM e WHERE id % 7 = 0), n AS (SELECT table_id, CASE WHEN table_id % 6 = 0 THEN 3 ELSE 2 END AS page_count FROM p GROUP BY table_id HAVING table_id % 11 <> 0),
x AS (SELECT table_id, max(page) AS expected FROM p GROUP BY table_id) SELECT x.table_id, 'expected exactly ' || expected || ' pages; got ' || coalesce(page_count, 0) AS error FROM x LEFT JOIN n USING (table_id) WHERE page_count IS DISTINCT FROM expected
UNION ALL SELECT table_id, 'missing printed columns of panel ' || panel_id FROM p WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.table_id = p.table_id AND c.panel_id = p.panel_id)""",
)
def g_missing_panels(spark, sf_dir):
    rows = sql(spark, sf_dir, _NEEDED)
    panels = rows.select("table_id", "panel_id", "page").distinct()
    counts = panels.select("table_id").distinct().filter("table_id % 11 <> 0").withColumn("page_count", F.when(F.col("table_id") % 6 == 0, 3).otherwise(2))
    return G.missing_panels(panels, rows.filter("id % 7 = 0"), counts, ["table_id"])


@query("g_widened_rows", f"WITH b AS ({SECTIONS}), r AS (SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY start, stop) - 1 AS INTEGER) AS row_index, start AS y0, stop AS y1 FROM b) SELECT *, 100 AS x0, 900 + CAST(page AS INTEGER) AS x1 FROM r")
def g_widened_rows(spark, sf_dir):
    boxes = G.row_boxes(sql(spark, sf_dir, SECTIONS).withColumns({"x0": F.lit(0), "x1": F.lit(90), "top": F.lit(0), "bottom": F.lit(2000), "page_width": F.lit(2000), "page_height": F.lit(2000)}), ["page"], 0)
    rows = boxes.select("page", "row_index", F.col("box_y0").alias("y0"), F.col("box_y1").alias("y1"))
    bodies = rows.select("page").distinct().select("page", F.lit(100).alias("x0"), (F.col("page").cast("int") + 900).alias("x1"))
    return G.widened_rows(rows, bodies, ["page"])
