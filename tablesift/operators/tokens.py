"""Grounded OCR answers: parsing, boxes, and assignment of tokens to columns."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesift.functions import text as T

# The grounded markup, its shorthand, and the range of box coordinates.
REF = r"(?s)<\|ref\|>(.*?)<\|/ref\|>\s*<\|det\|>(.*?)<\|/det\|>"
_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?"
SHORTHAND = rf"(?:^|\s)([^\[\r\n]+?)\s*(\[\[\s*{_NUMBER}\s*,\s*{_NUMBER}\s*,\s*{_NUMBER}\s*,\s*{_NUMBER}\s*\]\])"
BOX = rf"\[\s*({_NUMBER})\s*,\s*({_NUMBER})\s*,\s*({_NUMBER})\s*,\s*({_NUMBER})\s*\]"
FULL = 1000
BOXES = "array<array<double>>"


def is_box(box: Column) -> Column:
    """Four coordinates from 0 to 1000 that span an area."""
    x0, y0, x1, y1 = (F.get(box, F.lit(i)) for i in range(4))
    return F.coalesce((F.size(box) == 4) & (x0 >= 0) & (x0 < x1) & (x1 <= FULL) & (y0 >= 0) & (y0 < y1) & (y1 <= FULL), F.lit(False))


def parse_boxes(raw: Column) -> Column:
    """The usable boxes of a JSON list of boxes, one bare box, or boxes found in broken JSON."""
    text = F.trim(raw)
    listed = F.from_json(text, BOXES)
    one = F.from_json(text, "array<double>")
    single = F.when((F.size(one) == 4) & F.forall(one, lambda x: x.isNotNull()), F.array(one))
    found = F.transform(F.regexp_extract_all(raw, F.lit(BOX), F.lit(0)), lambda b: F.transform(F.split(F.regexp_replace(b, r"[\[\]\s]", ""), ","), lambda x: x.try_cast("double")))
    nested = F.startswith(F.regexp_replace(text, r"\s", ""), F.lit("[["))
    return F.filter(F.coalesce(F.when(nested, listed), single, found), is_box)


def parse_tokens(content: Column) -> Column:
    """array<struct(text, box)>: tagged references, each with its boxes; the shorthand if there are none."""

    def of(pattern: str) -> Column:
        texts, boxes = (F.regexp_extract_all(content, F.lit(pattern), F.lit(i)) for i in (1, 2))
        pairs = F.arrays_zip(texts.alias("t"), boxes.alias("b"))
        each = F.transform(pairs, lambda p: F.transform(parse_boxes(p["b"]), lambda b: F.struct(F.trim(p["t"]).alias("text"), b.alias("box"))))
        return F.flatten(each)

    tagged = of(REF)
    return F.when(F.size(tagged) > 0, tagged).otherwise(of(SHORTHAND))


def parse_issues(content: Column) -> Column:
    """What was wrong with an answer: references without a usable box, or nothing grounded at all."""
    texts, boxes = (F.regexp_extract_all(content, F.lit(REF), F.lit(i)) for i in (1, 2))
    bad = F.filter(F.arrays_zip(texts.alias("t"), boxes.alias("b")), lambda p: F.size(parse_boxes(p["b"])) == 0)
    named = F.transform(bad, lambda p: F.concat(F.lit("Grounded ref "), T.quoted(F.trim(p["t"])), F.lit(" has no usable box")))
    none = F.when(F.size(parse_tokens(content)) == 0, F.array(F.lit("No grounded markup or shorthand tokens were parsed"))).otherwise(F.array().cast("array<string>"))
    return F.concat(named, none)


def message_content(response: Column) -> Column:
    """struct(content, error) of a response envelope; content that isn't a string is an error too."""
    found = F.try_variant_get(F.try_parse_json(response), "$.choices[0].message.content", "variant")
    kind = F.schema_of_variant(found)
    content = F.when(kind == "STRING", F.get_json_object(response, "$.choices[0].message.content"))
    error = F.when(content.isNotNull(), F.lit(None).cast("string")).when(found.isNull() | (kind == "VOID"), "invalid response envelope").otherwise("response content is not a string")
    return F.struct(F.coalesce(content, F.lit("")).alias("content"), error.alias("error"))


def response_hash(responses: Column) -> Column:
    """sha256 of each JSON response in its canonical form: keys sorted at every depth. NULL for a text that isn't JSON."""

    def digests(texts: pd.Series) -> pd.Series:
        def digest(text: str | None) -> str | None:
            try:
                return hashlib.sha256(json.dumps(json.loads(text), sort_keys=True, ensure_ascii=False).encode()).hexdigest()
            except (TypeError, ValueError):
                return None

        return texts.map(digest)

    return F.pandas_udf(digests, "string")(responses)


def embedded_text(cells: DataFrame, words: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """(keys, name, embedded): the page's own words between a cell's left and right edge that overlap its height, top to bottom and left to right.

    cells: keys, name, x0, y0, x1, y1; words: keys, text, wx0, wy0, wx1, wy1. A cell without words has the empty text.
    """
    met = cells.select(*keys, name, "x0", "y0", "x1", "y1").join(words.select(*keys, "text", "wx0", "wy0", "wx1", "wy1"), list(keys), "left")
    inside = (F.col("wx0") >= F.col("x0")) & (F.col("wx1") <= F.col("x1")) & (F.col("wy0") < F.col("y1")) & (F.col("wy1") > F.col("y0"))
    own = F.sort_array(F.collect_list(F.when(inside, F.struct("wy0", "wx0", "text"))))
    return met.groupBy(*keys, name).agg(F.trim(F.array_join(F.transform(own, lambda w: w["text"]), " ")).alias("embedded"))


def is_usable(tokens: Column) -> Column:
    """At least one token, and each with a box."""
    return (F.size(tokens) > 0) & F.forall(tokens, lambda t: is_box(t["box"]))


def scaled(box: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A box of 0 to 1000 within a crop, in pixels; NULL for a box that isn't one."""

    def at(i: int, low: Column, high: Column) -> Column:
        return low + F.get(box, F.lit(i)) / FULL * (high - low)

    return F.when(is_box(box), F.struct(at(0, x0, x1).alias("x0"), at(1, y0, y1).alias("y0"), at(2, x0, x1).alias("x1"), at(3, y0, y1).alias("y1")))


def assigned(tokens: DataFrame, spans: DataFrame, keys: tuple[str, ...] = ("table_id",)) -> DataFrame:
    """Each token with the first column span that holds its centre, edges included; tokens outside all spans go.

    tokens: keys, row_index, token_idx, text, x0, x1; spans: keys, column_no, x_start, x_end. The spans of a key are
    few, so they travel as one sorted array; the join is on equal keys and no token meets a span of another table.
    """
    order = F.sort_array(F.collect_list(F.struct("column_no", "x_start", "x_end")))
    packed = spans.groupBy(*keys).agg(order.alias("spans"))
    centre = (F.col("x0") + F.col("x1")) / 2
    hit = F.get(F.filter("spans", lambda s: (centre >= s["x_start"]) & (centre <= s["x_end"])), F.lit(0))
    return tokens.join(packed, list(keys)).withColumn("column_no", hit["column_no"]).filter(F.col("column_no").isNotNull()).drop("spans")


def cell_text(placed: DataFrame, keys: tuple[str, ...] = ("table_id", "row_index", "column_no")) -> DataFrame:
    """The texts of a cell from left to right; blanks are skipped."""
    text = F.expr("listagg(nullif(trim(text), ''), ' ') within group (order by x0, token_idx)")
    return placed.groupBy(*keys).agg(F.coalesce(text, F.lit("")).alias("raw_value"))


def words_of_line(text: Column, x0: Column, x1: Column) -> Column:
    """array<struct(word_idx, word, x0, x1)>: a grounded line cut into words of equal width."""
    words = F.filter(F.split(T.squeeze(text), " "), lambda w: w != "")
    width = (x1 - x0) / F.greatest(F.size(words), F.lit(1))
    return F.transform(words, lambda w, i: F.struct(i.alias("word_idx"), w.alias("word"), F.bround(x0 + width * i).cast("int").alias("x0"), F.bround(x0 + width * (i + 1)).cast("int").alias("x1")))


def merged_panels(cells: DataFrame, identity: tuple[str, ...] = ("sl_no", "town_name", "tahsil_name")) -> DataFrame:
    """One cell for each variable: the first panel with text wins, and only the anchor panel names the row.

    cells: table_id, row_index, panel_order, is_anchor, variable, raw_value. Rows whose anchor is a cross-reference
    take nothing from other panels.
    """
    references = cells.filter(F.col("is_anchor") & F.col("variable").isin(*identity) & T.is_cross_reference(F.col("raw_value"))).select("table_id", "row_index").distinct()
    anchor = cells.filter("is_anchor")
    others = cells.filter(~F.col("is_anchor") & ~F.col("variable").isin(*identity)).join(references, ["table_id", "row_index"], "left_anti")
    filled = F.struct((F.trim("raw_value") == "").alias("blank"), "panel_order")
    both = anchor.unionByName(others)
    return both.groupBy("table_id", "row_index", "variable").agg(F.min_by("raw_value", filled).alias("raw_value"))


def identity_of(tokens: Column, first_data_x: Column) -> Column:
    """struct(serial, name, is_reference) from the tokens left of the data; a see-token takes in all tokens.

    tokens: array<struct(cx, text)>; a leading number or bracketed roman numeral is the serial.
    """
    ordered = F.array_sort(tokens)
    reference = F.exists(ordered, lambda t: F.lower(F.trim(t["text"])).isin("see", "sec"))
    left = F.when(reference, ordered).otherwise(F.filter(ordered, lambda t: t["cx"] < first_data_x))
    texts = F.filter(F.transform(left, lambda t: F.trim(t["text"])), lambda t: t != "")
    head = F.get(texts, F.lit(0))
    leads = F.coalesce(head.rlike(r"(?i)\A(?:[0-9]+|\([ivxlcdm]+\))\z"), F.lit(False))
    rest = F.when(leads, F.slice(texts, 2, F.greatest(F.size(texts), F.lit(1)))).otherwise(texts)
    return F.struct(F.when(leads, head).otherwise("").alias("serial"), F.array_join(rest, " ").alias("name"), reference.alias("is_reference"))


def refined_code(value: Column, right_edge: Column, embedded: Column, cell: Column) -> Column:
    """A code cell: kept if it is sound and not cut at the edge, else embedded text, else a sound or longer second reading."""
    sound = T.is_code_list(value)
    longer = F.length(F.coalesce(cell, F.lit(""))) > F.length(F.coalesce(value, F.lit("")))
    return (
        F.when(sound & (F.coalesce(right_edge, F.lit(0.0)) < 980), value)
        .when((F.coalesce(embedded, F.lit("")) != "") & T.is_code_list(embedded), embedded)
        .when((F.coalesce(cell, F.lit("")) != "") & T.is_code_list(cell), cell)
        .when(~sound & longer, cell)
        .otherwise(value)
    )


def cache_key(**parts: Column) -> Column:
    """sha256 over the named parts of a request as one JSON object, names in order; NULL and the empty text differ."""
    named = F.struct(*[parts[name].alias(name) for name in sorted(parts)])
    return F.sha2(F.to_json(named, {"ignoreNullFields": "false"}), 256)


def request_key(pdf_sha256: Column, crop_bbox: Column, page_number: Column, panel_id: Column, model: Column, prompt: Column, prompt_version: Column, png_sha256: Column) -> Column:
    """The content address of a recognition request; crop_bbox is an array of four integers."""
    return cache_key(pdf_sha256=pdf_sha256, crop_bbox=crop_bbox, page_number=page_number, panel_id=panel_id, model=model, prompt=prompt, prompt_version=prompt_version, png_sha256=png_sha256)


def uncached(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests without a good answer in the cache; corrupt or failed entries are misses."""
    good = cache.filter(F.coalesce("ok", F.lit(False)) & F.col("response").isNotNull()).select("cache_key").distinct()
    return requests.join(good, "cache_key", "left_anti")
