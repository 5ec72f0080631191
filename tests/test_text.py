from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesift.functions import pages as P
from tablesift.functions import text as T


def values(spark, column, *texts, schema="t string"):
    rows = [t if isinstance(t, tuple) else (t,) for t in texts]
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column.alias("v")).collect()]


def test_null_marks(spark):
    assert values(spark, T.null_mark(F.col("t")), "", "Nil", "—", "...", " … ", "n.a.", "NA", "None", "x", None) == [None] * 8 + ["x", None]


def test_unicode_space(spark):
    assert values(spark, T.squeeze(F.col("t")), "a  b c\n", " \t ") == ["a b c", ""]


@pytest.mark.parametrize(("raw", "value", "flag"), [("7 0 8", 708, "SPACED_DIGITS"), ("8,100)", 8100, "TRAILING_MARK_REMOVED"), ("1,200", 1200, None), ("1O", 10, "LETTER_O_AS_ZERO"), ("2-0", None, "AMBIGUOUS_OCR"), ("", None, None), ("99999999999999999999", None, "AMBIGUOUS_OCR")])
def test_integers(spark, raw, value, flag):
    df = spark.createDataFrame([(raw,)], "t string").withColumn("v", T.typed(F.col("t"), F.lit("integer"), F.lit("n")))
    row = df.select("v.*", T.review_flag(F.col("t"), F.lit("integer"), F.lit("n"), F.col("v.parse_error").isNotNull()).alias("flag")).first()
    assert (row["int_value"], row["flag"]) == (value, flag)


def test_parse_message(spark):
    df = spark.createDataFrame([("2-0",), ("it's",)], "t string").select(T.typed(F.col("t"), F.lit("Integer"), F.lit("elec_domestic"))["parse_error"].alias("e"))
    assert [r.e for r in df.collect()] == ["elec_domestic: expected integer for '2-0'", 'elec_domestic: expected integer for "it\'s"']


def test_floats_and_others(spark):
    one = spark.createDataFrame([("1.5", "float"), ("x", "float"), ("xii", "integer_or_roman")], "t string, k string").select(T.typed(F.col("t"), F.col("k"), F.lit("n")).alias("v")).collect()
    assert [(r.v.dbl_value, r.v.str_value, r.v.parse_error is None) for r in one] == [(1.5, None, True), (None, None, False), (None, "xii", True)]


@pytest.mark.parametrize(
    ("name", "serial", "kind", "target"),
    [
        ("See Sl. No. 1 Agra (U.A.)", "2", "CROSS_REFERENCE", "Sl. No. 1 Agra (U.A.)"),
        ("Agra Sec Agra City Urban Agglomeration", "2", "CROSS_REFERENCE", "Agra City Urban Agglomeration"),
        ("Agra see", "2", "CROSS_REFERENCE", "Agra see"),
        ("DISTRICT TOTAL", "", "TOTAL", None),
        ("Rural total", "", "TOTAL", None),
        ("Civil Lines", "3", "COMPONENT", None),
        ("(ii) Cantonment", "3", "COMPONENT", None),
        ("Agra", "(iv)", "COMPONENT", None),
        ("Agra (U.A.)", "1", "AGGREGATE", None),
        ("Seesaw", "1", "ORDINARY", None),
        (None, None, "ORDINARY", None),
    ],
)
def test_row_classes(spark, name, serial, kind, target):
    row = spark.createDataFrame([(name, serial)], "n string, s string").select(T.row_class(F.col("n"), F.col("s")).alias("c")).first().c
    assert (row.row_type, row.reference_target) == (kind, target)


def test_roads(spark):
    got = values(spark, T.road_lengths(F.col("t")), "PR 14.50 KR 3.20", "pucca: 3", "12.5", "Nil", None)
    assert [(r.pucca_road_km, r.kutcha_road_km) for r in got] == [(14.5, 3.2), (3.0, None), (None, None), (None, None), (None, None)]


def test_code_lists(spark):
    assert values(spark, T.is_code_list(F.col("t")), "HC/MT/B", "HC/MI/B", "HC/", "B/H/L", "Nil", "MT/HL/B/HC", "", "n.a.") == [True, False, False, False, True, True, True, False]


def test_guard(spark):
    got = values(spark, T.cell_guard(F.col("t"), F.lit(None).cast("string")), "<table>CategoryValue11002100</table>", "x" * 251, "<|ref|>Agra<|/ref|><|det|>[[1,2,3,4]]<|/det|>")
    assert [(g.text, g.issue is None) for g in got] == [("", False), ("", False), ("Agra", True)]


def test_printed_numbers(spark):
    assert values(spark, T.printed_number(F.col("t")), "(12)", "50.", "51", "0", "123", "x", "1a2") == [12, 50, None, None, None, None, None]


def test_word_kinds(spark):
    assert values(spark, T.is_title_word(F.col("t")), "STATEMENT.", "-Appendix:", "state") == [True, True, False]
    assert values(spark, T.is_footer_word(F.col("t")), "Note:", "SOURCE", "noted") == [True, True, False]


def test_page_names(spark):
    assert values(spark, P.district(F.col("t")), "1971 Baliya.pdf", " 1971  Bara  Banki.PDF") == ["Baliya", "Bara Banki"]
    assert values(spark, P.slug(F.col("t")), " Uttar Kashi & Co. ", "--") == ["uttar_kashi_and_co", ""]
    assert values(spark, P.leading_page_number(F.col("t")), "( 315 ) Text", "12 x", "ab (7) c", "none", "") == [315, 12, 7, None, None]
    assert values(spark, P.is_civic(F.col("t")), "No. of LATRlNES larter", "Night-soil", "market") == [True, True, False]


def test_optional_ints(spark):
    assert values(spark, T.optional_int(F.col("t")), "3.9", "", None, " 7 ", "n/a", "12d") == [3, None, None, 7, None, None]
    assert values(spark, T.as_double(F.col("t")), "12d", "1f", "1e3", ".5", "-2.", "x") == [None, None, 1000.0, 0.5, -2.0, None]


def test_sequence_quality(spark):
    assert values(spark, T.sequence_quality(F.col("t")), 0.55, 0.62, 1.0, schema="t double") == [0.95, 0.95, 1.0]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab \t  \n", max_size=12), min_size=1, max_size=20))
def test_squeeze_is_python_split(spark, texts):
    assert values(spark, T.squeeze(F.col("t")), *texts) == [" ".join(t.replace(" ", " ").split()) for t in texts]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=15), st.text(max_size=4)), min_size=1, max_size=20))
def test_every_row_has_a_class(spark, pairs):
    kinds = {r.k for r in spark.createDataFrame(pairs, "n string, s string").select(T.row_class(F.col("n"), F.col("s"))["row_type"].alias("k")).collect()}
    assert kinds <= {"CROSS_REFERENCE", "TOTAL", "COMPONENT", "AGGREGATE", "ORDINARY"}
