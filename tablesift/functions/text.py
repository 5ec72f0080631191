"""Column functions over noisy cell text. All are built-in expressions, so they stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and word lists that results depend on.
NULL_MARK = r"(?i)\A(?:nil|n\.?a\.?|none|[-–—.·…]+)\z"
NUMBER = r"(?i)\A\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|nan)\s*\z"
SEE = r"(?iU)\bse[ec]\b"
CODE = r"(?:HC|HL|MT|WB|B|C|T)"
LEAK_MARKS = ("<table>", "expected-value examples", "possible printed forms", "return only the visible cell text", "this is an archival 1971")
LEAK_LENGTH = 250
FOOTER_WORDS = ("note", "notes", "source", "footnote")
TITLE_WORDS = ("statement", "directory", "appendix")
INTEGER_TYPES = ("integer", "float")
NIGHT_SOIL = "night_soil_disposal_method"


def squeeze(c: Column) -> Column:
    """White space of any kind, in any run, becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " "))


def null_mark(c: Column) -> Column:
    """NULL for blanks and printed null marks, else the squeezed text."""
    value = squeeze(c)
    return F.when((value == "") | value.rlike(NULL_MARK), F.lit(None).cast("string")).otherwise(value)


def clean_number(c: Column) -> Column:
    """Text of a number without separators: O reads as 0, closing marks at the end go."""
    return F.regexp_replace(F.translate(c, "Oo, ", "00"), r"[)\]}]+$", "")


def quoted(c: Column) -> Column:
    """The text in single quotes, or in double ones if it holds just single quotes."""
    escaped = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    double = F.contains(c, F.lit("'")) & ~F.contains(c, F.lit('"'))
    return F.when(double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))


def as_double(number: Column) -> Column:
    """The number, or NULL for any other text; type letters behind it, as in 12d, are no number."""
    return F.when(number.rlike(NUMBER), number.try_cast("double"))


def _is_whole(number: Column, kind: Column) -> Column:
    return (kind == "integer") & number.rlike(r"\A[+-]?[0-9]+\z")


def parse_failed(value: Column, number: Column, data_type: Column) -> Column:
    """Whether typed_parts has a parse_error, without its text."""
    kind = F.lower(data_type)
    bad_integer = (kind == "integer") & F.coalesce(~_is_whole(number, kind) | number.try_cast("long").isNull(), F.lit(True))
    return value.isNotNull() & (bad_integer | ((kind == "float") & as_double(number).isNull()))


def typed_parts(value: Column, number: Column, data_type: Column, variable: Column) -> dict[str, Column]:
    """int_value, dbl_value, str_value and parse_error from the null-marked text and its cleaned number.

    An integer outside 64 bits keeps its text in str_value and gives the error RANGE.
    """
    kind = F.lower(data_type)
    whole = _is_whole(number, kind)
    as_int, as_float = number.try_cast("long"), as_double(number)
    problem = (
        F.when((kind == "integer") & ~whole, F.concat(F.lit(": expected integer for "), quoted(value)))
        .when(whole & as_int.isNull(), F.concat(F.lit(": RANGE for "), quoted(value)))
        .when((kind == "float") & as_float.isNull(), F.concat(F.lit(": could not convert string to float: "), quoted(number), F.lit(" for "), quoted(value)))
    )
    return {
        "int_value": F.when(whole, as_int),
        "dbl_value": F.when(kind == "float", as_float),
        "str_value": F.when(~kind.isin(*INTEGER_TYPES) | (whole & as_int.isNull()), value),
        "parse_error": F.when(value.isNotNull(), F.concat(variable, problem)),
    }


def typed(raw: Column, data_type: Column, variable: Column) -> Column:
    """struct(int_value, dbl_value, str_value, parse_error) of one raw text."""
    value = null_mark(raw)
    return F.struct(*[c.alias(n) for n, c in typed_parts(value, clean_number(value), data_type, variable).items()])


def review_flag(raw: Column, data_type: Column, variable: Column, failed: Column, value: Column | None = None) -> Column:
    """Why a reader should look at a cell; the raw text decides, not the cleaned one.

    failed: whether the cell has a parse error; value: its null-marked text, if at hand.
    """
    value = null_mark(raw) if value is None else value
    codes = value.rlike(rf"(?i)\A{CODE}(?:/{CODE})*\z")
    numeric = F.nullif(
        F.concat_ws(
            "|",
            F.when(raw.rlike(r"(?U)\d\s+\d"), "SPACED_DIGITS"),
            F.when(raw.rlike("[Oo]"), "LETTER_O_AS_ZERO"),
            F.when(raw.rlike(r"(?U)[)\]}]\s*\z"), "TRAILING_MARK_REMOVED"),
        ),
        F.lit(""),
    )
    night = variable == NIGHT_SOIL
    return (
        F.when(failed, "AMBIGUOUS_OCR")
        .when(night & value.isNull(), None)
        .when(night & ~codes, "AMBIGUOUS_HISTORIC_CODE")
        .when(~F.lower(data_type).isin(*INTEGER_TYPES) | value.isNull(), None)
        .otherwise(numeric)
    )


def row_class(identity: Column, serial: Column) -> Column:
    """struct(row_type, reference_target); letters that look like a roman numeral count, valid or not."""
    name = F.trim(F.coalesce(identity, F.lit("")))
    number = F.trim(F.coalesce(F.when(serial.cast("string") == "0", "").otherwise(serial.cast("string")), F.lit("")))
    low = F.lower(name)
    seen = name.rlike(SEE)
    after = F.trim(F.regexp_extract(name, SEE + r"\s*(.*)", 1))
    kind = (
        F.when(seen, "CROSS_REFERENCE")
        .when(F.contains(low, F.lit("district total")) | (low == "total") | F.endswith(low, F.lit(" total")), "TOTAL")
        .when(name.rlike(r"(?iU)\A\(?[ivxlcdm]+\)?[.)]?\s") | number.rlike(r"(?i)\A\(?[ivxlcdm]+\)?\z"), "COMPONENT")
        .when(F.contains(low, F.lit("urban agglomeration")) | F.contains(low, F.lit("(u.a")) | F.contains(low, F.lit("(ua")), "AGGREGATE")
        .otherwise("ORDINARY")
    )
    return F.struct(kind.alias("row_type"), F.when(seen, F.when(after == "", name).otherwise(after)).alias("reference_target"))


def is_cross_reference(identity: Column) -> Column:
    return F.coalesce(identity, F.lit("")).rlike(SEE)


def road_lengths(raw: Column) -> Column:
    """struct(pucca_road_km, kutcha_road_km): the first labelled number of each kind; unlabelled numbers don't count."""
    value = F.upper(F.coalesce(null_mark(raw), F.lit("")))

    def first(labels: str) -> Column:
        return F.nullif(F.regexp_extract(value, labels + r"\s*[:=-]?\s*([0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).cast("double")

    return F.struct(first("(?:PR|PUCCA)").alias("pucca_road_km"), first("(?:KR|K[AU]TCH?A)").alias("kutcha_road_km"))


def is_code_list(raw: Column) -> Column:
    """An empty cell, nil, a run of dashes or dots, or codes with slashes between."""
    return squeeze(F.coalesce(raw, F.lit(""))).rlike(rf"(?i)\A(?:|nil|[-–—.·…]+|{CODE}(?:/{CODE})*)\z")


def strip_markup(c: Column) -> Column:
    """Text without grounding tags and boxes."""
    tags = F.regexp_replace(c, r"<\|/?(?:ref|det)\|>", " ")
    return squeeze(F.regexp_replace(tags, r"(?s)\[\[.*?\]\]", " "))


def cell_guard(c: Column, error: Column) -> Column:
    """struct(text, issue): '' for failed requests and for answers that repeat the request."""
    text = strip_markup(F.coalesce(c, F.lit("")))
    low = F.lower(text)
    leak = (F.length(text) > LEAK_LENGTH) | reduce(lambda a, b: a | b, [F.contains(low, F.lit(m)) for m in LEAK_MARKS])
    return F.struct(
        F.when(error.isNotNull() | leak, "").otherwise(text).alias("text"),
        F.when(error.isNull() & leak, "probable schema or prompt leakage").alias("issue"),
    )


def printed_number(c: Column) -> Column:
    """A column number from 1 to 50 of at most two digits, whatever marks surround it."""
    digits = F.regexp_replace(F.trim(c), "^[^0-9]+|[^0-9]+$", "")
    number = F.when(digits.rlike(r"\A[0-9]{1,2}\z"), digits.cast("int"))
    return F.when(number.between(1, 50), number)


def identity_key(c: Column) -> Column:
    """Lower case, with one space for every run of anything but letters, digits and _."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", " "))


def is_footer_word(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z]", "").isin(*FOOTER_WORDS)


def is_title_word(c: Column) -> Column:
    return F.btrim(F.lower(c), F.lit(".,:-")).isin(*TITLE_WORDS)


def optional_int(c: Column) -> Column:
    """NULL for an empty cell or one that holds no number, else the number without its fraction."""
    return as_double(F.trim(c.cast("string"))).cast("int")


def sequence_quality(score: Column) -> Column:
    """Quality of an accepted panel, from 0.95 to 1."""
    share = F.least(F.greatest((score - 0.62) / 0.38, F.lit(0.0)), F.lit(1.0))
    return F.round(0.95 + share * 0.05, 4)


def required_int(c: Column, name: str) -> Column:
    """As optional_int, but an empty cell is an error that stops the job."""
    value = optional_int(c)
    return F.when(value.isNull(), F.raise_error(F.lit(f"{name} is required"))).otherwise(value)
