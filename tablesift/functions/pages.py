"""Column functions that name volumes and tell what a page shows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablesift.functions.text import squeeze

# What a page of each kind shows, in squashed text.
CIVIC_SIGNS = (r"\b(la[tr]e?r)", "sewer|sewel", r"\bnight\b|dight", "road len", "borne")
MEDICAL_STEMS = ("hospit", "dispensar", "nurs", "recrea", "educational")
APPENDIX_SIGNS = ("junior basic", "senior basic", "abstract", "appendix", "district total", "name of tahsil")
EXCLUDED_VOLUMES = ("1971 Aajmgrah.pdf", "1971 Badha.pdf", "1971 Bhrich.pdf", "1971 Mirzapur (Hindi).pdf")


def folded(c: Column) -> Column:
    return F.lower(squeeze(c))


def slug(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.replace(F.lower(F.trim(c)), F.lit("&"), F.lit("and")), "[^a-z0-9]+", "_"), F.lit("_"))


def district(file_name: Column) -> Column:
    """'1971 Baliya.pdf' -> 'Baliya'."""
    return squeeze(F.regexp_replace(F.regexp_replace(file_name, r"(?i)\.pdf$", ""), r"(?i)^\s*1971\s+", ""))


def leading_page_number(c: Column) -> Column:
    """The number that heads a page, else the first one in brackets within 200 characters."""
    head = squeeze(F.substring(c, 1, 200))
    first = F.nullif(F.regexp_extract(head, r"^\(?\s*([0-9]{1,4})\s*\)?", 1), F.lit(""))
    bracketed = F.nullif(F.regexp_extract(head, r"\(\s*([0-9]{1,4})\s*\)", 1), F.lit(""))
    return F.coalesce(first, bracketed).cast("int")


def squashed(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def is_civic(c: Column) -> Column:
    text = squashed(c)
    return sum((text.rlike(sign).cast("int") for sign in CIVIC_SIGNS), F.lit(0)) >= 1


def is_medical(c: Column) -> Column:
    text = squashed(c)
    return F.contains(text, F.lit("medical")) & _any(text, MEDICAL_STEMS)


def is_directory(c: Column) -> Column:
    return F.contains(squashed(c), F.lit("cultural facilities"))


def is_municipal(c: Column) -> Column:
    return F.contains(squashed(c), F.lit("municipal"))


def is_appendix(c: Column) -> Column:
    return _any(squashed(c), APPENDIX_SIGNS)


def category_file(name: Column, category: str) -> Column:
    return F.concat(slug(name), F.lit(f"_{category}_1971.pdf"))
