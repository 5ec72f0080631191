"""The table of documents: required columns, types, unique keys and lookups. What doesn't fit becomes rows, not a crash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesift.functions.text import optional_int

REQUIRED = ("pdf_id", "file_name", "format_id")
NUMBERS = ("year", "source_page_start", "source_page_end", "anchor_page", "continuation_page", "anchor_printed_page", "continuation_printed_page")


def missing_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> list[str]:
    return sorted(set(required) - set(df.columns))


def documents(df: DataFrame) -> DataFrame:
    """Rows with a file name: text trimmed, numbers as numbers, in order of the file name whatever its case."""
    gone = missing_columns(df)
    if gone:
        raise ValueError(f"missing columns {gone}")
    rows = df.filter(F.trim(F.coalesce(F.col("file_name").cast("string"), F.lit(""))) != "")
    typed = {c: optional_int(F.col(c)) if c in NUMBERS else F.trim(F.col(c).cast("string")) for c in df.columns}
    return rows.select(*[e.alias(c) for c, e in typed.items()]).orderBy(F.lower("file_name"))


def repeated_keys(df: DataFrame, keys: tuple[str, ...] = ("file_name", "pdf_id")) -> DataFrame:
    """(key_name, key, n) of keys that should be unique but aren't, whatever their case."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("key_name"), F.lower(F.col(k).cast("string")).alias("key")) for k in keys]))
    return df.select(each.alias("k")).groupBy("k.key_name", "k.key").agg(F.count("*").alias("n")).filter("n > 1")


def looked_up(files: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files with their document, files without one), by file name whatever its case."""
    keyed = docs.withColumn("__key", F.lower("file_name")).drop("file_name")
    named = files.withColumn("__key", F.lower("file_name"))
    return named.join(keyed, "__key").drop("__key"), named.join(keyed, "__key", "left_anti").drop("__key")


def format_conflicts(docs: DataFrame, formats: DataFrame) -> DataFrame:
    """Documents whose format is unknown; format ids are compared with their case."""
    return docs.join(formats.select("format_id").distinct(), "format_id", "left_anti")
