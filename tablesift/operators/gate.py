"""The weighted, fail-closed gate, routing, and the run manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Weights, threshold and statuses.
WEIGHTS = {"geometry": 0.30, "ocr": 0.35, "parsing": 0.15, "semantic": 0.20}
THRESHOLD = 0.95
STATUSES = ("CLEAN", "QUARANTINED", "DRY_RUN", "ERROR")
NOT_SEMANTIC = ("panel_discovery", "panel_alignment", "type_parse")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def quality(typed: DataFrame, findings: DataFrame, tables: DataFrame) -> DataFrame:
    """One row for each table: row counts, the four components, overall, is_valid and status.

    tables: table_id, panels_complete, aligned, geometry_min, ocr_ok, ocr_total.
    """
    parsed = typed.groupBy("table_id").agg(
        F.countDistinct("row_index").alias("total_rows"),
        F.count_if(F.trim("raw_value") != "").alias("cells"),
        F.count_if(F.col("parse_error").isNotNull()).alias("failures"),
    )
    errors = findings.filter(F.col("severity") == "ERROR").groupBy("table_id").agg(
        F.count("*").alias("errors"),
        F.count_if(~F.col("code").isin(*NOT_SEMANTIC)).alias("semantic_errors"),
        F.countDistinct("row_index").alias("error_rows"),
        F.slice(F.sort_array(F.collect_set("row_index")), 1, 10).alias("first_failures"),
    )
    joined = tables.join(parsed, "table_id", "left").join(errors, "table_id", "left").na.fill(0, ["total_rows", "cells", "failures", "errors", "semantic_errors", "error_rows"])
    components = joined.select(
        "table_id",
        "total_rows",
        F.greatest(F.col("total_rows") - F.col("error_rows"), F.lit(0)).alias("valid_rows"),
        (F.col("geometry_min") * F.when(F.col("aligned"), 1.0).otherwise(0.5)).alias("geometry"),
        _ratio(F.col("ocr_ok"), F.col("ocr_total")).alias("ocr"),
        F.when(F.col("cells") == 0, 0.0).otherwise(1 - _ratio(F.col("failures"), F.col("cells"))).alias("parsing"),
        F.greatest(F.lit(0.0), 1 - F.col("semantic_errors") / F.greatest(F.lit(1), F.col("total_rows"))).alias("semantic"),
        "errors",
        "first_failures",
        (F.col("panels_complete") & F.col("aligned")).alias("complete"),
    )
    overall = F.round(sum((F.col(k) * w for k, w in WEIGHTS.items()), F.lit(0.0)), 4)
    valid = F.col("complete") & (F.col("errors") == 0) & (F.col("overall") >= THRESHOLD)
    return components.withColumn("overall", overall).withColumn("is_valid", valid).withColumn("status", F.when(valid, "CLEAN").otherwise("QUARANTINED")).drop("complete")


def usable_results(results: DataFrame) -> DataFrame:
    """(table_id, ocr_ok, ocr_total): results without an error that have usable boxes or text."""
    ok = F.col("error").isNull() & (F.col("usable") | (F.trim(F.coalesce("raw_text", F.lit(""))) != ""))
    return results.groupBy("table_id").agg(F.count_if(ok).alias("ocr_ok"), F.count("*").alias("ocr_total"))


def latest(manifest: DataFrame, key: str = "pdf_id", at: str = "completed_at") -> DataFrame:
    """The last record of each key; equal times are settled by the whole record."""
    others = [F.col(c).desc() for c in manifest.columns if c not in (key, at)]
    order = Window.partitionBy(key).orderBy(F.col(at).desc(), *others)
    return manifest.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def status_counts(manifest: DataFrame) -> DataFrame:
    """Records by status, with zeros for statuses that don't occur."""
    spark = manifest.sparkSession
    every = spark.createDataFrame([(s,) for s in STATUSES], "status string")
    counts = manifest.groupBy("status").agg(F.count("*").alias("n"))
    return every.join(counts, "status", "left").select("status", F.coalesce("n", F.lit(0)).alias("n"))


def exit_code(manifest: DataFrame) -> DataFrame:
    """1 if any record failed, else 2 if any is quarantined, else 0."""
    failed, held = F.coalesce(F.bool_or(F.col("status") == "ERROR"), F.lit(False)), F.coalesce(F.bool_or(F.col("status") == "QUARANTINED"), F.lit(False))
    return manifest.agg(F.when(failed, 1).when(held, 2).otherwise(0).alias("exit_code"))


def dry_run_score(panels: DataFrame) -> DataFrame:
    """(table_id, score): the least panel quality, which is all that a dry run knows."""
    return panels.groupBy("table_id").agg(F.min("quality").alias("score"))


def usage(results: DataFrame) -> DataFrame:
    """Requests, cache hits and misses, and tokens of each table; counters that are absent count 0."""
    tokens = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")]
    return results.groupBy("table_id").agg(F.count("*").alias("requests"), F.count_if("cache_hit").alias("hits"), F.count_if(~F.col("cache_hit")).alias("misses"), *tokens)


def with_errors(manifest: DataFrame, errors: DataFrame) -> DataFrame:
    """A run's records with the documents that failed, whatever failed, as ERROR records; errors: pdf_id, error."""
    first = errors.groupBy("pdf_id").agg(F.min("error").alias("error"))
    kept = manifest.join(first.select("pdf_id"), "pdf_id", "left_anti")
    failed = first.select(*[F.lit("ERROR").alias(c) if c == "status" else F.col(c) if c in ("pdf_id", "error") else F.lit(None).cast(manifest.schema[c].dataType).alias(c) for c in manifest.columns])
    return kept.unionByName(failed)


def retried(cells: DataFrame, second: DataFrame) -> DataFrame:
    """Cells with a second reading that has text in place of the first; second: table_id, row_index, variable, raw_value."""
    again = second.filter(F.trim(F.coalesce("raw_value", F.lit(""))) != "").groupBy("table_id", "row_index", "variable").agg(F.max("raw_value").alias("again"))
    joined = cells.join(again, ["table_id", "row_index", "variable"], "left")
    return joined.withColumn("raw_value", F.coalesce("again", "raw_value")).drop("again").select(*cells.columns)
