"""Where results go: clean or quarantine areas in three formats, reports, audit records, and the manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.operators.gate import latest

AREAS = {"CLEAN": "clean", "QUARANTINED": "quarantine"}
MANIFEST = "run_id string, pdf_id string, status string, completed_at string, error string"


def routed(records: DataFrame, quality: DataFrame) -> DataFrame:
    """Records with the area that their table's status sends them to."""
    area = F.when(F.col("status") == "CLEAN", AREAS["CLEAN"]).otherwise(AREAS["QUARANTINED"])
    return records.join(quality.select("table_id", area.alias("area")), "table_id")


def without_empty_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The frame without columns that are NULL in every row; `keep` stays. One pass finds them."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns if c not in keep]).first().asDict()
    return df.drop(*[c for c, n in counts.items() if n == 0])


def write_records(records: DataFrame, folder: str, keys: Sequence[str] = ("area",)) -> None:
    """Parquet, CSV and JSON lines below area folders. Spark's commit protocol makes each write all or nothing."""
    records.write.mode("overwrite").partitionBy(*keys).parquet(f"{folder}/parquet")
    records.write.mode("overwrite").partitionBy(*keys).option("header", True).option("escape", '"').csv(f"{folder}/csv")
    records.write.mode("overwrite").partitionBy(*keys).option("ignoreNullFields", False).json(f"{folder}/jsonl")


def as_json_lines(df: DataFrame) -> DataFrame:
    """(value): each row as JSON with its keys in order and NULLs written."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]), {"ignoreNullFields": "false"}).alias("value"))


def write_audit(records: DataFrame, folder: str) -> None:
    """Audit records by document; kinds of record share one schema, absent fields are NULL."""
    records.write.mode("append").partitionBy("pdf_id").option("ignoreNullFields", False).json(folder)


def geometry_json(bands: DataFrame, spans: DataFrame) -> DataFrame:
    """(table_id, geometry): rows and columns of each table as one JSON text."""
    rows = bands.groupBy("table_id").agg(F.sort_array(F.collect_list(F.struct("row_index", "box_x0", "box_y0", "box_x1", "box_y1"))).alias("rows"))
    columns = spans.groupBy("table_id").agg(F.sort_array(F.collect_list(F.struct("column_no", "x_start", "x_end"))).alias("columns"))
    return rows.join(columns, "table_id", "full").select("table_id", F.to_json(F.struct("columns", "rows")).alias("geometry"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The records of earlier runs; a resumed run without them is an error."""
    return spark.read.schema(MANIFEST).json(path)


def upsert_manifest(old: DataFrame, new: DataFrame) -> DataFrame:
    """The latest record of each document in each run."""
    both = old.unionByName(new)
    return latest(both.withColumn("__key", F.struct("run_id", "pdf_id")), "__key").drop("__key")


def export_types(df: DataFrame, doubles: Sequence[str] = ("pucca_road_km", "kutcha_road_km"), longs: Sequence[str] = ("row_index", "year", "source_page_start", "source_page_end", "anchor_printed_page", "continuation_printed_page"), booleans: Sequence[str] = ("requires_review",)) -> DataFrame:
    """The types of an export: road lengths, counters and marks by name, everything else text."""
    kinds = {**dict.fromkeys(doubles, "double"), **dict.fromkeys(longs, "long"), **dict.fromkeys(booleans, "boolean")}
    return df.select(*[F.col(c).try_cast(kinds.get(c, "string")).alias(c) for c in df.columns])


def trim_report(ranges: DataFrame) -> DataFrame:
    """(volume, report): each volume's page ranges and warnings as JSON."""
    warnings = F.filter(
        F.array(
            F.when(F.col("civic_start").isNull(), "civic title not found"),
            F.when(F.col("civic_start").isNotNull() & F.col("medical_start").isNull(), "medical title not found"),
            F.when(F.col("civic_start").isNotNull() & F.col("appendix_start").isNull(), "appendix not found (volume may be truncated)"),
        ),
        lambda w: w.isNotNull(),
    )
    parts = [F.when(F.col(f"{k}_start").isNotNull(), F.array(F.col(f"{k}_start"), F.col(f"{k}_end"))).alias(k) for k in ("civic", "medical", "appendix")]
    return ranges.select("volume", F.to_json(F.struct(*parts, warnings.alias("warnings"))).alias("report"))


def write_dashboard(rows: DataFrame, overall: DataFrame, states: DataFrame, folder: str) -> None:
    """The archive's rows and its yearly statistics, with those of their states, as JSON lines."""
    rows.write.mode("overwrite").json(f"{folder}/data")
    nested = states.groupBy("year").agg(F.sort_array(F.collect_list(F.struct("state", *[c for c in states.columns if c not in ("year", "state")]))).alias("state_stats"))
    overall.join(nested, "year", "left").write.mode("overwrite").json(f"{folder}/stats")
