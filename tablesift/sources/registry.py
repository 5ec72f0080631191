"""Table schemas from YAML files: read on the driver, checked as a whole, used as small frames."""

from __future__ import annotations

from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMN_SCHEMA = "format_id string, column_no int, column_name string, variable string, data_type string, description string, value_examples array<string>, is_anchor_page boolean"
PANEL_SCHEMA = "format_id string, panel_id string, panel_order int, page int, printed_columns array<int>, identity_columns array<int>, headings array<string>, row_anchor boolean, align_to string"


class SchemaError(ValueError):
    """A schema that can't be trusted; nothing falls back to a guess."""


def load_schemas(folder: str) -> dict[str, dict]:
    """Schemas by format_id and by name, from the YAML files of a folder in order of their paths."""
    found: dict[str, dict] = {}
    for path in sorted(Path(folder).glob("*.yaml")):
        schema = yaml.safe_load(path.read_text(encoding="utf-8"))
        if schema["format_id"] in found:
            raise SchemaError(f"duplicate format_id {schema['format_id']}")
        problems = schema_problems(schema)
        if problems:
            raise SchemaError(f"{path.name}: {'; '.join(problems)}")
        found[schema["format_id"]] = found[schema["name"]] = schema
    return found


def logical_columns(schema: dict) -> list[dict]:
    """Columns of both pages by number; the continuation page's definition of a number counts."""
    by_number = {c["column_no"]: c for c in schema.get("anchor_page", [])}
    by_number.update({c["column_no"]: c for c in schema.get("continuation_page", [])})
    return [by_number[n] for n in sorted(by_number)]


def schema_problems(schema: dict) -> list[str]:
    panels = schema.get("panels") or []
    out = [] if panels else ["no panels"]
    names = {p["panel_id"] for p in panels}
    for p in panels:
        numbers = p.get("printed_columns") or []
        if not numbers or len(set(numbers)) != len(numbers):
            out.append(f"panel {p['panel_id']}: printed columns must be unique and not empty")
        if p.get("row_anchor") and p.get("align_to"):
            out.append(f"panel {p['panel_id']}: an anchor may not align to another panel")
        if p.get("align_to") and p["align_to"] not in names:
            out.append(f"panel {p['panel_id']}: unknown panel {p['align_to']}")
    missing = {c["column_no"] for c in logical_columns(schema)} - {n for p in panels for n in p.get("printed_columns") or []}
    if missing:
        out.append(f"columns without a panel: {sorted(missing)}")
    if sum(bool(p.get("row_anchor")) for p in panels) != 1:
        out.append("exactly one panel must be the row anchor")
    return out


def lookup(schemas: dict[str, dict], key: str) -> dict:
    if key not in schemas:
        raise SchemaError(f"unknown format {key!r}")
    return schemas[key]


def frames(spark: SparkSession, schemas: dict[str, dict]) -> tuple[DataFrame, DataFrame]:
    """(schema_columns, schema_panels), each format once and in order of its id."""
    unique = {s["format_id"]: s for s in schemas.values()}
    columns, panels = [], []
    for format_id in sorted(unique):
        schema = unique[format_id]
        front = {c["column_no"] for c in schema.get("anchor_page", [])}
        columns += [(format_id, c["column_no"], c.get("column_name"), c["variable"], c.get("data_type", "string"), c.get("description"), [str(x) for x in c.get("value_examples") or []], c["column_no"] in front) for c in logical_columns(schema)]
        panels += [(format_id, p["panel_id"], i, p["page"], p["printed_columns"], p.get("identity_columns") or [], p.get("headings") or [], bool(p.get("row_anchor")), p.get("align_to")) for i, p in enumerate(schema["panels"])]
    return spark.createDataFrame(columns, COLUMN_SCHEMA), spark.createDataFrame(panels, PANEL_SCHEMA)


def uncovered_columns(columns: DataFrame, panels: DataFrame) -> DataFrame:
    """Columns that no panel of their format prints."""
    printed = panels.select("format_id", F.explode("printed_columns").alias("column_no"))
    return columns.join(printed, ["format_id", "column_no"], "left_anti")


def first_panel(columns: DataFrame, panels: DataFrame) -> DataFrame:
    """The first panel that prints each column."""
    printed = panels.select("format_id", "panel_id", "panel_order", F.explode("printed_columns").alias("column_no"))
    return columns.join(printed, ["format_id", "column_no"], "left").groupBy("format_id", "column_no", "variable").agg(F.min_by("panel_id", "panel_order").alias("panel_id"))


def export_schema(schema: dict, derived: tuple[str, ...] = ()) -> T.StructType:
    """Raw text and flag of each variable, then derived values."""
    fields = [T.StructField(n, T.StringType()) for c in logical_columns(schema) for n in (c["variable"], f"{c['variable']}_flag")]
    return T.StructType(fields + [T.StructField(d, T.DoubleType()) for d in derived])
