"""The long cell table: typing, flags, row classes, and the wide record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesift.functions import text as T

KEY = ("table_id", "row_index")
SERIAL, IDENTITY = "sl_no", "town_name"


def to_long(wide: DataFrame, variables: Sequence[tuple[str, str]]) -> DataFrame:
    """(table_id, row_index, column_no, variable, data_type, raw_value) from a record with a column for each variable."""
    cells = F.array(*[F.struct(F.lit(i + 1).alias("column_no"), F.lit(v).alias("variable"), F.lit(t).alias("data_type"), F.coalesce(F.col(v), F.lit("")).alias("raw_value")) for i, (v, t) in enumerate(variables)])
    return wide.select(*KEY, F.inline(cells))


def typed_cells(cells: DataFrame) -> DataFrame:
    """The long table with int_value, dbl_value, str_value, parse_error and flag.

    The marked text and the number are columns of their own on the way: used several times, they are computed once.
    """
    marked = cells.withColumn("__value", T.null_mark(F.col("raw_value"))).withColumn("__number", T.clean_number(F.col("__value")))
    kind, variable = F.col("data_type"), F.col("variable")
    parsed = marked.withColumns(T.typed_parts(F.col("__value"), F.col("__number"), kind, variable))
    flag = T.review_flag(F.col("raw_value"), kind, variable, T.parse_failed(F.col("__value"), F.col("__number"), kind), F.col("__value"))
    return parsed.withColumn("flag", flag).drop("__value", "__number")


def classified_rows(typed: DataFrame, identity: str = IDENTITY) -> DataFrame:
    """(table_id, row_index, serial, identity, row_type, reference_target): one row for each record."""

    def of(variable: str):
        return F.max(F.when(F.col("variable") == variable, F.coalesce(F.col("int_value").cast("string"), F.col("str_value"))))

    rows = typed.groupBy(*KEY).agg(of(SERIAL).alias("serial"), of(identity).alias("identity"))
    kind = T.row_class(F.col("identity"), F.col("serial"))
    return rows.withColumn("kind", kind).select(*KEY, "serial", "identity", "kind.row_type", "kind.reference_target")


def values(typed: DataFrame, rows: DataFrame, identity: str = IDENTITY, with_roads: bool = True) -> DataFrame:
    """Cells with row_type and `value`: the data of a cross-reference is blank. Road lengths come from raw text after that."""
    joined = typed.join(rows.select(*KEY, "row_type"), list(KEY))
    own = F.coalesce(F.col("int_value").cast("string"), F.col("dbl_value").cast("string"), F.col("str_value"))
    blanked = (F.col("row_type") == "CROSS_REFERENCE") & ~F.col("variable").isin(SERIAL, identity)
    out = joined.withColumn("value", F.when(~blanked, own))
    if with_roads:
        road = T.road_lengths(F.when(F.col("variable") == "road_length_km", F.col("raw_value")))
        out = out.withColumn("road", road).withColumns({"pucca_road_km": F.col("road.pucca_road_km"), "kutcha_road_km": F.col("road.kutcha_road_km")}).drop("road")
    return out


def wide(cells: DataFrame, variables: Sequence[str], column: str = "raw_value") -> DataFrame:
    """One row for each record; the variables are given, so no job looks for them."""
    return cells.groupBy(*KEY).pivot("variable", list(variables)).agg(F.first(column))


def flags_wide(typed: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Each variable followed by its flag, then requires_review."""
    columns = [c for v in variables for c in (F.max(F.when(F.col("variable") == v, F.col("raw_value"))).alias(v), F.max(F.when(F.col("variable") == v, F.col("flag"))).alias(f"{v}_flag"))]
    return typed.groupBy(*KEY).agg(*columns, F.bool_or(F.col("flag").isNotNull()).alias("requires_review"))
