"""Data-quality rules: each gives findings (table_id, code, severity, message, row_index, variable).

Rules that look at order do so within a table; nothing is windowed over all tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesift.functions import text as T
from tablesift.operators.cells import IDENTITY, KEY, SERIAL

COLUMNS = ("table_id", "code", "severity", "message", "row_index", "variable")


def _findings(df: DataFrame, code: str, message: Column, row: Column | None = None, variable: Column | None = None) -> DataFrame:
    return df.select(
        "table_id",
        F.lit(code).alias("code"),
        F.lit("ERROR").alias("severity"),
        message.alias("message"),
        (F.lit(None) if row is None else row).cast("long").alias("row_index"),
        (F.lit(None) if variable is None else variable).cast("string").alias("variable"),
    )


def type_parse(typed: DataFrame) -> DataFrame:
    return _findings(typed.filter(F.col("parse_error").isNotNull()), "type_parse", F.col("parse_error"), F.col("row_index"), F.col("variable"))


def ambiguous(typed: DataFrame) -> DataFrame:
    """Flags of cells that did parse; those that did not have a flag of their own."""
    flagged = typed.filter(F.col("flag") != "AMBIGUOUS_OCR")
    message = F.concat(F.col("variable"), F.lit(": "), F.col("flag"), F.lit(" for "), T.quoted(F.col("raw_value")))
    return _findings(flagged, "ambiguous_ocr", message, F.col("row_index"), F.col("variable"))


def negative(typed: DataFrame) -> DataFrame:
    value = F.coalesce(F.col("int_value").cast("double"), F.col("dbl_value"))
    found = typed.filter((value < 0) & (F.col("variable") != SERIAL))
    text = F.coalesce(F.col("int_value").cast("string"), F.col("dbl_value").cast("string"))
    return _findings(found, "nonnegative", F.concat(F.lit("Negative count/value "), text), F.col("row_index"), F.col("variable"))


def serial_progression(rows: DataFrame) -> DataFrame:
    """A numeric serial must exceed the numeric serial before it, itself right or wrong."""
    number = F.when(F.col("serial").rlike(r"\A[0-9]+\z") & (F.col("serial") != "0"), F.col("serial").try_cast("long"))
    before = Window.partitionBy("table_id").orderBy("row_index").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("number", number).withColumn("previous", F.coalesce(F.last("number", ignorenulls=True).over(before), F.lit(0)))
    found = placed.filter(F.col("number") <= F.col("previous"))
    return _findings(found, "serial_progression", F.concat(F.lit("Serial "), F.col("number"), F.lit(" follows "), F.col("previous")), F.col("row_index"), F.lit(SERIAL))


def identity_missing(rows: DataFrame, identity: str = IDENTITY) -> DataFrame:
    blank = rows.filter(F.trim(F.coalesce("identity", F.lit(""))) == "")
    return _findings(blank, "identity_missing", F.lit("Row identity is blank"), F.col("row_index"), F.lit(identity))


def duplicate_identity(rows: DataFrame, identity: str = IDENTITY) -> DataFrame:
    """An ordinary row whose identity any earlier row has, whatever that row's type."""
    named = rows.filter(F.trim(F.coalesce("identity", F.lit(""))) != "").withColumn("key", T.identity_key(F.col("identity")))
    earlier = Window.partitionBy("table_id", "key").orderBy("row_index").rowsBetween(Window.unboundedPreceding, -1)
    found = named.withColumn("seen", F.count("*").over(earlier)).filter((F.col("seen") > 0) & (F.col("row_type") == "ORDINARY"))
    return _findings(found, "duplicate_identity", F.concat(F.lit("Duplicate identity "), T.quoted(F.trim("identity"))), F.col("row_index"), F.lit(identity))


def reference_purity(valued: DataFrame, identity: str = IDENTITY) -> DataFrame:
    """Cross-references that carry data all the same; names listed in column order."""
    impure = valued.filter((F.col("row_type") == "CROSS_REFERENCE") & ~F.col("variable").isin(SERIAL, identity) & F.col("value").isNotNull())
    grouped = impure.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("column_no", "variable"))).alias("found"))
    names = F.concat(F.lit("Cross-reference has data in ['"), F.array_join(F.col("found.variable"), "', '"), F.lit("']"))
    return _findings(grouped, "cross_reference_purity", names, F.col("row_index"))


def row_completeness(valued: DataFrame, identity: str = IDENTITY) -> DataFrame:
    """One finding for each data variable of a row without any data; cross-references are exempt."""
    data = valued.filter((F.col("row_type") != "CROSS_REFERENCE") & ~F.col("variable").isin(SERIAL, identity))
    empty = data.groupBy(*KEY).agg(F.bool_or(F.trim("raw_value") != "").alias("any"), F.collect_set("variable").alias("variables")).filter(~F.col("any"))
    exploded = empty.select(*KEY, F.explode("variables").alias("variable"))
    return _findings(exploded, "ocr_completeness", F.lit("Row has no transcribed data cells"), F.col("row_index"), F.col("variable"))


def column_completeness(valued: DataFrame, identity: str = IDENTITY) -> DataFrame:
    """Data variables that no row of the table has text for; cross-references don't count."""
    data = valued.filter((F.col("row_type") != "CROSS_REFERENCE") & ~F.col("variable").isin(SERIAL, identity))
    empty = data.groupBy("table_id", "variable").agg(F.bool_or(F.trim("raw_value") != "").alias("any")).filter(~F.col("any"))
    return _findings(empty, "column_ocr_completeness", F.concat(F.lit("Column "), T.quoted(F.col("variable")), F.lit(" has no transcribed values")), None, F.col("variable"))


def _total_rows(rows: DataFrame) -> DataFrame:
    return rows.groupBy("table_id").agg(F.count_if(F.col("row_type") == "TOTAL").alias("totals"))


def total_presence(rows: DataFrame) -> DataFrame:
    wrong = _total_rows(rows).filter("totals <> 1")
    return _findings(wrong, "tahsil_total_presence", F.concat(F.lit("Expected one district total row; found "), F.col("totals")))


def total_sum(valued: DataFrame, rows: DataFrame) -> DataFrame:
    """With one total row: an integer column whose parts are all numbers must add up to it."""
    one = _total_rows(rows).filter("totals = 1").select("table_id")
    cells = valued.join(one, "table_id").filter((F.col("data_type") == "integer") & (F.col("variable") != SERIAL))
    number = F.when(F.col("value").isNotNull(), F.col("int_value"))
    is_total = F.col("row_type") == "TOTAL"
    summed = cells.groupBy("table_id", "variable").agg(
        F.sum(F.when(~is_total, number)).alias("parts"),
        F.bool_and(F.when(~is_total, number.isNotNull())).alias("whole"),
        F.max(F.when(is_total, number)).alias("total"),
        F.max(F.when(is_total, F.col("row_index"))).alias("row_index"),
    )
    wrong = summed.filter("whole and total is not null and parts <> total")
    return _findings(wrong, "tahsil_total_sum", F.concat(F.lit("District total "), F.col("total"), F.lit(" != component sum "), F.col("parts")), F.col("row_index"), F.col("variable"))


def panel_findings(tables: DataFrame) -> DataFrame:
    """Table-level rules; tables: table_id, total_rows, panels_found, panels_expected, aligned_min, aligned_max."""
    aligned = (F.col("total_rows") > 0) & (F.col("aligned_min") == F.col("total_rows")) & (F.col("aligned_max") == F.col("total_rows"))
    discovery = _findings(tables.filter("panels_found < panels_expected"), "panel_discovery", F.lit("One or more required panels were not discovered"))
    counts = _findings(tables.filter("total_rows = 0"), "row_count", F.lit("No anchor data rows were segmented"))
    text = F.concat(F.lit("Panel row counts are not aligned: "), F.col("aligned_min"), F.lit(".."), F.col("aligned_max"))
    return union([discovery, counts, _findings(tables.filter(~aligned), "panel_alignment", text)])


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.select(*COLUMNS) for p in parts])


def _found(code: str, message: Column, variable: Column, when: Column) -> Column:
    return F.when(when, F.struct(F.lit(code).alias("code"), message.alias("message"), variable.cast("string").alias("variable")))


def _exploded(df: DataFrame, found: Column) -> DataFrame:
    """Rows with an array of findings, some NULL, as findings."""
    each = df.select("table_id", F.col("row_index").cast("long").alias("row_index"), F.explode(F.filter(found, lambda f: f.isNotNull())).alias("f"))
    return each.select("table_id", "f.code", F.lit("ERROR").alias("severity"), "f.message", "row_index", "f.variable")


def cell_findings(typed: DataFrame) -> DataFrame:
    """type_parse, ambiguous and negative in one pass over the cells."""
    value = F.coalesce(F.col("int_value").cast("double"), F.col("dbl_value"))
    number = F.coalesce(F.col("int_value").cast("string"), F.col("dbl_value").cast("string"))
    variable = F.col("variable")
    found = F.array(
        _found("type_parse", F.col("parse_error"), variable, F.col("parse_error").isNotNull()),
        _found("ambiguous_ocr", F.concat(variable, F.lit(": "), F.col("flag"), F.lit(" for "), T.quoted(F.col("raw_value"))), variable, F.col("flag") != "AMBIGUOUS_OCR"),
        _found("nonnegative", F.concat(F.lit("Negative count/value "), number), variable, (value < 0) & (variable != SERIAL)),
    )
    return _exploded(typed, found)


def row_findings(rows: DataFrame, identity: str = IDENTITY) -> DataFrame:
    """serial_progression, identity_missing and duplicate_identity in one pass over the rows."""
    name = F.trim(F.coalesce("identity", F.lit("")))
    number = F.when(F.col("serial").rlike(r"\A[0-9]+\z") & (F.col("serial") != "0"), F.col("serial").try_cast("long"))
    before = Window.partitionBy("table_id").orderBy("row_index").rowsBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("table_id", "key").orderBy("row_index").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("number", number).withColumn("key", T.identity_key(name)).withColumn("blank", name == "")
    placed = placed.withColumn("previous", F.coalesce(F.last("number", ignorenulls=True).over(before), F.lit(0))).withColumn("seen", F.count_if(~F.col("blank")).over(same))
    found = F.array(
        _found("serial_progression", F.concat(F.lit("Serial "), F.col("number"), F.lit(" follows "), F.col("previous")), F.lit(SERIAL), F.col("number") <= F.col("previous")),
        _found("identity_missing", F.lit("Row identity is blank"), F.lit(identity), F.col("blank")),
        _found("duplicate_identity", F.concat(F.lit("Duplicate identity "), T.quoted(name)), F.lit(identity), ~F.col("blank") & (F.col("seen") > 0) & (F.col("row_type") == "ORDINARY")),
    )
    return _exploded(placed, found)


def record_findings(valued: DataFrame, identity: str = IDENTITY) -> DataFrame:
    """cross_reference_purity and ocr_completeness from one aggregate of each record's data cells."""
    data = valued.filter(~F.col("variable").isin(SERIAL, identity))
    reference = F.col("row_type") == "CROSS_REFERENCE"
    named = F.struct("column_no", "variable")
    grouped = data.groupBy(*KEY, "row_type").agg(
        F.sort_array(F.collect_list(F.when(reference & F.col("value").isNotNull(), named))).alias("impure"),
        F.bool_or(F.trim("raw_value") != "").alias("any"),
        F.collect_set("variable").alias("variables"),
    )
    names = F.concat(F.lit("Cross-reference has data in ['"), F.array_join(F.col("impure.variable"), "', '"), F.lit("']"))
    impure = F.array(_found("cross_reference_purity", names, F.lit(None), reference & (F.size("impure") > 0)))
    empty = F.transform("variables", lambda v: _found("ocr_completeness", F.lit("Row has no transcribed data cells"), v, ~reference & ~F.col("any")))
    return _exploded(grouped, F.concat(impure, empty))


def all_findings(typed: DataFrame, rows: DataFrame, valued: DataFrame, with_totals: bool = False) -> DataFrame:
    """Every rule, in one pass for each grain: cells, rows, records, columns."""
    parts = [cell_findings(typed), row_findings(rows), record_findings(valued), column_completeness(valued)]
    if with_totals:
        parts += [total_presence(rows), total_sum(valued, rows)]
    return union(parts)


def retry_targets(findings: DataFrame) -> DataFrame:
    """Distinct cells that a second request may repair."""
    codes = ("type_parse", "ambiguous_ocr", "ocr_completeness", "column_ocr_completeness")
    return findings.filter(F.col("code").isin(*codes) & F.col("row_index").isNotNull() & F.col("variable").isNotNull()).select("table_id", "row_index", "variable").distinct()
