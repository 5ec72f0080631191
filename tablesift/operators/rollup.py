"""Coverage of an archive: counts by state and year, filters and order of the state table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cleaned(rows: DataFrame) -> DataFrame:
    """(state, district, available, language, year): trimmed, with defaults; rows without state or district go."""
    named = rows.filter((F.coalesce("state", F.lit("")) != "") & (F.coalesce("district", F.lit("")) != ""))

    def or_default(name: str, default: str) -> Column:
        return F.when(F.coalesce(F.col(name), F.lit("")) == "", default).otherwise(F.trim(name)).alias(name)

    return named.select(F.trim("state").alias("state"), F.trim("district").alias("district"), or_default("available", "No"), or_default("language", "Unknown"), "year")


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(F.round(part / whole * 100, 1))


def _counts() -> list[Column]:
    yes = F.col("available") == "Yes"
    return [
        F.count("*").alias("total"),
        F.count_if(yes).alias("available"),
        (F.count("*") - F.count_if(yes)).alias("not_available"),
        F.count_if(F.col("language") == "Yes").alias("english"),
        F.count_if(F.col("language") == "No").alias("hindi"),
        F.count_if(F.col("language") == "No PDF").alias("no_pdf"),
    ]


def _with_percent(df: DataFrame) -> DataFrame:
    return df.withColumn("availability_pct", _percent(F.col("available"), F.col("total")))


def overall(rows: DataFrame) -> DataFrame:
    """One row for each year."""
    unknown = F.count_if(~F.col("language").isin("Yes", "No", "No PDF")).alias("unknown")
    return _with_percent(rows.groupBy("year").agg(*_counts(), unknown, F.countDistinct("state").alias("states_count")))


def by_state(rows: DataFrame) -> DataFrame:
    return _with_percent(rows.groupBy("year", "state").agg(*_counts()))


def all_years(rows: DataFrame) -> DataFrame:
    """Years and their sum (year NULL); the percentage is that of the sums."""
    return _with_percent(rows.rollup("year").agg(*_counts()))


def matching(rows: DataFrame, state: str = "", language: str = "", available: str = "", year: int | None = None) -> DataFrame:
    """Rows by part of the state's or district's name, and by exact language, availability and year."""
    out = rows
    if state:
        out = out.filter(F.contains(F.lower("state"), F.lit(state.lower())) | F.contains(F.lower("district"), F.lit(state.lower())))
    for name, value in (("language", language), ("available", available), ("year", year)):
        if value not in ("", None):
            out = out.filter(F.col(name) == value)
    return out


def sort_states(states: DataFrame, key: str, descending: bool = False) -> DataFrame:
    """States by any of their columns, equal ones by name."""
    return states.orderBy(F.col(key).desc() if descending else F.col(key).asc(), F.col("state").asc())


def colour(percent: Column) -> Column:
    return F.when(percent >= 80, "green").when(percent >= 40, "amber").otherwise("red")


def badge(language: Column) -> Column:
    return F.when(language == "Yes", "English").when(language == "No", "Hindi").otherwise("No PDF")
