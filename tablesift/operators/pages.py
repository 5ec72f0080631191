"""Which pages of a volume show which table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesift.functions import pages as P

# Pages read at either end of a volume, and where the search for the anchor starts.
FRONT_PAGES, TAIL_PAGES, ANCHOR_FROM = 45, 12, 15


def volumes(files: DataFrame, column: str = "file_name") -> DataFrame:
    """(district_key, file_name): the last file of each district; excluded volumes don't count."""
    kept = files.filter(~F.col(column).isin(*P.EXCLUDED_VOLUMES))
    return kept.groupBy(P.folded(P.district(F.col(column))).alias("district_key")).agg(F.max(column).alias("file_name"))


def read_pages(pages: DataFrame) -> DataFrame:
    """Pages at either end, their text folded; pages: volume, page, page_count, text."""
    near = pages.filter((F.col("page") <= FRONT_PAGES) | (F.col("page") > F.col("page_count") - TAIL_PAGES))
    return near.withColumn("text", P.folded(F.coalesce("text", F.lit(""))))


def ranges(pages: DataFrame, tail_pages: int = TAIL_PAGES) -> DataFrame:
    """One row for each volume with the page ranges of its tables; a volume without a civic table has no other range."""
    text = F.col("text")
    seen = pages.select("volume", "page", "page_count", P.is_municipal(text).alias("municipal"), P.is_civic(text).alias("civic"), P.is_medical(text).alias("medical"), P.is_directory(text).alias("directory"), P.is_appendix(text).alias("appendix"))
    front = seen.filter(F.col("page") <= FRONT_PAGES)

    def first(flag: Column) -> Column:
        return F.min(F.when(flag, F.col("page")))

    whole = seen.groupBy("volume").agg(F.max("page_count").alias("page_count"), first(F.col("appendix") & (F.col("page") >= F.greatest(F.lit(1), F.col("page_count") - tail_pages + 1))).alias("appendix"))
    anchor = front.groupBy("volume").agg(first(F.col("municipal") & (F.col("page") >= ANCHOR_FROM)).alias("anchor"))
    civic = front.join(anchor, "volume").groupBy("volume").agg(first(F.col("civic") & (F.col("page") >= F.coalesce("anchor", F.lit(0)))).alias("civic"))
    later = front.drop("civic").join(civic.filter("civic is not null"), "volume").filter(F.col("page") >= F.col("civic"))
    medical = later.groupBy("volume").agg(first(F.col("medical")).alias("medical"), first(F.col("directory")).alias("directory"))
    joined = whole.join(civic, "volume", "left").join(medical, "volume", "left")
    last = F.col("page_count")
    end = F.when(F.col("directory") >= F.col("medical"), F.col("directory")).otherwise(F.col("medical") + 1)
    found = F.col("civic").isNotNull()
    return joined.select(
        "volume",
        F.col("civic").alias("civic_start"),
        F.least(F.col("civic") + 1, F.when(found, last)).alias("civic_end"),
        F.coalesce("medical", "directory").alias("medical_start"),
        F.when(F.col("medical").isNotNull(), F.least(end, last)).otherwise(F.col("directory")).alias("medical_end"),
        F.when(found, F.col("appendix")).alias("appendix_start"),
        F.when(found & F.col("appendix").isNotNull(), F.least(last, F.col("appendix") + 1)).alias("appendix_end"),
    )


def page_set(page_ranges: DataFrame) -> DataFrame:
    """(volume, page): the pages of all ranges, each once."""
    parts = [page_ranges.filter(F.col(f"{k}_start").isNotNull()).select("volume", F.explode(F.sequence(F.col(f"{k}_start"), F.greatest(f"{k}_start", f"{k}_end"))).alias("page")) for k in ("civic", "medical", "appendix")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def has_text(pages: DataFrame) -> DataFrame:
    return pages.groupBy("volume").agg(F.bool_or(F.trim(F.coalesce("text", F.lit(""))) != "").alias("has_text"))
