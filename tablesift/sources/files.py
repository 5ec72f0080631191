"""Files as rows: sorted listings and content digests, by Spark's own reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listed(spark: SparkSession, folder: str, pattern: str = "*.pdf", limit: int | None = None) -> DataFrame:
    """(path, length) in order of the path, the first `limit` of them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "length").orderBy("path")
    return files if limit is None else files.limit(limit)


def digests(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, sha256) of whole files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.sha2("content", 256).alias("sha256"))
