"""From raw documents to packed training sequences: five stages, each written and read again by the next.

Toxic documents go; later copies of repeated line runs are cut; of each group of near copies the document with the
smallest id stays; benchmark passages are cut out; the rest is packed. Stages that cut text set n_chars anew where
that column exists, and drop a document only if nothing but white space is left of what had words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from tablesift.llm.common import fresh, staged, table


def _recounted(df: DataFrame) -> DataFrame:
    """n_chars after a cut, in its own type."""
    if "n_chars" not in df.columns:
        return df
    return df.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(df.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the rejection threshold."""
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    name = fresh(docs.columns, "toxicity")
    return toxicity.score(docs, "text", weights, name).filter(F.col(name) < toxicity.REJECT).drop(name)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated line runs."""
    names = tuple(fresh(docs.columns, n) for n in ("line_count", "lines_removed", "runs_removed"))
    kept = line_dedup.remove_runs(docs, "doc_id", "text", names=names).filter((F.col(names[1]) == 0) | (F.trim("text") != ""))
    return _recounted(kept.select(*docs.columns))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.one_of_each(docs, "doc_id", "text")


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return _recounted(decontaminate.remove_contamination(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences that mix the sources."""
    import public_tokenizers

    return packing.pack(docs, "doc_id", "text", "source", public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("jaccard_join", one_of_near_copies),
    ("decontamination", cut_benchmark),
    ("packing", pack_sequences),
]

#: The stages train a model and tokenise, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
