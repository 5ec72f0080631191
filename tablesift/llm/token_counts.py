"""Token counts by a map-side two-tier lookup; no pre-token is ever shuffled by document.

Tier 1: the most frequent pre-tokens of the whole corpus with their token counts, a broadcast table of at most
`frequent` entries (a fixed bound, whatever the corpus). Each task summarises its pre-tokens in a bounded
Misra-Gries counter over all its texts; the summaries are merged by a small aggregate. Tier 2: other pre-tokens are
encoded in batches and kept in a bounded cache of the Python worker. Both tiers only save work: each text's count is
exact whatever they hold.

Cases: a null text counts as empty (0 bytes, 0 tokens, not over the limit). Rows that repeat, or have a null id,
each give a row; ids of any type do. A text of any length counts whole; one longer than a chunk is a chunk of its own.
An empty table gives no row. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import uuid
from collections import ChainMap, Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm.bpe import BpeTokenizer, loaded
from tablesift.llm.common import chunks, held_latest, ship, staged, table

FREQUENT = 1 << 17
CACHE = 400_000
#: Longer pieces are encoded each time they come, so that tiers and caches are bounded in bytes too.
LONGEST = 64


def _pruned(counts: Counter, most: int) -> Counter:
    """Misra-Gries step: keep at most `most` counters, lowered by the largest one dropped."""
    if len(counts) <= most:
        return counts
    values = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
    cut = int(np.partition(values, len(values) - most - 1)[len(values) - most - 1])
    return Counter({k: v - cut for k, v in counts.items() if v > cut})


def frequent_pieces(texts: DataFrame, tokenizer_path: str, most: int = FREQUENT) -> DataFrame:
    """(piece, n): the heaviest pre-tokens of all texts, at most `most` of them; the merged counts are written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, counts = loaded(tokenizer_path), Counter()
        for batch in batches:
            for _, part in chunks(batch, "text"):
                for text in part:
                    if text:
                        counts.update(p for p in tokenizer.pieces(text) if len(p) <= LONGEST)
                if len(counts) > 4 * most:
                    counts = _pruned(counts, most)
        counts = _pruned(counts, most)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    summed = staged(texts.mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")), "pieces")
    total = summed.agg(F.sum("n").alias("n")).first()["n"] or 0
    # counts that reach a `most`-th of their total are at most `most`, so no sort is needed to bound them
    return summed.filter(F.col("n") * most >= total)


class TwoTier:
    """The lookup of one worker: the broadcast tier and a bounded cache of misses."""

    def __init__(self, tokenizer: BpeTokenizer, blob: bytes, ends: np.ndarray, lengths: np.ndarray) -> None:
        self.tokenizer = tokenizer
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        self.first = {blob[a:b].decode(): n for a, b, n in zip(starts.tolist(), ends.tolist(), lengths.tolist(), strict=True)}
        self.table = dict(self.first)

    def counts(self, texts: list[str | None]) -> list[int]:
        split = [self.tokenizer.pieces(t) if t else [] for t in texts]
        if len(self.table) > len(self.first) + CACHE:
            self.table = dict(self.first)
        known = self.table
        misses = list({p for pieces in split for p in pieces if p not in known})
        found = list(zip(misses, self.tokenizer.lengths(misses), strict=True))
        known.update((p, n) for p, n in found if len(p) <= LONGEST)
        get = ChainMap(known, {p: n for p, n in found if len(p) > LONGEST}).__getitem__ if any(len(p) > LONGEST for p in misses) else known.__getitem__
        return [sum(map(get, pieces)) for pieces in split]


def count_tokens(df: DataFrame, id_column: str, text_column: str, tokenizer_path: str, limit: int = 1024, frequent: int = FREQUENT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row."""
    spark: SparkSession = df.sparkSession
    ship(spark)
    texts = df.select(F.col(text_column).cast("string").alias("text"))
    top = [r.piece for r in frequent_pieces(texts, tokenizer_path, frequent).collect()]
    lengths = np.array(loaded(tokenizer_path).lengths(top), dtype=np.int64)
    encoded = [p.encode() for p in top]
    shared = spark.sparkContext.broadcast((b"".join(encoded), np.cumsum([len(e) for e in encoded], dtype=np.int64), lengths))

    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tier = held_latest("bpe", f"tiers/{key}", lambda: TwoTier(loaded(tokenizer_path), *shared.value))
        for batch in batches:
            for start, part in chunks(batch, "text"):
                tokens = tier.counts(part)
                ids = batch.column(0).slice(start, len(part))
                size = [len(t.encode()) if t else 0 for t in part]
                yield pa.RecordBatch.from_arrays([ids, pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())], names=["id", "n_bytes", "n_tokens", "over_limit"])

    kind = df.schema[id_column].dataType.simpleString()
    rows = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_column)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
