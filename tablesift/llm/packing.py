"""Mixture-controlled packing: deficit round-robin over source queues.

Each source is a queue of its documents in table order. In every window of `window` tokens a source is granted its
target share; a document is served in the first window in which the granted tokens cover it, and what is granted but
not yet used is the source's deficit, carried to the next window. Since a queue never runs dry before its end, the
window in which a document is served follows from its place in the queue alone: ceil(tokens up to its end / quantum).
So the queues are prefix sums (carried from partition to partition by per-partition totals), and no task walks a
whole source. Windows follow each other in one stream of tokens, cut into sequences; only the last one needs padding.

Cases: a null text is empty and still has its end token; a null source is a queue of its own; repeated rows and ids
(of any type, null too) are packed as rows of their own; a text of any length is one document, cut by sequences; an
empty table gives no piece. Sources that a given mixture doesn't name, or gives a share of 0, are spread evenly over
the windows that the others need. Without a mixture each source's target is its own share of all tokens. Extra columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesift.llm.bpe import loaded
from tablesift.llm.common import chunks, ship, staged, table

LENGTH = 2048
#: Tokens in a window of the mixture: 32 sequences.
WINDOW = 32 * LENGTH
END_ID = 1
#: Windows that share one partial sum; keeps the last prefix sum to one row per 4096 windows.
_GROUP = 4096
#: Documents of a queue and file split that share one partial sum.
_BLOCK = 512


def tokenized(df: DataFrame, id_column: str, text_column: str, source_column: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """(part, idx, id, queue, n_tokens, ids): the ids of every whole text with the end id, as bytes of unsigned integers."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(tokenizer_path)
        wide = array(tokenizer.wide).itemsize
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start, texts in chunks(batch, "text", 4 << 20):
                ids = [tokenizer.packed(t or "", end_id) for t in texts]
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64()), batch.column(0).slice(start, n), batch.column(1).slice(start, n), pa.array([len(i) // wide for i in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["part", "idx", "id", "queue", "n_tokens", "ids"],
                )
                at += n

    kind = df.schema[id_column].dataType.simpleString()
    queue = F.coalesce(F.concat(F.lit("="), F.col(source_column).cast("string")), F.lit("-"))
    rows = df.select(F.col(id_column).alias("id"), queue.alias("queue"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"part int, idx long, id {kind}, queue string, n_tokens long, ids binary")


def round_robin(lengths: DataFrame, window: int = WINDOW, mixture: Mapping[str, float] | None = None) -> DataFrame:
    """(part, idx, window, at): the window that serves each document and its first token's place in the stream.

    lengths: part, idx, queue, n_tokens. mixture: target share of each source; without one, its share of all tokens.
    """
    blocks = lengths.withColumn("block", F.expr(f"idx div {_BLOCK}"))
    per_block = blocks.groupBy("queue", "part", "block").agg(F.sum("n_tokens").alias("tokens"))
    in_part = per_block.select("queue", "part", "block", (F.sum("tokens").over(Window.partitionBy("queue", "part").orderBy("block")) - F.col("tokens")).alias("passed"))
    per_part = per_block.groupBy("queue", "part").agg(F.sum("tokens").alias("tokens"))
    carried = per_part.withColumn("before", F.sum("tokens").over(Window.partitionBy("queue").orderBy("part")) - F.col("tokens"))
    totals = per_part.groupBy("queue").agg(F.sum("tokens").alias("queue_tokens"))
    everything = totals.agg(F.sum("queue_tokens").alias("n")).first()["n"] or 1
    if mixture is None:
        quantum = F.col("queue_tokens") * F.lit(float(window)) / F.lit(float(everything))
    else:
        whole = float(sum(mixture.values())) or 1.0
        quantum = F.lit(0.0)
        for source, share in sorted(mixture.items()):
            quantum = F.when(F.col("queue") == f"={source}", F.lit(window * share / whole)).otherwise(quantum)
    wanted = totals.withColumn("quantum", quantum)
    needed = wanted.agg(F.max(F.when(F.col("quantum") > 0, F.ceil(F.col("queue_tokens") / F.col("quantum")))).alias("n")).first()["n"]
    windows = int(needed or max(1, everything // window))
    quanta = wanted.select("queue", F.when(F.col("quantum") > 0, F.col("quantum")).otherwise(F.col("queue_tokens") / F.lit(float(windows))).alias("quantum"))
    local = Window.partitionBy("queue", "part", "block").orderBy("idx")
    placed = (
        blocks.withColumn("so_far", F.sum("n_tokens").over(local))
        .join(in_part, ["queue", "part", "block"])
        .join(carried.select("queue", "part", "before"), ["queue", "part"])
        .join(quanta, "queue")
        .withColumn("window", (F.ceil((F.col("before") + F.col("passed") + F.col("so_far")) / F.col("quantum")) - 1).cast("long"))
        .withColumn("group", F.expr(f"window div {_GROUP}"))
        .drop("block")
    )
    per_window = placed.groupBy("group", "window").agg(F.sum("n_tokens").alias("tokens"))
    per_group = per_window.groupBy("group").agg(F.sum("tokens").alias("tokens"))
    group_at = per_group.select("group", (F.sum("tokens").over(Window.orderBy("group")) - F.col("tokens")).alias("group_at"))
    window_at = per_window.select("group", "window", (F.sum("tokens").over(Window.partitionBy("group").orderBy("window")) - F.col("tokens")).alias("window_at"))
    within = Window.partitionBy("window").orderBy("queue", "part", "idx")
    return (
        placed.withColumn("in_window", F.sum("n_tokens").over(within) - F.col("n_tokens"))
        .join(window_at.drop("group"), "window")
        .join(group_at, "group")
        .select("part", "idx", "window", (F.col("group_at") + F.col("window_at") + F.col("in_window")).alias("at"))
    )


def pack(df: DataFrame, id_column: str, text_column: str, source_column: str, tokenizer_path: str, length: int = LENGTH, window: int = WINDOW, mixture: Mapping[str, float] | None = None, with_ids: bool = True) -> DataFrame:
    """One row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window and (with_ids) its ids as unsigned 32-bit bytes.

    The tokenised rows are written once to the shared folder: the plan needs their lengths, the cut their ids.
    """
    tokens = staged(tokenized(df, id_column, text_column, source_column, tokenizer_path), "packing")
    kind = "<u2" if loaded(tokenizer_path).wide == "H" else "<u4"
    plan = round_robin(tokens.select("part", "idx", "queue", "n_tokens"), window, mixture)
    rows = tokens.select("part", "idx", "id", "n_tokens", "ids").join(plan.hint("shuffle_hash"), ["part", "idx"]).select("id", "n_tokens", "window", "at", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window"] + ["ids"] * with_ids
        for batch in batches:
            if not batch.num_rows:
                continue
            n, at = batch.column(1).to_numpy(), batch.column(3).to_numpy()
            first, last = at // length, (at + n - 1) // length
            pieces = last - first + 1
            row = np.repeat(np.arange(len(n)), pieces)
            sequence = np.repeat(first, pieces) + np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = np.maximum(sequence * length, at[row])
            stop = np.minimum((sequence + 1) * length, (at + n)[row])
            start, size = begin - at[row], stop - begin
            raw, crcs, kept = None, [], []
            for k, (r, a, m) in enumerate(zip(row.tolist(), start.tolist(), size.tolist(), strict=True)):
                if a == 0 or k == 0:
                    raw = np.frombuffer(batch.column(4)[r].as_buffer(), dtype=kind)
                ids = raw[a : a + m].astype("<u4").tobytes()
                crcs.append(zlib.crc32(ids))
                if with_ids:
                    kept.append(ids)
            columns = [batch.column(0).take(pa.array(row)), pa.array(start), pa.array(size), pa.array(crcs, pa.int64()), pa.array(n[row]), pa.array(sequence), pa.array(begin - sequence * length), batch.column(2).take(pa.array(row))]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_ids, names=names)

    schema = f"id {df.schema[id_column].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window long"
    return rows.mapInArrow(run, schema + ", ids binary" * with_ids).withColumnRenamed("id", id_column)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), "doc_id", "text", "source", public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
