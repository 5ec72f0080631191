"""Exact top-k inner products by no-random-access aggregation (NRA).

Vectors are dealt to shards and queries to blocks, both by hashes of their ids; each pair of a shard and a block is a
cell that one task works on, its queries sorted before its vectors, so nothing is collected or broadcast. In a cell the
vectors lie as one sorted list per dimension. For a query, a list is read from the end that its weight favours; after
reading to some depth, a vector's score lies between a lower bound (unread components at the list's far end) and an
upper bound (unread components at the last value read). Bounds of all queries at a depth are two matrix products.
Vectors whose upper bound is below the query's k-th lower bound can't qualify and drop out; reading goes on until at
most k candidates are left or the lists end, and only these get their exact integer scores.

The cells of the first shard go first. The k-th score that a query has there is its bar: other shards pass by what
stays below it. Cells' results meet in a small ranked merge.

Cases: vectors that are null, hold a null or a non-finite component, or have a null id take no part; empty vectors
have score 0 with each other. Only vectors of the query's length are compared. A query's own id is no candidate; other
rows that repeat are candidates each, and a query id that repeats counts once, with its smallest vector. Ties go to the
smaller id. Ids are integers; any other type is a TypeError. Sums beyond 64 bits are cut to the largest or smallest 64-bit
integer. An empty table gives no row. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesift.llm.common import integer_id, ship, staged, table

K = 5
EVERY = 50
SCALE = 256
QUERY_BLOCK = 4096
#: Numbers in the vectors of a shard, and rows that a shard is worth while there are tasks to spare.
SHARD, LEAST_SHARD = 1 << 21, 1024
#: Depths at which bounds are compared, as shares of the lists; at the last all is read and bounds are scores.
DEPTHS = (0.25, 0.5, 0.75, 0.875, 1.0)
#: Components beyond this are scored with Python's integers.
_SAFE = 1 << 25


def _candidates(rows: np.ndarray, lower: np.ndarray, upper: np.ndarray, k: int, bar: float, slack: float) -> np.ndarray:
    """The rows whose upper bound reaches the k-th lower bound and the bar."""
    return rows[upper >= max(np.partition(lower, len(rows) - k)[len(rows) - k], bar) - slack]


class SortedLists:
    """One ascending list per dimension over the vectors of a shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        order = np.argsort(vectors, axis=0, kind="stable")
        self.sorted = np.take_along_axis(vectors, order, axis=0)
        self.place = np.empty(order.shape, dtype=np.int32)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=np.int32)[:, None], axis=0)

    def _bounds(self, up: np.ndarray, down: np.ndarray, depth: int, rows: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (queries x vectors) after `depth` reads of each list."""
        n = len(self.ids)
        x, place = (self.vectors, self.place) if rows is None else (self.vectors[rows], self.place[rows])
        kind = up.dtype
        x = x.astype(kind)
        read_up, read_down = place >= n - depth, place < depth
        least, most = self.sorted[0].astype(kind), self.sorted[-1].astype(kind)
        last_up, last_down = self.sorted[n - depth].astype(kind), self.sorted[depth - 1].astype(kind)
        lower = up @ np.where(read_up, x, least).T + down @ np.where(read_down, x, most).T
        upper = up @ np.where(read_up, x, last_up).T + down @ np.where(read_down, x, last_down).T
        return lower, upper

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, bars: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query row, ids, scores) of the k best vectors of this shard; those below the query's bar may be left out."""
        n, dims = self.vectors.shape
        if bars is None:
            bars = np.full(len(queries), -np.inf)
        if max(np.abs(self.vectors).max(initial=0), np.abs(queries).max(initial=0)) >= _SAFE:
            whole, queries = self.vectors.astype(object), queries.astype(object)
            for q in range(len(queries)):
                yield q, *self._ranked(np.arange(n), np.clip(whole @ queries[q], -(2**63), 2**63 - 1).astype(np.int64), query_ids[q], k)
            return
        largest = int(np.abs(self.vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(dims, 1)
        kind = np.float32 if largest < 1 << 24 else np.float64
        # beyond 2^53 sums are rounded, and bounds that are nearly equal don't decide
        slack = largest * 2.0**-40 if largest >= 1 << 53 else 0.0
        up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
        step = max(1, (16 << 20) // max(n, 1) // 8)
        for a in range(0, len(queries), step):
            yield from self._block(range(a, min(len(queries), a + step)), query_ids, queries, bars, up, down, k, slack)

    def _block(self, block: range, query_ids: np.ndarray, queries: np.ndarray, bars: np.ndarray, up: np.ndarray, down: np.ndarray, k: int, slack: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        n = len(self.ids)
        left = {q: np.flatnonzero(self.ids != query_ids[q]) for q in block}
        for share in DEPTHS:
            depth = max(1, int(n * share))
            wide = [q for q in block if len(left[q]) > max(k, n // 8)]
            if wide:
                lower, upper = self._bounds(up[wide], down[wide], depth, None)
                for i, q in enumerate(wide):
                    left[q] = _candidates(left[q], lower[i, left[q]], upper[i, left[q]], k, bars[q], slack)
            for q in set(block).difference(wide):
                if len(left[q]) > k:
                    lower, upper = self._bounds(up[[q]], down[[q]], depth, left[q])
                    left[q] = _candidates(left[q], lower[0], upper[0], k, bars[q], slack)
        for q in block:
            yield q, *self._ranked(left[q], self.vectors[left[q]] @ queries[q], query_ids[q], k)

    def _ranked(self, rows: np.ndarray, scores: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        others = self.ids[rows] != query_id
        ids, scores = self.ids[rows][others], scores[others]
        first = np.lexsort((ids, -scores.astype(object) if scores.min(initial=0) == -(2**63) else -scores))[:k]
        return ids[first], scores[first]


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, components times SCALE, floored, rows) for each vector length in a batch of a cell's rows."""
    ids, vectors = batch.column(3).to_numpy(), batch.column(4)
    flat = np.asarray(vectors.flatten())
    sizes = np.asarray(vectors.value_lengths())
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        scaled = np.floor(flat[(starts[rows][:, None] + np.arange(size))].astype(np.float64) * SCALE)
        small = np.abs(scaled).max(initial=0) < 2**62
        yield ids[rows], scaled.astype(np.int64) if small else np.array([[int(x) for x in r] for r in scaled.tolist()], dtype=object), rows


def _cells(rows: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): what each cell finds; rows: shard, block, kind (0 query, 1 vector), id, v, bar."""

    def found(queries: list, vectors: list) -> Iterator[pa.RecordBatch]:
        for dims in {m.shape[1] for _, m, _ in queries} & {m.shape[1] for _, m in vectors}:
            own = [x for x in queries if x[1].shape[1] == dims]
            query_ids, wanted, bars = (np.concatenate([x[i] for x in own]) for i in range(3))
            lists = SortedLists(*(np.concatenate([x[i] for x in vectors if x[1].shape[1] == dims]) for i in range(2)))
            for q, ids, scores in lists.best(query_ids, wanted, k, bars):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), query_ids[q]), pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, queries, vectors = None, [], []
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(2)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, e in zip(cuts, cuts[1:], strict=False):
                if a == e:
                    continue
                if tuple(keys[a]) != cell:
                    yield from found(queries, vectors)
                    cell, queries, vectors = tuple(keys[a]), [], []
                part = batch.slice(a, e - a)
                kind = part.column(2).to_numpy()
                split = int(np.searchsorted(kind, 1))
                bars = np.asarray(part.column(5).fill_null(-np.inf))
                queries += [(ids, m, bars[:split][at]) for ids, m, at in _matrices(part.slice(0, split))]
                vectors += [(ids, m) for ids, m, _ in _matrices(part.slice(split))]
        yield from found(queries, vectors)

    return rows.repartition("shard", "block").sortWithinPartitions("shard", "block", "kind").mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(df: DataFrame, id_column: str, vector_column: str, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for each row whose id is divisible by `every`."""
    spark: SparkSession = df.sparkSession
    ship(spark)
    integer_id(df, id_column)
    sound = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull() & sound)
    size = vectors.agg(F.count("*").alias("n"), F.sum(F.size("v") + 1).alias("numbers"), F.count(F.when(F.col("id") % every == 0, 1)).alias("queries")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(-(-(size["numbers"] or 0) // SHARD), min(parts, -(-size["n"] // LEAST_SHARD)), 1)
    blocks = max(1, -(-size["queries"] // QUERY_BLOCK))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64(F.lit(8), "id"), F.lit(blocks)).cast("int")
    queries = staged(vectors.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v")).withColumn("block", block), "queries")
    meant = vectors.select(shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "v", F.lit(None).cast("double").alias("bar"))

    def asked(own: DataFrame, first: int, last: int) -> DataFrame:
        rows = own.select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("shard"), "block", F.lit(0).alias("kind"), "id", "v", "bar")
        return rows.unionByName(meant.filter(F.col("shard").between(first, last)))

    best = staged(_cells(asked(queries.withColumn("bar", F.lit(None).cast("double")), 0, 0), k), "first_shard")
    if shards > 1:
        kth = best.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k)
        # a double may round a score up; the one below never does
        barred = queries.join(kth, "id", "left").withColumn("bar", F.col("least").cast("double") - F.abs("least") * 2.0**-50)
        best = best.unionByName(_cells(asked(barred, 1, shards - 1), k))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
