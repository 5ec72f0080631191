"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesift.llm.common import release, salted, staged

#: A graph of no more edges (8 MB) is solved by one task.
SMALL = 500_000
#: Edges of which a task makes a forest at a time.
_FOREST = 1_000_000


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of an edge (a, b) and the smallest node that it reaches; a staged table.

    Every task first replaces its edges by a forest of stars, so that hubs and long paths within it are gone; a graph of
    at most SMALL edges is one task and done. Otherwise minima are taken by aggregates with map-side combine and joined
    back with hot nodes dealt over several tasks. Each round is written to the shared folder, the one before deleted.
    """
    now = staged(_oriented(edges.select("a", "b")), "edges")
    if now.count() <= SMALL:
        return _finished(now, now.coalesce(1).mapInArrow(_forest, "a long, b long"))
    stars = staged(now.mapInArrow(_forest, "a long, b long"), "edges")
    release(now)
    now, state = stars, None
    while True:
        both = staged(now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("root"))
        # large star: every greater neighbour is tied to the least of the neighbourhood
        large = staged(_oriented(salted(both, least, ["a"], "b").filter("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))), "large")
        release(both, now)
        # small star: a node and its smaller neighbours are tied to the least of them
        smallest = large.groupBy("a").agg(F.min("b").alias("root"))
        small = salted(large, smallest, ["a"], "b").select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(smallest.select("a", F.col("root").alias("b")))
        now = staged(_oriented(small), "edges")
        release(large)
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state:
            return _finished(now, now)
        state = found


def _finished(now: DataFrame, stars: DataFrame) -> DataFrame:
    """The table of stars (a, b) with each b as its own root."""
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    out = staged(stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots), "roots")
    release(now)
    return out


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars (a, b) with the same components, b the smallest node of each; of at most _FOREST edges at a time."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def stars() -> pa.RecordBatch:
        pairs = [(n, root(n)) for n in parent]
        pairs = [(a, b) for a, b in pairs if a != b]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
        if len(parent) > _FOREST:
            yield stars()
    yield stars()


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the greater to the smaller node."""
    return edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
