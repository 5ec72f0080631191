"""Which hashes occur in more than one document? Bloom filters sized by the corpus, built without a row for each hash.

Tasks list the hashes of each chunk of texts once, as sorted 32-bit values in a bucket that the upper bits choose.
Each bucket is merged in one place, and hashes that several documents have become one slice of a filter; those that
occur in many chunks also enter the filters of hot hashes. A slice has BITS_EACH bits for each of its hashes, up to its
share of MOST_BITS; beyond that it is fuller. A hash that a filter wrongly names only costs work.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bits for each hash of a slice; bits of a filter over all buckets, the bound of what is collected and broadcast (96 MB for three filters).
BITS_EACH, MOST_BITS = 10, 1 << 28

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def bucket_count(spark: SparkSession) -> int:
    """Buckets for the session's size: four for each shuffle partition."""
    return max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def low_bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _probes(low: np.ndarray, bits: int | np.ndarray) -> Iterator[np.ndarray]:
    x = low.astype(np.uint64) * _P
    for shift in (0, 17, 31):
        yield (((x >> np.uint64(shift)) * _Q >> np.uint64(20)) % np.asarray(bits, dtype=np.uint64)).astype(np.int64)


def _slice(low: np.ndarray, buckets: int) -> bytes:
    bits = min(max(64, BITS_EACH * len(low)), MOST_BITS // buckets) // 8 * 8
    out = np.zeros(bits, dtype=np.uint8)
    for at in _probes(low, bits):
        out[at] = 1
    return np.packbits(out, bitorder="little").tobytes()


class Filters:
    """The collected slices: filter 0 knows hashes of several documents, filter i the i-th kind of hot ones."""

    def __init__(self, buckets: int, hot: Sequence[int], slices: list[dict]) -> None:
        empty = bytes(8)
        parts = [[empty] * buckets for _ in range(1 + len(hot))]
        for r in slices:
            for k, content in enumerate(r["filters"]):
                parts[k][r["bucket"]] = content
        self.sizes = [np.array([len(x) for x in p], dtype=np.int64) for p in parts]
        self.starts = [np.cumsum(s) - s for s in self.sizes]
        self.tables = [np.frombuffer(b"".join(p), dtype=np.uint8) for p in parts]

    def has(self, which: int, bucket: np.ndarray, low: np.ndarray) -> np.ndarray:
        found = np.ones(len(low), dtype=bool)
        start, bits = self.starts[which][bucket], (8 * self.sizes[which][bucket]).astype(np.uint64)
        for at in _probes(low, bits):
            found &= (self.tables[which][start + (at >> 3)] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return found


def listed(hashes: np.ndarray, doc: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The rows of one chunk: (bucket, hashes, several), the latter those that documents of the chunk share."""
    key = bucket_of(hashes, buckets) << 32 | low_bits(hashes)
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    several = np.minimum.reduceat(doc, start) < np.maximum.reduceat(doc, start)
    key = key[start]
    bucket, low = key >> 32, (key & 0xFFFFFFFF).astype("<u4")
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    spans = list(zip(cut.tolist(), [*cut[1:].tolist(), len(bucket)], strict=True))
    columns = [pa.array(bucket[cut], pa.int64()), pa.array([low[a:e].tobytes() for a, e in spans], pa.binary()), pa.array([low[a:e][several[a:e]].tobytes() for a, e in spans], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "hashes", "several"])


LISTED = "bucket long, hashes binary, several binary"


def slices(rows: DataFrame, buckets: int, hot: Sequence[int]) -> list[dict]:
    """The filter slices of listed rows; hot: for each filter of hot hashes, in how many chunks they are found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        for batch in batches:
            for i, bucket in enumerate(batch.column(0).to_pylist()):
                own = held.setdefault(bucket, ([], []))
                for k in (0, 1):
                    own[k].append(np.frombuffer(batch.column(1 + k)[i].as_buffer(), dtype="<u4"))
        while held:
            bucket, (hashes, several) = held.popitem()
            low, count = np.unique(np.concatenate(hashes), return_counts=True)
            shared = np.union1d(low[count > 1], np.concatenate(several))
            if len(shared):
                filters = [_slice(x, buckets) for x in (shared, *[low[count >= n] for n in hot])]
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([filters], pa.list_(pa.binary()))], names=["bucket", "filters"])

    return [r.asDict() for r in rows.repartition("bucket").mapInArrow(run, "bucket long, filters array<binary>").collect()]
