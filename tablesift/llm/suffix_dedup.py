"""Removal of long byte strings that an earlier document has too, by suffix arrays built with two-stage sorting.

Which text must be sorted together? Every string of LENGTH bytes has one anchor, the smallest hashed gram in it, and
equal strings have the same anchor at the same offset. Strings are therefore dealt by their anchor's hash:
1. each task lists its anchors' hashes (4 bytes each, once for each chunk of texts); hashes that occur in one
   document only drop out, the others go into a Bloom filter of fixed size, one slice for each bucket of hashes;
2. around each anchor in the filter, the stretch of text whose strings have that anchor goes to the bucket of the
   hash, with its place. Of equal stretches in a chunk only the earliest document's travel, the others are copies;
   hashes in many chunks are dealt once more, by the 15 bytes left or right of the anchor that the string contains;
3. each bucket sorts the suffixes of its distinct stretches in two stages, in shards of bounded size, compares
   neighbours, and takes runs of suffixes that share LENGTH bytes: all but those of the run's smallest document are
   removed;
4. the removed ranges meet their documents, merge and are cut out.
The hashes only choose what is sorted together; what is removed is decided on bytes.

Cases: a null text is empty; rows with a null id are kept whole and are no source; rows that share an id don't
remove each other's text, and rows that also share the text have the same result. Ids are integers; any other type
is a TypeError. Bytes are UTF-8, cut without regard to characters. A text of any length is read in overlapping pieces;
texts shorter than LENGTH lose nothing; an empty table gives no row. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm.common import chunks, held_latest, integer_id, ship, table
from tablesift.llm.shared_hashes import LISTED, Filters, bucket_count, bucket_of, listed, low_bits, slices
from tablesift.llm.two_stage import Strings

LENGTH = 50
GRAM = 20
_WINDOW = LENGTH - GRAM + 1
_HALF = (LENGTH - GRAM) // 2
CHUNK = 4 << 20
BLOCK = 1 << 18
#: Hashes found in so many chunks are dealt by more bytes.
HOT = (24,)
#: Stretches sorted in one shard; one hash is never split between shards.
SHARD = 4096
#: Hot stretches that a task remembers to have sent.
_SENT = 100_000

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * _P) ^ ((np.arange(1, 257, dtype=np.uint64) * _Q) >> np.uint64(23))
_PLACE = np.uint64((1 << 24) - 1)


def _joined(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    """Hashes of twofold grams from those of their halves."""
    n = min(len(a), len(b) - shift)
    x = (a[:n] * _Q) ^ (b[shift : shift + n] + np.uint64(shift))
    x *= _P
    x ^= x >> np.uint64(29)
    return x


class Anchors:
    """The anchors of a chunk's texts, each with the range of strings whose anchor it is; places count through the chunk."""

    def __init__(self, texts: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(sizes)
        self.begins = ends - sizes
        found = [np.zeros((4, 0), dtype=np.int64)]
        hashes = [np.zeros(0, dtype=np.uint64)]
        row = 0
        while row < len(texts):
            # a block of whole texts: the hashes of a position take some hundred bytes
            stop = max(row + 1, int(np.searchsorted(ends, self.begins[row] + BLOCK, side="right")))
            base = int(self.begins[row])
            first, last, at, own = _anchored(self.data[base : int(ends[stop - 1])], sizes[row:stop], hashes)
            found.append(np.stack([first + base, last + base, at + base, own + row]))
            row = stop
        self.first, self.last, self.at, self.row = np.concatenate(found, axis=1)
        self.hash = np.concatenate(hashes)


def _anchored(data: np.ndarray, sizes: np.ndarray, hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first string, last string, anchor, text) of each anchor in a block; their hashes are appended."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none, none
    ends = np.cumsum(sizes)
    starts = ends - sizes
    h1 = _BYTE[data]
    h2 = _joined(h1, h1, 1)
    h4 = _joined(h2, h2, 2)
    del h1, h2
    h8 = _joined(h4, h4, 4)
    gram = _joined(_joined(h8, h8, 8), h4, 16)
    del h4, h8
    least = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
    for width in (1, 2, 4, 8):
        least = np.minimum(least[:-width], least[width:])
    least = np.minimum(least[: -(_WINDOW - 16)], least[_WINDOW - 16 :])
    place = (least & _PLACE).astype(np.int32)
    # strings that lie within one text
    inside = np.zeros(len(place) + 1, dtype=np.int8)
    long = sizes >= LENGTH
    np.add.at(inside, starts[long], np.int8(1))
    np.add.at(inside, ends[long] - LENGTH + 1, np.int8(-1))
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    moved = place[1:] != place[:-1]
    edge = inside.copy()
    edge[1:] &= moved | ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= moved | ~inside[1:]
    first, last = np.flatnonzero(edge), np.flatnonzero(stop)
    at = place[first].astype(np.int64)
    hashes.append(gram[at])
    return first, last, at, np.searchsorted(ends, first, side="right")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """(ids, checks, offsets, pieces) by chunks: a text longer than a block is cut into pieces that overlap by LENGTH - 1."""
    for batch in batches:
        ids, checks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for start, part in chunks(batch, "text", CHUNK):
            rows, offsets, pieces = [], [], []
            for i, text in enumerate(part):
                raw = text.encode()
                for a in range(0, max(1, len(raw) - LENGTH + 1), BLOCK - LENGTH + 1):
                    rows.append(start + i)
                    offsets.append(a)
                    pieces.append(raw[a : a + BLOCK])
            yield ids[rows], checks[rows], np.array(offsets, dtype=np.int64), pieces


def _shared_hashes(texts: DataFrame, buckets: int) -> list[dict]:
    """The slices of the filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, _, pieces in _chunks(batches):
            anchors = Anchors(pieces)
            if len(anchors.hash):
                yield listed(anchors.hash, ids[anchors.row], buckets)

    return slices(texts.mapInArrow(run, LISTED), buckets, HOT)


_SPAN = [("doc", pa.int64()), ("check", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]
_SPANS = "doc long, check long, start long, stop long"


def _merge_runs(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges that touch merge; input sorted by row and start, stops of a row ascending."""
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] > stop[:-1])])
    at = np.flatnonzero(new)
    return row[at], start[at], stop[np.concatenate([at[1:], [len(row)]]) - 1]


def _stretches(texts: DataFrame, buckets: int, shared, key: str) -> DataFrame:
    """(bucket, kind, content): packed stretches of each chunk for a bucket, and (kind 1) ranges that are copies within the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = held_latest("suffix_dedup", f"filters/{key}", lambda: Filters(buckets, HOT, shared.value))
        number = 0
        sent_before: dict[bytes, int] = {}
        for ids, checks, offsets, pieces in _chunks(batches):
            number += 1
            anchors = Anchors(pieces)
            if not len(anchors.hash):
                continue
            bucket, low = bucket_of(anchors.hash, buckets), low_bits(anchors.hash)
            kept = np.flatnonzero(filters.has(0, bucket, low))
            if not len(kept):
                continue
            bucket, low = bucket[kept], low[kept]
            first, last, at, row, h = anchors.first[kept], anchors.last[kept], anchors.at[kept], anchors.row[kept], anchors.hash[kept]
            hot = filters.has(1, bucket, low)
            is_hot = hot
            if hot.any():
                # strings with 15 bytes or more left of the anchor are dealt by those, the others by 15 bytes right of it
                by_left, by_right = hot & (first <= at - _HALF), hot & (last > at - _HALF)
                side = np.concatenate([np.zeros(int((~hot).sum()), np.int64), np.ones(int(by_left.sum()), np.int64), np.full(int(by_right.sum()), 2)])
                order = np.concatenate([np.flatnonzero(~hot), np.flatnonzero(by_left), np.flatnonzero(by_right)])
                first = np.where(side == 2, np.maximum(first[order], at[order] - _HALF + 1), first[order])
                last = np.where(side == 1, np.minimum(last[order], at[order] - _HALF), last[order])
                at, row, h, is_hot = at[order], row[order], h[order].copy(), hot[order]
                for s, offset in ((1, -_HALF), (2, GRAM)):
                    mine = np.flatnonzero(side == s)
                    for k in range(_HALF):
                        h[mine] = (h[mine] ^ _BYTE[anchors.data[at[mine] + offset + k]]) * _Q + np.uint64(s)
                    h[mine] ^= h[mine] >> np.uint64(29)
                order = np.lexsort((first, row))
                first, last, row, h, is_hot = first[order], last[order], row[order], h[order], is_hot[order]
                bucket, low = bucket_of(h * _P, buckets), low_bits(h)
            size = last - first + LENGTH
            doc = ids[row]
            # equal stretches of the chunk: only the smallest document's travel
            blob = anchors.data.tobytes()
            strings = [blob[a : a + n] for a, n in zip(first.tolist(), size.tolist(), strict=True)]
            numbers: dict[bytes, int] = {}
            name = np.fromiter((numbers.setdefault(s, len(numbers)) for s in strings), dtype=np.int64, count=len(strings))
            strings_of = list(numbers)
            smallest = np.full(len(numbers), np.iinfo(np.int64).max)
            np.minimum.at(smallest, name, doc)
            # a hot stretch that this task has sent for a smaller document needn't travel again
            for i in np.unique(name[is_hot]).tolist() if is_hot.any() else ():
                text = strings_of[i]
                before = sent_before.get(text)
                if before is None or smallest[i] < before:
                    if len(sent_before) >= _SENT:
                        sent_before.clear()
                    sent_before[text] = int(smallest[i])
                else:
                    smallest[i] = before
            copy = doc > smallest[name]
            place = first - anchors.begins[row] + offsets[row]
            rows: list[tuple[int, int, bytes]] = []
            if copy.any():
                r, a, e = _merge_runs(row[copy], place[copy], (place + size)[copy])
                rows.append((int(number % buckets), 1, np.stack([ids[r], checks[r], a, e]).astype("<i8").tobytes()))
            sent = np.flatnonzero(~copy)
            sent = sent[np.argsort(bucket[sent], kind="stable")]
            own = bucket[sent]
            cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else own
            for a, e in zip(cut.tolist(), [*cut[1:].tolist(), len(own)], strict=False):
                part = sent[a:e]
                head = np.array([len(part)], dtype="<i8").tobytes()
                fixed = [doc[part].astype("<i8"), checks[row[part]].astype("<i8"), place[part].astype("<u4"), low[part].astype("<u4"), size[part].astype("u1")]
                rows.append((int(own[a]), 0, head + b"".join(x.tobytes() for x in fixed) + b"".join([strings[i] for i in part.tolist()])))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "content"])

    return texts.mapInArrow(run, "bucket long, kind int, content binary")


def _unpacked(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    n = int(np.frombuffer(content, dtype="<i8", count=1)[0])
    at, out = 8, []
    for kind, width in (("<i8", 8), ("<i8", 8), ("<u4", 4), ("<u4", 4), ("u1", 1)):
        out.append(np.frombuffer(content, dtype=kind, count=n, offset=at))
        at += width * n
    sizes = out.pop()
    ends = at + np.cumsum(sizes, dtype=np.int64)
    return *out, [content[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def covered(doc: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, start, stop): ranges of each entry that are strings of LENGTH bytes found in an entry of a smaller document."""
    numbers: dict[bytes, int] = {}
    name = np.fromiter((numbers.setdefault(s, len(numbers)) for s in strings), dtype=np.int64, count=len(strings))
    distinct = Strings(list(numbers))
    smallest = np.full(len(numbers), np.iinfo(np.int64).max)
    np.minimum.at(smallest, name, doc)
    order = distinct.suffix_array(LENGTH + 6)
    order = order[distinct.left[order] >= LENGTH]
    run = np.flatnonzero(distinct.common_prefixes(order) < LENGTH)
    least = np.full(len(distinct.left), np.iinfo(np.int64).max)
    if len(order):
        least[order] = np.repeat(np.minimum.reduceat(smallest[distinct.owner[order]], run), np.diff(np.concatenate([run, [len(order)]])))
    width = distinct.sizes - LENGTH + 1
    # all strings of all entries, entry by entry
    windows = width[name]
    entry = np.repeat(np.arange(len(strings)), windows)
    offset = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    found = least[distinct.starts[name][entry] + offset] < doc[entry]
    entry, offset = entry[found], offset[found]
    if not len(entry):
        return entry, offset, offset
    return _merge_runs(entry, offset, offset + LENGTH)


def _removed(stretches: DataFrame) -> DataFrame:
    """Ranges to remove, found by the suffix arrays of each bucket."""

    def out(doc: np.ndarray, check: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (doc, check, start, stop)], names=[n for n, _ in _SPAN])

    def solved(parts: list) -> Iterator[pa.RecordBatch]:
        doc, check, place, low = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(4))
        strings = [s for p in parts for s in p[4]]
        order = np.argsort(low, kind="stable")
        low = low[order]
        groups = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        begin = 0
        for end in [*groups[1:].tolist(), len(low)]:
            # whole groups up to the shard's size
            following = groups[min(np.searchsorted(groups, end, side="right"), len(groups) - 1)]
            if end < len(low) and max(following, end) - begin <= SHARD:
                continue
            rows = order[begin:end]
            begin = end
            if doc[rows].min() < doc[rows].max():
                entry, start, stop = covered(doc[rows], [strings[i] for i in rows.tolist()])
                if len(entry):
                    own = rows[entry]
                    yield out(doc[own], check[own], place[own] + start, place[own] + stop)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts = None, []
        for batch in batches:
            for bucket, kind, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if kind:
                    yield out(*np.frombuffer(content.as_buffer(), dtype="<i8").reshape(4, -1))
                    continue
                if bucket != current:
                    if parts:
                        yield from solved(parts)
                    current, parts = bucket, []
                parts.append(_unpacked(content.as_py()))
        if parts:
            yield from solved(parts)

    return stretches.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _SPANS)


def repeated_ranges(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc, check, start, stop): byte ranges to remove; a document is its id and a 64-bit hash of its text. Ranges may overlap."""
    spark: SparkSession = df.sparkSession
    ship(spark)
    integer_id(df, id_column)
    buckets = bucket_count(spark)
    text = F.col(text_column).cast("string")
    texts = df.select(F.col(id_column).cast("long").alias("doc"), F.xxhash64(text).alias("check"), text.alias("text")).filter(F.col("doc").isNotNull() & (F.octet_length("text") >= LENGTH))
    shared = spark.sparkContext.broadcast(_shared_hashes(texts, buckets))
    return _removed(_stretches(texts, buckets, shared, uuid.uuid4().hex))


def remove_repeats(df: DataFrame, id_column: str, text_column: str, with_kept: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) and, with_kept, the remaining bytes."""
    ranges = repeated_ranges(df, id_column, text_column).groupBy("doc", "check").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    text = F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.col(id_column).alias("id"), text.alias("text")).withColumns({"doc": F.col("id").cast("long"), "check": F.xxhash64(F.col("text").cast("string"))})
    found = rows.join(ranges.hint("shuffle_hash"), ["doc", "check"], "left").select("id", "text", F.col("ranges.start").alias("starts"), F.col("ranges.stop").alias("stops"))
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, starts, stops in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                raw = memoryview(text.as_buffer())
                kept, at, spans = hashlib.sha256(), 0, 0
                parts = []
                if starts.is_valid:
                    a, e = np.asarray(starts.values), np.asarray(stops.values)
                    order = np.argsort(a, kind="stable")
                    a, e = a[order], np.maximum.accumulate(e[order])
                    _, a, e = _merge_runs(np.zeros(len(a), dtype=np.int8), a, e)
                    spans = len(a)
                    for x, y in zip(a.tolist(), e.tolist(), strict=True):
                        parts.append(raw[at:x])
                        at = y
                parts.append(raw[at:])
                for part in parts:
                    kept.update(part)
                left = sum(map(len, parts))
                rows.append((len(raw), len(raw) - left, spans, kept.hexdigest(), b"".join(parts) if with_kept else b""))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * with_kept
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=names)

    schema = f"id {df.schema[id_column].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    return found.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")
