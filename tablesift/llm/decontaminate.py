"""Benchmark decontamination by an FM-index for each training shard.

A shard is what one task holds at a time (about `shard_bytes` of texts). Its words are mapped to the words of the
benchmark; a word outside that vocabulary can't be part of a phrase and ends a run, and runs shorter than the
shortest phrase are left out, so the index holds just the text that phrases can match. The phrases (all windows of
the benchmark items) are searched backwards through wavelet ranks, occurrences are located by sampled suffix
positions, and their word ranges merge into removal spans. The benchmark streams through the driver once and is
broadcast in blocks of bounded size; a task searches its shard for one block after the other and keeps the phrases of
the latest only. Documents are never shuffled.

Cases: a null text has no words, spans or items. A text longer than a shard is a shard of its own. Items with a null
id or text, or no words, give no phrase. An item id that repeats stands for all its texts. Repeated documents each get
their own row, ids of any type and null ids stay as they are. An empty benchmark leaves all documents clean, an empty
table gives no row. Extra columns are ignored by `find_contamination` (with keep they stand before its own, and one
that has the name of these makes a second column of it) and kept by `remove_contamination`, whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm.common import chunks, fresh, held_latest, ship, table
from tablesift.llm.fm_index import FMIndex

WINDOW = 10
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 8 << 20

#: Lower-cases A-Z and turns every byte that isn't in a word into a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD_BEFORE_LOWERING = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


class Phrases:
    """The phrases of one block of items."""

    def __init__(self, items: list[tuple[object, str]], window: int) -> None:
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], list[int]] = {}
        self.items: list[str] = []
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            if not ids:
                continue
            self.items.append(str(item))
            for at in range(max(1, len(ids) - window + 1)):
                owners.setdefault(tuple(ids[at : at + window]), []).append(len(self.items) - 1)
        self.lengths = np.array([len(p) for p in owners], dtype=np.int64)
        self.symbols = np.zeros((len(owners), window), dtype=np.int64)
        for row, phrase in enumerate(owners):
            self.symbols[row, window - len(phrase) :] = phrase
        self.owner_ends = np.cumsum([len(set(o)) for o in owners.values()], dtype=np.int64)
        self.owners = np.array([i for o in owners.values() for i in sorted(set(o))], dtype=np.int64)
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0

    def hits(self, docs: list[list[bytes]], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first word, words, phrase) of every occurrence; words number through the shard."""
        none = np.zeros(0, dtype=np.int64)
        if not len(self.lengths):
            return none, none, none
        total = int(ends[-1]) if len(ends) else 0
        symbols = np.empty(total, dtype=np.int32)
        at = 0
        for doc in docs:
            symbols[at : at + len(doc)] = np.fromiter(map(self.vocabulary.get, doc, repeat(0)), dtype=np.int32, count=len(doc))
            at += len(doc)
        stop = symbols == 0
        # runs end at foreign words and at the ends of documents
        opens = ~stop
        begins = opens.copy()
        begins[1:] &= stop[:-1]
        starts_of_docs = ends[:-1][ends[:-1] < total]
        begins[starts_of_docs] = opens[starts_of_docs]
        starts = np.flatnonzero(begins)
        closes = opens.copy()
        closes[:-1] &= stop[1:]
        last_of_docs = ends[(ends > 0)] - 1
        closes[last_of_docs] = opens[last_of_docs]
        sizes = np.flatnonzero(closes) + 1 - starts
        long = sizes >= self.shortest
        starts, sizes = starts[long], sizes[long]
        if not len(starts):
            return none, none, none
        # lay the runs out one after the other, each followed by a terminator
        lengths = sizes + 1
        offsets = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(offsets - starts, lengths)
        text = symbols[np.minimum(place, total - 1)].astype(np.int64)
        text[offsets + sizes] = 0
        index = FMIndex(text, len(self.vocabulary))
        low, high = index.search(self.symbols, self.lengths)
        counts = high - low
        phrase = np.repeat(np.arange(len(counts)), counts)
        rows = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts - low, counts)
        return place[index.locate(rows)], self.lengths[phrase], phrase


def _phrases(key: str, block: int, shared, window: int) -> Phrases:
    """The phrases of one block; a worker keeps the latest only."""

    def build() -> Phrases:
        phrases = Phrases(shared.value, window)
        shared.__dict__.pop("_value", None)  # the list itself is read again from the worker's disk when wanted
        return phrases

    return held_latest("decontaminate", f"block/{key}/{block}", build)


def _benchmark_blocks(benchmark: DataFrame, id_column: str, text_column: str) -> list:
    """Broadcasts of at most about BLOCK_BYTES each, or of one longer item; an item's texts may lie in several."""
    context = benchmark.sparkSession.sparkContext
    items = benchmark.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).cast("string").alias("text")).dropna()
    out, block, size = [], [], 0
    for r in items.toLocalIterator():
        block.append((r["item"], r["text"]))
        size += len(r["text"])
        if size >= BLOCK_BYTES:
            out.append(context.broadcast(block))
            block, size = [], 0
    return [*out, context.broadcast(block)] if block else out


def find_contamination(df: DataFrame, id_column: str, text_column: str, benchmark: DataFrame, item_column: str, item_text: str, window: int = WINDOW, keep: bool = False) -> DataFrame:
    """For each document: n_words, n_hit, items (array of ids as strings, sorted), spans (array of byte ranges to remove).

    With keep, the columns of the document stand before these.
    """
    spark: SparkSession = df.sparkSession
    ship(spark)
    blocks = _benchmark_blocks(benchmark, item_column, item_text)
    key = uuid.uuid4().hex
    found = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]

    def shard(texts: list[str | None]) -> list[pa.Array]:
        docs = [words(t) for t in texts]
        sizes = np.array([len(d) for d in docs], dtype=np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        total = int(ends[-1]) if len(ends) else 0
        edge = np.zeros(total + 1, dtype=np.int64)
        items: list[set[str]] = [set() for _ in docs]
        for number, shared in enumerate(blocks):
            phrases = _phrases(key, number, shared, window)
            first, length, phrase = phrases.hits(docs, ends)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + length, -1)
            if len(first):
                doc = np.searchsorted(ends, first, side="right")
                for pair in np.unique(doc * len(phrases.lengths) + phrase).tolist():
                    row, p = divmod(pair, len(phrases.lengths))
                    begin = int(phrases.owner_ends[p - 1]) if p else 0
                    items[row].update(phrases.items[i] for i in phrases.owners[begin : int(phrases.owner_ends[p])].tolist())
        hit = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
        n_hit = hit[ends] - hit[starts] if len(ends) else sizes
        spans: list[list[dict[str, int]]] = []
        for row, text in enumerate(texts):
            ranges = []
            if n_hit[row]:
                flags = np.diff(hit[starts[row] : ends[row] + 1]).astype(bool)
                change = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
                places = [m.span() for m in _WORD_BEFORE_LOWERING.finditer(text.encode())]
                ranges = [{"start": places[a][0], "stop": places[b - 1][1]} for a, b in zip(change[::2].tolist(), change[1::2].tolist(), strict=True)]
            spans.append(ranges)
        return [pa.array(sizes), pa.array(n_hit.astype(np.int64)), pa.array([sorted(i) for i in items], found[2][1]), pa.array(spans, found[3][1])]

    columns = df.columns if keep else [id_column]
    whole = fresh([*columns, *(n for n, _ in found)], "whole_text")
    rows = df.select(*[F.col(c) for c in columns], F.col(text_column).cast("string").alias(whole))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in chunks(batch, whole, SHARD_BYTES):
                own = [batch.column(i).slice(start, len(texts)) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays(own + shard(texts), names=columns + [n for n, _ in found])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(run, schema + ", n_words long, n_hit long, items array<string>, spans array<struct<start:long,stop:long>>")


def remove_contamination(df: DataFrame, text_column: str, benchmark: DataFrame, item_column: str, item_text: str, window: int = WINDOW) -> DataFrame:
    """The documents with all removal spans cut out; one that loses all its words goes. Clean documents stay as they are."""
    columns = df.columns
    clash = {c: f"own_{i}" for i, c in enumerate(columns)}
    found = find_contamination(df.select(*[F.col(c).alias(clash[c]) for c in columns]), clash[columns[0]], clash[text_column], benchmark, item_column, item_text, window, keep=True)
    raw = F.col(clash[text_column]).cast("binary")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s["stop"]))
    stops = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.octet_length(clash[text_column]).cast("long")))
    pieces = F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda p: F.substring(raw, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")))
    cut = F.decode(F.aggregate(pieces, F.lit(b""), lambda x, y: F.concat(x, y)), "UTF-8")
    kept = found.filter((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words")))
    text = F.when(F.col("n_hit") > 0, cut).otherwise(F.col(clash[text_column]))
    return kept.select(*[(text if c == text_column else F.col(clash[c])).alias(c) for c in columns])


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (SELECT DISTINCT item, least({WINDOW}, len(w)) AS n, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - {WINDOW} + 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win))),
hit AS (SELECT doc_id, i, n, item FROM dw JOIN win USING (n, g)),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN it USING (doc_id)
"""
