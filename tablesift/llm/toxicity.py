"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features: the words of a text (A-Z lower-cased; letters, digits and bytes from 0x80) and their stems, pairs of
neighbours and pairs with one word between, hashed to 2 ** BITS slots; each counts once. Training visits a bounded sample of labelled
documents (`most_positive` and `most_negative`, the smallest hashes of their ids) with per-coordinate learning rates.
Their features are written to the shared folder and stream through one task, EPOCHS times in different orders, sorted
by Spark; the task holds the model and a batch. The L1 term leaves few weights, which are broadcast. The intercept is
moved from the sample's share of positives to that of all labelled training rows. Labels, language, source and id are
never inputs of a score.

Cases: a null or empty text has no features and gets the intercept's score. A text of any length counts whole; one
longer than a chunk is a chunk of its own. Label rows with a null id or label are left out; an id with any label 1
counts as toxic; documents whose id repeats are each a sample. Without labels of both kinds, or documents that have
them, the score is the share of positives (0 without labels). An empty table of documents gives no row. Extra columns
are kept by `score`; one named like the score (in any case of letters) is replaced.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm.common import chunks, crc_mod, fresh, held, held_latest, release, ship, staged, table
from tablesift.llm.decontaminate import WORD_BYTES

BITS = 20
#: Bytes of text whose features are held at a time.
CHUNK = 1 << 20
MOST_POSITIVE = 4000
MOST_NEGATIVE = 8000
#: FTRL: alpha, beta, L1, L2 and passes over the sample.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 5.0, 0.1, 4
REJECT = 0.7

#: Bytes of the word stems that count beside the whole word, so that unseen endings of a known stem still tell.
STEMS = (4, 5, 6)

_MOST_WORDS = 200_000
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _hashes(words: list[bytes]) -> np.ndarray:
    """A row for each word: the hash of the word and of its stems (0 where the word is no longer than the stem)."""
    known: dict[bytes, bytes] = held("toxicity", "words", dict)
    if len(known) > _MOST_WORDS:
        known.clear()
    for w in set(words).difference(known):
        own = [xxhash.xxh64_intdigest(w)] + [xxhash.xxh64_intdigest(w[:n] + b"*") if len(w) > n else 0 for n in STEMS]
        known[w] = np.array(own, dtype=np.uint64).tobytes()
    return np.frombuffer(b"".join(map(known.__getitem__, words)), dtype=np.uint64).reshape(-1, 1 + len(STEMS))


def _slots(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of all word n-grams and skip-grams; pairs never cross texts. They may repeat."""
    split = [t.encode().translate(WORD_BYTES).split() if t else [] for t in texts]
    sizes = [len(s) for s in split]
    table = _hashes([w for s in split for w in s])
    h = np.ascontiguousarray(table[:, 0])
    row = np.repeat(np.arange(len(texts)), sizes)
    rows, slots = [row], [_slots(h)]
    for k in range(1, table.shape[1]):
        stem = np.flatnonzero(table[:, k])
        rows.append(row[stem])
        slots.append(_slots(table[stem, k]))
    for gap, factor in ((1, _PAIR), (2, _SKIP)):
        if len(h) > gap:
            same = row[gap:] == row[:-gap]
            pair = (h[:-gap] * factor + np.uint64(gap)) ^ (h[gap:] << np.uint64(1) | h[gap:] >> np.uint64(63))
            rows.append(row[gap:][same])
            slots.append(_slots(pair[same]))
    return np.concatenate(rows), np.concatenate(slots)


class FTRL:
    """Per-coordinate FTRL-proximal for binary features; slot -1, the last one, is the intercept (without L1)."""

    def __init__(self, size: int) -> None:
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
        return w

    def intercept(self) -> float:
        return float(-self.z[-1] / ((BETA + math.sqrt(self.n[-1])) / ALPHA))

    def learn(self, slots: np.ndarray, label: int) -> None:
        w, b = self.weights(slots), self.intercept()
        p = 1 / (1 + math.exp(-max(-35.0, min(35.0, w.sum() + b))))
        g = p - label
        n = self.n[slots]
        self.z[slots] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[slots] = n + g * g
        n = self.n[-1]
        self.z[-1] += g - (math.sqrt(n + g * g) - math.sqrt(n)) / ALPHA * b
        self.n[-1] = n + g * g


def train(df: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, most_positive: int = MOST_POSITIVE, most_negative: int = MOST_NEGATIVE) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, weights, intercept). labels has id_column and label_column; only ids outside the held-out third train."""
    ship(df.sparkSession)
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label")).dropna().filter(crc_mod("id", 3) != 1)
    known = known.groupBy("id").agg(F.max((F.col("label") == 1).cast("int")).alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    positive, negative = counts.get(1, 0), counts.get(0, 0)
    none = np.zeros(0, dtype=np.int64), np.zeros(0)
    if not positive or not negative:
        share = positive / max(1, positive + negative)
        return *none, 40.0 if share else -40.0
    ids = None
    for label, most in ((1, most_positive), (0, most_negative)):
        part = known.filter(F.col("label") == label).withColumn("h", F.xxhash64(F.lit(10), "id")).orderBy("h", "id").limit(most)
        ids = part if ids is None else ids.unionByName(part)
    # at most most_positive + most_negative ids: a proven bound
    sample = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).join(F.broadcast(ids), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in chunks(batch, "text", CHUNK):
                row, slot = features(texts)
                keys = np.unique(row << BITS | slot)
                ends = np.searchsorted(keys >> BITS, np.arange(len(texts)), side="right")
                kept = (keys & ((1 << BITS) - 1)).astype("<u4")
                own = [kept[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), batch.column(1).slice(start, len(texts)), pa.array(own, pa.binary())], names=["h", "label", "slots"])

    features_of = staged(sample.select("h", "label", "text").mapInArrow(run, "h long, label int, slots binary"), "features")
    met = {r["label"]: r["n"] for r in features_of.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(met) < 2:
        release(features_of)
        return *none, 40.0 if 1 in met else -40.0

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = FTRL(1 << BITS)
        for batch in batches:
            labels, slots = batch.column(0).to_pylist(), batch.column(1)
            for i, label in enumerate(labels):
                model.learn(np.frombuffer(slots[i].as_buffer(), dtype="<u4").astype(np.int64), label)
        w = model.weights(slice(0, -1))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array([at.astype("<i8").tobytes()]), pa.array([w[at].astype("<f8").tobytes()]), pa.array([model.intercept()])], names=["at", "weights", "intercept"])

    visits = features_of.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS))))
    ordered = visits.repartition(1).sortWithinPartitions("epoch", F.xxhash64("epoch", "h"), "h", "slots").select("label", "slots")
    found = ordered.mapInArrow(learn, "at binary, weights binary, intercept double").first()
    release(features_of)
    shift = math.log(positive / negative) - math.log(met[1] / met[0])
    return np.frombuffer(found["at"], dtype="<i8"), np.frombuffer(found["weights"], dtype="<f8"), found["intercept"] + shift


def score(df: DataFrame, text_column: str, weights: tuple[np.ndarray, np.ndarray, float], name: str = "score") -> DataFrame:
    """The frame with the probability of label 1 as a further column; an own column of that name is replaced."""
    ship(df.sparkSession)
    df = df.select(*[F.col(c) for c in df.columns if c.lower() != name.lower()])
    at, values, intercept = weights
    shared, key = df.sparkSession.sparkContext.broadcast((at, values.astype(np.float32))), uuid.uuid4().hex
    columns = df.columns
    whole = fresh([*columns, name], "whole_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def laid_out() -> np.ndarray:
            table = np.zeros(1 << BITS, dtype=np.float32)
            table[shared.value[0]] = shared.value[1]
            return table

        dense = held_latest("toxicity", f"dense/{key}", laid_out)
        for batch in batches:
            for start, texts in chunks(batch, whole, CHUNK):
                row, slot = features(texts)
                w = dense[slot]
                live = np.flatnonzero(w)
                keys = np.unique(row[live] << BITS | slot[live])
                total = np.bincount(keys >> BITS, weights=dense[keys & ((1 << BITS) - 1)], minlength=len(texts)) + intercept
                p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
                yield pa.RecordBatch.from_arrays([batch.column(i).slice(start, len(texts)) for i in range(len(columns))] + [pa.array(p, pa.float64())], names=[*columns, name])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns) + f", `{name}` double"
    return df.select("*", F.col(text_column).cast("string").alias(whole)).mapInArrow(run, schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    weights = train(documents, table(spark, sf_dir, "labels"), "doc_id", "text", "toxic")
    scored = score(documents.select("doc_id", "text"), "text", weights)
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"))
