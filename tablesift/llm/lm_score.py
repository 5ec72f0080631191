"""Language-model scores by online logistic context mixing over binary decisions.

A text is a sequence of words and one end. Words that training has at least twice (an alphabet of at most ALPHABET, the
most frequent) are coded by a Huffman tree built from corpus counts, so a word is a few binary decisions; any other word
is an escape followed by a bit, whether the text has had the word before, and then by its place among the text's
escaped words or by its letters; the words met once tell how likely an escape is. Each of a word's decisions is predicted
by three contexts: the tree node alone, the node hashed with the word before, and the node hashed with the two words
before. The predictors' log odds are mixed by weights that a gate picks by how much the two hashed contexts have seen; an
adaptive table then refines the mixed probability. Total bits give the score, and bits per byte.

Training: every task runs the mixer online over its training texts (predict, correct the weights and the refinement,
then count) in blocks of at most BLOCK symbols. The context tables grow with the corpus, up to a bound, since they are broadcast; a
task trains on TASK_TOKENS or more where there are as many, so tables stay a fraction of the text. Tasks hand on their
dense count tables in ranges, which a streaming sum merges; weights are averaged by decisions. Words of the corpus are
counted exactly by a shuffle; a bounded frequent part is broadcast, other words of a text meet their counts in a join.

Cases: a null text is empty and is one end token. A text of any length counts whole; one longer than a chunk is a chunk
of its own. Rows that repeat are scored each; ids of any type do, a null id counts as the empty text in the fold.
Without training rows all counts are 0 and the model is that of an untrained mixer. An empty table gives no row. Extra
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm.common import chunks, crc_mod, held, held_latest, ship, staged, table

#: Coded words at most, and how often training has each at least; other words are spelled.
ALPHABET, LEAST = 1 << 17, 2
#: Words whose counts are broadcast, the most frequent ones.
FREQUENT = 1 << 18
#: Bits of the slots for contexts of one word, by the corpus; those of two words have one bit more.
LEAST_BITS, MOST_BITS = 18, 21
#: Tokens that a training task takes at least.
TASK_TOKENS = 6_000_000
BITS_SPELL, BITS_SPELL_THREE = 12, 14
#: Parts into which a task's tables are cut for merging.
RANGES = 64
#: Levels of what a context has seen; three bits in the merged tables.
LEVELS = 8
BUCKETS = 32
RATE = 0.25
#: Symbols that are predicted before they are counted; a task's first blocks double up to BLOCK, so that small tasks too learn from what they counted.
FIRST_BLOCK, BLOCK = 256, 4096
#: Symbols that are scored at a time.
SCORED = 8192
_FLUSH = 250_000
_STEP = np.float32(256)

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def split(text: str | None) -> list[bytes]:
    """Words between runs of space and 0x09-0x0D, A-Z lower-cased; bytes.split knows just these separators."""
    return text.encode().translate(LOWER).split() if text else []


@dataclass
class Words:
    """The words of some texts, each as a place among the distinct ones."""

    distinct: pa.LargeBinaryArray
    codes: np.ndarray
    #: Words and UTF-8 bytes of each text.
    sizes: np.ndarray
    lengths: np.ndarray

    def owners(self) -> np.ndarray:
        """The text that each word is of."""
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def listed(self) -> list[bytes]:
        """The distinct words; by way of numpy, which makes no scalar for each."""
        return self.distinct.to_numpy(zero_copy_only=False).tolist()


def words_of(texts: list[str | None]) -> Words:
    """What `split` gives for each text, found for all at once without an object for each word."""
    raw = [t.encode() if t else b"" for t in texts]
    lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    data = np.frombuffer(b" ".join([b"", *raw, b""]).translate(LOWER), dtype=np.uint8)
    inside = (data != 32) & (data - np.uint8(9) > 4)
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    begins = np.cumsum(lengths + 1) - lengths
    sizes = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
    offsets = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    encoded = words.dictionary_encode()
    return Words(encoded.dictionary, encoded.indices.to_numpy().astype(np.int64), sizes, lengths)


@dataclass
class Coder:
    """Each symbol's path through the tree. Symbol 0 is the end, 1 the escape, then come the coded words, most frequent first."""

    words: list[bytes]
    starts: np.ndarray
    sizes: np.ndarray
    #: For each step of each path: the tree node spread over 32 bits, the bit taken and the node's own log odds.
    spread: np.ndarray
    bits: np.ndarray
    odds: np.ndarray
    #: Bits of the slots for contexts of one and of two words.
    slots: tuple[int, int]

    def table_sizes(self) -> list[int]:
        """Numbers in each kind of table: one word before, two words before, spelling by one byte, by two, by three."""
        return [2 << self.slots[0], 2 << self.slots[1], 1 << 16, 256 << BITS_SPELL, 256 << BITS_SPELL_THREE]


def slot_bits(tokens: int) -> tuple[int, int]:
    """About half a slot for each token, within the bounds."""
    one = min(MOST_BITS, max(LEAST_BITS, int(tokens).bit_length() - 2))
    return one, one + 1


def build_coder(words: list[bytes], counts: list[int], ends: int, escapes: int, slots: tuple[int, int] = (LEAST_BITS, LEAST_BITS + 1)) -> Coder:
    """Huffman code of end, escape and words by their counts."""
    weights = [max(1, ends), max(1, escapes), *counts]
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent: dict[int, tuple[int, int]] = {}
    below: list[tuple[int, int]] = []
    mass = list(weights)
    while len(heap) > 1:
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        node = len(mass)
        mass.append(a + b)
        parent[i], parent[j] = (node, 0), (node, 1)
        below.append((a, b))
        heapq.heappush(heap, (a + b, node))
    n = len(weights)
    starts, sizes, nodes, bits = [], [], [], []
    for symbol in range(n):
        path, at = [], symbol
        while at in parent:
            at, bit = parent[at]
            path.append((at - n, bit))
        starts.append(len(nodes))
        sizes.append(len(path))
        nodes.extend(p for p, _ in reversed(path))
        bits.extend(b for _, b in reversed(path))
    odds = np.array([math.log((b + 0.4) / (a + 0.4)) for a, b in below], dtype=np.float32)
    node = np.array(nodes, dtype=np.uint32)
    return Coder(words, np.array(starts), np.array(sizes), node * np.uint32(0xC2B2AE35), np.array(bits, dtype=np.uint8), odds[node] if nodes else odds, slots)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint32(0x9E3779B1)
    return (x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA6B)


class Decisions:
    """The binary decisions of a block of symbols with their context slots."""

    def __init__(self, coder: Coder, symbols: np.ndarray, before: np.ndarray, before_two: np.ndarray) -> None:
        sizes = coder.sizes.take(symbols)
        offset = np.cumsum(sizes) - sizes
        at = np.repeat(coder.starts.take(symbols) - offset, sizes)
        at += np.arange(len(at))
        spread, self.bits, self.odds, self.offset = coder.spread.take(at), coder.bits.take(at), coder.odds.take(at), offset
        one = _mixed(before.astype(np.uint32) + np.uint32(1))
        two = _mixed(one ^ _mixed(before_two.astype(np.uint32) + np.uint32(7)))
        self.one, self.two = (self._slots(x, sizes, spread, bits) for x, bits in zip((one, two), coder.slots, strict=True))

    @staticmethod
    def _slots(context: np.ndarray, sizes: np.ndarray, spread: np.ndarray, bits: int) -> np.ndarray:
        x = np.repeat(context, sizes)
        x ^= spread
        x *= np.uint32(0x9E3779B1)
        x >>= np.uint32(32 - bits)
        return x.astype(np.intp)


_SEEN = np.minimum(np.frompyfunc(lambda n: int(n).bit_length(), 1, 1)(np.arange(256)).astype(np.uint8), LEVELS - 1)


def _odds(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of a bit 1 and how much the context has seen, from 0 to LEVELS - 1."""
    odds = ones.astype(np.float32)
    odds += np.float32(0.4)
    odds /= zeros.astype(np.float32) + np.float32(0.4)
    return np.log(odds, out=odds), _SEEN.take(np.minimum(zeros + ones, 255))


class Mixer:
    """Gated weights, and the adaptive refinement of what they give."""

    def __init__(self) -> None:
        self.weights = np.tile(np.array([0.4, 0.4, 0.3, 0.0], dtype=np.float32), (LEVELS * LEVELS, 1))
        self.squares = np.full((LEVELS * LEVELS, 4), 1e-4, dtype=np.float32)
        self.refined = np.zeros((LEVELS * BUCKETS, 2))
        self.decisions = 0

    def mix(self, odds: tuple[np.ndarray, ...], gate: np.ndarray) -> np.ndarray:
        """Log odds of a bit 1."""
        w = np.ascontiguousarray(self.weights.T)
        x = w[3].take(gate)
        for i, o in enumerate(odds):
            x += w[i].take(gate) * o
        np.minimum(x, np.float32(11), out=x)
        return np.maximum(x, np.float32(-11), out=x)

    def buckets(self, x: np.ndarray, level: np.ndarray) -> np.ndarray:
        return level.astype(np.int32) * BUCKETS + ((x + np.float32(11)) * np.float32((BUCKETS - 0.01) / 22)).astype(np.int32)

    def rates(self) -> np.ndarray:
        """Share of bits 1 in each bucket, drawn to the bucket's middle where little was seen."""
        middle = (np.arange(BUCKETS) + 0.5) * 22 / BUCKETS - 11
        prior = np.tile(1 / (1 + np.exp(-middle)), LEVELS)
        return ((self.refined[:, 1] + 8 * prior) / (self.refined.sum(axis=1) + 8)).astype(np.float32)

    def learn(self, odds: tuple[np.ndarray, ...], gate: np.ndarray, level: np.ndarray, bits: np.ndarray) -> None:
        x = self.mix(odds, gate)
        error = bits - 1 / (1 + np.exp(-x))
        n = np.maximum(np.bincount(gate, minlength=LEVELS * LEVELS), 1)
        for i, o in enumerate((*odds, None)):
            g = np.bincount(gate, weights=error if o is None else error * o, minlength=LEVELS * LEVELS) / n
            self.squares[:, i] += g * g
            self.weights[:, i] += RATE * g / np.sqrt(self.squares[:, i])
        both = np.bincount(self.buckets(x, level) * 2 + bits, minlength=2 * LEVELS * BUCKETS)
        self.refined += both.reshape(-1, 2)
        self.decisions += len(bits)

    def bits(self, odds: np.ndarray, one: np.ndarray, two: np.ndarray, bits: np.ndarray, rates: np.ndarray) -> np.ndarray:
        """Cost of each decision in bits; odds: the node's own, one and two: entries of the merged tables."""
        bias, own, first, second = (np.ascontiguousarray(self.weights[:, i]) for i in (3, 0, 1, 2))
        gate = (((two & 7) << 3) | (one & 7)).astype(np.intp)
        x = own.take(gate)
        x *= odds
        x += bias.take(gate)
        x += (first / _STEP).take(gate) * (one >> 3)
        x += (second / _STEP).take(gate) * (two >> 3)
        np.minimum(x, np.float32(11), out=x)
        np.maximum(x, np.float32(-11), out=x)
        bucket = ((x + np.float32(11)) * np.float32((BUCKETS - 0.01) / 22)).astype(np.intp)
        bucket += (gate >> 3) * BUCKETS
        p = np.exp(-x)
        p += np.float32(1)
        np.divide(np.float32(0.5), p, out=p)
        p += (rates * np.float32(0.5)).take(bucket)
        p = np.where(bits, p, np.float32(1) - p)
        np.maximum(p, np.float32(1e-6), out=p)
        return -np.log2(p, out=p)


def _spelled(words: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(byte, its contexts of one, two and three bytes before, ends) of the words, each closed by a space."""
    sizes = np.array([len(w) + 1 for w in words])
    data = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8).astype(np.int64)
    ends = np.cumsum(sizes)
    place = np.arange(len(data)) - np.repeat(ends - sizes, sizes)
    last = [np.where(place >= k, np.roll(data, k), 32).astype(np.uint32) for k in (1, 2, 3)]
    two = _mixed(last[0] * np.uint32(257) + last[1])
    three = _mixed(two ^ (last[2] * np.uint32(0x01000193) + np.uint32(5)))
    contexts = [last[0], two >> np.uint32(32 - BITS_SPELL), three >> np.uint32(32 - BITS_SPELL_THREE)]
    return data, [c.astype(np.int64) for c in contexts], ends


class Speller:
    """Bytes of a spelled word by the bytes before it: counts of longer contexts interpolated with shorter ones."""

    def __init__(self, tables: list[np.ndarray]) -> None:
        self.tables = [t.reshape(-1, 256) for t in tables]
        self.sums = [t.sum(axis=1) for t in self.tables]

    def bits(self, words: list[bytes]) -> np.ndarray:
        data, contexts, ends = _spelled(words)
        p = np.full(len(data), 1 / 256)
        for context, counts, total in zip(contexts, self.tables, self.sums, strict=True):
            p = (counts[context, data] + 4 * p) / (total[context] + 4)
        return np.diff(np.concatenate([[0.0], np.cumsum(-np.log2(p))])[np.concatenate([[0], ends])])


def _escaped_before(code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each escaped word: whether its text has had it before, and how many distinct ones the text has had.

    code: the words as numbers; doc: the texts they are of, ascending.
    """
    first = np.zeros(len(code), dtype=bool)
    first[np.unique(doc * (code.max(initial=0) + 1) + code, return_index=True)[1]] = True
    passed = np.cumsum(first) - first
    return ~first, passed - passed[np.searchsorted(doc, doc)]


def _level(had: np.ndarray) -> np.ndarray:
    """Sixteen levels of how many escaped words a text has had."""
    return np.minimum(np.ceil(np.log2(had + 1)), 15).astype(np.int64)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the column text: words as bytes, and the empty word for ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # an earlier model goes now, not when the next one comes
        held("lm_count", "nothing", list)
        words, counts, ends = pa.array([], pa.large_binary()), np.zeros(0, dtype=np.int64), 0

        def flushed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([words.cast(pa.binary()), pa.array(counts)], names=["word", "n"])

        for batch in batches:
            for _, part in chunks(batch, "text"):
                own = words_of(part)
                both = pa.concat_arrays([words, own.distinct]).dictionary_encode()
                # sums of whole numbers below 2^53 are exact
                n = np.append(counts, np.bincount(own.codes, minlength=len(own.distinct)))
                words, counts = both.dictionary, np.bincount(both.indices.to_numpy(), weights=n, minlength=len(both.dictionary)).astype(np.int64)
                ends += len(part)
                if len(words) > _FLUSH:
                    yield flushed()
                    words, counts = words[:0], counts[:0]
        if len(words):
            yield flushed()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([b""], pa.binary()), pa.array([ends], pa.int64())], names=["word", "n"])

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _looked_up(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    """The words' places among the known words, or -1."""
    return np.fromiter(map(known.get, words, repeat(-1)), dtype=np.int64, count=len(words))


def _symbols(coded: int, at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all documents with their ends, the two symbols before each (ends before a document), and where documents start."""
    starts = np.cumsum(sizes + 1) - sizes - 1
    out = np.zeros(len(at) + len(sizes), dtype=np.int32)
    out[np.arange(len(at)) + np.repeat(np.arange(len(sizes)), sizes)] = np.where((at >= 0) & (at < coded), at + 2, 1)
    before, before_two = np.zeros_like(out), np.zeros_like(out)
    before[1:] = out[:-1]
    before_two[2:] = out[:-2]
    second = starts + 1
    before_two[second[second < len(out)]] = 0
    before_two[starts] = 0
    return out, before, before_two, starts


def _ranged(kind: int, counts: np.ndarray) -> Iterator[tuple[int, int, int, bytes]]:
    for r, part in enumerate(np.array_split(counts.ravel(), RANGES)):
        if part.any():
            yield kind, r, 2 if part.max() < 1 << 16 else 8, part.astype("<u2" if part.max() < 1 << 16 else "<i8").tobytes()


#: Kinds of merged tables beside those of `Coder.table_sizes`.
_WEIGHTS, _REFINED, _AGAIN = 5, 6, 7


def _pair(table: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of bits 0 and 1; both lie in one 64-bit word, so a slot is one access."""
    both = table.view("<i8").take(slot).view("<i4")
    return both[::2], both[1::2]


#: What a bit 0 and a bit 1 add to such a word.
_BIT = np.array([1, 1 << 32], dtype="<i8")


def _count(table: np.ndarray, slot: np.ndarray, bits: np.ndarray) -> None:
    """Counts a block's decisions.

    _BIT is read here, in the worker's own module: a copy pickled with a task has another dtype object, which keeps
    `add.at` from its fast loop.
    """
    np.add.at(table.view("<i8"), slot, _BIT.take(bits))


def _trained(texts: DataFrame, coder_shared, key: str) -> DataFrame:
    """(kind, part, width, content): each task's tables after its online pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder: Coder = held_latest("lm_train", f"coder/{key}", lambda: coder_shared.value)
        known: dict[bytes, int] = held_latest("lm_train", f"coded/{key}", lambda: {w: i for i, w in enumerate(coder.words)})
        tables = [np.zeros(n, dtype="<i4") for n in coder.table_sizes()]
        repeats = np.zeros((16, 2))
        mixer, spelled, met, block = Mixer(), set(), np.zeros(len(coder.words), dtype=bool), FIRST_BLOCK
        for batch in batches:
            for _, part in chunks(batch, "text", 3 << 20):
                own = words_of(part)
                words = own.listed()
                place = _looked_up(words, known)
                at = place.take(own.codes)
                symbols, before, before_two, _ = _symbols(len(known), at, own.sizes)
                a = 0
                while a < len(symbols):
                    d = Decisions(coder, symbols[a : a + block], before[a : a + block], before_two[a : a + block])
                    odds_one, seen_one = _odds(*_pair(tables[0], d.one))
                    odds_two, seen_two = _odds(*_pair(tables[1], d.two))
                    gate = seen_two.astype(np.intp) * LEVELS + seen_one
                    mixer.learn((d.odds, odds_one, odds_two), gate, seen_two, d.bits)
                    _count(tables[0], d.one, d.bits)
                    _count(tables[1], d.two, d.bits)
                    a, block = a + block, min(2 * block, BLOCK)
                outside = np.flatnonzero(at < 0)
                again, had = _escaped_before(own.codes[outside], own.owners()[outside])
                np.add.at(repeats, (_level(had), again.astype(np.int8)), 1)
                # the speller learns from each word once in a task, coded or not
                new = {words[i] for i in np.flatnonzero(place < 0).tolist()} - spelled
                here = np.zeros(len(met), dtype=bool)
                here[place[place >= 0]] = True
                coded = np.flatnonzero(here & ~met).tolist()
                met |= here
                if new or coded:
                    data, contexts, _ = _spelled([*new, *(coder.words[i] for i in coded)])
                    each = np.ones(len(data), dtype=np.int32)
                    for table_of, context in zip(tables[2:], contexts, strict=True):
                        np.add.at(table_of, context * 256 + data, each)
                    spelled |= new
                    if len(spelled) > _FLUSH:
                        spelled.clear()
        weighed = np.append(mixer.weights.astype(np.float64).ravel() * mixer.decisions, mixer.decisions)
        own = [(_WEIGHTS, 0, 0, weighed.tobytes()), (_REFINED, 0, 0, mixer.refined.tobytes()), (_AGAIN, 0, 0, repeats.tobytes())]
        # one range at a time beside the tables
        for kind, part, width, content in chain(own, (x for kind, t in enumerate(tables) for x in _ranged(kind, t))):
            yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([width], pa.int32()), pa.array([content], pa.binary())], names=["kind", "part", "width", "content"])

    return texts.mapInArrow(run, "kind int, part int, width int, content binary")


def _merged(tables: DataFrame) -> DataFrame:
    """(kind, part, content): sums of the tasks' tables; log odds and levels in two bytes for the hashed contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            kinds, parts, widths = (batch.column(i).to_pylist() for i in range(3))
            for i, (kind, part, width) in enumerate(zip(kinds, parts, widths, strict=True)):
                got = np.frombuffer(batch.column(3)[i].as_buffer(), dtype={0: "<f8", 2: "<u2", 8: "<i8"}[width])
                if (kind, part) in sums:
                    sums[kind, part] += got
                else:
                    sums[kind, part] = got.astype(np.int64 if width else np.float64)
        for (kind, part), total in sorted(sums.items()):
            if kind in (0, 1):
                odds, seen = _odds(total[::2], total[1::2])
                total = (np.clip(np.rint(odds * _STEP), -4095, 4095).astype(np.int16) << 3) | seen
            elif kind < _WEIGHTS:
                total = np.minimum(total, 1 << 30).astype("<i4")
            yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["kind", "part", "content"])

    return tables.repartition("kind", "part").mapInArrow(run, "kind int, part int, content binary")


@dataclass
class Model:
    coder: Coder
    one: np.ndarray
    two: np.ndarray
    speller: Speller
    mixer: Mixer
    rates: np.ndarray
    #: Texts' escaped words by how many they have had: new ones and ones they have had.
    repeats: np.ndarray

    def escapes(self, words: list[bytes], code: np.ndarray, doc: np.ndarray, spelled: dict[bytes, float]) -> np.ndarray:
        """Bits of each escaped word beside its escape; code: their places in `words`; spelled is a cache of what letters cost."""
        if len(spelled) > _FLUSH:
            spelled.clear()
        own, code = np.unique(code, return_inverse=True)
        names = [words[i] for i in own.tolist()]
        new = [w for w in names if w not in spelled]
        if new:
            spelled.update(zip(new, self.speller.bits(new).tolist(), strict=True))
        letters = np.fromiter(map(spelled.__getitem__, names), dtype=np.float64, count=len(names))[code]
        again, had = _escaped_before(code, doc)
        counts = self.repeats[_level(had)]
        p = (counts[:, 1] + 0.5) / (counts.sum(axis=1) + 1)
        told = np.where(again, -np.log2(p) + np.log2(np.maximum(had, 1)), letters - np.log2(1 - p))
        return np.where(had > 0, told, letters)

    def cost(self, words: list[bytes], own: Words, at: np.ndarray, spelled: dict[bytes, float]) -> np.ndarray:
        """Bits of each document; words: the distinct ones; at: each word's place among the known; spelled is a cache of what letters cost."""
        coded, sizes = len(self.coder.words), own.sizes
        symbols, before, before_two, starts = _symbols(coded, at, sizes)
        cost = np.empty(len(symbols))
        for a in range(0, len(symbols), SCORED):
            d = Decisions(self.coder, symbols[a : a + SCORED], before[a : a + SCORED], before_two[a : a + SCORED])
            each = self.mixer.bits(d.odds, self.one.take(d.one), self.two.take(d.two), d.bits, self.rates)
            cost[a : a + SCORED] = np.add.reduceat(each, d.offset) if len(each) else 0
        outside = np.flatnonzero((at < 0) | (at >= coded))
        doc = own.owners()[outside]
        letters = self.escapes(words, own.codes[outside], doc, spelled)
        return np.add.reduceat(cost, starts) + np.bincount(doc, weights=letters, minlength=len(sizes))


def _table_of(rows: list, kind: int, size: int, dtype: str) -> np.ndarray:
    """Merged ranges put together; ranges that no task has stay 0."""
    parts = {r["part"]: np.frombuffer(r["content"], dtype=dtype) for r in rows if r["kind"] == kind}
    sizes = [len(x) for x in np.array_split(np.empty(size, dtype=np.uint8), RANGES)]
    return np.concatenate([parts.get(i, np.zeros(n, dtype=dtype)) for i, n in enumerate(sizes)])


def _least_count(counts: DataFrame, most: int) -> int:
    """A count that at most `most` words reach, from a histogram of counts in eighths of powers of two."""
    step = F.floor(F.log2("n") * 8).cast("int")
    passed = 0
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.max("n").alias("most")).orderBy(F.desc("step")).collect():
        passed += r["words"]
        if passed > most:
            return r["most"] + 1
    return 1


def _rare_words(own: Words, at: np.ndarray) -> pa.ListArray:
    """For each document its distinct words among the given places, with their numbers."""
    distinct = max(1, len(own.distinct))
    pairs, counts = np.unique(own.owners()[at] * distinct + own.codes[at], return_counts=True)
    owner, name = np.divmod(pairs, distinct)
    offsets = np.searchsorted(owner, np.arange(len(own.sizes) + 1)).astype(np.int32)
    entries = pa.StructArray.from_arrays([own.distinct.take(pa.array(name)).cast(pa.binary()), pa.array(counts, pa.int64())], names=["word", "n"])
    return pa.ListArray.from_arrays(pa.array(offsets), entries)


def score_texts(df: DataFrame, id_column: str, text_column: str, folds: int = 5, held_out: int = 1) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for each row."""
    spark: SparkSession = df.sparkSession
    ship(spark)
    key = uuid.uuid4().hex
    rows = df.select(F.col(id_column).alias("id"), (crc_mod(id_column, folds) == held_out).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    training = rows.filter(~F.col("held_out")).select("text")
    counts = staged(word_counts(training), "words")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.filter((F.col("n") >= _least_count(counts, FREQUENT)) & (F.octet_length("word") > 0)).toArrow().combine_chunks()
    top = top.sort_by([("n", "descending"), ("word", "ascending")])
    words, numbers = top.column("word").to_pylist(), top.column("n").to_pylist()
    ends = counts.filter(F.octet_length("word") == 0).agg(F.sum("n")).first()[0] or 0
    coded = min(ALPHABET, sum(n >= LEAST for n in numbers))
    coder = build_coder(words[:coded], numbers[:coded], ends, tokens - ends - sum(numbers[:coded]), slot_bits(tokens))
    coder_shared = spark.sparkContext.broadcast(coder)
    # fewer, larger tasks than file splits, without a shuffle
    tasks = training.coalesce(max(1, -(-tokens // TASK_TOKENS)))
    merged = _merged(_trained(tasks, coder_shared, key)).collect()
    mixer, repeats = Mixer(), np.zeros((16, 2))
    for r in merged:
        if r["kind"] == _WEIGHTS:
            total = np.frombuffer(r["content"])
            if total[-1]:
                mixer.weights = (total[:-1] / total[-1]).reshape(-1, 4).astype(np.float32)
        if r["kind"] == _AGAIN:
            repeats = np.frombuffer(r["content"]).reshape(-1, 2).copy()
        if r["kind"] == _REFINED:
            mixer.refined = np.frombuffer(r["content"]).reshape(-1, 2).copy()
    sizes = coder.table_sizes()
    speller = Speller([_table_of(merged, k, sizes[k], "<i4") for k in (2, 3, 4)])
    # of each pair of counts the merged table has one entry
    one, two = (_table_of(merged, k, sizes[k] // 2, "<i2") for k in (0, 1))
    model = Model(coder, one, two, speller, mixer, mixer.rates(), repeats)
    model_shared = spark.sparkContext.broadcast(model)
    known_shared = spark.sparkContext.broadcast((words, np.log10(np.array([*numbers, ends or 0], dtype=np.float64) + 0.5)))
    below = math.log10(tokens + 0.5 * (distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = held_latest("lm_score", f"model/{key}", lambda: model_shared.value)
        known: dict[bytes, int] = held_latest("lm_score", f"known/{key}", lambda: {w: i for i, w in enumerate(known_shared.value[0])})
        logs = known_shared.value[1]
        spelled: dict[bytes, float] = held_latest("lm_score", f"spelled/{key}", dict)
        part_id, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start, texts in chunks(batch, "text", 2 << 20):
                mine = words_of(texts)
                words = mine.listed()
                at = _looked_up(words, known).take(mine.codes)
                n, sizes = len(mine.sizes), mine.sizes
                bits = own.cost(words, mine, at, spelled)
                doc, found = mine.owners(), at >= 0
                base = np.bincount(doc[found], weights=logs[at[found]], minlength=n) + logs[-1] - below * (sizes + 1)
                seen = np.bincount(doc[found], minlength=n) + (ends > 0)
                rare = _rare_words(mine, np.flatnonzero(~found))
                size = mine.lengths
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part_id] * n, pa.int32()), pa.array(range(row, row + n), pa.int64()), batch.column(0).slice(start, n), batch.column(1).slice(start, n)]
                    + [pa.array(sizes + 1, pa.int64()), pa.array(seen, pa.int64()), pa.array(base, pa.float64()), pa.array(-bits * math.log10(2), pa.float64()), pa.array(bits / np.maximum(size, 1), pa.float64())]
                    + [rare],
                    names=["part", "idx", "id", "held_out", "n_tokens", "seen", "base", "score", "bits_per_byte", "rare"],
                )
                row += n

    kind = df.schema[id_column].dataType.simpleString()
    scored = staged(rows.mapInArrow(run, f"part int, idx long, id {kind}, held_out boolean, n_tokens long, seen long, base double, score double, bits_per_byte double, rare array<struct<word:binary,n:long>>"), "scores")
    lookups = scored.select("part", "idx", F.inline("rare"))
    found = lookups.join(counts.withColumnRenamed("n", "c").hint("shuffle_hash"), "word", "left").groupBy("part", "idx").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"), F.sum(F.col("n") * F.log10(F.coalesce(F.col("c"), F.lit(0)) + 0.5)).alias("logs")
    )
    return scored.drop("rare").join(found, ["part", "idx"], "left").select(
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        (F.col("seen") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", F.lit(0.0))).alias("base_score"),
        "score",
        "bits_per_byte",
    )


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), "doc_id", "text")
