"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct shingles; two link if their sets' Jaccard similarity reaches PERCENT. The
result names each document's component of links, so links inside a component already known need no check.

1. Shingles of one document only can't be shared. A document with a link has PERCENT of its shingles in another, so
   one with fewer shared shingles (found by filters) is its own component at once. The others collapse to classes of
   equal sets, told apart by their size and two 64-bit hashes.
2. A class's shared shingles stand in one global order: unshared ones before them, hot ones last. Its prefix for l
   matches has l - 1 shingles more than the plain one; linked classes share l shingles of their prefixes for l.
3. Stars: each prefix shingle has a pivot, of the classes that have it the one with fewest unshared shingles; each class
   is verified against the one pivot with which it shares most. Families of near copies become components here, with
   one check for each member.
4. The adaptive join runs on what is left: shingles whose classes lie in several components. Each class chooses l by
   the estimated cost of its lists and of the candidates they leave. Entries of a list meet by an equi-join that
   passes by pairs within a component, those whose sizes differ too much, and those whose places leave too few common
   shingles (at most those before plus those after both places). Of the others it gives a pair once, at its first
   common shingle, and only if the prefixes share l. These are verified on whole sets.
5. The verified links give the components.
Joins on shingles and classes deal hot keys over several tasks (`common.salted`). Tables in the shared folder are
deleted as soon as nothing reads them.

Cases: a null text, or one without words, has an empty set and links with nothing; fewer than WORDS words are one
shingle. A text of any length is one row of at most 8 bytes a shingle; one longer than a chunk is a chunk of its own.
Rows that repeat, or share an id, are documents of one class. A null id is no smallest id; its row gets the
smallest other id of its component, or null. An empty table gives no row. Extra columns, whatever their names, are
ignored by `linked`, kept by `one_of_each`. Shingles are compared as 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm.common import chunks, fresh, held, held_latest, release, salted, ship, staged, table
from tablesift.llm.components import components
from tablesift.llm.shared_hashes import LISTED, Filters, bucket_count, bucket_of, listed, low_bits, slices

WORDS = 5
PERCENT = 80
#: Shingles found in so many chunks come last in the order, in two steps.
HOT = (16, 64)
MOST_MATCHES = 8
CHUNK = 4 << 20

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_P = np.uint64(0x9E3779B97F4A7C15)
_MOST_WORDS = 200_000


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each text, by row and hash."""
    split = [t.encode().translate(LOWER).split() if t else [] for t in texts]
    known: dict[bytes, int] = held("jaccard", "words", dict)
    if len(known) > _MOST_WORDS:
        known.clear()
    words = [w for s in split for w in s]
    for w in set(words).difference(known):
        known[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    sizes = np.array([len(s) for s in split], dtype=np.int64)
    row = np.repeat(np.arange(len(texts)), sizes)
    n = max(0, len(h) - WORDS + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(WORDS):
        out = (out ^ h[k : k + n]) * _P
        out ^= out >> np.uint64(29)
    whole = row[:n] == row[WORDS - 1 :] if n else np.zeros(0, dtype=bool)
    rows, hashes = [row[:n][whole]], [out[whole]]
    short = np.flatnonzero((sizes > 0) & (sizes < WORDS))
    if len(short):
        rows.append(short)
        hashes.append(np.array([xxhash.xxh64_intdigest(b" ".join(split[i]), seed=1) for i in short.tolist()], dtype=np.uint64))
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    if len(row):
        first = np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])])
        row, h = row[first], h[first]
    return row, h


def _sets(texts: DataFrame, kind: str) -> DataFrame:
    """(id, n_shingles, cls, check, shared) of every row; the last three are null for rows that can't have a link.

    cls and check: hashes of the set; shared: its shared shingles in the global order.
    """
    spark = texts.sparkSession
    buckets = bucket_count(spark)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in chunks(batch, "text", CHUNK):
                row, h = shingles(part)
                if len(h):
                    yield listed(h, row, buckets)

    found = slices(texts.select("text").filter(F.col("text") != "").mapInArrow(hashes, LISTED), buckets, HOT)
    shared_filters, key = spark.sparkContext.broadcast(found), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = held_latest("jaccard", f"filters/{key}", lambda: Filters(buckets, HOT, shared_filters.value))
        for batch in batches:
            for start, part in chunks(batch, "text", CHUNK):
                row, h = shingles(part)
                bucket, low = bucket_of(h, buckets), low_bits(h)
                shared = filters.has(0, bucket, low)
                size = len(part)
                n = np.bincount(row, minlength=size)
                able = (np.bincount(row[shared], minlength=size) * 100 >= n * PERCENT) & (n > 0)
                ends = np.cumsum(n)
                cls: list[int | None] = [None] * size
                check: list[int | None] = [None] * size
                for i in np.flatnonzero(able).tolist():
                    raw = h[ends[i] - n[i] : ends[i]].tobytes()
                    cls[i], check[i] = (xxhash.xxh64_intdigest(raw, seed=s) - (1 << 63) for s in (3, 4))
                kept = np.flatnonzero(shared & able[row])
                heat = sum(filters.has(k, bucket[kept], low[kept]).astype(np.int8) for k in range(1, len(HOT) + 1))
                kept = kept[np.lexsort((h[kept], heat, row[kept]))]
                offsets = np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=size))])
                own = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(h[kept].view(np.int64)), mask=pa.array(~able))
                columns = [batch.column(0).slice(start, size), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(check, pa.int64()), own]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "n_shingles", "cls", "check", "shared"])

    return texts.mapInArrow(run, f"id {kind}, n_shingles long, cls long, check long, shared array<long>")


def _least(n: Column) -> Column:
    """Shared shingles that a set of n needs with any other: PERCENT of its own."""
    return F.ceil(n * PERCENT / 100)


def _overlap(n: Column, m: Column) -> Column:
    """Shared shingles that sets of n and m need: 100 * shared >= PERCENT * union."""
    return F.ceil((n + m) * PERCENT / (100 + PERCENT))


def _postings(classes: DataFrame) -> DataFrame:
    """(token, c, n, m, at, level): each class's prefix shingles for up to MOST_MATCHES matches.

    n: its shingles; m: the shared ones; at: the token's place among these; level: from how many matches on the token
    is in the prefix. Unshared shingles stand before all others.
    """
    own = classes.withColumn("m", F.size("shared"))
    length = _prefix_length(F.col("n"), F.col("m"), F.lit(MOST_MATCHES))
    rows = own.select("c", "n", "m", F.posexplode(F.slice("shared", 1, length)).alias("at", "token"))
    # the prefix for l matches has the first m - least + l of the shared shingles
    level = F.greatest(F.lit(1), F.col("at") + 1 - F.col("m") + _least(F.col("n"))).cast("int")
    return rows.select("token", "c", "n", "m", "at", level.alias("level"))


def _possible(x: str, y: str) -> Column:
    """Can the classes x and y of a common token link? Their sizes, and the places of the token in both, must leave enough."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    after = F.least(F.col(f"{x}m") - F.col(f"{x}at"), F.col(f"{y}m") - F.col(f"{y}at"))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT) & (F.least(f"{x}at", f"{y}at") + after >= _overlap(n, m))


def _named(entries: DataFrame, side: str) -> DataFrame:
    return entries.select("token", *[F.col(c).alias(f"{side}{c}") for c in entries.columns if c != "token"])


def _star_pairs(postings: DataFrame, lists: DataFrame, rows: int) -> DataFrame:
    """(a, b): each class with the pivot that shares most of its plain prefix."""
    pivots = postings.join(lists.select("token", F.col("pivot.c").alias("c")), ["token", "c"])
    met = salted(_named(postings.filter("level = 1"), "x_"), _named(pivots, "y_"), ["token"], "x_c", counts=lists, rows=rows)
    pairs = met.filter((F.col("x_c") != F.col("y_c")) & _possible("x_", "y_")).groupBy("x_c", "y_c").agg(F.count("*").alias("matches"))
    best = pairs.groupBy("x_c").agg(F.max(F.struct("matches", F.negative("y_c").alias("y"))).alias("best"))
    return best.select(F.col("x_c").alias("a"), F.negative("best.y").alias("b"))


def _prefix_length(n: Column, m: Column, matches: Column) -> Column:
    """Shared shingles in the prefix for so many matches."""
    return F.greatest(F.lit(0), m - _least(n) + matches).cast("int")


def _adaptive_pairs(entries: DataFrame, lists: DataFrame, classes: DataFrame, rows: int) -> DataFrame:
    """(a, b): classes of different components that share as many prefix shingles as the larger one asks for."""
    lengths = salted(entries.select("token", "c", "n", "level"), lists.select("token", "n_list"), ["token"], "c", counts=lists, rows=rows)
    scanned = lengths.groupBy("c").agg(F.first("n").alias("n"), *[F.sum(F.when(F.col("level") <= k, F.col("n_list")).otherwise(0)).alias(f"s{k}") for k in range(1, MOST_MATCHES + 1)])
    # scanned entries, and candidates times the cost of a check
    costs = [F.struct((F.col(f"s{k}") * (1 + F.col("n") / (4.0 * k))).alias("cost"), F.lit(k).alias("k")) for k in range(1, MOST_MATCHES + 1)]
    asked = scanned.select("c", F.array_min(F.filter(F.array(*costs), lambda x: (x["k"] == 1) | (x["k"] <= _least(F.col("n")))))["k"].alias("asked"))
    m = F.size("shared")
    prefixes = classes.join(asked, "c").select("c", "asked", F.slice("shared", 1, _prefix_length(F.col("n"), m, F.lit(MOST_MATCHES))).alias("prefix"))
    ready = staged(entries.join(prefixes, "c"), "prefixes")
    x = _named(ready.filter("level <= asked").withColumn("prefix", F.slice("prefix", 1, _prefix_length(F.col("n"), F.col("m"), F.col("asked")))), "x_")
    met = salted(x, _named(ready.drop("asked"), "y_"), ["token"], "x_c", counts=lists, rows=rows)
    larger = (F.col("x_n") > F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_c") > F.col("y_c")))
    able = (F.col("x_root") != F.col("y_root")) & larger & (F.col("y_level") <= F.col("x_asked")) & _possible("x_", "y_")
    common = F.array_intersect("x_prefix", F.slice("y_prefix", 1, _prefix_length(F.col("y_n"), F.col("y_m"), F.col("x_asked"))))
    counted = F.when(able, (F.size(common) >= F.col("x_asked")) & (F.get(common, F.lit(0)) == F.col("token"))).otherwise(False)
    pairs = staged(met.filter(counted).select(F.col("x_c").alias("a"), F.col("y_c").alias("b")), "pairs")
    release(ready)
    return pairs


def _verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose whole sets reach PERCENT."""
    sets = {side: classes.select(F.col("c").alias(side), F.col("n").alias(f"n_{side}"), F.col("shared").alias(f"set_{side}")) for side in "ab"}
    rows = pairs.count()
    own = salted(pairs, sets["a"], ["a"], "b", rows=rows)
    both = salted(own, sets["b"], ["b"], "a", counts=pairs.groupBy("b").agg(F.count("*").alias("n")), rows=rows)
    return both.filter(F.size(F.array_intersect("set_a", "set_b")) >= _overlap(F.col("n_a"), F.col("n_b"))).select("a", "b")


def _roots(classes: DataFrame) -> DataFrame:
    """(node, root) of the classes that have links, by stars and then by the adaptive join; classes: c, n, shared."""
    postings = staged(_postings(classes), "postings")
    rows = postings.count()
    fewest = F.when(F.col("level") == 1, F.struct((F.col("n") - F.col("m")).alias("unshared"), "c"))
    lists = staged(postings.groupBy("token").agg(F.min(fewest).alias("pivot"), F.count("*").alias("n")).filter("n > 1"), "lists")
    pairs = staged(_star_pairs(postings, lists, rows), "star_pairs")
    links = staged(_verified(pairs, classes), "star_links")
    release(pairs)
    known = components(links)
    # of the shingles, those whose classes lie in several components
    rooted = postings.join(known.select(F.col("node").alias("c"), "root"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    apart = staged(rooted, "rooted")
    release(postings, lists, known)
    several = staged(apart.groupBy("token").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.count("*").alias("n")).filter("r < s").select("token", "n", F.col("n").alias("n_list")), "several")
    entries = staged(salted(apart, several.select("token"), ["token"], "c", counts=several, rows=rows), "entries")
    release(apart)
    pairs = _adaptive_pairs(entries, several, classes, rows)
    release(entries, several)
    more = staged(_verified(pairs, classes), "links")
    release(pairs)
    roots = components(links.unionByName(more))
    release(links, more)
    return roots


def linked(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, n_shingles, component_id) for each row."""
    ship(df.sparkSession)
    kind = df.schema[id_column].dataType.simpleString()
    texts = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    sets = staged(_sets(texts, kind), "sets")
    able = sets.filter(F.col("cls").isNotNull())
    grouped = able.groupBy("cls", "check", F.col("n_shingles").alias("n")).agg(F.min("id").alias("smallest"), F.first("shared").alias("shared"))
    classes = staged(grouped.withColumn("c", F.monotonically_increasing_id()), "classes")
    rows = staged(sets.drop("shared"), "rows")
    release(sets)
    found = _roots(classes.select("c", "n", "shared"))
    named = classes.select("cls", "check", F.col("n").alias("n_shingles"), "smallest", "c").join(found.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    rooted = staged(named, "rooted_classes")
    release(classes, found)
    smallest = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    component = staged(salted(rooted, smallest, ["root"], "c").select("cls", "check", "n_shingles", "component_id"), "components")
    release(rooted)
    alone = rows.filter(F.col("cls").isNull()).select("id", "n_shingles", F.col("id").alias("component_id"))
    able = rows.filter(F.col("cls").isNotNull())
    joined = salted(able.withColumn("row", F.monotonically_increasing_id()), component, ["cls", "check", "n_shingles"], "row")
    return alone.unionByName(joined.select("id", "n_shingles", "component_id")).withColumnRenamed("id", id_column)


def one_of_each(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The rows whose id is the smallest of their component; of rows that share id and text one stays.

    Rows with a null id, and those without words, stay.
    """
    key = fresh(df.columns, "own_id")
    found = staged(linked(df, id_column, text_column).select(F.col(id_column).alias(key), "n_shingles", "component_id"), "linked").filter((F.col("n_shingles") > 0) & F.col(key).isNotNull())
    by_id = found.groupBy(key).agg(F.max(F.col(key) != F.col("component_id")).alias("gone"), F.count("*").alias("rows"))
    same = df[id_column] == F.col(key)
    kept = df.join(by_id.filter("gone").select(key), same, "left_anti")
    repeated = by_id.filter("not gone and rows > 1").select(key)
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, same, "left_semi").dropDuplicates([id_column, text_column])
    return kept.join(repeated, same, "left_anti").unionByName(once)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"), "doc_id", "text")
