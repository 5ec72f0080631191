"""Deletion of repeated runs of lines by a suffix array over line-ID sequences, built by distributed prefix doubling.

A line's ID is two 64-bit hashes of its exact text; blank lines have none and don't count. A run of consecutive lines
is deleted from a document if it has at least `least` characters and starts at an earlier place too; places are
ordered by document id, then line. All runs of that kind count, so whole maximal repeats go.

1. Lines whose ID is unique can't repeat; they, and the ends of documents, end a segment. What is left is ranked by
   ID: a rank is the first index of the line's group in the suffix array.
2. Doubling: the rank at depth 2k of a suffix is that of the pair of its rank and the rank k lines on. Pairs are
   counted with map-side sums and ranked by prefix sums over sorted ranges, so a hot line is no window of its own.
   A suffix whose pair is unique can't be part of a longer repeat and drops out.
3. Suffixes with equal ranks at depth m form an interval of common prefix m. A run needs as many lines as reach
   `least` characters, forwards from its first or backwards from its last line; its interval is named by the two
   overlapping ranks of the largest power of two that fits. All but the interval's first place are later copies.
Doubling ends when that power reaches the longest run needed, or no suffix is left. Everything is DataFrame
operations; joins on ranks deal hot ones over several tasks.
4. A broadcast Bloom filter of the texts that lose lines sends only those (and a few more) to the join with their ranges.
   All others keep their text and never travel; for that the input is read twice.

Cases: a null text has no lines and stays null; an empty or blank text stays as it is. Ids of any orderable type do.
Rows with a null id are kept whole and are no source. Rows with the same id and text are one document, and each row
has its result; of other rows that share an id the text's hash decides the order. Blank lines within a deleted run go
with it. A document whose lines are all deleted has the empty text. A very long text is split as a whole, in one
task; an empty table gives no row. Extra columns are ignored by `repeated_runs`, kept by `remove_runs`, whose own
column names are the caller's to choose: one that clashes makes a second column of that name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesift.llm.common import release, salted, staged, table

#: Characters in the lines of a run that is worth deleting.
LEAST = 200
#: The filter of texts that lose lines: bits for each, words of 64 bits in a block, and blocks at most (32 MB in all).
#: A fuller filter only sends more texts to the exact join.
FILTER_BITS, BLOCK_WORDS, MOST_BLOCKS = 16, 256, 1 << 14


def _identity(id_column: str, text: Column) -> list[Column]:
    """A document's key: its id and the hash of its text."""
    return [F.col(id_column).alias("doc"), F.xxhash64(text).alias("version")]


def _lines(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc, version, at, line, chars, id, other) of every line that isn't blank; at numbers just these."""
    text = F.col(text_column).cast("string")
    numbered = F.transform(F.split(text, "\n", -1), lambda content, line: F.struct(line.alias("line"), content.alias("content")))
    filled = F.filter(numbered, lambda x: F.trim(x["content"]) != "")
    rows = df.filter(F.col(id_column).isNotNull()).select(*_identity(id_column, text), F.posexplode(filled).alias("at", "own"))
    content = F.col("own.content")
    return rows.select("doc", "version", "at", "own.line", F.length(content).cast("long").alias("chars"), F.xxhash64(content).alias("id"), F.xxhash64(F.lit(6), content).alias("other"))


def _ranked(counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys and rank, the first index of each group; counts: keys and n, a staged table. Prefix sums over ranges, written once since ranges are sampled."""
    ranged = staged(counts.repartitionByRange(*keys).withColumn("range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("range").agg(F.sum("n").alias("total"))
    # a row for each range
    before = totals.select("range", (F.sum("total").over(Window.orderBy("range")) - F.col("total")).alias("before"))
    local = F.sum("n").over(Window.partitionBy("range").orderBy(*keys)) - F.col("n")
    ranks = staged(ranged.withColumn("local", local).join(F.broadcast(before), "range").select(*keys, (F.col("before") + F.col("local") + 1).alias("rank")), "ranks")
    release(ranged)
    return ranks


def _doubled(ranks: DataFrame, depth: int) -> DataFrame:
    """(doc, version, at, rank) at depth 2 * depth, of the suffixes that repeat there; ranks: the same at `depth`."""
    along = Window.partitionBy("doc", "version").orderBy("at").rangeBetween(depth, depth)
    pairs = staged(ranks.select("doc", "version", "at", F.col("rank").alias("own"), F.max("rank").over(along).alias("following")).filter("following is not null"), "pairs")
    counts = staged(pairs.groupBy("own", "following").agg(F.count("*").alias("n")).filter("n > 1"), "pair_counts")
    renamed = _ranked(counts, ["own", "following"])
    out = staged(salted(pairs, renamed, ["own", "following"], "doc", counts=counts, rows=pairs.count()).select("doc", "version", "at", "rank"), "line_ranks")
    release(pairs, counts, renamed)
    return out


def repeated_runs(df: DataFrame, id_column: str, text_column: str, least: int = LEAST) -> DataFrame:
    """(doc, version, first, last): lines to delete in each document; ranges are maximal and don't touch. A staged table."""
    lines = staged(_lines(df, id_column, text_column), "lines")
    counts = staged(lines.groupBy("id", "other").agg(F.count("*").alias("n")).filter("n > 1"), "line_counts")
    named = _ranked(counts, ["id", "other"])
    repeated = salted(lines, named, ["id", "other"], "doc", counts=counts, rows=lines.count()).drop("id", "other")
    # a gap in `at` ends a segment
    along = Window.partitionBy("doc", "version").orderBy("at")
    within = Window.partitionBy("doc", "version", "segment")
    segments = repeated.dropDuplicates(["doc", "version", "at"]).withColumn("segment", F.col("at") - F.row_number().over(along))
    places = staged(segments.withColumn("reached", F.sum("chars").over(within.orderBy("at"))).withColumn("passed", F.col("reached") - F.col("chars")), "places")
    release(lines, counts, named)
    # the shortest runs of `least` characters from each line on, and up to each line
    onwards = within.orderBy("passed").rangeBetween(0, least - 1)
    back = within.orderBy("reached").rangeBetween(-(least - 1), 0)
    found = [places.select("doc", "version", *[f(c).over(w).alias(n) for f, c, n in ((F.min, "at", "start"), (F.max, "at", "stop"), (F.min, "line", "first"), (F.max, "line", "last"), (F.sum, "chars", "sum"))]) for w in (onwards, back)]
    size = (F.col("stop") - F.col("start") + 1).alias("size")
    runs = staged(found[0].unionByName(found[1]).filter(F.col("sum") >= least).select("doc", "version", "start", "first", "last", size).distinct(), "runs")
    longest = runs.agg(F.max("size")).first()[0] or 0
    levels, depth = [places.select("doc", "version", "at", "rank")], 1
    made = [places]
    while 2 * depth <= longest:
        levels.append(_doubled(levels[-1], depth))
        made.append(levels[-1])
        depth *= 2
        if levels[-1].isEmpty():
            break
    ranks = reduce(DataFrame.unionByName, [x.withColumn("power", F.lit(k)) for k, x in enumerate(levels)])
    power = F.floor(F.log2(F.col("size") + F.lit(0.5))).cast("int")
    sized = runs.withColumn("power", power).withColumn("second", (F.col("start") + F.col("size") - F.pow(F.lit(2), F.col("power"))).cast("int"))
    keys = ["doc", "version", "power"]
    intervals = staged(
        sized.join(ranks.withColumnsRenamed({"at": "start", "rank": "a"}), [*keys, "start"]).join(ranks.withColumnsRenamed({"at": "second", "rank": "b"}), [*keys, "second"]).select("doc", "version", "first", "last", "size", "a", "b"),
        "intervals",
    )
    release(runs, *made)
    place = F.struct("doc", "version", "first")
    origins = staged(intervals.groupBy("size", "a", "b").agg(F.min(place).alias("origin"), F.count("*").alias("n")).filter("n > 1"), "origins")
    copies = salted(intervals, origins.drop("n"), ["size", "a", "b"], "doc", counts=origins.drop("origin"), rows=intervals.count()).filter(place > F.col("origin")).select("doc", "version", "first", "last").distinct()
    ordered = Window.partitionBy("doc", "version").orderBy("first", "last")
    reach = F.max("last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    # ranges that follow each other with nothing but blank lines between are left apart; deleting both leaves those lines
    islands = copies.withColumn("new", F.when(F.col("first") <= F.coalesce(reach, F.lit(-2)) + 1, 0).otherwise(1)).withColumn("island", F.sum("new").over(ordered))
    out = staged(islands.groupBy("doc", "version", "island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("island"), "line_runs")
    release(intervals, origins)
    return out


def _slots(version: Column, blocks: int) -> tuple[Column, Column, Column]:
    """(block, word, mask) of a text in the filter: four bits of one word; blocks: a power of two."""
    h = F.xxhash64(F.lit(7), version)
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, k).bitwiseAND(63).cast("int")) for k in (24, 30, 36, 42)]
    return h.bitwiseAND(blocks - 1), F.shiftrightunsigned(h, 16).bitwiseAND(BLOCK_WORDS - 1), reduce(Column.bitwiseOR, masks)


def _filtered(keyed: DataFrame, runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """keyed's rows whose text may have a row in runs, and those whose text has none for certain."""
    needed = -(-runs.count() * FILTER_BITS // (BLOCK_WORDS * 64))
    blocks = min(MOST_BLOCKS, 1 << max(0, needed - 1).bit_length())
    block, word, mask = _slots(F.col("version"), blocks)
    empty = runs.sparkSession.range(blocks * BLOCK_WORDS).select(F.floor(F.col("id") / BLOCK_WORDS).alias("block"), (F.col("id") % BLOCK_WORDS).alias("word"), F.lit(0).cast("long").alias("mask"))
    words = runs.select(block.alias("block"), word.alias("word"), mask.alias("mask")).unionByName(empty).groupBy("block", "word").agg(F.bit_or("mask").alias("mask"))
    # a block has all its words, so a word's place is its number
    blocked = words.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("word", "mask")))["mask"].alias("words"))
    met = keyed.withColumn("block", block).join(F.broadcast(blocked), "block", "left")
    may = F.coalesce(F.get("words", word.cast("int")).bitwiseAND(mask) == mask, F.lit(True))
    return met.filter(may).drop("block", "words"), met.filter(~may).drop("block", "words")


def remove_runs(df: DataFrame, id_column: str, text_column: str, least: int = LEAST, names: tuple[str, str, str] = ("__lines", "__removed", "__runs")) -> DataFrame:
    """The rows with text_column replaced by what is kept, and three columns of the given names: lines, lines removed, runs removed."""
    columns = df.columns
    runs = repeated_runs(df, id_column, text_column, least)
    ranges = runs.groupBy("doc", "version").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("ranges"))
    keyed = df.select(F.struct(*[F.col(c) for c in columns]).alias("own"), *_identity(id_column, F.col(text_column).cast("string")))
    some, rest = _filtered(keyed, runs)
    met = some.join(ranges, ["doc", "version"], "left").unionByName(rest.withColumn("ranges", F.lit(None).cast(ranges.schema["ranges"].dataType)))
    joined = met.withColumn("content", F.col("own")[text_column].cast("string")).withColumn("lines", F.split("content", "\n", -1))
    split = F.col("lines")
    starts = F.concat(F.array(F.lit(0)), F.transform("ranges", lambda r: r["last"] + 1))
    stops = F.concat(F.transform("ranges", lambda r: r["first"]), F.array(F.size(split)))
    kept = F.flatten(F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda p: F.slice(split, p["a"] + 1, p["b"] - p["a"])))
    removed = F.aggregate("ranges", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"] + 1)
    text = F.when(F.col("ranges").isNull(), F.col("content")).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[(text if c == text_column else F.col("own")[c]).alias(c) for c in columns],
        F.coalesce(F.size(split), F.lit(0)).cast("long").alias(names[0]),
        F.coalesce(removed, F.lit(0)).cast("long").alias(names[1]),
        F.coalesce(F.size("ranges"), F.lit(0)).cast("long").alias(names[2]),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_lines, n_removed, n_runs, kept_sha256): line counts and the digest of the text that is kept."""
    found = remove_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return found.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.col("__lines")).cast("long").alias("n_lines"),
        F.col("__removed").alias("n_removed"),
        F.when(F.col("__removed") > 0, F.col("__runs")).otherwise(0).cast("long").alias("n_runs"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


#: The same rule by brute force: all shortest runs from and up to each line, grouped by their text.
ORACLE = f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
e AS (SELECT doc_id, unnest(range(0, len(ls))) AS line, unnest(ls) AS content FROM d),
l AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS pos, length(content) AS chars FROM e WHERE trim(content) <> ''),
c AS (SELECT *, sum(chars) OVER (PARTITION BY doc_id ORDER BY pos) AS reached FROM l),
f AS (SELECT a.doc_id, a.pos AS start, min(b.pos) AS stop FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.reached - a.reached + a.chars >= {LEAST} GROUP BY a.doc_id, a.pos),
g AS (SELECT a.doc_id, max(b.pos) AS start, a.pos AS stop FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.pos <= a.pos AND a.reached - b.reached + b.chars >= {LEAST} GROUP BY a.doc_id, a.pos),
w AS (SELECT * FROM f UNION SELECT * FROM g),
r AS (SELECT w.doc_id, w.start, min(line) AS first, max(line) AS last, string_agg(content, chr(10) ORDER BY pos) AS body
  FROM w JOIN c ON c.doc_id = w.doc_id AND c.pos BETWEEN w.start AND w.stop GROUP BY w.doc_id, w.start, w.stop),
x AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, first) AS n FROM r),
k AS (SELECT e.doc_id, e.line, e.content, EXISTS (SELECT 1 FROM x WHERE n > 1 AND x.doc_id = e.doc_id AND e.line BETWEEN first AND last) AS gone FROM e),
m AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY line), false) AS opens FROM k),
s AS (SELECT doc_id, count(*) AS n_lines, count_if(gone) AS n_removed, count_if(opens) AS n_runs, string_agg(CASE WHEN NOT gone THEN content END, chr(10) ORDER BY line) AS kept FROM m GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs,
  sha256(CASE WHEN s.doc_id IS NULL THEN coalesce(text, '') ELSE coalesce(kept, '') END) AS kept_sha256
FROM documents LEFT JOIN s ON documents.doc_id = s.doc_id
"""
