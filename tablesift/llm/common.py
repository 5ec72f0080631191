"""What the corpus operators share: shared scratch tables, text chunks, the words of the contracts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.session import ship, table

__all__ = ["ship", "table", "shared_folder", "staged", "release", "scratch", "release_paths", "salted", "chunks", "integer_id", "fresh", "held", "held_latest", "crc_mod"]

T = TypeVar("T")

_MADE: dict[str, SparkSession] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one of our own where it is unset (tests, local runs)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = getattr(spark.sparkContext, "_tablesift_scratch", None)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="tablesift_shared_")
        spark.sparkContext._tablesift_scratch = folder
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read again: lineage ends here and a lost executor costs no rework.

    The folder goes by `release`, or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tablesift_{name}_{uuid.uuid4().hex}"
    df.write.parquet(path)
    _MADE[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._tablesift_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Deletes tables of `staged` that nothing reads any more."""
    for frame in frames:
        _delete(frame._tablesift_path)


def scratch() -> set[str]:
    """The tables of `staged` that exist now."""
    return set(_MADE)


def release_paths(paths: Iterable[str]) -> None:
    for path in paths:
        _delete(path)


def _delete(path: str) -> None:
    spark = _MADE.pop(path, None)
    if spark is not None:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _clear() -> None:
    for path in list(_MADE):
        try:
            _delete(path)
        except Exception:  # noqa: BLE001  the session may be gone already; scratch is not worth a failing exit
            continue


atexit.register(_clear)

#: Rows of one key that a task takes whatever the table's size.
KEY_ROWS = 2048


def salted(left: DataFrame, right: DataFrame, keys: list[str], spread: str, how: str = "inner", counts: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """left.join(right, keys, how) in which no key of `left` is the work of one task.

    A key with more than its share of left's rows (KEY_ROWS, or a quarter of the mean of a shuffle partition) is dealt by
    a hash of the column `spread`, and right's rows for it are repeated. There are at most four such keys for each shuffle partition,
    so they are broadcast. left: a staged table, since it is counted, unless counts (keys and n) and rows (their sum)
    are known already.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(KEY_ROWS, (left.count() if rows is None else rows) // (4 * parts))
    found = left.groupBy(*keys).agg(F.count("*").alias("n")) if counts is None else counts
    names = [fresh([*left.columns, *right.columns], n) for n in ("salts", "salt")]
    hot = F.broadcast(found.filter(F.col("n") > share).select(*keys, F.ceil(F.col("n") / share).cast("int").alias(names[0])))
    salts = F.coalesce(F.col(names[0]), F.lit(1))
    dealt = left.join(hot, keys, "left").withColumn(names[1], F.pmod(F.xxhash64(spread), salts).cast("int")).drop(names[0])
    copies = right.join(hot, keys, "left").withColumn(names[1], F.explode(F.sequence(F.lit(0), salts - 1))).drop(names[0])
    return dealt.join(copies, [*keys, names[1]], how).drop(names[1])


def chunks(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) in slices of at most `most` bytes, or of one longer text, so that Python objects of only one slice live at a time."""
    values = batch.column(batch.schema.get_field_index(column))
    ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(values):
        passed = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, passed + most, side="right")))
        yield start, values.slice(start, stop - start).to_pylist()
        start = stop


_HELD: dict[str, object] = {}


def held(owner: str, key: str, make: Callable[[], T]) -> T:
    """What a Python worker keeps between tasks for one operator. Another operator's things go first, since workers are reused."""
    if _HELD.get("owner") != owner:
        _HELD.clear()
        _HELD["owner"] = owner
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]


def held_latest(owner: str, key: str, make: Callable[[], T]) -> T:
    """As held, but a new key replaces the owner's older ones of the same name; key: name/version."""
    if _HELD.get("owner") == owner and key not in _HELD:
        name = key.partition("/")[0]
        for old in [k for k in _HELD if k.partition("/")[0] == name]:
            del _HELD[old]
    return held(owner, key, make)


def fresh(columns: list[str], name: str) -> str:
    """The name, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def integer_id(df: DataFrame, column: str) -> None:
    """Ids that travel as 64-bit integers must be such; others are a TypeError instead of a failing task."""
    if df.schema[column].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{column} is {df.schema[column].dataType.simpleString()}; this operator needs an integer id")


def crc_mod(column: str, mod: int) -> Column:
    """crc32 of an id written as text, modulo `mod`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(mod))
