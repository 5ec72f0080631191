"""URL filter over a sorted digest array.

Rules (host, path prefix, verdict) are laid out once as a sorted array of 64-bit xxhash keys with the full rule
strings behind it. The index files go to every executor with addFile; each Python worker memory-maps them, so all
workers of a host share one copy of the pages. A url probes the digests of its host suffixes joined with its path
prefixes of the lengths that occur among the rules, by vectorised binary search; every digest hit is confirmed on
the stored string, so a collision never decides. Suffixes longer than the longest host of a rule can't fit, so only the
end of a host and the start of a path reach Python.

Cases: a null url or one without "://" has empty host and path and meets no rule; a path is compared from its
first character; of several fitting rules the longest host + path wins, of equal ones the longest host; rules that
repeat must agree. The verdict without a rule is `default` (allow). Repeated rows give repeated results, ids of any
type and null ids stay as they are. A very long url costs no more than the longest rule; an empty table gives no
row, no rules give the default. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import atexit
import mmap
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm.common import held_latest, ship, table

#: The contract's rules as (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def build_index(rules: Sequence[tuple[str, str, str]]) -> dict[str, bytes]:
    """The index files by name: keys (sorted uint64), offsets into strings, verdicts, the longest host, path lengths in use."""
    seen: dict[tuple[str, str], str] = {}
    for host, path, verdict in rules:
        if seen.setdefault((host.lower(), path), verdict) != verdict:
            raise ValueError(f"rules disagree on {host}{path}")
    rows = sorted((xxhash.xxh64_intdigest(f"{h}\n{p}".encode()), h, p, v) for (h, p), v in seen.items())
    strings = [f"{h}\n{p}".encode() for _, h, p, _ in rows]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings], dtype=np.int64)]) if rows else np.zeros(1, np.int64)
    return {
        "keys": np.array([r[0] for r in rows], dtype="<u8").tobytes(),
        "offsets": offsets.astype("<i8").tobytes(),
        "strings": b"".join(strings),
        "verdicts": np.array([r[3] == "block" for r in rows], dtype=np.uint8).tobytes(),
        "longest": np.array([max((len(h) for _, h, _, _ in rows), default=0)], dtype="<i8").tobytes(),
        "lengths": np.unique(np.array([len(r[2]) for r in rows], dtype="<i8")).tobytes(),
    }


class DigestIndex:
    """The memory-mapped index of one set of rules."""

    def __init__(self, files: dict[str, str]) -> None:
        self.keys = self._mapped(files["keys"], "<u8")
        self.offsets = self._mapped(files["offsets"], "<i8")
        self.strings = self._mapped(files["strings"], "u1")
        self.verdicts = self._mapped(files["verdicts"], "u1")
        self.longest = int(self._mapped(files["longest"], "<i8")[0])
        self.lengths = [int(x) for x in self._mapped(files["lengths"], "<i8")]

    @staticmethod
    def _mapped(path: str, kind: str) -> np.ndarray:
        if os.path.getsize(path) == 0:
            return np.zeros(0, dtype=kind)
        with open(path, "rb") as f:
            return np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), dtype=kind)

    def stored(self, i: int) -> bytes:
        return self.strings[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def match(self, hosts: list[str], paths: list[str]) -> list[tuple[str, bool] | None]:
        """For each url the winning rule as (text, blocks), or None."""
        probes: list[bytes] = []
        owner: list[int] = []
        for row, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            if not host:
                continue
            prefixes = [path[:n] for n in self.lengths if n <= len(path)]
            # suffixes after a dot, or the whole host, that are no longer than a rule's host
            at = 0 if len(host) <= self.longest else host.find(".", len(host) - self.longest - 1) + 1 or len(host)
            while at < len(host):
                suffix = host[at:]
                for prefix in prefixes:
                    probes.append(f"{suffix}\n{prefix}".encode())
                    owner.append(row)
                at = host.find(".", at) + 1 or len(host)
        found: list[tuple[int, int, int] | None] = [None] * len(hosts)
        if probes and len(self.keys):
            digests = np.fromiter(map(xxhash.xxh64_intdigest, probes), dtype=np.uint64, count=len(probes))
            at = np.searchsorted(self.keys, digests)
            hits = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == digests)
            for k in hits.tolist():
                i = int(at[k])
                while i < len(self.keys) and self.keys[i] == digests[k]:
                    if self.stored(i) == probes[k]:
                        rank = (len(probes[k]), probes[k].index(b"\n"), i)
                        row = owner[k]
                        if found[row] is None or rank > found[row]:
                            found[row] = rank
                        break
                    i += 1
        return [None if f is None else (self.stored(f[2]).decode().replace("\n", ""), bool(self.verdicts[f[2]])) for f in found]


def _opened(names: dict[str, str]) -> DigestIndex:
    return held_latest("urls", f"index/{names['keys']}", lambda: DigestIndex({k: SparkFiles.get(v) for k, v in names.items()}))


def filter_urls(df: DataFrame, id_column: str, url_column: str, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for each row; no shuffle, only the two columns are read."""
    spark: SparkSession = df.sparkSession
    ship(spark)
    folder = os.path.realpath(tempfile.mkdtemp(prefix="tablesift_rules_"))
    tag = uuid.uuid4().hex[:12]
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    names = {}
    index = build_index(rules)
    nearest, farthest = int(np.frombuffer(index["longest"], "<i8")[0]) + 1, max(np.frombuffer(index["lengths"], "<i8"), default=0)
    for kind, content in index.items():
        names[kind] = f"url_rules_{tag}.{kind}"
        with open(os.path.join(folder, names[kind]), "wb") as f:
            f.write(content)
        spark.sparkContext.addFile(os.path.join(folder, names[kind]))
    rest = F.when(F.contains(F.col("u"), F.lit("://")), F.expr("substring(u, length(substring_index(u, '://', 1)) + 4)")).otherwise(F.lit(""))
    parts = (
        df.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("u"))
        .select("id", F.coalesce(rest, F.lit("")).alias("rest"))
        .select(
            "id",
            F.translate(F.regexp_extract("rest", "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
            F.regexp_extract("rest", "(?s)^[^/?#]*([^?#]*)", 1).alias("path"),
        )
        .select("*", F.when(F.length("host") > nearest, F.substring("host", -nearest, nearest)).otherwise(F.col("host")).alias("near"), F.substring("path", 1, int(farthest)).alias("head"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _opened(names)
        for batch in batches:
            hosts, paths = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            won = index.match(hosts, paths)
            rule = pa.array([w and w[0] for w in won], pa.string())
            verdict = pa.array([default if w is None else "block" if w[1] else "allow" for w in won], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), rule, verdict], names=["id", "host", "path", "rule", "verdict"])

    kind = df.schema[id_column].dataType.simpleString()
    out = parts.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_column)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), "page_id", "url")


_FITS = "CASE WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}' END"
ORACLE = f"""
WITH r AS (SELECT page_id, CASE WHEN url IS NOT NULL AND contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
m AS (SELECT page_id, host, path, unnest([{", ".join(_FITS.format(h=h, p=p) for h, p, _ in RULES)}, '']) AS rule FROM p),
w AS (SELECT page_id, host, path, nullif(max_by(rule, length(rule)), '') AS rule FROM m WHERE rule IS NOT NULL GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, CASE {" ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in RULES)} ELSE 'allow' END AS verdict FROM w
"""
