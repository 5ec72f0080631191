"""The request side of recognition: an injected transport, retries, and a cache that only keeps good answers."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesift.operators.tokens import uncached

RESULT = "cache_key string, response string, status int, attempts int, error string, ok boolean"
#: (payload) -> (status, headers, body); raises OSError for a broken connection.
Transport = Callable[[str], tuple[int, dict[str, str], str]]


def retry_after(value: str | None, now: datetime | None = None) -> float | None:
    """Seconds to wait by a Retry-After header: a number, or the time until a date; None if it says nothing useful."""
    if not value:
        return None
    try:
        seconds = float(value)
        return seconds if seconds >= 0 else None
    except ValueError:
        pass
    try:
        then = parsedate_to_datetime(value)
    except (TypeError, ValueError):
        return None
    then = then if then.tzinfo else then.replace(tzinfo=timezone.utc)
    return max(0.0, (then - (now or datetime.now(timezone.utc))).total_seconds())


def request(transport: Transport, payload: str, attempts: int = 4, base: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, int | None, int, str | None]:
    """(body, status, attempts, error): 429, 5xx and broken connections are tried again, other failures are final."""
    status, error = None, None
    for attempt in range(1, attempts + 1):
        headers: dict[str, str] = {}
        try:
            status, headers, body = transport(payload)
        except OSError as problem:
            status, error = None, str(problem) or type(problem).__name__
        else:
            if status == 200:
                return body, status, attempt, None
            error = f"HTTP {status}"
            if status != 429 and status < 500:
                return None, status, attempt, error
        if attempt < attempts:
            wait = retry_after(headers.get("Retry-After"))
            sleep(base * 2 ** (attempt - 1) + random.uniform(0, 0.25) if wait is None else wait)
    return None, status, attempts, error


def has_text(body: str | None) -> bool:
    """An answer worth keeping: it has a message with text."""
    try:
        return bool(str(json.loads(body or "")["choices"][0]["message"]["content"]).strip())
    except (ValueError, KeyError, IndexError, TypeError):
        return False


def answered(requests: DataFrame, transport: Transport, parallel: int = 2, attempts: int = 4, base: float = 1.0) -> DataFrame:
    """One result row for each request (cache_key, payload); `parallel` requests are under way at once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, payload in zip(frame["cache_key"], frame["payload"], strict=True):
                body, status, tried, error = request(transport, payload, attempts, base)
                rows.append((key, body, status, tried, error, body is not None and has_text(body)))
            yield pd.DataFrame(rows, columns=["cache_key", "response", "status", "attempts", "error", "ok"])

    return requests.select("cache_key", "payload").repartition(parallel).mapInPandas(run, RESULT)


def resolve(requests: DataFrame, cache_path: str, transport: Transport, **options) -> DataFrame:
    """Answers for all requests: cached ones are read, the others are asked for once and, if good, appended."""
    spark = requests.sparkSession
    try:
        cache = spark.read.schema(RESULT).parquet(cache_path)
        cache.limit(1).count()
    except Exception as problem:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        cache = spark.createDataFrame([], RESULT)
    fresh = answered(uncached(requests.dropDuplicates(["cache_key"]), cache), transport, **options).persist()
    fresh.filter("ok").write.mode("append").parquet(cache_path)
    known = cache.filter("ok").dropDuplicates(["cache_key"]).join(requests.select("cache_key").distinct(), "cache_key", "left_semi")
    return fresh.withColumn("cache_hit", F.lit(False)).unionByName(known.withColumn("cache_hit", F.lit(True)))
