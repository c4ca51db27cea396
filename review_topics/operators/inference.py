"""Batch model inference with an injected provider and a ledger of finished calls."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_topics import fixed_values as V
from review_topics import schemas
from review_topics.session import path_exists, scratch_path, stage, unstage

# Requests of one slice: what a run that was cut off may have to ask again.
SLICE_ROWS = 10_000
# Share of limited calls from which fewer are sent.
LIMITED_SHARE = 0.1


class RateLimited(Exception):
    """Raised by a provider when the call may be tried again later; ``wait`` is the provider's hint in seconds."""

    def __init__(self, wait: float | None = None):
        super().__init__(wait)
        self.wait = wait


class Provider(Protocol):
    """Picklable client. One copy lives in each task; its calls may come from several threads."""

    def complete(self, request_id, request: str, attempt: int) -> tuple[list[str], str | None]:
        """Arguments of the tool calls, and the plain content."""


def _call(provider: Provider, request_id, request: str, attempt: int, longest: float) -> tuple:
    try:
        tool_args, content = provider.complete(request_id, request, attempt)
        return (request_id, attempt, "ok", tool_args, content)
    except RateLimited as limited:
        if limited.wait:
            time.sleep(min(limited.wait, longest))
        return (request_id, attempt, "rate_limited", [], None)
    except Exception as error:  # an outcome to report, not a reason to lose the other rows
        return (request_id, attempt, "error", [], f"{type(error).__name__}: {error}")


def infer(
    requests: DataFrame,
    provider: Provider,
    attempt: int = 1,
    max_in_flight: int = V.MAX_IN_FLIGHT,
    backoff: tuple[float, float] | None = V.BACKOFF_SECONDS,
    calls_per_task: int = 1,
) -> DataFrame:
    """One reply row per ``(id, request)`` row, whatever the outcome of the call; ids keep their type.

    At most ``max_in_flight`` calls run at once: ``calls_per_task`` in each of as many tasks as that allows. In a later
    attempt each task waits once, before its first call, and otherwise only as long as the provider asks.
    """
    if not 1 <= calls_per_task <= max_in_flight:
        raise ValueError("calls_per_task must be from 1 to max_in_flight")
    schema = schemas.reply_schema(requests.schema["id"].dataType)

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high = backoff or (0.0, 0.0)
        waited = attempt == 1 or backoff is None
        with ThreadPoolExecutor(calls_per_task) as slots:
            for batch in batches:
                if not waited and len(batch):
                    time.sleep(random.uniform(low, min(high, low * 2**attempt)))
                    waited = True
                ask = partial(_call, provider, attempt=attempt, longest=high)
                rows = list(slots.map(ask, batch["id"].tolist(), batch["request"].tolist()))
                yield pd.DataFrame(rows, columns=schema.names)

    return requests.select("id", "request").repartition(max_in_flight // calls_per_task).mapInPandas(call, schema)


def next_window(window: int, asked: int, limited: int, most: int, step: int = 1) -> int:
    """Calls to keep in flight next: half of the window where more than LIMITED_SHARE of its calls were limited, else ``step`` more."""
    if asked and limited > LIMITED_SHARE * asked:
        return max(1, window // 2)
    return min(most, window + step)


def infer_with_retries(
    requests: DataFrame,
    provider: Provider,
    ledger: str | None = None,
    attempts: int = V.MAX_ATTEMPTS,
    max_in_flight: int = V.MAX_IN_FLIGHT,
    backoff: tuple[float, float] | None = V.BACKOFF_SECONDS,
    slice_rows: int = SLICE_ROWS,
    calls_per_task: int = 1,
) -> DataFrame:
    """Call until every request has succeeded, failed for good or used its attempts; returns the ledger.

    Requests without a finished call and with attempts left are written once, in slices of about ``slice_rows``. Slices
    follow each other, so the number of tasks grows with the data while the calls in flight stay bounded. Every attempt
    of a slice is committed to a folder of its own before anything reads it, because a model call is neither free nor
    repeatable: a run that was cut off is started again with the same ledger and repeats one attempt of one slice.

    The calls in flight follow the provider's limit: they start at ``max_in_flight``, and what share of a committed attempt was
    limited decides about the next one (next_window). They never pass ``max_in_flight``, in as many tasks as ``calls_per_task``
    allows.
    """
    spark = requests.sparkSession
    ledger = ledger or scratch_path(spark, "ledger")
    schema = schemas.reply_schema(requests.schema["id"].dataType)

    def read(path: str) -> DataFrame:
        rows = spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
        return rows.select(*schema.names)

    seen = read(ledger).groupBy("id").agg(
        F.max("attempt").alias("last_attempt"), F.bool_or(F.col("status") != "rate_limited").alias("finished")
    )
    last = F.coalesce("last_attempt", F.lit(0))
    wanted = requests.select("id", "request").join(seen, "id", "left").where(~F.coalesce("finished", F.lit(False)) & (last < attempts))
    wanted = stage(wanted.select("id", "request", last.alias("last_attempt")), "requests")
    slices = max(1, -(-wanted.count() // slice_rows))
    sliced = scratch_path(spark, "slices")
    numbered = wanted.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int"))
    numbered.repartition(slices, "slice").write.partitionBy("slice").parquet(sliced)
    unstage(wanted)
    window = max_in_flight
    for part in range(slices):
        folder = f"{sliced}/slice={part}"
        if not path_exists(spark, folder):
            continue
        own = spark.read.schema(wanted.schema).parquet(folder)
        again = None  # what the attempt before left open
        for attempt in range(1, attempts + 1):
            due = own.where(F.col("last_attempt") == attempt - 1)
            if again is not None:
                due = due.unionByName(own.join(again, "id", "left_semi"))
            path = f"{ledger}/round={uuid.uuid4().hex}"
            infer(due, provider, attempt, window, backoff, min(calls_per_task, window)).write.parquet(path)
            asked, limited = read(path).agg(F.count("*"), F.count_if(F.col("status") == "rate_limited")).first()
            if not asked:
                break
            window = next_window(window, asked, limited, max_in_flight, calls_per_task)
            again = read(path).where("status = 'rate_limited'").select("id")
    return read(ledger)


def latest_replies(ledger: DataFrame) -> DataFrame:
    """The last attempt of each request."""
    last = F.max_by(F.struct("attempt", "status", "tool_args", "content"), "attempt")
    return ledger.groupBy("id").agg(last.alias("r")).select("id", "r.*")
