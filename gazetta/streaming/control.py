"""Rate control and micro-batches: token buckets, runtime budgets, flushing and merging as a stream."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gazetta.sinks import master


class TokenBucket:
    """Lets a call through every 1 / qps seconds; a rate of 0 or less counts as 0.1. acquire returns the seconds waited."""

    def __init__(self, qps: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.qps, self.clock, self.sleep = qps if qps > 0 else 0.1, clock, sleep
        self.tokens, self.seen = 0.0, clock()  # the first call waits too

    def acquire(self) -> float:
        now = self.clock()
        self.tokens = min(1.0, self.tokens + (now - self.seen) * self.qps)
        self.seen = now
        wait = max(0.0, (1.0 - self.tokens) / self.qps)
        if wait:
            self.sleep(wait)
            self.seen = self.clock()
            self.tokens = 1.0
        self.tokens -= 1.0
        return wait


def await_within(query: StreamingQuery, seconds: float | None) -> None:
    """Waits for a streaming query; beyond the budget it is stopped and a TimeoutError raised."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"the run took more than {seconds} s")


def persist_step(n_chars: int) -> int:
    """Completed tokens after which progress is saved: 500 for more than 100 keywords, else each."""
    return 500 if n_chars > 100 else 1


def merge_stream(details: DataFrame, root: str, checkpoint: str, run_id: str, every: str | None = None) -> StreamingQuery:
    """Appends a stream of detail rows to the master table under root, one run for each micro-batch (our addition).

    A batch that runs again after a failure finds that it was put in, so it counts once.
    """
    writer = details.writeStream.foreachBatch(lambda batch, number: master.append(batch, root, run_id, stream=checkpoint, number=number)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def flush_stream(rows: DataFrame, path: str, checkpoint: str, at_most: int = 1000) -> StreamingQuery:
    """Appends a stream to Parquet files of at most so many rows (our addition)."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).option("maxRecordsPerFile", at_most).trigger(availableNow=True).start()


def latest_events(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """First of each event id within the watermark (our addition)."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
