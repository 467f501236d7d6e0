"""Claims of tasks in a stream of events: what a worker neither ends nor gives back within the timeout is released."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The state store that keeps open sessions on disk.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RELEASED = "id string, worker string, claimed_at timestamp, released_at timestamp"


def timed_out(events: DataFrame, timeout_minutes: int = 30, delay: str = "0 seconds", order: Sequence[str] = ()) -> DataFrame:
    """(id, worker, claimed_at, released_at) of claims in a stream of events (id, kind, worker, ts) that no later event of their task followed in time.

    Time is that of the events. Events of a task no more than the timeout apart are a session; its state is its last event, and it
    ends when the watermark, `delay` behind the latest event, passes the timeout after that. A session that ends with a claim is a
    claim timed out. Any event of a task ends its claim; of several at one time they count in the order of their kind (null last),
    then of the columns `order`, then of the worker. Events that arrive out of order count at their own time, those behind the
    watermark are left out, and so are events without an id or a time. Watermarks are in milliseconds. For many tasks set PROVIDER.
    """
    rows = events.where("id is not null and ts is not null").withWatermark("ts", delay)
    last = F.max_by(F.struct("kind", "worker", "ts"), F.struct("ts", F.col("kind").isNull(), "kind", *order, "worker"))
    ended = rows.groupBy("id", F.session_window("ts", f"{int(timeout_minutes)} minutes").alias("_s")).agg(last.alias("_last"))
    return ended.where("_last.kind = 'claimed'").select("id", F.col("_last.worker").alias("worker"), F.col("_last.ts").alias("claimed_at"), F.col("_s.end").alias("released_at"))
