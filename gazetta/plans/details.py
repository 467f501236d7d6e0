"""A detail run from end to end: claim tasks, fetch them with retries, mark them, and merge the details into the master table."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.operators import projection, stats
from gazetta.operators.lineage import cut
from gazetta.sinks import master, tasklog
from gazetta.sources import replay


class DetailRun(NamedTuple):
    tasks: DataFrame
    master: DataFrame
    batches: int
    done: int
    failed: int


def read_tasks(spark: SparkSession, folder: str) -> DataFrame:
    """The tasks of a run as they are now."""
    return tasklog.read(spark, f"{folder}/tasks")


def run_details(
    spark: SparkSession, folder: str, fetch: Callable[[str], tuple[int, str]], run_id: str, ids: DataFrame | None = None, batch: int = 5000, attempts: int = 3, most_attempts: int = 5, qps: float = 0.0,
    seconds: float | None = None, worker: str = "w0", sleep: Callable[[float], None] = time.sleep,
) -> DetailRun:
    """Fetches the details of all open tasks under folder, `batch` at a time, until none is left or the seconds are over.

    folder/tasks holds the log of the tasks, folder/master the master table; a batch appends to both and rewrites
    neither. ids not yet among the tasks are added. Several runs may share a folder under different worker names: each
    task is claimed by one of them. A run that was killed goes on where it stopped: what its worker had claimed is
    given back first, and tasks that the master has are marked done, as a batch goes into the master before its tasks are marked.
    Tasks that fail are marked retry, and failed after `most_attempts`; failed ones are not tried again in this run.
    """
    began = time.monotonic()
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    log, details = f"{folder}/tasks", f"{folder}/master"
    tasklog.release(spark, log, worker, now)
    if ids is not None:
        tasklog.add(ids, log, now)
    tasklog.settle(spark, log, master.read(spark, details), now)
    batches = done = failed = 0
    while seconds is None or time.monotonic() - began < seconds:
        chosen = tasklog.claim(spark, log, worker, batch, F.current_timestamp(), where=F.col("status") != "failed")
        if chosen.isEmpty():
            break
        tried = chosen.select("id", F.coalesce("attempts", F.lit(0)).alias("_tried"))
        results = cut(replay.fetch_details(chosen.select("id"), fetch, qps, attempts, sleep).join(tried, "id"))
        good = results.where("ok")
        master.append(projection.detail_rows(good, F.col("_tried") + 1, F.lit(worker), now), details, run_id)
        kind = F.when(F.col("ok"), "done").when(F.col("_tried") + 1 >= most_attempts, "failed").otherwise("retry")
        tasklog.append(results.select("id", kind.alias("kind"), F.lit(worker).alias("worker"), now.alias("at"), "error"), log)
        n = results.agg(F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("bad")).first()
        batches, done, failed = batches + 1, done + n.good, failed + n.bad
    return DetailRun(read_tasks(spark, folder), master.read(spark, details), batches, done, failed)


#: Calls a second that a calibration tries, one level after another.
LADDER = (1, 2, 5, 10, 20, 30, 50)


class Calibration(NamedTuple):
    levels: DataFrame  #: latency_summary by qps, of the levels that were tried
    calls: DataFrame  #: FetchResult rows with their qps
    rate: DataFrame  #: one row, as stats.safe_rate


def calibrate(ids: DataFrame, fetch: Callable[[str], tuple[int, str]], ladder: Sequence[float] = LADDER, seconds: float = 30.0, sample: int = 100) -> Calibration:
    """Places calls for `sample` ids (by a hash of the id) at each rate of the ladder; the first level with a 429 or 403 is the last.

    A level makes as many calls as its rate allows in `seconds`, at most one for each id of the sample, from one
    task, so its token bucket holds the whole rate. No call is tried again.
    """
    chosen = cut(ids.select("id").where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(sample))
    tried: list[DataFrame] = []
    for qps in ladder:
        calls = chosen.limit(max(1, int(qps * seconds))).coalesce(1)
        tried.append(cut(replay.fetch_details(calls, fetch, qps).withColumn("qps", F.lit(float(qps)))))
        if not tried[-1].where("status_code in (403, 429)").isEmpty():
            break
    calls = reduce(DataFrame.unionByName, tried)
    levels = cut(stats.latency_summary(calls, ["qps"]))
    return Calibration(levels, calls, stats.safe_rate(levels))
