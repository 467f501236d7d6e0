"""The state of fetch tasks: counts, claims, reconciliation with a master table, and dealing out to workers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.operators.lineage import cut
from gazetta.schemas import STATUSES


def priority(status: Column, order: Sequence[str] = ("pending", "retry", "failed", "claimed")) -> Column:
    out = F.lit(len(order))
    for k, name in reversed(list(enumerate(order))):
        out = F.when(status == name, k).otherwise(out)
    return out


def claimable(tasks: DataFrame, now: Column, timeout_minutes: int = 30, status: str = "status", since: str = "claimed_at") -> DataFrame:
    """Tasks that are pending, to retry or failed, and claims older than the timeout."""
    stale = (F.col(status) == "claimed") & (F.col(since).cast("timestamp") < now - F.expr(f"interval {int(timeout_minutes)} minutes"))
    return tasks.where(F.col(status).isin("pending", "retry", "failed") | stale)


def claim_batch(tasks: DataFrame, size: int, now: Column, timeout_minutes: int = 30) -> DataFrame:
    """The next tasks to claim: by priority of their status, then the longest untouched, then the id."""
    return claimable(tasks, now, timeout_minutes).orderBy(priority(F.col("status")), "updated_at", "id").limit(size)


def claimable_order(tasks: DataFrame) -> DataFrame:
    """All unclaimed open tasks in claim order; read it with toLocalIterator to stream."""
    return tasks.where(F.col("status").isin("pending", "retry", "failed")).orderBy(priority(F.col("status")), "updated_at", "id")


def claimed(tasks: DataFrame, ids: DataFrame, worker: Column, now: Column) -> DataFrame:
    return _set(tasks, ids, {"status": F.lit("claimed"), "claimed_by": worker, "claimed_at": now, "updated_at": now})


def _set(tasks: DataFrame, ids: DataFrame, values: dict[str, Column], where: Column | None = None) -> DataFrame:
    rows = tasks.join(ids.select("id").distinct().withColumn("_hit", F.lit(True)), "id", "left")
    hit = F.coalesce("_hit", F.lit(False)) & (F.lit(True) if where is None else where)
    return rows.select(*[F.when(hit, values[c]).otherwise(F.col(c)).cast(tasks.schema[c].dataType).alias(c) if c in values else F.col(c) for c in tasks.columns])


def mark_done(tasks: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    return _set(tasks, ids, {"status": F.lit("done"), "done_at": now, "updated_at": now, "last_error": F.lit(None)})


def mark_open(tasks: DataFrame, errors: DataFrame, status: str, now: Column) -> DataFrame:
    """Tasks of errors (id, error) marked retry or failed: one more attempt, the error cut to 500 characters.

    Errors are cut before they are grouped (the greatest, cut, is the greatest of the cut ones) and merged, never
    broadcast: Spark takes a computed text for 20 bytes, so whole ones would pass through the driver unseen.
    """
    short = errors.select("id", F.substring("error", 1, 500).alias("error"))
    rows = tasks.join(short.groupBy("id").agg(F.max("error").alias("_error"), F.lit(True).alias("_hit")).hint("merge"), "id", "left")
    hit = F.coalesce("_hit", F.lit(False))
    values = {"status": F.lit(status), "last_error": F.col("_error"), "attempts": F.coalesce("attempts", F.lit(0)) + 1, "updated_at": now}
    return rows.select(*[F.when(hit, values[c]).otherwise(F.col(c)).cast(tasks.schema[c].dataType).alias(c) if c in values else F.col(c) for c in tasks.columns])


def release_claims(tasks: DataFrame, now: Column) -> DataFrame:
    """All claims back to pending."""
    was = F.col("status") == "claimed"
    values = {"status": F.lit("pending"), "claimed_by": F.lit(None), "claimed_at": F.lit(None), "updated_at": now}
    return tasks.select(*[F.when(was, values[c]).otherwise(F.col(c)).cast(tasks.schema[c].dataType).alias(c) if c in values else F.col(c) for c in tasks.columns])


def to_mark_done(tasks: DataFrame, master: DataFrame) -> DataFrame:
    """Tasks that the master table has but that are not done."""
    return tasks.where(F.coalesce(F.col("status") != "done", F.lit(False))).join(master.select("id"), "id", "left_semi")


def sync_done(tasks: DataFrame, master: DataFrame, now: Column) -> DataFrame:
    return _set(tasks, master, {"status": F.lit("done"), "done_at": now, "updated_at": now}, F.col("status") != "done")


def inconsistent(tasks: DataFrame, master: DataFrame, null_aware: bool = True) -> DataFrame:
    """Tasks that are done but not in the master table. Null-aware as NOT IN: one null id in the master gives no rows."""
    rows = tasks.where(F.col("status") == "done").join(master.where("id is not null").select("id"), "id", "left_anti")
    if null_aware:
        some = master.where("id is null").limit(1).select(F.lit(1).alias("_one"))
        rows = rows.join(some, F.col("_one") == 1, "left_anti")
    return rows


def fix_inconsistent(tasks: DataFrame, master: DataFrame, now: Column) -> DataFrame:
    return _set(tasks, inconsistent(tasks, master), {"status": F.lit("pending"), "done_at": F.lit(None), "updated_at": now})


def status_counts(tasks: DataFrame, column: str = "status", known: Sequence[str] = STATUSES) -> DataFrame:
    """Rows for each status, zero for known ones that do not occur; unknown statuses are kept, and `total` comes last."""
    spark = tasks.sparkSession
    counted = tasks.groupBy(F.col(column).alias("status")).agg(F.count("*").alias("n"))
    base = spark.createDataFrame([(s,) for s in known], "status string")
    rows = base.join(counted, "status", "full").select("status", F.coalesce("n", F.lit(0)).alias("n"))
    return rows.unionByName(counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(F.lit("total").alias("status"), "n"))


def last_updated(tasks: DataFrame, column: str = "updated_at") -> DataFrame:
    return tasks.agg(F.max(column).alias("last_updated"))


def numbered(rows: DataFrame, order: Sequence[str], name: str = "_n") -> DataFrame:
    """Rows with their place (from 0) in a total order, without sorting all rows in one task.

    Rows are range-partitioned and sorted; partition counts, one small row each, shift the places within.
    The ranges are cut from their lineage, since counts and rows must see the same ones.
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    placed = cut(placed.withColumn("_k", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = placed.groupBy("_p").agg(F.count("*").alias("_c"))
    shift = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_p", F.coalesce(F.sum("_c").over(shift), F.lit(0)).alias("_s"))
    return placed.join(F.broadcast(starts), "_p").withColumn(name, F.col("_s") + F.col("_k")).drop("_p", "_k", "_s")


def round_robin(rows: DataFrame, workers: int, order: Sequence[str]) -> DataFrame:
    """worker_id = place in the order modulo workers."""
    return numbered(rows, order).withColumn("worker_id", (F.col("_n") % workers).cast("int")).drop("_n")


def first_of_each(rows: DataFrame, by: str, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of each worker; n = 0 means all."""
    if not n:
        return rows
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_k") <= n).drop("_k")


def exact_sample(rows: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n rows without replacement, all if there are fewer: those whose hash with the seed is least, so the same ones however the rows are partitioned."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in rows.columns])
    return rows.withColumn("_r", F.md5(text)).orderBy("_r").limit(n).drop("_r")
