"""Queries over append-only tables: the master table in runs and the task log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.operators.lineage import scratch
from gazetta.plans.registry import ORACLE_SQL, query, table
from gazetta.plans.storage import _detail_rows
from gazetta.plans.updates import _half
from gazetta.sinks import buckets, master, pool, tasklog
from gazetta.streaming import claims, control

_DAYS = ("2024-01-11", "2024-01-21")
_TURN = f"CASE WHEN ts < TIMESTAMP '{_DAYS[0]}' THEN 0 WHEN ts < TIMESTAMP '{_DAYS[1]}' THEN 1 ELSE 2 END"


@query(
    f"SELECT id, arg_max(event_type, (ts, event_id)) AS place_code, 'run ' || max({_TURN}) AS source_run_id, lpad(arg_max(event_id, (ts, event_id))::VARCHAR, 12, '0') AS source_worker_id FROM (SELECT *, user_id::VARCHAR || event_type AS id FROM events) GROUP BY id"
)
def master_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches of details, by ten days each, appended to a master table as runs. Ids are users and event types."""
    root = scratch(spark, "master")
    rows = _detail_rows(spark, sf_dir).withColumn("id", F.concat("id", "place_code"))
    day = F.substring("fetched_at", 1, 10)
    turn = F.when(day < _DAYS[0], 0).when(day < _DAYS[1], 1).otherwise(2)
    master.create(spark, root, buckets=8)
    for k in range(3):
        master.append(rows.where(turn == k), root, f"run {k}")
    return master.read(spark, root).select("id", "place_code", "source_run_id", "source_worker_id")


#: What the events of the given table say of a task.
_KIND = {"signup": "added", "click": "claimed", "view": "done", "error": "retry", "purchase": "released"}
_KINDS = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _KIND.items()) + " END"


@query(f"""
WITH e AS (SELECT user_id::VARCHAR || '-' || (event_id % 40) AS id, {_KINDS} AS kind, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS moment, props AS error, event_id AS step, (ts < TIMESTAMP '{_DAYS[0]}')::INTEGER AS early FROM events),
r AS (SELECT *, row_number() OVER (ORDER BY {"CASE early WHEN 1 THEN 0 ELSE 1 END"}, step) AS k FROM e)
SELECT id,
    coalesce(CASE arg_max(kind, k) FILTER (kind <> 'added') WHEN 'released' THEN 'pending' ELSE arg_max(kind, k) FILTER (kind <> 'added') END, 'pending') AS status,
    CASE WHEN arg_max(kind, k) FILTER (kind IN ('claimed', 'released')) = 'claimed' THEN 'w' || arg_max(length(error), k) FILTER (kind IN ('claimed', 'released')) END AS claimed_by,
    CASE WHEN arg_max(kind, k) FILTER (kind IN ('claimed', 'released')) = 'claimed' THEN arg_max(moment, k) FILTER (kind IN ('claimed', 'released')) END AS claimed_at,
    arg_max(moment, k) FILTER (kind = 'done') AS done_at,
    count(*) FILTER (kind = 'retry')::INTEGER AS attempts,
    CASE WHEN arg_max(kind, k) FILTER (kind IN ('done', 'retry')) = 'retry' THEN arg_max(error, k) FILTER (kind IN ('done', 'retry')) END AS last_error,
    coalesce(arg_max(moment, k) FILTER (kind <> 'added'), arg_min(moment, k)) AS updated_at
FROM r GROUP BY id
""")
def task_log_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a task log in three commits; the first become a snapshot, the last are folded in when the log is read."""
    root, at = scratch(spark, "tasks"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.create_map(*[F.lit(x) for pair in _KIND.items() for x in pair])
    events = table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_id") % 40).alias("id"), F.element_at(kind, F.col("event_type")).alias("kind"), F.concat(F.lit("w"), F.length("props")).alias("worker"),
        at.alias("at"), F.col("props").alias("error"), F.col("event_id").alias("step"), (F.col("ts") < F.lit(_DAYS[0]).cast("timestamp_ntz")).alias("early"),
    )
    later = events.where("not early")
    middle = F.lit(later.agg(F.percentile_approx("step", 0.5)).first()[0])
    tasklog.append(events.where("early"), root)
    tasklog.append(later.where(F.col("step") <= middle), root, share=1e9)
    tasklog.append(later.where(F.col("step") > middle), root, share=1e9)
    return tasklog.read(spark, root)


@query("SELECT DISTINCT id FROM (SELECT o_custkey::VARCHAR AS id FROM orders UNION ALL SELECT c_custkey::VARCHAR FROM customer UNION ALL SELECT 'p' || l_partkey FROM lineitem)")
def insert_ignore_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders, then all customers and the parts of line items put into a pool that has Bloom filters."""
    root = scratch(spark, "pool")
    pool.create(spark, root, buckets=8)
    pool.insert_ignore(table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("id")), root)
    pool.insert_ignore(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id")), root)
    pool.insert_ignore(table(spark, sf_dir, "lineitem").select(F.concat(F.lit("p"), "l_partkey").alias("id")), root)
    return pool.read(spark, root)


@query(ORACLE_SQL["upsert_keep_captured"])
def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As upsert_keep_captured, with the old and the new table bucketed by id."""
    name = f"divisions_{uuid.uuid4().hex}"
    buckets.store(_half(spark, sf_dir, False), f"{name}_old", ["id"], 8)
    out = buckets.put_in(spark, f"{name}_old", f"{name}_new", _half(spark, sf_dir, True), ["id"], keep=["captured_at"])
    spark.sql(f"DROP TABLE {name}_old")
    return out


@query(f"""
WITH e AS (SELECT user_id::VARCHAR || '-' || (event_id % 40) AS id, {_KINDS} AS kind, 'w' || length(props) AS worker, ts, event_id FROM events),
n AS (SELECT *, lead(ts) OVER (PARTITION BY id ORDER BY ts, kind, event_id) AS following FROM e)
SELECT id, worker, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS claimed_at FROM n
WHERE kind = 'claimed' AND (following > ts + INTERVAL 2 DAY OR following IS NULL AND ts + INTERVAL 2 DAY < (SELECT max(ts) FROM events))
""")
def claims_timed_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims in a stream of the events that nothing followed within two days, by sessions in state."""
    kind = F.create_map(*[F.lit(x) for pair in _KIND.items() for x in pair])
    source, out, mark = scratch(spark, "events"), scratch(spark, "released"), scratch(spark, "mark")
    table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("event_id") % 40).alias("id"), F.element_at(kind, F.col("event_type")).alias("kind"), F.concat(F.lit("w"), F.length("props")).alias("worker"),
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("step"),
    ).write.parquet(source)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, claims.PROVIDER)
    try:
        rows = claims.timed_out(spark.readStream.schema("id string, kind string, worker string, ts timestamp, step long").parquet(source), 2 * 24 * 60, order=["step"])
        control.await_within(rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start(), 600)
    finally:
        spark.conf.unset(provider) if before is None else spark.conf.set(provider, before)
    return spark.read.schema(claims.RELEASED).parquet(out).select("id", "worker", F.date_format("claimed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("claimed_at"))
