"""Queries over keyed updates and task states. Events before the middle of January 2024 are the old table, those after it the new rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.operators import stats, tasks, upsert
from gazetta.plans.registry import query, table

CUT = "2024-01-16 00:00:00"
NOW = "2024-02-01 00:00:00"


def _half(spark: SparkSession, sf_dir: str, new: bool) -> DataFrame:
    """The last event of each user in one half, as a row (id, event_type, value, captured_at, seen)."""
    events = table(spark, sf_dir, "events").where(f"ts {'>=' if new else '<'} timestamp_ntz'{CUT}' and user_id % 10 <> {9 if new else 8}")
    rows = upsert.last_wins(events, ["user_id"], ["ts", "event_id"])
    return rows.select(F.col("user_id").alias("id"), "event_type", "value", F.col("event_id").alias("captured_at"), F.lit("new" if new else "old").alias("seen"))


_HALVES = f"""
    old AS (SELECT user_id AS id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value, arg_max(event_id, (ts, event_id)) AS captured_at, 'old' AS seen FROM events WHERE ts < TIMESTAMP '{CUT}' AND user_id % 10 <> 8 GROUP BY 1),
    new AS (SELECT user_id AS id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value, arg_max(event_id, (ts, event_id)) AS captured_at, 'new' AS seen FROM events WHERE ts >= TIMESTAMP '{CUT}' AND user_id % 10 <> 9 GROUP BY 1)"""


@query("SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2")
def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.last_wins(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2")
def first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.first_wins(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query(f"WITH {_HALVES} SELECT coalesce(n.id, o.id) AS id, coalesce(n.event_type, o.event_type) AS event_type, coalesce(n.value, o.value) AS value, coalesce(o.captured_at, n.captured_at) AS captured_at, coalesce(n.seen, o.seen) AS seen FROM old o FULL JOIN new n ON o.id = n.id")
def upsert_keep_captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.upsert(_half(spark, sf_dir, False), _half(spark, sf_dir, True), ["id"], keep=["captured_at"])


@query(f"WITH {_HALVES} SELECT coalesce(n.id, o.id) AS id, coalesce(n.event_type, o.event_type) AS event_type, coalesce(n.value, o.value) AS value, coalesce(n.captured_at, o.captured_at) AS captured_at, coalesce(n.seen, o.seen) AS seen FROM old o FULL JOIN new n ON o.id = n.id")
def upsert_replace_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.upsert(_half(spark, sf_dir, False), _half(spark, sf_dir, True), ["id"])


@query(
    f"WITH {_HALVES} SELECT coalesce(n.id, o.id) AS id, coalesce(n.event_type, o.event_type) AS event_type, coalesce(CASE WHEN o.value > 20 THEN o.value END, n.value, o.value) AS value, coalesce(n.captured_at, o.captured_at) AS captured_at, coalesce(o.seen, n.seen) AS first_seen, coalesce(n.seen, o.seen) AS last_seen FROM old o FULL JOIN new n ON o.id = n.id"
)
def upsert_master_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = lambda df: df.select("id", "event_type", "value", "captured_at", F.col("seen").alias("first_seen"), F.col("seen").alias("last_seen"))
    rules = {"first_seen": lambda old, new: F.coalesce(old, new), "value": lambda old, new: F.when(old > 20, old).otherwise(new)}
    return upsert.upsert(shape(_half(spark, sf_dir, False)), shape(_half(spark, sf_dir, True)), ["id"], rules=rules)


@query(f"WITH {_HALVES} SELECT coalesce(n.id, o.id)::VARCHAR AS run_id, coalesce(o.source_name, n.source_name) AS source_name, coalesce(n.status, o.status) AS status, coalesce(n.item_count, o.item_count) AS item_count, coalesce(o.started_at, n.started_at) AS started_at FROM (SELECT id, seen AS source_name, event_type AS status, value AS item_count, captured_at AS started_at FROM old) o FULL JOIN (SELECT id, seen AS source_name, event_type AS status, value AS item_count, captured_at AS started_at FROM new) n ON o.id = n.id")
def run_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = lambda df: df.select(F.col("id").cast("string").alias("run_id"), F.col("seen").alias("source_name"), F.col("event_type").alias("status"), F.col("value").alias("item_count"), F.col("captured_at").alias("started_at"))
    return upsert.upsert_runs(shape(_half(spark, sf_dir, False)), shape(_half(spark, sf_dir, True)))


@query(f"WITH {_HALVES} SELECT coalesce(n.id, o.id) AS parent_code, coalesce(n.captured_at, o.captured_at) AS fetched_at FROM old o FULL JOIN new n ON o.id = n.id")
def marker_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = lambda df: df.select(F.col("id").alias("parent_code"), F.col("captured_at").alias("fetched_at"))
    return upsert.upsert_marks(shape(_half(spark, sf_dir, False)), shape(_half(spark, sf_dir, True)))


@query(f"WITH {_HALVES} SELECT (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '{CUT}' AND user_id % 10 <> 9) AS rows_read, count(*) FILTER (o.id IS NULL) AS inserted, (SELECT count(*) FROM events WHERE ts >= TIMESTAMP '{CUT}' AND user_id % 10 <> 9) - count(*) FILTER (o.id IS NULL) AS updated FROM new n LEFT JOIN old o ON o.id = n.id")
def upsert_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where(f"ts >= timestamp_ntz'{CUT}' and user_id % 10 <> 9").select(F.col("user_id").alias("id"))
    return upsert.merge_counts(_half(spark, sf_dir, False), rows)


@query("SELECT doc_id AS id FROM labels UNION SELECT doc_id FROM documents")
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id").alias("id")
    return upsert.insert_ignore(table(spark, sf_dir, "labels").select(key).distinct(), table(spark, sf_dir, "documents").select(key)).table


@query("SELECT count(DISTINCT doc_id) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) AS added, count(*) - count(DISTINCT doc_id) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) AS existed, count(*) AS total FROM documents")
def insert_ignore_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id").alias("id")
    return upsert.insert_ignore(table(spark, sf_dir, "labels").select(key).distinct(), table(spark, sf_dir, "documents").select(key)).counts


@query(f"SELECT event_type AS keyword, user_id::VARCHAR AS code FROM events WHERE ts < TIMESTAMP '{CUT}' UNION SELECT event_type, user_id::VARCHAR FROM events WHERE ts >= TIMESTAMP '{CUT}' AND event_type IN ('click', 'view')")
def token_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("keyword"), F.col("user_id").cast("string").alias("code"))
    own = spark.createDataFrame([("click",), ("view",)], "keyword string")
    return upsert.union_tokens(tokens.where(f"ts < timestamp_ntz'{CUT}'"), tokens.where(f"ts >= timestamp_ntz'{CUT}'"), own)


@query(f"SELECT DISTINCT event_type AS keyword, user_id::VARCHAR AS code FROM events WHERE ts < TIMESTAMP '{CUT}' AND (event_type, user_id) NOT IN (SELECT (event_type, user_id) FROM events WHERE ts >= TIMESTAMP '{CUT}' AND value > 40)")
def not_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gazetta.operators import search

    tokens = table(spark, sf_dir, "events").select("ts", "value", F.col("event_type").alias("keyword"), F.col("user_id").cast("string").alias("code"))
    return search.not_completed(tokens.where(f"ts < timestamp_ntz'{CUT}'").select("keyword", "code").distinct(), tokens.where(f"ts >= timestamp_ntz'{CUT}' and value > 40"))


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as tasks: click pending, view done, purchase claimed, signup retry, error failed."""
    status = F.element_at(F.create_map(*[F.lit(x) for pair in (("click", "pending"), ("view", "done"), ("purchase", "claimed"), ("signup", "retry"), ("error", "failed")) for x in pair]), F.col("event_type"))
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"), status.alias("status"), F.when(status == "claimed", F.concat(F.lit("w"), F.col("user_id") % 5)).alias("claimed_by"), F.when(status == "claimed", at).alias("claimed_at"),
        F.when(status == "done", at).alias("done_at"), (F.col("user_id") % 3).cast("int").alias("attempts"), F.lit(None).cast("string").alias("last_error"), at.alias("updated_at"),
    )


_TASKS = """tasks AS (
    SELECT event_id::VARCHAR AS id, CASE event_type WHEN 'click' THEN 'pending' WHEN 'view' THEN 'done' WHEN 'purchase' THEN 'claimed' WHEN 'signup' THEN 'retry' ELSE 'failed' END AS status,
        CASE WHEN event_type = 'purchase' THEN 'w' || (user_id % 5) END AS claimed_by, CASE WHEN event_type = 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS claimed_at,
        CASE WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS done_at, (user_id % 3)::INTEGER AS attempts, NULL::VARCHAR AS last_error, strftime(ts, '%Y-%m-%d %H:%M:%S') AS updated_at, user_id, value
    FROM events)"""


def _master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where("value > 30").select(F.col("event_id").cast("string").alias("id"))


@query(f"WITH {_TASKS} SELECT id, status FROM tasks WHERE status <> 'done' AND value > 30")
def sync_done_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.to_mark_done(_tasks(spark, sf_dir), _master(spark, sf_dir)).select("id", "status")


@query(f"WITH {_TASKS} SELECT id, CASE WHEN value > 30 THEN 'done' ELSE status END AS status, CASE WHEN value > 30 AND status <> 'done' THEN '{NOW}' ELSE done_at END AS done_at, CASE WHEN value > 30 AND status <> 'done' THEN '{NOW}' ELSE updated_at END AS updated_at FROM tasks")
def sync_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.sync_done(_tasks(spark, sf_dir), _master(spark, sf_dir), F.lit(NOW)).select("id", "status", "done_at", "updated_at")


@query(f"WITH {_TASKS} SELECT id, CASE WHEN status = 'done' AND value <= 30 THEN 'pending' ELSE status END AS status, CASE WHEN status = 'done' AND value <= 30 THEN NULL ELSE done_at END AS done_at FROM tasks")
def fix_inconsistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.fix_inconsistent(_tasks(spark, sf_dir), _master(spark, sf_dir), F.lit(NOW)).select("id", "status", "done_at")


@query(f"WITH {_TASKS} SELECT 'with null' AS master, count(*) AS n FROM tasks WHERE status = 'done' AND id NOT IN (SELECT id FROM tasks WHERE value > 30 UNION ALL SELECT NULL) UNION ALL SELECT 'without', count(*) FROM tasks WHERE status = 'done' AND id NOT IN (SELECT id FROM tasks WHERE value > 30)")
def not_in_null_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, master = _tasks(spark, sf_dir), _master(spark, sf_dir)
    null = spark.createDataFrame([(None,)], "id string")
    count = lambda m, name: tasks.inconsistent(rows, m).agg(F.count("*").alias("n")).select(F.lit(name).alias("master"), "n")
    return count(master.unionByName(null), "with null").unionByName(count(master, "without"))


@query(f"WITH {_TASKS}, base AS (SELECT unnest(['pending', 'claimed', 'done', 'retry', 'failed', 'other']) AS status) SELECT b.status, count(t.id) AS n FROM base b LEFT JOIN (SELECT * FROM tasks WHERE status <> 'claimed') t ON b.status = t.status GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM tasks WHERE status <> 'claimed'")
def status_counts_zero_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.status_counts(_tasks(spark, sf_dir).where("status <> 'claimed'"), known=("pending", "claimed", "done", "retry", "failed", "other"))


_PRIORITY = "CASE status WHEN 'pending' THEN 0 WHEN 'retry' THEN 1 WHEN 'failed' THEN 2 WHEN 'claimed' THEN 3 ELSE 4 END"


@query(f"WITH {_TASKS} SELECT id, status, updated_at FROM tasks WHERE status IN ('pending', 'retry', 'failed') OR (status = 'claimed' AND claimed_at::TIMESTAMP < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 30 MINUTE) ORDER BY {_PRIORITY}, updated_at, id LIMIT 100")
def claim_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.claim_batch(_tasks(spark, sf_dir), 100, F.lit("2024-01-20 00:00:00").cast("timestamp")).select("id", "status", "updated_at")


@query(f"WITH {_TASKS} SELECT id, row_number() OVER (ORDER BY {_PRIORITY}, updated_at, id) - 1 AS place FROM tasks WHERE status IN ('pending', 'retry', 'failed')")
def claimable_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tasks.claimable_order(_tasks(spark, sf_dir)).withColumn("_p", tasks.priority(F.col("status")))
    return tasks.numbered(rows, ["_p", "updated_at", "id"], "place").select("id", "place")


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_updated FROM events")
def last_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.last_updated(_tasks(spark, sf_dir))


@query(
    f"""WITH {_TASKS} SELECT id, CASE WHEN status = 'claimed' AND value > 25 THEN 'done' WHEN status = 'claimed' THEN 'retry' WHEN status = 'retry' AND value > 50 THEN 'failed' ELSE status END AS status,
    attempts + CASE WHEN (status = 'claimed' AND value <= 25) OR (status = 'retry' AND value > 50) THEN 1 ELSE 0 END AS attempts, CASE WHEN (status = 'claimed' AND value <= 25) OR (status = 'retry' AND value > 50) THEN length(substr(repeat('e', 300 + user_id * 5), 1, 500)) END AS error_length FROM tasks"""
)
def task_state_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tasks(spark, sf_dir)
    events = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("id"), "event_type", "value", F.expr("repeat('e', cast(300 + user_id * 5 as int))").alias("error"))
    rows = tasks.mark_done(rows, events.where("event_type = 'purchase' and value > 25"), F.lit(NOW))
    rows = tasks.mark_open(rows, events.where("event_type = 'purchase' and value <= 25"), "retry", F.lit(NOW))
    rows = tasks.mark_open(rows, events.where("event_type = 'signup' and value > 50"), "failed", F.lit(NOW))
    return rows.select("id", "status", "attempts", F.length("last_error").cast("long").alias("error_length"))


@query(f"WITH {_TASKS} SELECT id, CASE WHEN status = 'claimed' THEN 'pending' ELSE status END AS status, NULL::VARCHAR AS claimed_by FROM tasks")
def release_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.release_claims(_tasks(spark, sf_dir), F.lit(NOW)).select("id", "status", "claimed_by")


@query(f"WITH {_TASKS} SELECT id, CASE WHEN status = 'pending' AND value > 10 THEN 'claimed' ELSE status END AS status, CASE WHEN status = 'pending' AND value > 10 THEN 'w9' ELSE claimed_by END AS claimed_by FROM tasks")
def bulk_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "events").where("event_type = 'click' and value > 10").select(F.col("event_id").cast("string").alias("id"))
    return tasks.claimed(_tasks(spark, sf_dir), ids, F.lit("w9"), F.lit(NOW)).select("id", "status", "claimed_by")


@query(
    """WITH rows AS (SELECT l_partkey::VARCHAR AS id, l_suppkey % 5 AS worker, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, l_discount, l_tax FROM lineitem),
    best AS (SELECT id, arg_max({'w': worker, 'q': l_quantity, 'p': l_extendedprice}, (worker, l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_discount, l_tax)) AS r, count(*) AS n FROM rows GROUP BY id)
    SELECT id, r.w AS worker, r.q AS quantity, r.p AS price, CASE WHEN id::BIGINT % 3 = 0 THEN 'before' ELSE 'now' END AS first_seen FROM best
    UNION ALL SELECT p_partkey::VARCHAR, -1, 0.0, p_retailprice, 'before' FROM part WHERE p_partkey % 3 = 0 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem)"""
)
def worker_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("worker", F.col("l_suppkey") % 5)
    rows = rows.select(F.col("l_partkey").cast("string").alias("id"), "worker", F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.lit("now").alias("first_seen"), "l_orderkey", "l_linenumber", "l_discount", "l_tax")
    latest = upsert.last_wins(rows, ["id"], ["worker", "l_orderkey", "l_linenumber", "price", "quantity", "l_discount", "l_tax"])
    # every third part is known from a run before: a contract of this query's fixture, all parts and all line items take part
    old = table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(F.col("p_partkey").cast("string").alias("id"), F.lit(-1).cast("long").alias("worker"), F.lit(0.0).alias("quantity"), F.col("p_retailprice").alias("price"), F.lit("before").alias("first_seen"))
    return upsert.upsert(old, latest.select(*old.columns), ["id"], rules={"first_seen": lambda before, after: F.coalesce(before, after)})


@query("SELECT 'customer' AS \"table\", count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'total', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.total_counts(customer=table(spark, sf_dir, "customer"), supplier=table(spark, sf_dir, "supplier"))
