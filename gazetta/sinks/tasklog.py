"""The state of fetch tasks as a log of events with snapshots.

Workers append what happens to tasks; nothing is rewritten. The state is the newest snapshot with the later events folded
in by task, and a new snapshot is written when the events have grown to a share of the tasks. A claim is a commit at
the very next version after the state it was chosen from, so of two workers that choose at a time one must choose again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta import schemas
from gazetta.operators import tasks
from gazetta.operators.lineage import cut
from gazetta.sinks import commits

#: What can happen to a task: `added` makes it unless it is there, `reset` opens one that was done, `released` gives a claim back.
KINDS = ("added", "claimed", "done", "retry", "failed", "released", "reset")
#: Order of events of one task within one commit is that of `step`.
EVENT = "id string, kind string, worker string, at string, error string, step long"
#: A snapshot is due when there are more events than this share of the tasks.
SHARE = 0.5

_STATUS = {"claimed": "claimed", "done": "done", "retry": "retry", "failed": "failed", "released": "pending", "reset": "pending"}


class Log(NamedTuple):
    version: int
    snapshot: str | None  #: folder of the newest snapshot
    tasks: int  #: rows of it
    events: list[tuple[int, str, int]]  #: (version, folder, rows) of later commits
    retired: list[str]  #: folders that the snapshot replaced


def log(spark: SparkSession, root: str) -> Log:
    out = Log(-1, None, 0, [], [])
    for version, info in commits.history(spark, root):
        if "whole" in info:  # a snapshot of all events up to a version; later ones were appended meanwhile
            out = Log(version, info["whole"], info["rows"], [tuple(e) for e in info["later"]], info["retired"])
        else:
            out = out._replace(version=version, events=[*out.events, (version, info["folder"], info["rows"])])
    return out


def fold(events: DataFrame, order: Sequence[str] = ("version", "step")) -> DataFrame:
    """One row for each task of the events: what they make of it, and which of its columns they say anything about.

    `tries` counts attempts that ended in retry or failed. An `added` event counts only for tasks without any other.
    """
    rank, kind = F.struct(*order), F.col("kind")
    says = kind != "added"
    status = F.create_map(*[F.lit(x) for pair in _STATUS.items() for x in pair])

    def last(value: Column, kinds: Sequence[str]) -> Column:
        """The value at the last event of these kinds; in a struct, since it may be null."""
        return F.max_by(F.struct(value.alias("v")), F.when(kind.isin(*kinds), rank))

    return events.groupBy("id").agg(
        F.max_by(F.struct(F.element_at(status, kind).alias("status"), F.col("at").alias("updated_at")), F.when(says, rank)).alias("now"),
        F.min_by("at", rank).alias("added_at"),
        last(F.struct(F.when(kind == "claimed", F.col("worker")).alias("by"), F.when(kind == "claimed", F.col("at")).alias("at")), ("claimed", "released")).alias("claim"),
        last(F.when(kind == "done", F.col("at")), ("done", "reset")).alias("done"),
        last(F.when(kind != "done", F.substring("error", 1, 500)), ("done", "retry", "failed")).alias("error"),
        F.count_if(kind.isin("retry", "failed")).cast("int").alias("tries"),
    )


def apply(snapshot: DataFrame, folded: DataFrame) -> DataFrame:
    """The snapshot's tasks with folded events put in, and the tasks that only the events know."""
    new = folded.withColumnRenamed("id", "_id")
    both = snapshot.join(new, F.col("id") == F.col("_id"), "full")
    value = lambda c, old: F.when(F.col(c).isNotNull(), F.col(f"{c}.v")).otherwise(F.col(old))
    claim = lambda field, old: F.when(F.col("claim").isNotNull(), F.col(f"claim.v.{field}")).otherwise(F.col(old))
    return both.select(
        F.coalesce("id", "_id").alias("id"), F.coalesce(F.col("now.status"), F.col("status"), F.lit("pending")).alias("status"), claim("by", "claimed_by").alias("claimed_by"), claim("at", "claimed_at").alias("claimed_at"),
        value("done", "done_at").alias("done_at"), (F.coalesce("attempts", F.lit(0)) + F.coalesce("tries", F.lit(0))).alias("attempts"), value("error", "last_error").alias("last_error"),
        F.coalesce(F.col("now.updated_at"), F.col("updated_at"), F.col("added_at")).alias("updated_at"),
    )


def _snapshot(spark: SparkSession, root: str, folder: str | None) -> DataFrame:
    return spark.read.schema(schemas.TASK).parquet(f"{root}/{folder}") if folder else spark.createDataFrame([], schemas.TASK)


def _state(spark: SparkSession, root: str, at: Log) -> DataFrame:
    before = _snapshot(spark, root, at.snapshot)
    if not at.events:
        return before
    parts = [spark.read.schema(EVENT).parquet(f"{root}/{folder}").withColumn("version", F.lit(version)) for version, folder, _ in at.events]
    return apply(before, fold(reduce(DataFrame.unionByName, parts)))


def read(spark: SparkSession, root: str) -> DataFrame:
    """All tasks as they are now."""
    return _state(spark, root, log(spark, root))


def _write(events: DataFrame, root: str) -> tuple[str, int]:
    name, path = commits.data_folder(root)
    defaults: dict[str, Column] = {"worker": F.lit(None), "error": F.lit(None), "step": F.lit(0)}
    rows = events.where("id is not null").withColumns({c: v for c, v in defaults.items() if c not in events.columns})
    kinds = dict(c.split() for c in EVENT.split(", "))
    rows.select(*[F.col(c).cast(k).alias(c) for c, k in kinds.items()]).write.parquet(path)
    return name, events.sparkSession.read.schema(EVENT).parquet(path).count()  # from the footers


def append(events: DataFrame, root: str, share: float = SHARE, tries: int = 100) -> int:
    """Appends events (id, kind, at and, where they have any, worker, error, step) that hold whatever else happens. Then a snapshot, if one is due.

    Returns the version, -1 if there were no events.
    """
    spark = events.sparkSession
    name, rows = _write(events, root)
    if not rows:
        commits.delete(spark, f"{root}/{name}")
        return -1
    for _ in range(tries):
        version = commits.last_version(spark, root) + 1
        try:
            commits.commit(spark, root, version, {"folder": name, "rows": rows})
        except commits.Conflict:
            continue
        snapshot(spark, root, share)
        return version
    raise commits.Conflict(f"{tries} commits to {root} were overtaken")


def append_at(events: DataFrame, root: str, version: int) -> None:
    """Appends events that hold only after what is there: as that version, or Conflict if another writer was first."""
    name, rows = _write(events, root)
    try:
        commits.commit(events.sparkSession, root, version, {"folder": name, "rows": rows})
    except commits.Conflict:
        commits.delete(events.sparkSession, f"{root}/{name}")
        raise


def snapshot(spark: SparkSession, root: str, share: float = SHARE) -> bool:
    """Writes the state as a new snapshot if the events since the last have grown beyond a share of its tasks, and drops what that makes needless.

    What a snapshot replaces stays for readers that began earlier, until the next one.
    """
    at = log(spark, root)
    if not at.events or sum(n for _, _, n in at.events) <= share * at.tasks:
        return False
    name, path = commits.data_folder(root)
    _state(spark, root, at).write.parquet(path)
    rows = spark.read.schema(schemas.TASK).parquet(path).count()
    retired = [folder for _, folder, _ in at.events] + ([at.snapshot] if at.snapshot else [])
    while True:
        before = commits.last_version(spark, root)  # read first: whatever comes after it makes the commit fail
        now = log(spark, root)
        if now.snapshot != at.snapshot:  # another writer was faster
            commits.delete(spark, path)
            return False
        try:
            commits.commit(spark, root, before + 1, {"whole": name, "rows": rows, "later": [e for e in now.events if e[0] > at.version], "retired": retired})
        except commits.Conflict:
            continue
        for folder in at.retired:
            commits.delete(spark, f"{root}/{folder}")
        commits.forget(spark, root, before + 1)
        return True


def add(ids: DataFrame, root: str, at: Column) -> int:
    """New tasks for ids that have none; known ones stay as they are."""
    known = read(ids.sparkSession, root).select("id")
    new = ids.select("id").where("id is not null").distinct().join(known, "id", "left_anti")
    return append(new.select("id", F.lit("added").alias("kind"), at.alias("at")), root)


def claim(spark: SparkSession, root: str, worker: str, size: int, now: Column, timeout_minutes: int = 30, where: Column | None = None, tries: int = 20) -> DataFrame:
    """(id, attempts) of up to `size` tasks that are this worker's from now on; none is ever another's at the same time.

    They are chosen as tasks.claim_batch does. A claim that was overtaken by any other commit is chosen anew.
    """
    for _ in range(tries):
        before = commits.last_version(spark, root)  # read first: whatever comes after it makes the claim fail
        state = read(spark, root)
        chosen = cut(tasks.claim_batch(state if where is None else state.where(where), size, now, timeout_minutes).select("id", "attempts"))
        if chosen.isEmpty():
            return chosen
        try:
            append_at(chosen.select("id", F.lit("claimed").alias("kind"), F.lit(worker).alias("worker"), F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss").alias("at")), root, before + 1)
        except commits.Conflict:
            continue
        snapshot(spark, root)
        return chosen
    raise commits.Conflict(f"{tries} claims on {root} were overtaken")


def release(spark: SparkSession, root: str, worker: str, at: Column) -> int:
    """Gives back what this worker has claimed and not ended, as after it was killed."""
    own = read(spark, root).where((F.col("status") == "claimed") & (F.col("claimed_by") == worker))
    return append(own.select("id", F.lit("released").alias("kind"), at.alias("at")), root)


def settle(spark: SparkSession, root: str, master: DataFrame, at: Column) -> int:
    """Marks tasks done that the master has, however they stand."""
    missed = tasks.to_mark_done(read(spark, root), master)
    return append(missed.select("id", F.lit("done").alias("kind"), at.alias("at")), root)

