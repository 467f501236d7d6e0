"""The master table of details as sorted runs: a batch appends a run to the buckets it touches, and a bucket is rewritten only when its runs have grown to a share of it.

Each row is written when it comes and about 1 / SHARE times when its bucket is compacted, however large the table is. A
reader takes the newest row of each id over a bucket's runs, and first_seen_at from the oldest.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta import schemas
from gazetta.operators import upsert
from gazetta.sinks import commits

#: Buckets of a new table by a hash of the id; a table keeps the number it was made with.
BUCKETS = 64
#: A bucket is compacted when its later runs have more than this share of the rows of its first.
SHARE = 0.5
#: ... or when it has more runs than this.
MOST_RUNS = 16
ORDER = ("fetched_at", "worker_id", "attempt")


class Run(NamedTuple):
    version: int  #: newer runs win
    folder: str
    rows: int


class State(NamedTuple):
    version: int  #: the last commit, -1 for a table that is not there
    buckets: int
    runs: dict[int, list[Run]]  #: of each bucket, oldest first; the first is its base
    batches: dict[str, int]  #: the last batch that each stream has put in
    retired: list[list]  #: (bucket, folder) of the runs that the last compaction replaced


def state(spark: SparkSession, root: str) -> State:
    """The table as its commits leave it."""
    out = State(-1, BUCKETS, {}, {}, [])
    for version, info in commits.history(spark, root):
        runs, batches, retired = out.runs, out.batches, out.retired
        if "whole" in info:
            whole = info["whole"]
            runs, batches, retired = {int(b): [Run(*r) for r in rs] for b, rs in whole["runs"].items()}, whole["batches"], whole["retired"]
        for b, n in info.get("rows", {}).items():
            kept = runs.get(int(b), [])
            if "upto" in info:  # a compaction stands for all runs up to a version
                runs[int(b)] = [Run(info["upto"], info["folder"], n), *(r for r in kept if r.version > info["upto"])]
            else:
                runs[int(b)] = [*kept, Run(version, info["folder"], n)]
        out = State(version, info.get("buckets", out.buckets), runs, batches | info.get("batch", {}), info.get("retired", retired))
    return out


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")


def _write(rows: DataFrame, root: str, buckets: int) -> tuple[str, dict[str, int]]:
    """Rows as one sorted file a bucket in a new folder; its name, and the rows of each bucket (from the files' footers)."""
    name, path = commits.data_folder(root)
    rows.withColumn("bucket", _bucket(buckets)).repartition("bucket").sortWithinPartitions("bucket", "id").write.partitionBy("bucket").parquet(path)
    spark = rows.sparkSession
    if not any(n.startswith("bucket=") for n in commits.listed(spark, path)):
        return name, {}
    got = spark.read.schema("id string, bucket int").parquet(path).groupBy("bucket").count().collect()  # as many rows as buckets
    return name, {str(r["bucket"]): r["count"] for r in got}


def _commit(spark: SparkSession, root: str, info: dict[str, Any], still: Any = None, tries: int = 100) -> int:
    """Commits under the next free number; appends commute, so a number that is taken means the next. `still` says whether the commit still makes sense."""
    for _ in range(tries):
        now = state(spark, root)
        if still is not None and not still(now):
            return -1
        version = commits.last_version(spark, root) + 1
        whole = {}
        if version and version % commits.WHOLE == 0 and now.version == version - 1:  # else a marker lies between, and a later round number will do
            whole = {"whole": {"runs": {b: [list(r) for r in rs] for b, rs in now.runs.items()}, "batches": now.batches, "retired": now.retired}}
        try:
            commits.commit(spark, root, version, {"buckets": now.buckets} | info | whole)
        except commits.Conflict:
            continue
        if whole:
            commits.forget(spark, root, version)
        return version
    raise commits.Conflict(f"{tries} commits to {root} were overtaken")


def create(spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
    """A new table with this number of buckets; one that is there stays as it is."""
    if commits.last_version(spark, root) < 0:
        try:
            commits.commit(spark, root, 0, {"buckets": buckets})
        except commits.Conflict:
            pass


def _parts(spark: SparkSession, root: str, runs: dict[int, list[Run]]) -> DataFrame | None:
    """All rows of these runs, with the version of their run."""
    by: dict[tuple[int, str], list[int]] = {}
    for b, rs in runs.items():
        for r in rs:
            by.setdefault((r.version, r.folder), []).append(b)
    parts = [spark.read.schema(schemas.MASTER).parquet(*[f"{root}/{folder}/bucket={b}" for b in sorted(bs)]).withColumn("_version", F.lit(version)) for (version, folder), bs in sorted(by.items())]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _folded(rows: DataFrame) -> DataFrame:
    """The newest row of each id, with first_seen_at from its oldest."""
    rest = [c for c in schemas.MASTER.fieldNames() if c not in ("id", "first_seen_at")]
    best = rows.groupBy("id").agg(F.max_by(F.struct(*rest), "_version").alias("_row"), F.min_by("first_seen_at", "_version").alias("first_seen_at"))
    return best.select(*[F.col(c) if c in ("id", "first_seen_at") else F.col(f"_row.{c}").alias(c) for c in schemas.MASTER.fieldNames()])


def read(spark: SparkSession, root: str) -> DataFrame:
    """The master table. Buckets of one run are scanned as they are; only the others are folded, which shuffles no more than a share over what was written."""
    now = state(spark, root)
    plain = _parts(spark, root, {b: rs for b, rs in now.runs.items() if len(rs) == 1})
    several = _parts(spark, root, {b: rs for b, rs in now.runs.items() if len(rs) > 1})
    found = [x for x in (None if plain is None else plain.drop("_version"), None if several is None else _folded(several)) if x is not None]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], schemas.MASTER)


def append(batch: DataFrame, root: str, run_id: str, order: Sequence[str] = ORDER, stream: str | None = None, number: int | None = None, compacting: bool = True) -> int:
    """Puts detail rows into the table as one run; returns the version, -1 if there was nothing to put in.

    Rows without id or raw_json are left out, and of rows with one id the last in `order` counts. A batch of a
    stream that was put in before (stream, number) is not put in again. Then buckets with large runs are compacted.
    """
    spark = batch.sparkSession
    create(spark, root)
    now = state(spark, root)
    if stream is not None and now.batches.get(stream, -1) >= number:
        return -1
    latest = upsert.last_wins(batch.where("id is not null and raw_json is not null"), ["id"], order)
    at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    name, rows = _write(upsert.master_rows(latest.select(*schemas.DETAIL.fieldNames()), F.lit(run_id), at), root, now.buckets)
    if not rows and stream is None:
        commits.delete(spark, f"{root}/{name}")
        return -1
    version = _commit(spark, root, {"folder": name, "rows": rows} | ({"batch": {stream: number}} if stream is not None else {}), lambda s: stream is None or s.batches.get(stream, -1) < number)
    if version < 0:
        commits.delete(spark, f"{root}/{name}")
    elif compacting:
        compact(spark, root)
    return version


def grown(runs: list[Run], share: float = SHARE, most: int = MOST_RUNS) -> bool:
    return len(runs) > 1 and (sum(r.rows for r in runs[1:]) > share * runs[0].rows or len(runs) > most)


def compact(spark: SparkSession, root: str, share: float = SHARE, most: int = MOST_RUNS) -> int:
    """Writes each bucket whose later runs have grown too large as one run; returns how many. Appends go on meanwhile: only runs that were read are replaced.

    What a compaction replaces stays for readers until the next one; then its files go.
    """
    now = state(spark, root)
    chosen = {b: rs for b, rs in now.runs.items() if grown(rs, share, most)}
    if not chosen:
        return 0
    name, rows = _write(_folded(_parts(spark, root, chosen)), root, now.buckets)
    replaced = [[b, r.folder] for b, rs in chosen.items() for r in rs]
    if _commit(spark, root, {"folder": name, "rows": rows, "upto": now.version, "retired": replaced}, lambda s: all(s.runs.get(b, [])[: len(rs)] == rs for b, rs in chosen.items())) < 0:
        commits.delete(spark, f"{root}/{name}")
        return 0
    for b, folder in now.retired:
        commits.delete(spark, f"{root}/{folder}/bucket={b}")
    return len(chosen)
