"""Keyed upserts with a rule for each column, and the deduplication they need.

Tables are immutable files: an upsert returns the new table, which the caller writes to a new path and
swaps in. Old and new rows meet in one full outer join on the key, so a table bucketed by it moves once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gazetta.operators.lineage import cut
from gazetta.operators.projection import Routed, multi_rows, single_rows

Rule = Callable[[Column, Column], Column]


def _extreme(rows: DataFrame, keys: Sequence[str], order: Sequence[str], pick: Callable) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def last_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row a key: that with the greatest order. Aggregated before the shuffle, so a hot key costs nothing more."""
    return _extreme(rows, keys, order, F.max_by)


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _extreme(rows, keys, order, F.min_by)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), rules: dict[str, Rule] | None = None) -> DataFrame:
    """old with new rows put in: matched rows take every column from new but those to keep; rules give a column's value from (old, new).

    Keys must be unique on either side (see last_wins) and not null.
    """
    rules = rules or {}
    columns = [c for c in old.columns if c not in keys]
    left = old.select(*keys, F.struct(*columns).alias("_old"))
    right = new.select(*keys, F.struct(*[c for c in columns]).alias("_new"))
    both = left.join(right, list(keys), "full")

    def value(c: str) -> Column:
        before, after = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        matched = F.col("_old").isNotNull() & F.col("_new").isNotNull()
        merged = rules[c](before, after) if c in rules else before if c in keep else after
        return F.when(matched, merged).when(F.col("_new").isNotNull(), after).otherwise(before).alias(c)

    return both.select(*[F.col(c) if c in keys else value(c) for c in old.columns])


def _last(new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One new row a key, as if the rows had been put in one after another: the last in those columns of `order` that there are, ties and no order by the other columns."""
    order = [c for c in order if c in new.columns]
    rest = [c for c in new.columns if c not in keys and c not in order]
    return last_wins(new, keys, [*order, *rest])


def upsert_regions(old: DataFrame, new: DataFrame, order: Sequence[str] = ("updated_at",)) -> DataFrame:
    """As the other named upserts: of new rows with one key the last in `order` counts."""
    return upsert(old, _last(new, ["code", "version"], order), ["code", "version"], keep=["captured_at"])


def upsert_divisions(old: DataFrame, new: DataFrame, order: Sequence[str] = ("updated_at",)) -> DataFrame:
    return upsert(old, _last(new, ["code"], order), ["code"], keep=["captured_at"])


def upsert_places(old: DataFrame, new: DataFrame, order: Sequence[str] = ("updated_at",)) -> DataFrame:
    return upsert(old, _last(new, ["source_id"], order), ["source_id"], keep=["captured_at"])


def upsert_totals(single: DataFrame, multi: DataFrame, routed: Routed) -> tuple[DataFrame, DataFrame]:
    """Both total tables with the routed rows put in. A row that changed its geometry class stays in its old table too."""
    return upsert_places(single, single_rows(routed.single)), upsert_places(multi, multi_rows(routed.multi))


def upsert_runs(old: DataFrame, new: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    return upsert(old, _last(new, ["run_id"], order), ["run_id"], keep=["source_name", "started_at"])


def upsert_marks(old: DataFrame, new: DataFrame, order: Sequence[str] = ("fetched_at",)) -> DataFrame:
    return upsert(old, _last(new, ["parent_code"], order), ["parent_code"])


def has_mark(marks: DataFrame, parent: str) -> bool:
    """Whether a parent's children were fetched before, even if there were none."""
    return not marks.where(F.col("parent_code") == parent).isEmpty()


def upsert_details(old: DataFrame, new: DataFrame, order: Sequence[str] = ("fetched_at", "attempt")) -> DataFrame:
    return upsert(old, _last(new, ["id"], order), ["id"])


def master_rows(details: DataFrame, run_id: Column, now: Column) -> DataFrame:
    return details.withColumns({"first_seen_at": now, "last_seen_at": now, "source_run_id": run_id, "source_worker_id": F.col("worker_id"), "merge_at": now})


def upsert_master(old: DataFrame, details: DataFrame, run_id: Column, now: Column) -> DataFrame:
    """Master rows keep the time they were first seen; all else comes from the new details, the run and now."""
    return upsert(old, master_rows(details, run_id, now), ["id"], rules={"first_seen_at": lambda before, after: F.coalesce(before, after)})


def upsert_page_divisions(old: DataFrame, new: DataFrame, order: Sequence[str] = ("captured_at",)) -> DataFrame:
    """Unlike the other upserts, captured_at is replaced too."""
    return upsert(old, _last(new, ["code"], order), ["code"])


class Added(NamedTuple):
    table: DataFrame
    counts: DataFrame  #: added, existed, total


def insert_ignore(pool: DataFrame, ids: DataFrame, key: str = "id") -> Added:
    """The pool with the ids it lacks; repeated new ids count as existing."""
    new = ids.select(key).where(F.col(key).isNotNull()).distinct().join(pool.select(key), key, "left_anti")
    total, added = ids.select(F.count("*").alias("total")), new.select(F.count("*").alias("added"))
    counts = added.join(total).select("added", (F.col("total") - F.col("added")).alias("existed"), "total")  # one row each
    return Added(pool.unionByName(new, allowMissingColumns=True), counts)


def union_tokens(own: DataFrame, shared: DataFrame, keywords: DataFrame | None = None) -> DataFrame:
    """All completed (keyword, code) tokens; of the shared ones only those of own keywords, if these are given."""
    if keywords is not None:
        shared = shared.join(keywords.select("keyword"), "keyword", "left_semi")
    return own.select("keyword", "code").unionByName(shared.select("keyword", "code")).distinct()


def merge_counts(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """rows_read, inserted and updated of one merge of new (keys may repeat) into old."""
    read = new.groupBy(key).agg(F.count("*").alias("n")).join(old.select(key).distinct().withColumn("_old", F.lit(True)), key, "left")
    rows = read.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"), F.count_if(F.col("_old").isNull()).alias("inserted"))
    return rows.withColumn("updated", F.col("rows_read") - F.col("inserted"))


def merge_workers(master: DataFrame, details: DataFrame, run_id: Column, now: Column, order: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new master, counts, rejected): worker rows of all files in merge order, the last of an id wins; rows without an id or raw_json are rejected.

    The merge runs when this is called, once: the counts rows_read, inserted and updated are observed in the pass that writes the new master.
    """
    bad = F.col("id").isNull() | F.col("raw_json").isNull()
    read, merged = Observation("read"), Observation("merged")
    good = details.where(~bad).observe(read, F.count("*").alias("rows_read"))
    latest = last_wins(good, ["id"], order).select(*[c for c in details.columns if c not in order or c in master.columns])
    known = master.withColumn("_known", F.lit(True))
    rows = upsert(known, master_rows(latest, run_id, now).withColumn("_known", F.lit(False)), ["id"], keep=["_known"], rules={"first_seen_at": lambda before, after: F.coalesce(before, after)})
    out = cut(rows.observe(merged, F.count_if(~F.col("_known")).alias("inserted")).drop("_known"))
    n, inserted = read.get["rows_read"], merged.get["inserted"]
    counts = master.sparkSession.createDataFrame([(n, inserted, n - inserted)], "rows_read long, inserted long, updated long")
    return out, counts, details.where(bad)
