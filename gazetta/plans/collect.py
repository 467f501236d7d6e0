"""Whole runs: a keyword search over divisions from recorded answers, a division crawl from pages, and the sample run."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta import schemas
from gazetta.functions import html, scalar, variant
from gazetta.operators import hierarchy, projection, search, upsert
from gazetta.operators.lineage import cut
from gazetta.sinks import commits, exports
from gazetta.sources import files, replay

ROOT = "0"


class Collected(NamedTuple):
    places: DataFrame  #: one row a source_id, the last found wins
    partitions: DataFrame  #: (keyword, code, total, page) that were read
    progress: DataFrame  #: (keyword, code) tokens that are complete now, those of before included


def collect_places(answers: DataFrame, divisions: DataFrame, keywords: Sequence[str], now: Column, progress: DataFrame | None = None, provinces: Sequence[str] | None = None, mode: str = "contain", threshold: int = 3000, size: int = 100) -> Collected:
    """Searches keywords in the provinces (all if none are given) from answers (keyword, code, page, payload).

    The first page of a partition tells its total; beyond the threshold a partition with children is split into
    them. Partitions that the progress names are left out at every level, the others complete.
    """
    found = answers.withColumn("_v", variant.parsed(F.col("payload")))
    totals = found.where("page = 1").select("keyword", "code", variant.total_of(F.col("_v"), F.lit(0).cast("long")).alias("total"))
    tops = search.in_provinces(divisions.where(F.col("parent_code") == ROOT), provinces)
    starts = search.keyword_partitions(keywords, tops)
    nodes = divisions.select("code", F.when(F.col("parent_code") != ROOT, F.col("parent_code")).alias("parent_code"))
    counts = totals.join(nodes, "code").select("keyword", "code", "parent_code", "total")
    below = counts.where("parent_code is not null")
    counts = counts.where("parent_code is null").join(starts, ["keyword", "code"], "left_semi").unionByName(below)
    partitions = hierarchy.adaptive_partitions(counts.select("keyword", "code", "parent_code", "total"), threshold, size, progress)
    rows = found.join(partitions.select("keyword", "code", "page"), ["keyword", "code", "page"], "left_semi")
    rank = F.array_position(F.array(*[F.lit(k) for k in keywords]), F.col("keyword"))
    raw = rows.select(
        "keyword", F.col("code").alias("partition_code"), rank.alias("_rank"), "page", F.posexplode(variant.records_of(F.col("_v"))).alias("_at", "_r")
    ).select("keyword", "partition_code", F.format_string("%09d|%s|%09d|%09d", "_rank", "partition_code", "page", "_at").alias("source_url"), variant.canonical(F.col("_r")).alias("raw"))
    raw = raw.withColumns({"match_mode": F.lit(mode), "fetched_at_utc": now})
    places = upsert.last_wins(projection.place_rows(raw, now), ["source_id"], ["source_url"]).withColumn("source_url", F.lit(""))
    tokens = starts.unionByName(partitions.select("keyword", "code")).distinct()
    return Collected(places, partitions, upsert.union_tokens(progress, tokens) if progress is not None else tokens)


#: The error of a request that a run had no time for.
NO_TIME = "out of time"


class _Asker:
    """Asks for pages in lots of `flush`; with a folder each lot is kept there, and what is there is not asked for again."""

    def __init__(self, spark: SparkSession, fetch: Callable[[str, str, int], tuple[int, str]], folder: str | None, flush: int, parallel: int, qps: float, attempts: int, until: float | None) -> None:
        self.spark, self.fetch, self.folder, self.flush, self.parallel, self.qps, self.attempts, self.until = spark, fetch, folder, flush, parallel, qps, attempts, until

    def known(self) -> DataFrame | None:
        path = f"{self.folder}/answers"
        names = commits.listed(self.spark, path) if self.folder else []
        return self.spark.read.parquet(path) if any(n.endswith(".parquet") for n in names) else None

    def ask(self, rows: DataFrame) -> DataFrame:
        rows, key = cut(rows.select("keyword", "code", "page")), ["keyword", "code", "page"]
        parts, before = [], self.known()
        open_rows = rows if before is None else cut(rows.join(before.select(*key), key, "left_anti"))
        lots = -(-open_rows.count() // self.flush)
        for lot in range(lots):
            place = F.pmod(F.xxhash64(*key), F.lit(lots))
            if self.until is not None and time.monotonic() >= self.until:
                nothing = [F.lit(None).cast("string").alias("payload"), F.lit(None).cast("int").alias("status"), F.lit(NO_TIME).alias("error")]
                parts.append(open_rows.where(place >= lot).select(*key, *nothing))
                break
            part = open_rows.where(place == lot)
            got = cut(replay.fetch_answers(part.repartition(self.parallel), self.fetch, self.qps, self.attempts))
            if self.folder:
                got.where("payload is not null").write.mode("append").parquet(f"{self.folder}/answers")
                got = got.where("payload is null")
            parts.append(got)
        kept = self.known()
        if kept is not None:
            parts.append(cut(kept.join(rows, key, "left_semi").select(*key, *[c for c in kept.columns if c not in key])))
        return reduce(DataFrame.unionByName, parts) if parts else cut(replay.fetch_answers(rows, self.fetch))


def search_live(
    divisions: DataFrame, keywords: Sequence[str], fetch: Callable[[str, str, int], tuple[int, str]], progress: DataFrame | None = None, provinces: Sequence[str] | None = None,
    threshold: int = 3000, size: int = 100, parallel: int = 8, qps: float = 0.0, attempts: int = 3, most: int = 100, folder: str | None = None, flush: int = 5000, seconds: float | None = None,
) -> DataFrame:
    """Answers (keyword, code, page, payload, error) that `collect_places` needs, fetched over a transport by `parallel` tasks.

    Each level is two steps: the first pages of its partitions, then the other pages of those that are not split
    into their children. Partitions in `progress` are not asked for. Requests that fail stay as rows with an error.
    With a folder, answers are kept in it in lots of `flush` requests; a run that was killed asks only for what is not there.
    When the `seconds` are over, no further lot is begun, and requests that are left have the error NO_TIME.
    """
    until = None if seconds is None else time.monotonic() + seconds
    ask = _Asker(divisions.sparkSession, fetch, folder, flush, parallel, qps, attempts, until).ask
    nodes = divisions.select("code", "parent_code")
    level = search.keyword_partitions(keywords, search.in_provinces(nodes.where(F.col("parent_code") == ROOT), provinces))
    inner = nodes.select(F.col("parent_code").alias("code")).distinct().withColumn("_inner", F.lit(True))
    answers = []
    for _ in range(most):
        level = search.not_completed(level, progress) if progress is not None else level
        first = ask(level.withColumn("page", F.lit(1)))
        if first.isEmpty():
            out = reduce(DataFrame.unionByName, answers) if answers else first
            return out.drop("status")
        answers.append(first)
        told = first.where("payload is not null").join(inner, "code", "left").withColumn("total", variant.total_of(variant.parsed(F.col("payload")), F.lit(0).cast("long")))
        told = cut(told.select("keyword", "code", "total", (F.coalesce("_inner", F.lit(False)) & (F.col("total") > threshold)).alias("splits")))
        rest = told.where("not splits").select("keyword", "code", F.explode(hierarchy.pages_of(F.col("total"), size)).alias("page")).where("page > 1")
        answers.append(ask(rest))
        level = told.where("splits").select("keyword", F.col("code").alias("parent_code")).join(nodes, "parent_code").select("keyword", "code")
    raise RuntimeError(f"partitions are split more than {most} times")


def whole(progress: DataFrame, failed: DataFrame, divisions: DataFrame, most: int = 100) -> DataFrame:
    """progress without the (keyword, code) of failed requests and those above them, so that a resumed run asks for them again."""
    parents = divisions.select("code", "parent_code").where(F.col("parent_code") != ROOT)
    level = cut(failed.select("keyword", "code").distinct())
    for _ in range(most):
        if level.isEmpty():
            return progress
        progress = progress.join(level, ["keyword", "code"], "left_anti")
        level = cut(level.join(parents, "code").select("keyword", F.col("parent_code").alias("code")).distinct())
    raise RuntimeError(f"the divisions are deeper than {most} levels")


class Synced(NamedTuple):
    divisions: DataFrame  #: all that are known now
    marks: DataFrame  #: parents whose children were asked for, even if there were none
    asked: DataFrame  #: (code) of this run's requests
    failed: DataFrame  #: (code) whose request failed; they carry no mark, so the next run asks again


def sync_divisions(cached: DataFrame, marks: DataFrame, ask: Callable[[DataFrame], DataFrame], now: Column, root: str = ROOT, most: int = 20) -> Synced:
    """Completes a division table from its root down, asking only for the children of parents that it doesn't know.

    A parent with children in the table, or with a mark, is not asked for: its children are those in the table.
    ask takes rows (code) and returns answers (code, payload), one or more rows a code; a null payload or no row is a failed request.
    Each level is one call of ask. Codes are visited once, so cycles end; codes deeper than `most` levels raise an error.
    Rows of answers are put into the table by code, keeping captured_at.
    """
    spark = cached.sparkSession
    held = [cached.where("parent_code is not null").select("code", "parent_code")]
    frontier = spark.createDataFrame([(root,)], "code string")
    levels, news, asked, failed = [], [], [], []
    for _ in range(most + 1):
        levels.append(frontier)
        known = reduce(DataFrame.unionByName, held)
        told = known.select(F.col("parent_code").alias("code")).unionByName(marks.select(F.col("parent_code").alias("code")))
        open_codes = frontier.join(told, "code", "left_anti")
        got = cut(open_codes.join(ask(open_codes).select("code", "payload"), "code", "left"))  # asked once, and kept
        rows = replay.divisions(got.where("payload is not null"), now)
        answered = got.groupBy("code").agg(F.max(F.col("payload").isNotNull()).alias("ok"))
        asked.append(answered.select("code"))
        failed.append(answered.where("not ok").select("code"))
        news.append(rows)
        below = known.join(frontier.select(F.col("code").alias("parent_code")), "parent_code", "left_semi").select("code").unionByName(rows.select("code"))
        held.append(rows.select("code", "parent_code"))
        frontier = cut(below.distinct().join(reduce(DataFrame.unionByName, levels), "code", "left_anti"))
        if frontier.isEmpty():
            break
    else:
        raise RuntimeError(f"divisions are deeper than {most} levels")
    every = reduce(DataFrame.unionByName, asked)
    lost = reduce(DataFrame.unionByName, failed)
    done = every.join(lost, "code", "left_anti").select(F.col("code").alias("parent_code"), now.alias("fetched_at"))
    return Synced(upsert.upsert_divisions(cached, reduce(DataFrame.unionByName, news)), upsert.upsert_marks(marks, done), every, lost)


def children_by(fetch: Callable[[str, str, int], tuple[int, str]], parallel: int = 8, qps: float = 0.0, attempts: int = 3) -> Callable[[DataFrame], DataFrame]:
    """What sync_divisions asks with, over a transport: it gets an empty keyword, the code and page 1."""

    def ask(codes: DataFrame) -> DataFrame:
        rows = codes.select(F.lit("").alias("keyword"), "code", F.lit(1).alias("page")).repartition(parallel)
        return replay.fetch_answers(rows, fetch, qps, attempts).select("code", "payload")

    return ask


def crawl_divisions(pages: DataFrame, seeds: DataFrame, base_url: str, most: int = 20) -> DataFrame:
    """Divisions reached from the seeds (code) over pages (code, url, html): provinces and cities are entered, the tables of the others give their towns."""
    own = html.divisions_of(pages.select("html", "url")).where("code <> ''")
    linked = html.children_of_pages(pages.join(own.select("code", F.col("source_url").alias("url"), "level"), "url").select("url", "level", F.col("html"), own["code"].alias("parent")), ["parent", "level"])
    edges = linked.select("code", F.col("parent").alias("parent_code"), "level")
    entered = hierarchy.expand(edges.where(F.col("level").isin("province", "city")), seeds.select("code", F.lit("").alias("parent_code")), most=most)
    visited = own.drop("parent_code").join(entered.select("code", "parent_code"), "code").select(*own.columns)
    rest = linked.where(~F.col("level").isin("province", "city")).join(entered.select(F.col("code").alias("parent")), "parent", "left_semi")
    towns = html.child_divisions(rest, F.col("parent"), base_url)
    return visited.unionByName(towns.join(visited.select("code"), "code", "left_anti").dropDuplicates(["code"]))


def summary(places: DataFrame) -> DataFrame:
    """(keyword, n_places, n_partitions) of a run."""
    return places.groupBy("keyword").agg(F.count("*").alias("n_places"), F.count_distinct("partition_code").alias("n_partitions"))


def sample_run(spark: SparkSession, folder: str, now: str, formats: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Sample regions, geocoded, put into a region table, exported, and recorded as a run: (regions, runs, exported files)."""
    regions = hierarchy.fill_coordinates(files.sample_regions(spark, now), F.broadcast(files.sample_points(spark))).select(*schemas.REGION.fieldNames())
    stored = upsert.upsert_regions(spark.createDataFrame([], schemas.REGION), regions)
    out = exports.export(stored.orderBy("code"), folder, formats, "regions", "regions", ["code", "version"])
    run = spark.createDataFrame([(now.translate({ord(c): None for c in "-: T"}), "sample", "done", stored.count(), now, now, "")], schemas.RUN)
    return stored, upsert.upsert_runs(spark.createDataFrame([], schemas.RUN), run), out


def agreeing(tasks: DataFrame) -> DataFrame:
    """tasks, or an error where they differ in the total table or the formats: tasks that run together share both."""
    if tasks.select("total_path", F.array_join("formats", ",")).distinct().limit(2).count() > 1:
        raise ValueError("parallel tasks must share the total table and the formats")
    return tasks


def task_partitions(tasks: DataFrame) -> DataFrame:
    """(task, keyword) of task rows (task, chars, total_path, formats): Spark schedules them all as one table."""
    return agreeing(tasks).select("task", F.explode(scalar.distinct_chars(F.col("chars"))).alias("keyword"))


class CollectedTasks(NamedTuple):
    places: DataFrame  #: task and the columns of a place: one row a task and source_id, the last found wins
    partitions: DataFrame  #: (task, keyword, code, total, page) that were read
    progress: DataFrame  #: (task, keyword, code) tokens that are complete now, those of before included


def collect_tasks(
    answers: DataFrame, divisions: DataFrame, tasks: DataFrame, now: Column, progress: DataFrame | None = None, mode: str = "contain", threshold: int = 3000, size: int = 100,
) -> CollectedTasks:
    """Several searches over the same answers as one job: tasks (task, chars, provinces, total_path, formats), no provinces meaning all.

    Each task is what `collect_places` does with its keywords and provinces, and has progress of its own. An answer that
    several tasks need is parsed and projected once. A top division without an answer is not complete.
    Tasks must agree on the total table and the formats; a task without keywords finds nothing.
    """
    words = agreeing(tasks).select("task", "provinces", F.posexplode(scalar.distinct_chars(F.col("chars"))).alias("_rank", "keyword"))
    found = answers.withColumn("_v", variant.parsed(F.col("payload")))
    told = found.where("page = 1").select("keyword", "code", variant.total_of(F.col("_v"), F.lit(0).cast("long")).alias("total"))
    nodes = divisions.select("code", F.when(F.col("parent_code") != ROOT, F.col("parent_code")).alias("parent_code"))
    wanted = F.col("parent_code").isNotNull() | (F.coalesce(F.size("provinces"), F.lit(0)) < 1) | F.array_contains("provinces", F.col("code"))
    counts = told.join(nodes, "code").join(words, "keyword").where(wanted)
    token = F.struct("task", "keyword").alias("keyword")  # keywords of different tasks are different keywords
    done = progress.select(token, "code") if progress is not None else None
    split = hierarchy.adaptive_partitions(counts.select(token, "code", "parent_code", "total"), threshold, size, done)
    partitions = cut(split.select("keyword.task", "keyword.keyword", "code", "total", "page"))
    pages = partitions.select("keyword", "code", "page").distinct()
    raw = found.join(pages, ["keyword", "code", "page"]).select("keyword", F.col("code").alias("partition_code"), "page", F.posexplode(variant.records_of(F.col("_v"))).alias("_at", "_r"))
    raw = raw.select("keyword", "partition_code", F.format_string("%09d|%09d", "page", "_at").alias("source_url"), variant.canonical(F.col("_r")).alias("raw"))
    rows = projection.place_rows(raw.withColumns({"match_mode": F.lit(mode), "fetched_at_utc": now}), now)
    rows = rows.withColumn("page", F.substring_index("source_url", "|", 1).cast("long"))
    read_by = partitions.join(words.select("task", "keyword", "_rank"), ["task", "keyword"]).select("task", "keyword", "_rank", F.col("code").alias("partition_code"), "page")
    rows = rows.join(read_by, ["keyword", "partition_code", "page"])
    last = upsert.last_wins(rows, ["task", "source_id"], ["_rank", "partition_code", "source_url"])
    places = last.withColumn("source_url", F.lit("")).select("task", *schemas.PLACE.fieldNames())
    tops = counts.where("parent_code is null").select("task", "keyword", "code")
    tokens = tops.unionByName(partitions.select("task", "keyword", "code")).distinct()
    return CollectedTasks(places, partitions, tokens.unionByName(progress.select(*tokens.columns)).distinct() if progress is not None else tokens)


def task_summary(places: DataFrame) -> DataFrame:
    """(task, n_places, n_partitions) of the places of several tasks."""
    return places.groupBy("task").agg(F.count("*").alias("n_places"), F.count_distinct("keyword", "partition_code").alias("n_partitions"))
