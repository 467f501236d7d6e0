"""Command line: python -m gazetta.cli COMMAND. Tables are Parquet paths; a new table goes to --out, never over its input."""

from __future__ import annotations

import argparse
import importlib
import json
import os
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta import schemas
from gazetta.operators import stats, tasks, upsert
from gazetta.plans import collect, details
from gazetta.sinks import commits, totals
from gazetta.sinks import exports
from gazetta.sources import files

MODES = ("contain", "exact")


def transport(name: str) -> Callable:
    """The function named MODULE:FUNCTION, which the executors must be able to import too."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def task_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Task files as rows for collect.collect_tasks; a task is named by its file, and two of one name are an error."""
    rows = []
    for path in paths:
        got = files.task(path)
        export = got.get("export") or []
        formats = export if isinstance(export, list) else [f.strip() for f in str(export).split(",")]
        rows.append((Path(path).stem, got.get("chars") or "", [str(c) for c in got.get("province_codes") or []], got.get("total_db_path"), formats))
    if len({r[0] for r in rows}) < len(rows):
        raise ValueError("task files must have different names")
    return spark.createDataFrame(rows, "task string, chars string, provinces array<string>, total_path string, formats array<string>")


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="gazetta")
    commands = out.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, /, *options: str, **more: dict) -> None:
        p = commands.add_parser(name, help=text)
        for o in options:
            p.add_argument(f"--{o}", required=True)
        for o, kind in more.items():
            p.add_argument(f"--{o.replace('_', '-')}", **kind)

    many, formats = {"nargs": "+", "required": True}, {"nargs": "*", "default": ["all"]}
    add("sample", "run the sample regions", "out", formats=formats)
    add("search", "collect places from recorded answers", "answers", "divisions", "chars", "out", mode={"choices": MODES, "default": "contain"}, provinces={"nargs": "*"}, progress={}, threshold={"type": int, "default": 3000}, page_size={"type": int, "default": 100})
    add("search-live", "collect places over a transport, in --out; goes on from its progress with --resume", "transport", "divisions", "chars", "out", mode={"choices": MODES, "default": "contain"}, provinces={"nargs": "*"}, resume={"action": "store_true"}, threshold={"type": int, "default": 3000}, page_size={"type": int, "default": 100}, workers={"type": int, "default": 8}, qps={"type": float, "default": 0.0}, flush={"type": int, "default": 5000}, max_runtime_seconds={"type": float}, total_path={}, sync_divisions_first={})
    add(
        "search-tasks", "collect places for several task files as one job", "answers", "divisions", "out",
        json={"action": "append", "required": True}, progress={}, mode={"choices": MODES, "default": "contain"}, threshold={"type": int, "default": 3000}, page_size={"type": int, "default": 100},
    )
    add(
        "sync-divisions", "complete a division table over a transport, asking for the children of unknown parents only", "transport", "out",
        divisions={}, marks={}, root={"default": collect.ROOT}, workers={"type": int, "default": 8}, qps={"type": float, "default": 0.0},
    )
    add("details", "fetch the details of open tasks in --folder", "transport", "folder", "run-id", ids={"nargs": "*", "default": []}, batch={"type": int, "default": 5000}, attempts={"type": int, "default": 3}, qps={"type": float, "default": 0.0}, max_runtime_seconds={"type": float}, worker={"default": "w0"})
    add("ladder", "place calls at rising rates until one is refused", "transport", levels={"nargs": "+", "type": float, "default": list(details.LADDER)}, ids={"nargs": "+", "required": True}, seconds={"type": float, "default": 30.0}, sample={"type": int, "default": 100}, out={})
    add("show-config", "the settings as they hold: YAML, then an env file, then the environment", config={"default": "config.yaml"}, sections={"nargs": "*", "default": []}, env_file={"default": ".env"}, prefix={"default": "GAZETTA_"})
    add("divisions", "crawl divisions from pages", "pages", "seed", "out", base_url={"default": ""})
    add("export", "export a table", "table", "out", formats=formats, name={"default": "places"}, keys={"nargs": "*", "default": []})
    add("sync-ids", "add the ids of files to a pool", "pool", "out", ids=many)
    add("status", "count the tasks by status", "tasks")
    add("reconcile", "mark tasks by the master table", "tasks", "master", "out")
    add("merge", "merge detail rows into a master table", "master", "out", "run-id", details=many)
    add("calibrate", "latency by level and the safe rate", "calls")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("gazetta").getOrCreate()
    now = datetime.now(UTC).isoformat(timespec="seconds")
    read = spark.read.parquet
    shown: object = None
    if args.command == "sample":
        shown = collect.sample_run(spark, args.out, now, args.formats)[2]
    elif args.command == "search":
        chars = files.characters(spark, args.chars).first().chars
        got = collect.collect_places(read(args.answers), read(args.divisions), chars, F.lit(now), read(args.progress) if args.progress else None, args.provinces, args.mode, args.threshold, args.page_size)
        got.places.write.mode("overwrite").parquet(f"{args.out}/places")
        got.progress.write.mode("overwrite").parquet(f"{args.out}/progress")
        shown = {r.keyword: r.n_places for r in collect.summary(read(f"{args.out}/places")).collect()}
    elif args.command == "search-live":
        chars, divisions, before = files.characters(spark, args.chars).first().chars, read(args.divisions), None
        if args.sync_divisions_first:
            ask = collect.children_by(transport(args.sync_divisions_first), args.workers, args.qps)
            found = collect.sync_divisions(divisions, spark.createDataFrame([], schemas.FETCH_MARK), ask, F.lit(now)).divisions
            found.write.mode("overwrite").parquet(f"{args.out}/divisions")
            divisions = read(f"{args.out}/divisions")
        if args.resume and commits.listed(spark, f"{args.out}/progress"):
            before = read(f"{args.out}/progress").select("keyword", "code").distinct()
        if not args.resume:
            commits.delete(spark, f"{args.out}/asked")
        answers = collect.search_live(divisions, chars, transport(args.transport), before, args.provinces, args.threshold, args.page_size, args.workers, args.qps, folder=f"{args.out}/asked", flush=args.flush, seconds=args.max_runtime_seconds)
        got = collect.collect_places(answers, divisions, chars, F.lit(now), before, args.provinces, args.mode, args.threshold, args.page_size)
        run = "run=" + now.translate({ord(c): None for c in "-:+T"})
        failed = answers.where("error is not null")
        got.places.write.mode("overwrite").parquet(f"{args.out}/places/{run}")
        if args.total_path:
            totals.put(read(f"{args.out}/places/{run}"), args.total_path)
        collect.whole(got.progress, failed, divisions).write.mode("overwrite").parquet(f"{args.out}/progress/{run}")
        shown = {"places": read(f"{args.out}/places/{run}").count(), "failed_requests": failed.count()}
        commits.delete(spark, f"{args.out}/asked")  # what is complete is in progress now, and the rest is to be asked again
    elif args.command == "search-tasks":
        rows = task_rows(spark, args.json)
        got = collect.collect_tasks(read(args.answers), read(args.divisions), rows, F.lit(now), read(args.progress) if args.progress else None, args.mode, args.threshold, args.page_size)
        got.places.write.mode("overwrite").partitionBy("task").parquet(f"{args.out}/places")
        got.progress.write.mode("overwrite").parquet(f"{args.out}/progress")
        stored = spark.read.schema(got.places.schema).parquet(f"{args.out}/places")
        first = rows.first()
        if first.total_path:
            totals.put(stored.drop("task"), first.total_path)
        if first.formats:
            exports.export(upsert.last_wins(stored.drop("task"), ["source_id"], ["updated_at"]), args.out, first.formats, "places", "places", ["source_id"])
        shown = {r.task: r.n_places for r in collect.task_summary(stored).collect()}
    elif args.command == "sync-divisions":
        cached = read(args.divisions) if args.divisions else spark.createDataFrame([], schemas.DIVISION)
        marks = read(args.marks) if args.marks else spark.createDataFrame([], schemas.FETCH_MARK)
        got = collect.sync_divisions(cached, marks, collect.children_by(transport(args.transport), args.workers, args.qps), F.lit(now), args.root)
        got.divisions.write.mode("overwrite").parquet(f"{args.out}/divisions")
        got.marks.write.mode("overwrite").parquet(f"{args.out}/marks")
        shown = {"divisions": read(f"{args.out}/divisions").count(), "asked": got.asked.count(), "failed": got.failed.count()}
    elif args.command == "details":
        ids = files.ids(spark, *args.ids) if args.ids else None
        done = details.run_details(spark, args.folder, transport(args.transport), getattr(args, "run_id"), ids, args.batch, args.attempts, qps=args.qps, seconds=args.max_runtime_seconds, worker=args.worker)
        shown = {"batches": done.batches, "done": done.done, "failed": done.tasks.where("status = 'failed'").count(), "master": done.master.count()}
    elif args.command == "ladder":
        got = details.calibrate(files.ids(spark, *args.ids), transport(args.transport), args.levels, args.seconds, args.sample)
        if args.out:
            got.calls.write.mode("overwrite").parquet(args.out)
        shown = {"levels": [r.asDict() for r in got.levels.orderBy("qps").collect()], **got.rate.first().asDict()}
    elif args.command == "show-config":
        shown = files.merged_settings(files.yaml_settings(args.config, args.sections), files.prefixed(files.env_file(args.env_file), args.prefix), files.prefixed(os.environ, args.prefix))
    elif args.command == "divisions":
        rows = collect.crawl_divisions(read(args.pages), spark.createDataFrame([(args.seed,)], "code string"), args.base_url)
        rows.withColumn("captured_at", F.lit(now)).write.mode("overwrite").parquet(args.out)
        shown = {r.level: r.n for r in stats.count_by(read(args.out), "level").collect()}
    elif args.command == "export":
        shown = exports.export(read(args.table), args.out, args.formats, args.name, args.name, args.keys)
    elif args.command == "sync-ids":
        added = upsert.insert_ignore(read(args.pool), files.ids(spark, *args.ids))
        added.table.write.mode("overwrite").parquet(args.out)
        shown = added.counts.first().asDict()
    elif args.command == "status":
        shown = {r.status: r.n for r in tasks.status_counts(read(args.tasks)).collect()}
        shown["completion"] = shown["done"] / shown["total"] if shown["total"] else 0
    elif args.command == "reconcile":
        master = read(args.master)
        tasks.sync_done(tasks.fix_inconsistent(read(args.tasks), master, F.lit(now)), master, F.lit(now)).write.mode("overwrite").parquet(args.out)
    elif args.command == "merge":
        master, counts, rejected = upsert.merge_workers(read(args.master), read(*args.details), F.lit(getattr(args, "run_id")), F.lit(now), ["fetched_at", "worker_id", "attempt"])
        master.write.mode("overwrite").parquet(args.out)
        shown = counts.first().asDict() | {"errors": rejected.count()}
    elif args.command == "calibrate":
        levels = stats.latency_summary(read(args.calls), ["qps"]).orderBy("qps")
        shown = {"levels": [r.asDict() for r in levels.collect()], **stats.safe_rate(levels).first().asDict()}
    print(json.dumps(shown, ensure_ascii=False, indent=2))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
