"""Append-only tables: commits, the master table in runs, and the task log."""

import random
import threading
import time

import pytest
from gazetta import schemas
from gazetta.sinks import commits, master, tasklog
from pyspark.sql import functions as F


def detail(key, code, at="t0"):
    return {"id": key, "raw_json": "{}", "worker_id": "w", "attempt": 1, "place_code": code, "fetched_at": at}


def test_one_of_many_writers_makes_a_commit(spark, tmp_path):
    root, won, lost = str(tmp_path / "log"), [], []

    def write(k):
        try:
            commits.commit(spark, root, 0, {"by": k})
            won.append(k)
        except commits.Conflict:
            lost.append(k)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and len(lost) == 7 and commits.history(spark, root) == [commits.Commit(0, {"by": won[0]})]


def test_a_marker_of_a_dead_writer_says_nothing(spark, tmp_path):
    root = tmp_path / "log"
    commits.commit(spark, str(root), 0, {"a": 1})
    (root / "_commits" / f"{1:012}.json").touch()
    assert commits.last_version(spark, str(root)) == 1
    assert [c.version for c in commits.history(spark, str(root), patience=0.3)] == [0]


def test_a_batch_costs_the_same_however_large_the_master_is(spark, tmp_path):
    spent = []
    for n in (2000, 20000):
        root = str(tmp_path / f"master{n}")
        master.create(spark, root, buckets=4)
        master.append(spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("{}").alias("raw_json"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.DETAIL if f.name not in ("id", "raw_json")]), root, "r0")
        before = commits.size(spark, root)
        master.append(spark.createDataFrame([detail(f"new{k}", "1") for k in range(200)], schemas.DETAIL), root, "r1")
        spent.append(commits.size(spark, root) - before)
        assert master.read(spark, root).count() == n + 200
    assert spent[1] < 1.2 * spent[0]


def test_runs_and_compactions_keep_the_newest_row_and_the_first_time(spark, tmp_path):
    root, rng, want, first = str(tmp_path / "master"), random.Random(1), {}, {}
    master.create(spark, root, buckets=3)
    master.create(spark, root, buckets=99)  # it is there
    for turn in range(7):
        rows = [detail(str(rng.randrange(40)), f"{turn}.{k}", f"t{turn}{k:02}") for k in range(15)]
        master.append(spark.createDataFrame([*rows, detail(None, "x"), {**detail("9", "x", "t9"), "raw_json": None}], schemas.DETAIL), root, f"run{turn}")
        for r in rows:
            want[r["id"]] = (r["place_code"], f"run{turn}")
            first.setdefault(r["id"], turn)
        if turn == 0:
            started = master.read(spark, root).agg(F.max("first_seen_at")).first()[0]
            time.sleep(1.1)
    now = master.state(spark, root)
    assert now.buckets == 3 and set(now.runs) <= {0, 1, 2}
    assert any(r.version > 0 and len(rs) >= 1 for rs in now.runs.values() for r in rs)
    got = {r.id: r for r in master.read(spark, root).collect()}
    assert {k: (r.place_code, r.source_run_id) for k, r in got.items()} == want
    assert all((r.first_seen_at <= started) == (first[k] == 0) and r.last_seen_at >= r.first_seen_at for k, r in got.items())


def test_a_compaction_leaves_later_runs_and_drops_old_files_late(spark, tmp_path):
    root = str(tmp_path / "master")
    master.create(spark, root, buckets=1)
    for turn in range(3):
        master.append(spark.createDataFrame([detail(str(k), str(turn)) for k in range(10)], schemas.DETAIL), root, "r", compacting=False)
    old = master.read(spark, root)
    assert master.compact(spark, root) == 1 and [len(rs) for rs in master.state(spark, root).runs.values()] == [1]
    assert old.count() == 10  # a reader that began before still finds its files
    master.append(spark.createDataFrame([detail("1", "new")], schemas.DETAIL), root, "r", compacting=False)
    assert master.compact(spark, root) == 0 and master.compact(spark, root, share=0.05) == 1
    assert {r.id: r.place_code for r in master.read(spark, root).collect()} == {str(k): "2" for k in range(10)} | {"1": "new"}
    with pytest.raises(Exception):  # noqa: B017
        old.count()


def test_a_stream_batch_counts_once_and_old_markers_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "WHOLE", 4)
    root = str(tmp_path / "master")
    for number in (0, 1, 1, 0, 2, 3, 4, 5):
        master.append(spark.createDataFrame([detail("a", str(number))], schemas.DETAIL), root, "r", stream="s", number=number)
    assert master.state(spark, root).batches == {"s": 5} and master.read(spark, root).first().place_code == "5"
    assert len(commits.history(spark, root)) <= 4 and master.append(spark.createDataFrame([], schemas.DETAIL), root, "r") == -1


def slow_fold(events):
    """Tasks after events (id, kind, worker, at, error) one after another."""
    state = {}
    for key, kind, worker, at, error in events:
        task = state.setdefault(key, {"status": None, "claimed_by": None, "claimed_at": None, "done_at": None, "attempts": 0, "last_error": None, "updated_at": at})
        if kind == "added":
            task["status"] = task["status"] or "pending"
            continue
        task["status"], task["updated_at"] = {"released": "pending", "reset": "pending"}.get(kind, kind), at
        if kind in ("claimed", "released"):
            task["claimed_by"], task["claimed_at"] = (worker, at) if kind == "claimed" else (None, None)
        elif kind in ("done", "reset"):
            task["done_at"] = at if kind == "done" else None
        if kind in ("done", "retry", "failed"):
            task["last_error"] = None if kind == "done" else error
            task["attempts"] += kind != "done"
    return state


@pytest.mark.parametrize("seed", range(3))
def test_folding_matches_one_event_after_another(spark, tmp_path, seed):
    rng, root, events = random.Random(seed), str(tmp_path / "tasks"), []
    for commit in range(4):
        new = [(str(rng.randrange(12)), rng.choice(tasklog.KINDS), f"w{rng.randrange(3)}", f"t{commit}{k:03}", rng.choice([None, "e1", "e2"])) for k in range(20)]
        events += new
        rows = spark.createDataFrame([(*e, k) for k, e in enumerate(new)], "id string, kind string, worker string, at string, error string, step long")
        tasklog.append(rows.repartition(3), root, share=(0.5, 1e9)[commit % 2])
    got = {r.id: r.asDict() for r in tasklog.read(spark, root).collect()}
    assert {k: {c: v for c, v in r.items() if c != "id"} for k, r in got.items()} == {k: v | {"status": v["status"] or "pending"} for k, v in slow_fold(events).items()}


def test_of_two_writers_at_one_version_one_gets_an_error(spark, tmp_path):
    root, now = str(tmp_path / "tasks"), F.lit("2024-01-01T00:00:00")
    tasklog.add(spark.createDataFrame([(str(k),) for k in range(20)], "id string"), root, now)
    version = commits.last_version(spark, root) + 1
    rows = tasklog.read(spark, root).limit(5).select("id", F.lit("claimed").alias("kind"), now.alias("at"))
    tasklog.append_at(rows, root, version)
    with pytest.raises(commits.Conflict):
        tasklog.append_at(rows, root, version)
    assert tasklog.read(spark, root).where("status = 'claimed'").count() == 5


def test_claims_of_workers_at_once_never_meet(spark, tmp_path):
    root, got = str(tmp_path / "tasks"), {}
    tasklog.add(spark.createDataFrame([(str(k),) for k in range(30)], "id string"), root, F.lit("2024-01-01T00:00:00"))

    def work(name):
        got[name] = [r.id for r in tasklog.claim(spark, root, name, 8, F.current_timestamp()).collect()]

    threads = [threading.Thread(target=work, args=(f"w{k}",)) for k in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    every = [k for ids in got.values() for k in ids]
    assert len(every) == len(set(every)) == 24
    tasklog.release(spark, root, "w1", F.lit("2024-01-02T00:00:00"))
    state = {r.id: r for r in tasklog.read(spark, root).collect()}
    assert {k for k, r in state.items() if r.status == "claimed"} == set(got["w0"]) | set(got["w2"])
    assert len(tasklog.claim(spark, root, "w3", 100, F.current_timestamp()).collect()) == 14


def test_a_batch_of_events_costs_the_same_however_many_tasks_there_are(spark, tmp_path):
    spent = []
    for n in (2000, 20000):
        root = str(tmp_path / f"tasks{n}")
        tasklog.append(spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("added").alias("kind"), F.lit("t").alias("at")), root)
        before = commits.size(spark, root)
        tasklog.append(spark.range(100).select(F.col("id").cast("string").alias("id"), F.lit("done").alias("kind"), F.lit("u").alias("at")), root)
        spent.append(commits.size(spark, root) - before)
    assert spent[1] < 1.2 * spent[0]


def test_snapshots_drop_what_they_replace(spark, tmp_path):
    root = str(tmp_path / "tasks")
    for turn in range(6):
        tasklog.append(spark.createDataFrame([(str(k), "retry", f"t{turn}") for k in range(10)], "id string, kind string, at string"), root)
    assert {r.attempts for r in tasklog.read(spark, root).collect()} == {6}
    assert len([n for n in commits.listed(spark, root) if n.startswith("data-")]) <= 4 and len(commits.listed(spark, f"{root}/_commits")) <= 2
