"""Keyword tables, running values, interval labels, pools with filters, bucketed upserts, observed merges and timed claims."""

import random
from collections import defaultdict

import pytest
from gazetta.operators import hierarchy, scan, search, tasks, upsert
from gazetta.sinks import buckets, pool
from gazetta.streaming import claims, control
from pyspark.sql import functions as F


@pytest.fixture
def several_ranges(spark):
    """Small tables are in one range otherwise."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("most", [4_000_000, 9])
def test_many_keywords_match_brute_force(spark, most):
    rng = random.Random(2)
    names = [(k, "".join(rng.choice("abc村é\U0001f600 ") for _ in range(rng.randrange(12)))) for k in range(120)] + [(900, None), (901, ""), (902, "村" * 5000)]
    words = [None, "", "a", "村", "ab", "abc", "村é", "\U0001f600", "ca b", "zz", "ab", "村" * 40]
    df = spark.createDataFrame(names, "n long, name string")
    got = search.search_many(df, spark.createDataFrame([(w,) for w in words], "keyword string"), most=most)
    want = sorted((n, w) for n, name in names if name is not None for w in {w for w in words if w is not None} if w in name)
    assert got.columns == ["n", "name", "keyword"] and sorted((r.n, r.keyword) for r in got.collect()) == want
    exact = search.search_many(df, spark.createDataFrame([(w,) for w in words], "keyword string"), "exact")
    assert sorted((r.n, r.keyword) for r in exact.collect()) == sorted((n, name) for n, name in names if name is not None and name in words)
    assert search.search_many(df, spark.createDataFrame([], "keyword string")).count() == 0 and search.search_many(df.limit(0), spark.createDataFrame([("ab",)], "keyword string")).count() == 0
    with pytest.raises(ValueError):
        search.search_many(df, df.select(F.col("name").alias("keyword")), "fuzzy")


@pytest.mark.parametrize("mode", ["contain", "exact"])
def test_hits_carry_no_text_that_is_not_kept(spark, mode):
    df = spark.createDataFrame([(1, "ab c", "t"), (2, "c", "t"), (3, None, "u")], "n long, name string, table string")
    words = spark.createDataFrame([("ab",), ("c",), ("",), ("b c",)], "keyword string")
    got = search.search_many(df, words, mode, keep=["table", "n"])
    want = {"contain": [("t", 1, ""), ("t", 1, "ab"), ("t", 1, "b c"), ("t", 1, "c"), ("t", 2, ""), ("t", 2, "c")], "exact": [("t", 2, "c")]}
    assert got.columns == ["table", "n", "keyword"] and sorted(map(tuple, got.collect())) == want[mode]
    assert sorted(r.keyword for r in search.search_many(df, words, mode, keep=[]).collect()) == sorted(k for _, _, k in want[mode])


def test_many_keywords_hold_no_texts(spark, sf001):
    """Counting hits must not copy a text for each: only tables and keywords leave the automaton."""
    from gazetta.plans.queries import QUERIES

    plan = QUERIES["keyword_many"](spark, sf001)._jdf.queryExecution().optimizedPlan().toString()
    made = [line for line in plan.splitlines() if "MapInArrow" in line]
    assert len(made) == 2 and not any("name" in line.split("[")[-1].split("]")[0] for line in made), made


def test_keywords_beyond_the_plan_of_one_condition(spark, sf001):
    part = spark.read.parquet(f"{sf001}/part.parquet").select("p_partkey", F.col("p_name").alias("name"))
    words = ["ring", "r", "small ring", "hot"]
    one = search.search(part, words)
    many = search.search_many(part, spark.createDataFrame([(w,) for w in [*words, *(f"absent {k}" for k in range(20000))]], "keyword string"))
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, one.collect()))


def slow_departures(calls, gap):
    out, free = {}, {}
    for at, n, user in sorted((at, n, user) for n, user, at in calls):
        out[n] = max(at, free.get(user, at))
        free[user] = out[n] + gap
    return out


def test_departures_match_a_loop_over_each_users_calls(spark, several_ranges):
    rng = random.Random(4)
    calls = [(n, "hot" if n % 3 else rng.choice(["a", "b", None]), rng.randrange(200_000)) for n in range(1500)]
    df = spark.createDataFrame(calls, "n long, user string, at long").repartition(6)
    got = scan.departures(df, "user", F.col("at"), ["n"], F.lit(100))
    assert {r.n: r.departs for r in got.collect()} == slow_departures([(n, u or "", at) for n, u, at in calls], 100)
    assert got.columns == ["n", "user", "at", "departs"]
    ranges = scan.ranged(df, ["user"], ["at", "n"]).where("user = 'hot'").select("_p").distinct().count()
    assert ranges > 1 and scan.departures(df.limit(0), "user", F.col("at"), ["n"], F.lit(100)).count() == 0


def test_sums_before_match_a_loop(spark, several_ranges):
    rng = random.Random(5)
    rows = [(n, rng.choice("aaab") if n % 7 else None, rng.randrange(-5, 9)) for n in range(800)]
    got = {r.n: r.total for r in scan.sum_before(spark.createDataFrame(rows, "n long, k string, v long"), ["k"], ["n"], F.col("v"), "total").collect()}
    sums = defaultdict(int)
    for n, k, v in rows:
        assert got[n] == sums[k]
        sums[k] += v


def slow_intervals(parents):
    children = defaultdict(list)
    for code in sorted(parents):
        children[parents[code] if parents[code] in parents else None].append(code)
    out, place = {}, 0
    stack = [(c, 0) for c in reversed(children[None])]
    order = []
    while stack:
        code, depth = stack.pop()
        order.append(code)
        out[code] = [depth, place, place]
        place += 1
        stack += [(c, depth + 1) for c in reversed(children[code])]
    for code in reversed(order):
        for c in children[code]:
            out[code][2] = max(out[code][2], out[c][2])
    return {c: tuple(v) for c, v in out.items()}


def test_intervals_match_a_walk(spark, several_ranges):
    rng = random.Random(6)
    parents = {f"{k:03}": f"{rng.randrange(k):03}" if k > 3 else rng.choice([None, "gone"]) for k in range(300)}
    labelled = hierarchy.intervals(spark.createDataFrame(list(parents.items()), "code string, parent_code string"))
    rows = labelled.collect()
    assert {r.code: (r.depth, r["first"], r["last"]) for r in rows} == slow_intervals(parents)
    inside = {r.code for r in hierarchy.below(labelled, "001").collect()}
    up = lambda c: c is not None and (parents.get(c) == "001" or up(parents.get(c)))
    assert inside == {c for c in parents if up(c)}
    assert hierarchy.intervals(spark.createDataFrame([], "code string, parent_code string")).count() == 0


def test_a_long_chain_takes_few_rounds_and_a_cycle_is_an_error(spark, monkeypatch):
    rounds, once = [], hierarchy._double
    monkeypatch.setattr(hierarchy, "_double", lambda *a: rounds.append(1) or once(*a))
    chain = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("code"), F.when(F.col("id") > 0, F.lpad((F.col("id") - 1).cast("string"), 5, "0")).alias("parent_code"))
    got = hierarchy.intervals(chain).agg(F.max("depth"), F.min("last"), F.max("first"), F.count_if(F.col("first") == F.col("depth"))).first()
    assert tuple(got) == (9999, 9999, 9999, 10000) and len(rounds) <= 2 * 15
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.intervals(spark.createDataFrame([("a", "b"), ("b", "a"), ("c", None)], "code string, parent_code string"))


def test_a_pool_reads_only_buckets_that_may_know_an_id(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pool, "MOST_RUNS", 2)
    root = str(tmp_path / "pool")
    ids = lambda names: spark.createDataFrame([(n,) for n in names], "id string")
    pool.create(spark, root, buckets=64, words=1024)
    assert pool.insert_ignore(ids([str(k) for k in range(3000)] + ["1", None]), root)[:3] == (3000, 2, 3002)
    got = pool.insert_ignore(ids([f"new{k}" for k in range(300)]), root)
    assert got[:3] == (300, 0, 300) and len(got.read) < 5
    got = pool.insert_ignore(ids(["7", "new5", "x1", "x1"]), root)
    assert got[:3] == (1, 3, 4) and 1 <= len(got.read) <= 4
    assert pool.insert_ignore(ids(["y"]), root).added == 1 and pool.insert_ignore(ids(["y", "x1", "2999"]), root)[:3] == (0, 3, 3)
    assert sorted(r.id for r in pool.read(spark, root).collect()) == sorted([str(k) for k in range(3000)] + [f"new{k}" for k in range(300)] + ["x1", "y"])
    assert pool.insert_ignore(ids([]), root)[:3] == (0, 0, 0)


def test_a_bucketed_upsert_moves_only_new_rows(spark):
    old = spark.range(500).select(F.col("id").cast("string").alias("id"), F.lit("old").alias("name"), F.lit("t0").alias("captured_at"))
    new = spark.range(400, 600).select(F.col("id").cast("string").alias("id"), F.lit("new").alias("name"), F.lit("t1").alias("captured_at"))
    buckets.store(old, "t_old", ["id"], 4)
    plan = upsert.upsert(spark.table("t_old"), new.repartition(4, "id"), ["id"], keep=["captured_at"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    got = buckets.put_in(spark, "t_old", "t_new", new, ["id"], keep=["captured_at"])
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert buckets.buckets_of(spark, "t_new") == 4
    assert {r.id: (r.name, r.captured_at) for r in got.collect()} == {str(k): ("new" if k >= 400 else "old", "t0" if k < 500 else "t1") for k in range(600)}


def test_samples_do_not_depend_on_partitions(spark):
    rows = spark.range(1000).toDF("id")
    pick = lambda df, seed: sorted(r.id for r in tasks.exact_sample(df, 50, seed).collect())
    assert pick(rows.repartition(1), 3) == pick(rows.repartition(7), 3) != pick(rows, 4) and len(pick(rows.limit(20), 3)) == 20


def test_claims_are_released_by_timers_and_by_later_events(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", claims.PROVIDER)
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    kind = "id string, kind string, worker string, ts timestamp"
    turns = [
        [("a", "claimed", "w1", 0), ("b", "claimed", "w1", 0), ("c", "claimed", "w2", 0), ("c", "done", "w2", 20), ("d", "claimed", "w1", 10), (None, "claimed", "w1", 0)],
        [("b", "claimed", "w3", 40), ("d", "released", "w1", 35), ("e", "done", None, 45)],  # b and d: 40 and 25 minutes later
        [("e", "done", None, 200)],
    ]
    for rows in turns:
        data = [(i, k, w, m) for i, k, w, m in rows]
        spark.createDataFrame(data, "id string, kind string, worker string, m int").select("id", "kind", "worker", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("m") * 60).alias("ts")).write.mode("append").parquet(source)
        query = claims.timed_out(spark.readStream.schema(kind).parquet(source), 30).writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
        control.await_within(query, 200)
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass") if before is None else spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = sorted((r.id, r.worker, int(r.claimed_at.timestamp() - 1_700_000_000) // 60, int(r.released_at.timestamp() - 1_700_000_000) // 60) for r in spark.read.schema(claims.RELEASED).parquet(out).collect())
    assert got == [("a", "w1", 0, 30), ("b", "w1", 0, 30), ("b", "w3", 40, 70)]


def test_claims_count_at_their_own_time_however_events_arrive(spark, tmp_path):
    """Brute force over all events in their order; each turn brings some that are older than what came before."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", claims.PROVIDER)
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rng, kinds = random.Random(6), ["claimed", "claimed", "done", "retry", None]
    rows = [(f"t{rng.randrange(40)}", rng.choice(kinds), f"w{rng.randrange(3)}", 10 * rng.randrange(60), n) for n in range(300)]
    rows += [("edge", "claimed", "w0", 0, 1000), ("edge", "claimed", "w1", 30, 1001), ("tie", "claimed", "w9", 50, 1002), ("tie", "claimed", "w1", 50, 1003), ("end", "done", None, 2000, 1004)]
    schema = "id string, kind string, worker string, ts timestamp, step long"
    for turn in range(2):
        part = [r for r in rows if (r[4] % 2 == turn if r[0] != "end" else turn == 1)]
        spark.createDataFrame(part, "id string, kind string, worker string, m int, step long").select("id", "kind", "worker", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("m") * 60).alias("ts"), "step").write.mode("append").parquet(source)
        stream = claims.timed_out(spark.readStream.schema(schema).parquet(source), 30, "2 days" if turn == 0 else "0 seconds", order=["step"])
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
        control.await_within(query, 200)
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass") if before is None else spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    tasks_of = defaultdict(list)
    for i, kind, worker, m, step in rows:
        tasks_of[i].append((m, kind is None, kind or "", step, worker))
    want = []
    for i, events in tasks_of.items():
        events.sort()
        ends = [e[0] for e in events[1:]] + [None]
        want += [(i, e[4], e[0]) for e, after in zip(events, ends, strict=True) if e[2] == "claimed" and (after is None or after > e[0] + 30)]
    got = [(r.id, r.worker, int(r.claimed_at.timestamp() - 1_700_000_000) // 60) for r in spark.read.schema(claims.RELEASED).parquet(out).collect()]
    assert sorted(got) == sorted(want) and ("edge", "w1", 30) in got and ("tie", "w1", 50) in got and len(got) > 40
