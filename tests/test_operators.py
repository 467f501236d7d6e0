import pytest
from gazetta import schemas
from gazetta.operators import hierarchy, projection, search, stats, tasks, upsert
from gazetta.sources import files
from pyspark.sql import functions as F

def now():
    return F.lit("now")


def raw(spark, *texts):
    return spark.createDataFrame([(t, "尾", "35", "u", "contain", "t") for t in texts], "raw string, keyword string, partition_code string, source_url string, match_mode string, fetched_at_utc string")


POINT = '{"id":"sid-1","standard_name":"东村","city_name":"","gdm":{"type":"multipoint","coordinates":[[118.1,24.1]]}}'
LINE = '{"id":"sid-2","standard_name":"龙村街","gdm":{"type":"linestring","coordinates":[[1,2],[3,4],[5,6]]}}'
FLAT = '{"id":"sid-3","standard_name":null,"gdm":{"type":"point","coordinates":[1,2]}}'


def test_place_rows_and_routing(spark):
    places = projection.place_rows(raw(spark, POINT, LINE, FLAT, "[1]", "{}", "broken", None), now())
    assert places.schema.fieldNames() == schemas.PLACE.fieldNames()
    routed = projection.route(places)
    single, multi, dropped = ([r.source_id for r in df.collect()] for df in routed)
    assert (single, multi, dropped) == (["sid-1"], ["sid-2"], ["sid-3"])
    row = routed.single.first()
    assert (row.longitude, row.latitude, row.city_name, row.coordinates_json) == (118.1, 24.1, None, "[[118.1,24.1]]")
    assert routed.multi.first().longitude is None and routed.dropped_no_geometry.first().standard_name == ""
    assert len(projection.single_rows(places).columns) == len(projection.multi_rows(places).columns) == 13
    back = projection.place_from_totals(projection.single_rows(routed.single), single=True).first()
    assert back.geometry_type == "point" and back.keyword == ""


def test_a_row_that_changes_its_geometry_stays_in_both_totals(spark):
    old = projection.place_rows(raw(spark, POINT), now())
    new = projection.place_rows(raw(spark, LINE.replace("sid-2", "sid-1")), now())
    r = projection.route(old)
    single, multi = projection.single_rows(r.single), projection.multi_rows(r.multi)
    single, multi = upsert.upsert_totals(single, multi, projection.route(new))
    assert (single.count(), multi.count()) == (1, 1)


def test_detail_rows(spark):
    results = spark.createDataFrame(
        [("a", True, 200, '{"place_code":"p","gdm":{"type":"point","coordinates":[[1,2]]}}', "raw", "e", 1.0), ("b", False, 500, None, None, "HTTP 500", None), ("c", True, 200, '{"gdm":{}}', "r", None, 2.0)], schemas.FETCH_RESULT
    )
    rows = {r.id: r for r in projection.detail_rows(results, F.lit(2), F.lit("w1"), now()).collect()}
    assert (rows["a"].coordinates_json, rows["a"].gdm_json, rows["a"].error, rows["a"].attempt) == ("[[1,2]]", '{"coordinates":[[1,2]],"type":"point"}', None, 2)
    assert (rows["b"].coordinates_json, rows["b"].gdm_json, rows["b"].error, rows["b"].raw_json) == ("null", None, "HTTP 500", "")
    assert rows["c"].gdm_json is None and rows["c"].coordinates_json == "null"


def test_last_and_first_wins(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 1, "y"), ("a", 3, None)], "k string, seq int, v string")
    assert {tuple(r) for r in upsert.last_wins(rows, ["k"], ["seq"]).collect()} == {("a", 3, None), ("b", 1, "y")}
    assert {tuple(r) for r in upsert.first_wins(rows, ["k"], ["seq"]).collect()} == {("a", 1, None), ("b", 1, "y")}


def test_upsert_rules(spark):
    old = spark.createDataFrame([("1", "a", "t0"), ("2", "b", "t0")], "code string, name string, captured_at string")
    new = spark.createDataFrame([("2", None, "t1"), ("3", "c", "t1")], old.schema)
    assert {tuple(r) for r in upsert.upsert_divisions(old, new).collect()} == {("1", "a", "t0"), ("2", None, "t0"), ("3", "c", "t1")}
    assert {tuple(r) for r in upsert.upsert_page_divisions(old, new).collect()} == {("1", "a", "t0"), ("2", None, "t1"), ("3", "c", "t1")}
    assert upsert.upsert_divisions(old.limit(0), new).count() == 2 and upsert.upsert_divisions(old, new.limit(0)).count() == 2


def test_master_merge(spark):
    detail = lambda i, worker, code: {"id": i, "raw_json": None if code == "bad" else "{}", "worker_id": worker, "place_code": code}
    rows = spark.createDataFrame([detail("a", "w1", "1"), detail("a", "w2", "2"), detail("b", "w1", "3"), detail("c", "w1", "bad"), detail(None, "w1", "4")], schemas.DETAIL)
    empty = spark.createDataFrame([], schemas.MASTER)
    master, counts, rejected = upsert.merge_workers(empty, rows, F.lit("r1"), F.lit("t1"), ["worker_id"])
    assert tuple(counts.first()) == (3, 2, 1) and rejected.count() == 2
    got = {r.id: r for r in master.collect()}
    assert got["a"].place_code == "2" and got["a"].source_worker_id == "w2" and got["b"].first_seen_at == "t1"
    again, counts, _ = upsert.merge_workers(master, rows.where("id = 'a'"), F.lit("r2"), F.lit("t2"), ["worker_id"])
    got = {r.id: r for r in again.collect()}
    assert (got["a"].first_seen_at, got["a"].last_seen_at, got["a"].source_run_id, got["b"].last_seen_at) == ("t1", "t2", "r2", "t1")
    assert tuple(counts.first()) == (2, 0, 2)


def test_insert_ignore(spark):
    pool, ids = spark.createDataFrame([("a",)], "id string"), spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    got = upsert.insert_ignore(pool, ids)
    assert sorted(r.id for r in got.table.collect()) == ["a", "b"] and tuple(got.counts.first()) == (1, 2, 3)


def test_marks(spark):
    marks = spark.createDataFrame([("35", "t")], schemas.FETCH_MARK)
    assert upsert.has_mark(marks, "35") and not upsert.has_mark(marks, "36")


EDGES = [("35", "0", "province"), ("44", "0", "province"), ("3501", "35", "city"), ("350101", "3501", "district"), ("35", "350101", "province")]


def test_hierarchies_stop_on_cycles(spark):
    edges = spark.createDataFrame(EDGES, "code string, parent_code string, level string")
    assert sorted(r.code for r in hierarchy.descend(edges).collect()) == ["35", "3501", "350101", "44"]
    found = hierarchy.expand(edges, edges.where("parent_code = '0'"))
    assert {(r.code, r.depth) for r in found.collect()} == {("35", 0), ("44", 0), ("3501", 1), ("350101", 2)}
    stopped = hierarchy.expand(edges, edges.where("parent_code = '0'"), stop_levels=("city",))
    assert {r.code for r in stopped.collect()} == {"35", "44", "3501"}


def test_adaptive_partitions(spark):
    counts = spark.createDataFrame([("尾", "35", None, 3100), ("尾", "3501", "35", 150), ("尾", "3502", "35", 0), ("尾", "44", None, 5000), ("村", "35", None, 7), ("村", "3501", "35", 7)], "keyword string, code string, parent_code string, total long")
    got = {(r.keyword, r.code, r.page) for r in hierarchy.adaptive_partitions(counts).collect()}
    assert got == {("尾", "3501", 1), ("尾", "3501", 2), ("尾", "3502", 1), *(("尾", "44", p) for p in range(1, 51)), ("村", "35", 1)}  # a leaf is paged however large


def test_partitions_are_split_at_any_depth(spark):
    chain = [("k", str(n), str(n - 1) if n else None, 5000) for n in range(16)]
    counts = spark.createDataFrame(chain, "keyword string, code string, parent_code string, total long")
    assert {(r.code, r.page) for r in hierarchy.adaptive_partitions(counts).collect()} == {("15", p) for p in range(1, 51)}
    assert hierarchy.adaptive_partitions(counts, completed=spark.createDataFrame([("k", "9")], "keyword string, code string")).count() == 0
    with pytest.raises(RuntimeError):
        hierarchy.adaptive_partitions(counts, most=5)
    with pytest.raises(RuntimeError):
        hierarchy.descend(counts.select("code", F.coalesce("parent_code", F.lit("-")).alias("parent_code")), "-", most=5)


def test_hierarchies_of_more_than_a_million_rows(spark):
    edges = spark.range(1_100_000).select(F.concat(F.lit("c"), "id").alias("code"), F.lit("0").alias("parent_code"))
    assert hierarchy.descend(edges).agg(F.count("*"), F.max("depth")).first()[:] == (1_100_000, 1)


def test_repeated_keys_of_an_upsert(spark):
    old = spark.createDataFrame([("a", "old", "t0", "t0")], "code string, name string, captured_at string, updated_at string")
    new = spark.createDataFrame([("a", "x", "t1", "t1"), ("a", "y", "t2", "t3"), ("a", "z", "t3", "t2"), ("b", "p", "t1", "t1"), ("b", "q", "t1", "t1")], old.schema)
    assert sorted(map(tuple, upsert.upsert_divisions(old, new).collect())) == [("a", "y", "t0", "t3"), ("b", "q", "t1", "t1")]
    assert sorted(map(tuple, upsert.upsert_page_divisions(old, new, ["updated_at"]).collect())) == [("a", "y", "t2", "t3"), ("b", "q", "t1", "t1")]


@pytest.mark.parametrize("gdm", ["null", "[]", '""', "0", "false", "{}"])
def test_empty_geometries_count_as_absent(spark, gdm):
    rows = spark.createDataFrame([("a", True, 200, '{"gdm": %s}' % gdm, "{}", None, 1.0)], schemas.FETCH_RESULT)
    row = projection.detail_rows(rows, F.lit(1), F.lit("w"), F.lit("t")).first()
    assert (row.geometry_type, row.coordinates_json, row.gdm_json) == (None, "null", None)


def test_geocoding(spark):
    regions = files.sample_regions(spark, "t")
    got = {r.code: r.longitude for r in hierarchy.fill_coordinates(regions, files.sample_points(spark)).collect()}
    assert got["110000"] == 116.4074 and got["110100"] is None and len(got) == 4
    kept = hierarchy.fill_coordinates(regions.withColumns({"longitude": F.lit(1.0), "latitude": F.lit(2.0)}), files.sample_points(spark))
    assert {r.longitude for r in kept.collect()} == {1.0}


def test_search_modes(spark):
    names = spark.createDataFrame([("东村",), ("村",), (None,)], "name string")
    assert search.search(names, ["村"]).count() == 2 and search.search(names, ["村"], "exact").count() == 1 and search.search(names, []).count() == 0
    with pytest.raises(ValueError):
        search.search(names, ["村"], "fuzzy")


def test_not_in_with_nulls(spark):
    rows = spark.createDataFrame([("a", "done"), ("b", "done"), ("c", "pending")], "id string, status string")
    master, null = spark.createDataFrame([("a",)], "id string"), spark.createDataFrame([(None,)], "id string")
    assert [r.id for r in tasks.inconsistent(rows, master).collect()] == ["b"]
    assert tasks.inconsistent(rows, master.union(null)).count() == 0
    assert tasks.inconsistent(rows, master.limit(0)).count() == 2


def test_transitions(spark):
    rows = spark.createDataFrame([("a", "claimed", "w", "t", None, 0, None, "t"), ("b", "pending", None, None, None, 2, None, "t")], schemas.TASK)
    errors = spark.createDataFrame([("a", "x" * 600)], "id string, error string")
    row = tasks.mark_open(rows, errors, "failed", now()).where("id = 'a'").first()
    assert (row.status, row.attempts, len(row.last_error)) == ("failed", 1, 500)
    assert tasks.release_claims(rows, now()).where("id = 'a'").first().claimed_by is None
    assert tasks.mark_done(rows, errors, now()).where("id = 'a'").first().done_at == "now"


def test_long_errors_stay_off_the_driver(spark):
    rows = spark.range(40).select(F.col("id").cast("string").alias("id"), F.lit("claimed").alias("status"), F.lit(0).alias("attempts"), F.lit(None).cast("string").alias("last_error"), F.lit("t").alias("updated_at"))
    errors = spark.range(60).select((F.col("id") % 30).cast("string").alias("id"), F.concat(F.lit("x" * 499), F.when(F.col("id") < 30, "a").otherwise("b"), F.repeat(F.lit("e"), 50_000)).alias("error"))
    got = tasks.mark_open(rows, errors, "retry", now())
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert {int(r.id): r.last_error for r in got.collect()} == {k: "x" * 499 + "b" if k < 30 else None for k in range(40)}


def test_statuses_are_zero_filled(spark):
    rows = spark.createDataFrame([("done",), ("odd",), ("done",)], "status string")
    got = {r.status: r.n for r in tasks.status_counts(rows).collect()}
    assert got == {"pending": 0, "claimed": 0, "done": 2, "retry": 0, "failed": 0, "odd": 1, "total": 3}
    assert {r.n for r in tasks.status_counts(rows.limit(0)).collect()} == {0}


def test_round_robin_numbers_all_rows(spark):
    rows = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    got = {r.k: r.worker_id for r in tasks.round_robin(rows, 7, ["k"]).collect()}
    assert got == {k: k % 7 for k in range(1000)}


@pytest.mark.parametrize("n", [1, 19, 20, 99, 100, 250])
def test_exclusive_quantiles(spark, n):
    import statistics

    values = [float((k * 37) % 101) for k in range(n)]
    rows = spark.createDataFrame([("x", v) for v in values] + [("x", None)], "g string, v double")
    got = stats.exclusive_quantiles(rows, ["g"], "v", {"p95": (0.95, 20), "p99": (0.99, 100)}).first()
    want95 = statistics.quantiles(values, n=20)[18] if n >= 20 else max(values)
    want99 = statistics.quantiles(values, n=100)[98] if n >= 100 else max(values)
    assert got.p95 == pytest.approx(want95) and got.p99 == pytest.approx(want99)


def test_safe_rate(spark):
    levels = lambda *r: spark.createDataFrame(list(r), "qps long, success_rate double, status_429 long, status_403 long")
    got = stats.safe_rate(levels((1, 100.0, 0, 0), (2, 96.0, 0, 0), (5, 99.0, 1, 0), (10, 99.0, 0, 0))).first()
    assert got.safe_qps == pytest.approx(1.4) and got.stable_qps == 2
    assert stats.safe_rate(levels((1, 50.0, 0, 0))).first().safe_qps is None


def test_sorts_put_nulls_first(spark):
    place = lambda i, city: (i, "p", city, "a", "n")
    rows = spark.createDataFrame([place("1", "c"), place("2", None), place("3", "")], "source_id string, province_name string, city_name string, area_name string, standard_name string")
    assert [r.source_id for r in stats.sorted_places(rows).collect()] == ["2", "3", "1"]
    assert [r.source_id for r in stats.sorted_places(rows.where("source_id = '1'"), rows.where("source_id <> '1'")).collect()] == ["2", "3", "1"]


def test_defaults_of_old_schemas(spark):
    old = spark.createDataFrame([("1", None)], "source_id string, match_mode string")
    got = projection.with_defaults(old, {"match_mode": F.lit("contain"), "geometry_type": F.lit("")}).first()
    assert (got.match_mode, got.geometry_type) == ("contain", "")
