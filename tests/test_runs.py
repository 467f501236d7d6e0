import json

import pytest
from gazetta import cli, schemas
from gazetta.plans import collect
from gazetta.sinks import commits, totals
from pyspark.sql import functions as F


def record(name, key):
    return {"id": key, "standard_name": name, "gdm": {"type": "point", "coordinates": [[1, 2]]}}


#: total and records by keyword, code and page
ANSWERS = {
    ("尾", "35", 1): (3100, []), ("尾", "3501", 1): (2, [record("山尾", "p1"), record("尾村", "shared")]), ("尾", "3502", 1): (1, [record("尾村", "shared")]), ("尾", "44", 1): (1, [record("溪尾", "p2")]),
    ("村", "35", 1): (1, [record("东村", "p3")]), ("村", "44", 1): (0, []), ("尾", "35", 2): (3100, [record("not read", "no")]),
}
DIVISIONS = [("35", "福建省", "0"), ("44", "广东省", "0"), ("3501", "福州市", "35"), ("3502", "厦门市", "35")]


@pytest.fixture()
def tables(spark, tmp_path):
    answers = spark.createDataFrame([(k, c, p, json.dumps({"total": t, "records": r}, ensure_ascii=False)) for (k, c, p), (t, r) in ANSWERS.items()], "keyword string, code string, page long, payload string")
    divisions = spark.createDataFrame([(c, n, p, "", "places", "t", "t") for c, n, p in DIVISIONS], schemas.DIVISION)
    answers.write.parquet(str(tmp_path / "answers"))
    divisions.write.parquet(str(tmp_path / "divisions"))
    return answers, divisions, tmp_path


def test_collects_split_partitions_once(spark, tables):
    answers, divisions, _ = tables
    got = collect.collect_places(answers, divisions, ["尾", "村"], F.lit("t"))
    places = {r.source_id: r for r in got.places.collect()}
    assert {p.standard_name for p in places.values()} == {"东村", "山尾", "尾村", "溪尾"} and len(places) == 4
    assert places["shared"].partition_code == "3502"  # the last wins
    assert {(r.keyword, r.code) for r in got.progress.collect()} == {("尾", "35"), ("尾", "3501"), ("尾", "3502"), ("尾", "44"), ("村", "35"), ("村", "44")}
    again = collect.collect_places(answers, divisions, ["尾", "村"], F.lit("t"), progress=got.progress)
    assert again.places.count() == 0
    assert {r.source_id for r in collect.collect_places(answers, divisions, ["尾"], F.lit("t"), provinces=["44"]).places.collect()} == {"p2"}


def page(name, code, level, children):
    rows = "".join(f'<tr><td><a href="/{c[:9]}.html">{n}</a></td><td>正常</td></tr>' for c, n in children)
    return f"<p>地区名称：{name}</p><p>统计用12位区划代码：{code}</p><p>地区级别：{level}</p><h3>下辖行政区划</h3><table>{rows}</table>"


def test_crawls_divisions(spark):
    pages = [("110000000000", "北京市", "省", [("110101000000", "东城区")]), ("110101000000", "东城区", "县", [("110101001000", "东华门街道")]), ("120000000000", "天津市", "省", [])]
    rows = spark.createDataFrame([(c, f"u/{c[:9]}.html", page(n, c, level, children)) for c, n, level, children in pages], "code string, url string, html string")
    got = {r.code: r for r in collect.crawl_divisions(rows, spark.createDataFrame([("110000000000",)], "code string"), "u").collect()}
    assert {c: r.level for c, r in got.items()} == {"110000000000": "province", "110101000000": "district", "110101001000": "town"}


def test_sample_run(spark, tmp_path):
    regions, runs, out = collect.sample_run(spark, str(tmp_path), "2024-01-01T00:00:00", ["json", "csv"])
    assert regions.count() == 4 and runs.first().item_count == 4 and set(out) == {"json", "csv"}
    assert json.load(open(out["json"], encoding="utf-8"))[0]["longitude"] == 116.4074


def test_parallel_tasks_must_agree(spark):
    rows = [("a", "村村尾", "t", ["csv"]), ("b", "山", "t", ["csv"])]
    schema = "task string, chars string, total_path string, formats array<string>"
    assert collect.task_partitions(spark.createDataFrame(rows, schema)).count() == 3
    with pytest.raises(ValueError):
        collect.task_partitions(spark.createDataFrame([*rows, ("c", "x", "other", ["csv"])], schema))


TASKS = "task string, chars string, provinces array<string>, total_path string, formats array<string>"


def test_several_tasks_give_what_each_gives_alone(spark, tables):
    answers, divisions, _ = tables
    asked = {"both": ("尾村", None), "turned": ("村尾尾", []), "south": ("尾", ["44"]), "none": ("山", None), "empty": ("", None), "null": (None, ["35"])}
    tasks = spark.createDataFrame([(t, chars, provinces, "t", ["csv"]) for t, (chars, provinces) in asked.items()], TASKS)
    got = collect.collect_tasks(answers, divisions, tasks, F.lit("t"))
    places, progress = got.places.collect(), got.progress.collect()
    assert len({(r.task, r.source_id) for r in places}) == len(places)
    for task, (chars, provinces) in asked.items():
        alone = collect.collect_places(answers, divisions, list(dict.fromkeys(chars or "")), F.lit("t"), provinces=provinces)
        own = {(r.source_id, r.keyword, r.partition_code, r.standard_name) for r in places if r.task == task}
        assert own == {(r.source_id, r.keyword, r.partition_code, r.standard_name) for r in alone.places.collect()}, task
    assert {(r.keyword, r.code) for r in progress if r.task == "both"} == {("尾", "35"), ("尾", "3501"), ("尾", "3502"), ("尾", "44"), ("村", "35"), ("村", "44")}
    assert not any(r.task in ("none", "empty", "null") for r in progress)

    # progress belongs to its task
    before = got.progress.where("task = 'both'")
    again = collect.collect_tasks(answers, divisions, tasks, F.lit("t"), progress=before)
    assert {r.task for r in again.places.collect()} == {"turned", "south"} and again.progress.count() == got.progress.count()
    assert {r.task: (r.n_places, r.n_partitions) for r in collect.task_summary(got.places).collect()} == {"both": (4, 4), "turned": (4, 4), "south": (1, 1)}


def test_task_files_on_the_command_line(spark, tables, tmp_path, capsys):
    for name, task in {"a": {"chars": "尾村", "export": ["json"], "total_db_path": f"{tmp_path}/total"}, "b": {"chars": "尾", "province_codes": [44], "export": "json", "total_db_path": f"{tmp_path}/total"}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(task), "utf-8")
    line = ["search-tasks", "--answers", f"{tmp_path}/answers", "--divisions", f"{tmp_path}/divisions", "--out", f"{tmp_path}/out"]
    assert cli.main([*line, "--json", f"{tmp_path}/a.json", "--json", f"{tmp_path}/b.json"], spark) == 0
    assert json.loads(capsys.readouterr().out) == {"a": 4, "b": 1}
    single, multi = totals.read(spark, f"{tmp_path}/total")
    assert {r.source_id for r in single.collect()} == {"p1", "p2", "p3", "shared"} and multi.count() == 0
    assert len(json.load(open(tmp_path / "out" / "places.json", encoding="utf-8"))) == 4
    with pytest.raises(ValueError, match="names"):
        cli.main([*line, "--json", f"{tmp_path}/a.json", "--json", f"{tmp_path}/a.json"], spark)
    (tmp_path / "c.json").write_text(json.dumps({"chars": "尾"}), "utf-8")
    with pytest.raises(ValueError, match="share"):
        cli.main([*line, "--json", f"{tmp_path}/a.json", "--json", f"{tmp_path}/c.json"], spark)


def test_division_sync_on_the_command_line(spark, tmp_path, capsys, monkeypatch):
    children = {"0": ["35", "44"], "44": ["4401"]}

    def fetch(keyword, code, page):  # local, so that it travels to the tasks by value
        return (404, "") if code == "35" else (200, json.dumps({"data": [{"code": c, "name": c} for c in children.get(code, [])]}))

    monkeypatch.setattr(cli, "transport", lambda name: {"m:f": fetch}[name])
    assert cli.main(["sync-divisions", "--transport", "m:f", "--out", f"{tmp_path}/one"], spark) == 0
    assert json.loads(capsys.readouterr().out) == {"divisions": 3, "asked": 4, "failed": 1}
    again = ["--divisions", f"{tmp_path}/one/divisions", "--marks", f"{tmp_path}/one/marks"]
    assert cli.main(["sync-divisions", "--transport", "m:f", "--out", f"{tmp_path}/two", *again], spark) == 0
    assert json.loads(capsys.readouterr().out) == {"divisions": 3, "asked": 1, "failed": 1}  # only the failed one is asked again


def test_command_line(spark, tables, capsys):
    _, _, folder = tables
    assert cli.main(["search", "--answers", f"{folder}/answers", "--divisions", f"{folder}/divisions", "--chars", "尾,村", "--out", f"{folder}/out"], spark) == 0
    assert json.loads(capsys.readouterr().out) == {"尾": 3, "村": 1}
    spark.createDataFrame([("a", "done"), ("b", "pending")], "id string, status string").selectExpr("id", "status", "cast(null as string) claimed_by", "cast(null as string) claimed_at", "cast(null as string) done_at", "0 attempts", "cast(null as string) last_error", "'t' updated_at").write.parquet(f"{folder}/tasks")
    assert cli.main(["status", "--tasks", f"{folder}/tasks"], spark) == 0 and json.loads(capsys.readouterr().out)["completion"] == 0.5
    spark.createDataFrame([("b", "{}")], "id string, raw_json string").write.parquet(f"{folder}/master")
    assert cli.main(["reconcile", "--tasks", f"{folder}/tasks", "--master", f"{folder}/master", "--out", f"{folder}/tasks2"], spark) == 0
    assert {r.id: r.status for r in spark.read.parquet(f"{folder}/tasks2").collect()} == {"a": "pending", "b": "done"}
    with pytest.raises(SystemExit):
        cli.main(["search", "--answers", "x", "--divisions", "x", "--chars", "x", "--out", "x", "--mode", "fuzzy"], spark)


def live(broken=()):
    import json  # the function travels to workers that do not know this module

    def fetch(keyword, code, page):
        """11 and 12 lie in the province 1, which has too much to read; 2 has three pages of two."""
        if (code, page) in broken:
            return 503, ""
        total = {"1": 50, "11": 1, "12": 3, "2": 5}[code]
        return 200, json.dumps({"total": total, "records": [{"id": f"{keyword}{code}.{k}", "standard_name": "x"} for k in range(2 * page - 2, min(2 * page, total))]})

    return fetch


def test_a_live_search_goes_on_where_requests_failed(spark):
    divisions = spark.createDataFrame([("1", "0"), ("2", "0"), ("11", "1"), ("12", "1")], "code string, parent_code string")
    run = lambda fetch, before: collect.search_live(divisions, ["a"], fetch, before, threshold=10, size=2, parallel=2, attempts=1)
    got = run(live({("12", 2), ("2", 1)}), None)
    assert {(r.code, r.page) for r in got.where("error is null").collect()} == {("1", 1), ("11", 1), ("12", 1)}
    assert {(r.code, r.page, r.error) for r in got.where("error is not null").collect()} == {("12", 2, "HTTP 503"), ("2", 1, "HTTP 503")}
    found = collect.collect_places(got, divisions, ["a"], F.lit("t"), threshold=10, size=2)
    progress = collect.whole(found.progress, got.where("error is not null"), divisions)
    assert {r.code for r in progress.collect()} == {"11"}
    again = run(live(), progress)
    assert {(r.code, r.page) for r in again.collect()} == {("1", 1), ("12", 1), ("12", 2), ("2", 1), ("2", 2), ("2", 3)}
    rest = collect.collect_places(again, divisions, ["a"], F.lit("t"), progress, threshold=10, size=2)
    ids = {r.source_id for r in found.places.unionByName(rest.places).collect()}
    assert ids == {"a11.0", *(f"a12.{k}" for k in range(3)), *(f"a2.{k}" for k in range(5))}
    assert {r.code for r in rest.progress.collect()} == {"1", "2", "11", "12"}
    assert run(live(), rest.progress).isEmpty()


def counted(calls, stop=None):
    """As live(), noting each call in a file; a call for `stop` ends the worker."""

    def fetch(keyword, code, page):
        import json

        if code == stop:
            raise SystemExit("killed")
        with open(calls, "a") as f:
            f.write(f"{code}.{page}\n")
        total = {"1": 50, "11": 1, "12": 3, "2": 5}[code]
        return 200, json.dumps({"total": total, "records": [{"id": f"{keyword}{code}.{k}", "standard_name": "x", "gdm": {"type": "point", "coordinates": [[k, 1], [k, 2]][: 1 + k % 2]}} for k in range(2 * page - 2, min(2 * page, total))]})

    return fetch


def test_a_killed_search_asks_only_for_what_it_lacks_and_totals_agree(spark, tmp_path):
    divisions = spark.createDataFrame([("1", "0"), ("2", "0"), ("11", "1"), ("12", "1")], "code string, parent_code string")
    calls, folder = str(tmp_path / "calls"), str(tmp_path / "asked")
    run = lambda fetch, folder, **more: collect.search_live(divisions, ["a"], fetch, None, threshold=10, size=2, parallel=1, attempts=1, folder=folder, flush=1, **more)
    with pytest.raises(Exception):  # noqa: B017
        run(counted(calls, stop="12"), folder)
    before = (tmp_path / "calls").read_text().split()
    assert {"1.1", "2.1", "2.2", "2.3"} <= set(before) and "12.1" not in before
    answers = run(counted(calls), folder)
    every = (tmp_path / "calls").read_text().split()
    assert sorted(every) == sorted(set(every)) == ["1.1", "11.1", "12.1", "12.2", "2.1", "2.2", "2.3"]
    whole = run(counted(str(tmp_path / "others")), None)
    places = lambda rows: collect.collect_places(rows, divisions, ["a"], F.lit("t"), threshold=10, size=2).places
    ids = lambda df: sorted(r.source_id for r in df.collect())
    assert ids(places(answers)) == ids(places(whole)) and len(ids(places(whole))) == 9

    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    totals.put(places(whole), one)
    for part in ("partition_code = '2'", "partition_code <> '2'", "partition_code = '2'"):
        totals.put(places(whole).where(part), two)
    for a, b in zip(totals.read(spark, one), totals.read(spark, two), strict=True):
        assert ids(a) == ids(b) and a.columns == b.columns
    assert sum(df.count() for df in totals.read(spark, one)) == 9 and len([n for n in commits.listed(spark, two) if n.startswith("data-")]) == 2


def test_a_search_out_of_time_leaves_the_rest_open(spark):
    divisions = spark.createDataFrame([("1", "0"), ("2", "0"), ("11", "1")], "code string, parent_code string")
    got = collect.search_live(divisions, ["a"], live(), None, threshold=10, size=2, parallel=1, attempts=1, seconds=0)
    assert {(r.code, r.page, r.error) for r in got.collect()} == {("1", 1, collect.NO_TIME), ("2", 1, collect.NO_TIME)}
    found = collect.collect_places(got, divisions, ["a"], F.lit("t"), threshold=10, size=2)
    assert collect.whole(found.progress, got.where("error is not null"), divisions).isEmpty()


def test_commands_over_a_transport(spark, tmp_path, capsys, monkeypatch):
    show = lambda *argv: (cli.main(list(argv), spark), json.loads(capsys.readouterr().out))[1]
    rows = [("r0", "0"), ("r1", "0"), ("n1", "r0"), ("n2", "r0")]
    spark.createDataFrame(rows, "code string, parent_code string").write.parquet(f"{tmp_path}/divisions")
    search = ["search-live", "--transport", "gazetta.plans.storage:_search", "--divisions", f"{tmp_path}/divisions", "--chars", "a", "--out", f"{tmp_path}/out", "--page-size", "10", "--workers", "2", "--resume"]
    assert show(*search) == {"places": 25 + 7 + 14, "failed_requests": 0}
    assert show(*search)["places"] == 0
    (tmp_path / "ids").write_text("\n".join(str(k) for k in range(1, 13)), "utf-8")
    ids = ["--ids", f"{tmp_path}/ids"]
    got = show("details", "--transport", "gazetta.plans.storage:_detail", "--folder", f"{tmp_path}/run", "--run-id", "r", *ids, "--batch", "100", "--attempts", "1", "--max-runtime-seconds", "600")
    assert got == {"batches": 5, "done": 8, "failed": 4, "master": 8}
    got = show("ladder", "--transport", "gazetta.plans.storage:_limited", *ids, "--levels", "200", "400", "--seconds", "1", "--out", f"{tmp_path}/calls")
    assert [(r["qps"], r["total"], r["ok"]) for r in got["levels"]] == [(200, 12, 9), (400, 12, 9)] and spark.read.parquet(f"{tmp_path}/calls").count() == 24
    monkeypatch.setenv("GAZETTA_SIZE", "9")
    (tmp_path / "c.yaml").write_text("crawl:\n  size: 5\nname: a\n", "utf-8")
    assert show("show-config", "--config", f"{tmp_path}/c.yaml", "--sections", "crawl", "--env-file", f"{tmp_path}/none") == {"size": "9", "name": "a"}


def _children(tree, calls):
    """Answers from a dict of children; codes that map to None fail. What is asked for is noted in calls."""

    def ask(codes):
        asked = sorted(r.code for r in codes.collect())
        calls.append(asked)
        rows = [(c, None if tree.get(c, []) is None else json.dumps({"data": [{"code": k, "name": k.upper()} for k in tree.get(c, [])]})) for c in asked]
        return codes.sparkSession.createDataFrame(rows, "code string, payload string")

    return ask


def test_a_division_sync_asks_for_unknown_parents_only(spark):
    tree = {"0": ["a", "b"], "a": ["a1", "a2"], "b": ["b1"], "b1": None, "a2": ["0", "a2"]}
    none, now, calls = spark.createDataFrame([], schemas.DIVISION), F.lit("t1"), []
    marks = spark.createDataFrame([], schemas.FETCH_MARK)
    got = collect.sync_divisions(none, marks, _children(tree, calls), now)
    assert calls == [["0"], ["a", "b"], ["a1", "a2", "b1"]]  # the cycle below a2 ends
    first = {r.code: r for r in got.divisions.collect()}
    assert {"a", "b", "a1", "a2", "b1"} <= set(first) and first["a1"].parent_code == "a" and first["b"].name == "B"
    assert {r.code for r in got.failed.collect()} == {"b1"}
    assert {r.parent_code for r in got.marks.collect()} == {"0", "a", "b", "a1", "a2"}

    tree["b1"], calls[:] = ["c"], []
    again = collect.sync_divisions(got.divisions, got.marks, _children(tree, calls), F.lit("t2"))
    assert [c for c in calls if c] == [["b1"], ["c"]]  # neither parents with children nor marked ones
    second = {r.code: r for r in again.divisions.collect()}
    assert set(second) == {*first, "c"} and second["c"].parent_code == "b1"
    assert all(second[k].captured_at == "t1" for k in first) and second["c"].captured_at == "t2"
    assert again.failed.count() == 0


def test_a_division_sync_that_is_too_deep_is_an_error(spark):
    none, marks = spark.createDataFrame([], schemas.DIVISION), spark.createDataFrame([], schemas.FETCH_MARK)
    chain = {str(k): [str(k + 1)] for k in range(9)}
    with pytest.raises(RuntimeError, match="deeper"):
        collect.sync_divisions(none, marks, _children(chain, []), F.lit("t"), most=4)
    assert collect.sync_divisions(none, marks, _children({"0": []}, []), F.lit("t")).divisions.count() == 0
