import json
import sqlite3
import time
import zipfile

import pytest
from gazetta import schemas
from gazetta.sinks import exports, master
from gazetta.sources import files, replay, sqlite
from gazetta.streaming import control
from pyspark.sql import functions as F


def test_id_files(spark, tmp_path):
    a, b = tmp_path / "a.txt", tmp_path / "b.txt"
    a.write_text(" x \n\n\ty\n", "utf-8")
    b.write_text("x", "utf-8")
    assert sorted(r.id for r in files.ids(spark, str(a), str(b)).collect()) == ["x", "x", "y"]
    assert files.count_lines(spark, str(a)) == 3
    with pytest.raises(Exception):
        files.ids(spark, str(tmp_path / "none")).collect()


def test_characters(spark, tmp_path):
    (tmp_path / "c.txt").write_text("村,村\n山", "utf-8")
    assert files.characters(spark, "c.txt", str(tmp_path)).first().chars == ["村", "山"]
    assert files.characters(spark, "尾尾").first().chars == ["尾"]
    assert files.han_characters(spark).count() == 102_998


def test_settings(tmp_path):
    (tmp_path / "s.yaml").write_text("crawl:\n  size: 5\nname: a\n", "utf-8")
    (tmp_path / ".env").write_text("# c\nNAME='b'\n", "utf-8")
    (tmp_path / "t.json").write_text("[1]", "utf-8")
    yaml = files.yaml_settings(str(tmp_path / "s.yaml"), ["crawl"])
    assert yaml == {"name": "a", "size": 5} and files.yaml_settings(str(tmp_path / "no"), []) == {}
    assert files.merged_settings({"name": "z", "x": 1}, yaml, {"name": files.env_file(str(tmp_path / ".env"))["NAME"], "size": None}) == {"name": "b", "x": 1, "size": 5}
    assert files.prefixed({"APP_SIZE": "1", "B": "2"}, "APP_") == {"size": "1"}
    with pytest.raises(ValueError):
        files.task(str(tmp_path / "t.json"))


def test_replayed_search(spark, tmp_path):
    answers = [{"keyword": "尾", "code": "35", "page": 1, "payload": {"total": 2, "records": [{"id": "a"}, 3]}}, {"keyword": "尾", "code": "35", "page": 2, "payload": {"total": 2, "records": [{"id": "b"}]}}, {"keyword": "村", "code": "35", "page": 1, "payload": {"records": [{"id": "c"}]}}]
    path = tmp_path / "answers.jsonl"
    path.write_text("\n".join(json.dumps(a, ensure_ascii=False) for a in answers), "utf-8")
    got = replay.search_places(spark, str(path), [{"keyword": "尾", "code": "35", "pages": [1, 2]}])
    assert {(r.page, r.total, r.raw) for r in got.collect()} == {(1, 2, '{"id":"a"}'), (2, 2, '{"id":"b"}')}  # canonical JSON, as everywhere
    rows = spark.createDataFrame([(a["keyword"], a["code"], a["page"], json.dumps(a["payload"])) for a in answers], "keyword string, code string, page int, payload string")
    assert replay.search_answers(rows).count() == 3


def test_divisions(spark):
    rows = spark.createDataFrame([("0", '{"data":{"rows":[{"code":"35","name":"福建省"},{"code":""},{"code":"3501","parentCode":"35"}]}}')], "code string, payload string")
    assert {(r.code, r.parent_code, r.level) for r in replay.divisions(rows, F.lit("t")).collect()} == {("35", "0", "province"), ("3501", "35", "city")}


def test_fetching_folds_faults_into_rows(spark):
    def fetch(key):
        if key == "t":
            raise TimeoutError
        if key == "c":
            raise ConnectionError("reset")
        return {"ok": (200, '{"a": 1}'), "bad": (200, "<html>"), "busy": (503, "x")}[key]

    ids = spark.createDataFrame([(k,) for k in ("ok", "bad", "busy", "t", "c")], "id string")
    got = {r.id: r for r in replay.fetch_details(ids, fetch, qps=1000).collect()}
    assert got["ok"].ok and got["ok"].data == '{"a": 1}' and got["busy"].status_code == 503
    assert "JSON" in got["bad"].error and got["t"].error == "请求超时" and got["c"].error.startswith("连接错误")


def test_pages_and_seeds(spark):
    def fetch(url):
        if "0001" in url:
            raise OSError
        return '<h3>同级行政区划</h3><table><tr><td><a href="/120000000.html">天津</a></td><td>x</td></tr></table>'

    pages = replay.fetch_pages(spark.createDataFrame([("110000000000",), ("000100000000",)], "code string"), fetch, "https://example.org")
    assert [r.url for r in pages.collect()] == ["https://example.org/110000000.html"]
    assert [r.code for r in replay.seed_codes(pages, "110000000000").collect()] == ["120000000000"]
    assert [r.code for r in replay.seed_codes(pages.limit(0), "110000000000").collect()] == ["110000000000"]


@pytest.fixture()
def table(spark):
    return spark.createDataFrame([("村&<", None, 1), ("b", 2.5, 2)], "source_id string, v double, n int").coalesce(1)


def test_exports(spark, table, tmp_path):
    out = exports.export(table, str(tmp_path / "out"), ["all"], "places", "places", ["source_id"])
    assert set(out) == set(exports.FORMATS)
    text = open(out["json"], encoding="utf-8").read()
    assert json.loads(text)[0] == {"source_id": "村&<", "v": None, "n": 1} and '\n  {\n    "source_id": "村&<"' in text
    assert open(out["csv"], encoding="utf-8").read().splitlines() == ["source_id,v,n", "村&<,,1", "b,2.5,2"]
    sheet = zipfile.ZipFile(out["xlsx"]).read("xl/worksheets/sheet1.xml").decode()
    assert "村&amp;&lt;" in sheet and "<v>2.5</v>" in sheet and sheet.count("<row") == 3
    assert sqlite3.connect(out["db"]).execute("SELECT count(*), sum(n) FROM places").fetchone() == (2, 3)


def test_empty_exports(spark, table, tmp_path):
    out = exports.export(table.limit(0), str(tmp_path / "out"), None, "x", "x")
    assert open(out["csv"]).read() == "" and open(out["json"]).read() == "[]" and "<row" not in zipfile.ZipFile(out["xlsx"]).read("xl/worksheets/sheet1.xml").decode()


def test_formats():
    assert exports.formats_of([]) == exports.formats_of(["csv", "all"]) == list(exports.FORMATS)
    assert exports.formats_of(["csv", "csv"]) == ["csv", "csv"]
    with pytest.raises(ValueError):
        exports.formats_of(["parquet"])


def test_division_export(spark, tmp_path):
    rows = spark.createDataFrame([tuple("c" for _ in schemas.PAGE_DIVISION)], schemas.PAGE_DIVISION)
    assert exports.export_divisions(rows, str(tmp_path / "d.csv"), "csv") == 0 and exports.export_divisions(rows.limit(0), str(tmp_path / "e.csv"), "csv") == 1
    assert open(tmp_path / "d.csv").readline().startswith("code,name,short_code")


def test_ids_checkpoints_and_snapshots(spark, table, tmp_path):
    assert spark.read.text(exports.write_ids(table, str(tmp_path / "ids"))).count() == 2
    exports.write_worker_ids(table.withColumn("worker_id", F.col("n") % 2), str(tmp_path / "w"), "source_id")
    assert {p.name for p in (tmp_path / "w").iterdir() if p.is_dir()} == {"worker_id=0", "worker_id=1"}
    path = exports.save_checkpoint(spark.createDataFrame([("b",), ("a",), ("b",)], "code string"), str(tmp_path / "c.json"))
    assert json.load(open(path)) == {"completed": ["a", "b"]} and exports.load_checkpoint(spark, path).count() == 2
    assert exports.load_checkpoint(spark, str(tmp_path / "no.json")).count() == 0
    assert spark.read.parquet(exports.snapshot(table, str(tmp_path / "s"))).count() == 2


def test_sqlite_source(spark, tmp_path):
    db = sqlite3.connect(tmp_path / "t.db")
    db.execute("CREATE TABLE t (id TEXT, n INTEGER, x REAL)")
    db.executemany("INSERT INTO t VALUES (?, ?, ?)", [(str(k), k, k / 2) for k in range(100)])
    db.execute("CREATE TABLE empty (id TEXT)")
    db.commit()
    rows = sqlite.table(spark, str(tmp_path / "t.db"), "t")
    assert rows.agg(F.sum("n"), F.sum("x"), F.count_distinct("id")).first()[:] == (4950, 2475.0, 100)
    assert sqlite.table(spark, str(tmp_path / "t.db"), "t", ["id"]).columns == ["id"] and sqlite.table(spark, str(tmp_path / "t.db"), "empty").count() == 0


def test_token_bucket():
    now, waits = [0.0], []
    bucket = control.TokenBucket(2.0, clock=lambda: now[0], sleep=lambda s: (waits.append(s), now.__setitem__(0, now[0] + s)))
    assert [bucket.acquire() for _ in range(3)] == [0.5, 0.5, 0.5] and sum(waits) == 1.5
    assert control.TokenBucket(0).qps == 0.1 and control.persist_step(101) == 500 and control.persist_step(100) == 1


def _detail(i, code, at):
    return {"id": i, "raw_json": "{}", "worker_id": "w", "attempt": 1, "place_code": code, "fetched_at": at}


def test_streaming_merge_restarts(spark, tmp_path):
    source, root, mark = str(tmp_path / "in"), str(tmp_path / "master"), str(tmp_path / "mark")
    for turn, rows in enumerate(([_detail("a", "1", "t1"), _detail("a", "2", "t2")], [_detail("a", "3", "t3"), _detail("b", "1", "t3")])):
        spark.createDataFrame(rows, schemas.DETAIL).write.mode("append").parquet(source)
        query = control.merge_stream(spark.readStream.schema(schemas.DETAIL).parquet(source), root, mark, f"r{turn}")
        control.await_within(query, 120)
    got = {r.id: r for r in master.read(spark, root).collect()}
    assert got["a"].place_code == "3" and got["b"].place_code == "1" and got["a"].first_seen_at <= got["a"].last_seen_at and len(got) == 2


def test_runtime_budget(spark):
    query = spark.readStream.format("rate").load().writeStream.format("noop").start()
    start = time.monotonic()
    with pytest.raises(TimeoutError):
        control.await_within(query, 1)
    assert time.monotonic() - start < 60 and not query.isActive


def test_flush_and_latest(spark, tmp_path, sf001):
    schema = spark.read.parquet(f"{sf001}/events.parquet").schema
    rows = spark.readStream.schema(schema).parquet(f"{sf001}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    query = control.flush_stream(control.latest_events(rows), str(tmp_path / "out"), str(tmp_path / "mark"), 100)
    control.await_within(query, 120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(f"{sf001}/events.parquet").count()
