"""Queries that go through the sinks and back through the sources, fetch over a transport, or run as streams.

What is written lies in a scratch folder of spark.checkpoint.dir. Single files are the sinks for people and take
tables of fixed size here; large tables go through the folder sinks.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta import schemas
from gazetta.functions import html, scalar
from gazetta.operators import hierarchy, upsert
from gazetta.operators.lineage import scratch
from gazetta.plans import collect, details
from gazetta.plans.records import _division_pages
from gazetta.plans.registry import query, table
from gazetta.sinks import exports, master
from gazetta.sources import files, replay, sqlite
from gazetta.streaming import control

NOW = "2024-02-01 00:00:00"


def _folder(spark: SparkSession) -> str:
    """A scratch folder as a path of the mounted file system, which single files need."""
    path = scratch(spark, "files")
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    elif "://" in path:
        raise ValueError(f"single files need a mounted folder, not {path}")
    os.makedirs(path, exist_ok=True)
    return path


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("s_acctbal"))


_SUPPLIERS = "SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS s_acctbal FROM supplier"


@query(_SUPPLIERS)
def json_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _suppliers(spark, sf_dir)
    return spark.read.schema(rows.schema).json(f"file://{exports.write_json(rows, f'{_folder(spark)}/rows.json')}", multiLine=True)


@query(_SUPPLIERS)
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _suppliers(spark, sf_dir)
    return spark.read.schema(rows.schema).csv(f"file://{exports.write_csv(rows, f'{_folder(spark)}/rows.csv')}", header=True)


@query(_SUPPLIERS)
def xlsx_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _suppliers(spark, sf_dir)
    sheet = files.sheet_rows(spark, f"file://{exports.write_xlsx(rows, f'{_folder(spark)}/rows.xlsx')}")
    return sheet.where("row > 1").select(*[F.get("cells", F.lit(k)).cast(f.dataType).alias(f.name) for k, f in enumerate(rows.schema)])


@query(_SUPPLIERS)
def sqlite_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = exports.write_sqlite(_suppliers(spark, sf_dir), f"{_folder(spark)}/rows.db", "suppliers", ["s_suppkey"])
    return sqlite.table(spark, path, "suppliers").withColumn("s_nationkey", F.col("s_nationkey").cast("int"))


@query("SELECT s_nationkey::VARCHAR AS code, count(*) AS n FROM supplier GROUP BY 1")
def sqlite_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = exports.write_sqlite(_suppliers(spark, sf_dir).withColumn("s_nationkey", F.col("s_nationkey").cast("string")), f"{_folder(spark)}/rows.db", "suppliers")
    return sqlite.table(spark, path, "suppliers", ["s_nationkey"]).groupBy(F.col("s_nationkey").alias("code")).agg(F.count("*").alias("n"))


@query("SELECT f AS format, (SELECT count(*) FROM nation) AS n FROM (VALUES ('json'), ('csv'), ('xlsx'), ('db')) v(f)")
def export_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exports.export(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), _folder(spark), ["json", "all"], "nations", "nations", ["n_nationkey"])
    back = {
        "json": spark.read.json(f"file://{out['json']}", multiLine=True), "csv": spark.read.csv(f"file://{out['csv']}", header=True),
        "xlsx": files.sheet_rows(spark, f"file://{out['xlsx']}").where("row > 1"), "db": sqlite.table(spark, out["db"], "nations"),
    }
    counts = [rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("format"), "n") for name, rows in back.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query("SELECT n_nationkey::VARCHAR AS source_id, n_name AS standard_name, n_regionkey::VARCHAR AS province_name, n_nationkey + 0.5::DOUBLE AS longitude, NULL::DOUBLE AS latitude FROM nation")
def places_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    known = {"source_id": F.col("n_nationkey"), "standard_name": F.col("n_name"), "province_name": F.col("n_regionkey"), "longitude": F.col("n_nationkey") + 0.5}
    places = nations.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.PLACE])
    out = exports.export_places(places, _folder(spark), ["db"])
    return sqlite.table(spark, out["db"], "places", ["source_id", "standard_name", "province_name", "longitude", "latitude"])


@query("SELECT lpad(n_nationkey::VARCHAR, 6, '0') || '000000' AS code, n_name AS name, 'city' AS level, kind FROM nation, (VALUES ('csv'), ('json'), ('db')) v(kind)")
def divisions_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.divisions_of(_division_pages(spark, sf_dir))
    rows = found.select(*[(F.col(f.name) if f.name in found.columns else F.lit(None)).cast("string").alias(f.name) for f in schemas.PAGE_DIVISION])
    folder = _folder(spark)
    for kind in ("csv", "json", "db"):
        exports.export_divisions(rows, f"{folder}/divisions.{kind}", kind)
    csv = spark.read.csv(f"file://{folder}/divisions.csv", header=True)
    js = spark.read.schema(schemas.PAGE_DIVISION).json(f"file://{folder}/divisions.json", multiLine=True)
    db = sqlite.table(spark, f"{folder}/divisions.db", "divisions", ["code", "name", "level"])
    parts = [df.select("code", "name", "level", F.lit(kind).alias("kind")) for df, kind in ((csv, "csv"), (js, "json"), (db, "db"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, kind FROM orders, (VALUES ('json'), ('csv'), ('parquet')) v(kind)")
def parts_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    back = [spark.read.schema(rows.schema).format(kind).load(exports.write_parts(rows, scratch(spark, "parts"), kind)).withColumn("kind", F.lit(kind)) for kind in ("json", "csv", "parquet")]
    return back[0].unionByName(back[1]).unionByName(back[2])


@query("SELECT c_custkey::VARCHAR AS id FROM customer WHERE c_custkey % 10 <> 0 UNION ALL SELECT s_suppkey::VARCHAR FROM supplier")
def id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    padded = table(spark, sf_dir, "customer").select(F.when(key % 10 == 0, F.lit(" ")).otherwise(F.concat(F.lit("\t"), key.cast("string"), F.lit("  "))).alias("source_id"))
    paths = [exports.write_ids(padded, scratch(spark, "ids")), exports.write_ids(table(spark, sf_dir, "supplier"), scratch(spark, "ids"), "s_suppkey")]
    return files.ids(spark, *paths)


@query("SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders")
def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"customer": "c_custkey", "orders": "o_orderkey"}
    rows = [(name, files.count_lines(spark, exports.write_ids(table(spark, sf_dir, name), scratch(spark, "ids"), key))) for name, key in keys.items()]
    return spark.createDataFrame(rows, "name string, n long")


@query(
    "SELECT string_agg(c, '' ORDER BY p) AS chars FROM (SELECT c, min(p) AS p FROM (SELECT unnest(string_split(s, '')) AS c, unnest(range(length(s))) AS p FROM (SELECT string_agg(r_name, ', ' ORDER BY r_regionkey) AS s FROM region)) WHERE c NOT IN (' ', ',') GROUP BY c)"
)
def characters_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_folder(spark)}/chars.txt"
    with open(path, "w", encoding="utf-8") as out:
        out.write(", ".join(r.r_name for r in table(spark, sf_dir, "region").orderBy("r_regionkey").toLocalIterator()))  # a handful of regions
    return files.characters(spark, path).select(F.array_join("chars", "").alias("chars"))


@query("SELECT c_custkey % 4 AS worker_id, c_custkey::VARCHAR AS id FROM customer")
def worker_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 4).alias("worker_id"))
    return spark.read.text(exports.write_worker_ids(assigned, scratch(spark, "workers"))).select(F.col("worker_id").cast("long").alias("worker_id"), F.col("value").alias("id"))


@query("SELECT DISTINCT c_nationkey::VARCHAR AS code FROM customer")
def checkpoint_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = exports.save_checkpoint(table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("code")), f"{_folder(spark)}/progress.json")
    return exports.load_checkpoint(spark, path)


@query(
    "SELECT * FROM (VALUES ('110000', '北京市', 'province', NULL, 116.4074::DOUBLE), ('110100', '市辖区', 'city', '110000', NULL), ('110101', '东城区', 'district', '110100', 116.4164), ('110101001', '东华门街道', 'town', '110101', 116.4039)) v(code, name, level, parent_code, longitude)"
)
def sample_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.fill_coordinates(files.sample_regions(spark, NOW), files.sample_points(spark)).select("code", "name", "level", "parent_code", "longitude")


@query(
    "SELECT 'k' AS keyword, c_nationkey::VARCHAR AS code, (c_custkey // 100 + 1)::INTEGER AS page, count(*) OVER (PARTITION BY c_nationkey, c_custkey // 100) AS total, '{\"id\":' || c_custkey || ',\"name\":\"' || c_name || '\"}' AS raw FROM customer"
)
def search_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.floor(F.col("c_custkey") / 100).cast("int") + 1
    record = F.struct(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"))
    pages = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("string").alias("code"), page.alias("page")).agg(F.collect_list(record).alias("records"))  # 100 at most
    answers = pages.select(F.lit("k").alias("keyword"), "code", "page", F.to_json(F.struct(F.size("records").alias("total"), "records")).alias("payload"))
    path = exports.write_parts(answers, scratch(spark, "answers"), "json")
    return replay.search_answers(spark.read.schema("keyword string, code string, page int, payload string").json(path))


@query("SELECT n_nationkey::VARCHAR AS code, n_name AS name, CASE WHEN n_nationkey % 3 = 0 THEN 'p' ELSE n_regionkey::VARCHAR END AS parent_code, 'province' AS level FROM nation WHERE n_nationkey >= 10")
def division_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    row = F.struct(F.when(key >= 10, key.cast("string")).otherwise("").alias("code"), F.col("n_name").alias("name"), F.when(key % 3 == 0, "p").alias("parentCode"))
    answers = table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").cast("string").alias("code")).agg(F.collect_list(row).alias("rows"))  # the nations of a region
    payload = F.to_json(F.struct(F.struct("rows").alias("data")))
    return replay.divisions(answers.select("code", payload.alias("payload")), F.lit(NOW)).select("code", "name", "parent_code", "level")


@query(
    """SELECT 'R' || r_regionkey AS code, r_name AS name, '0' AS parent_code, 'province' AS level FROM region
    UNION ALL SELECT 'N' || n_nationkey, CASE WHEN n_regionkey % 2 = 0 THEN 'kept ' ELSE '' END || n_name, 'R' || n_regionkey, 'city' FROM nation
    UNION ALL SELECT 'C' || c_custkey, c_name, 'N' || c_nationkey, 'district' FROM customer WHERE c_nationkey % 5 <> 0"""
)
def division_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations, customers = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    name = lambda letter, column: F.concat(F.lit(letter), F.col(column))
    row = lambda code, called, level: F.struct(code.alias("code"), F.col(called).alias("name"), F.lit(level).alias("level"))
    parts = [
        table(spark, sf_dir, "region").select(F.lit("0").alias("code"), row(name("R", "r_regionkey"), "r_name", "province").alias("row"), F.lit(0).alias("part")),
        nations.select(name("R", "n_regionkey").alias("code"), row(name("N", "n_nationkey"), "n_name", "city").alias("row"), F.lit(0).alias("part")),
        customers.select(name("N", "c_nationkey").alias("code"), row(name("C", "c_custkey"), "c_name", "district").alias("row"), F.floor(F.col("c_custkey") / 100).cast("int").alias("part")),
    ]
    # answers of at most 100 rows; a code has as many as it needs
    answers = reduce(DataFrame.unionByName, parts).groupBy("code", "part").agg(F.collect_list("row").alias("rows"))
    answers = answers.select("code", F.to_json(F.struct(F.struct("rows").alias("data"))).alias("payload"))
    # the nations of every other region are in the table, and every fifth nation is marked as one without parts
    kept = nations.where("n_regionkey % 2 = 0").select(name("N", "n_nationkey").alias("code"), F.concat(F.lit("kept "), "n_name").alias("name"), name("R", "n_regionkey").alias("parent_code"), F.lit("city").alias("level"))
    cached = kept.select("*", F.lit("places").alias("source_name"), F.lit(NOW).alias("captured_at"), F.lit(NOW).alias("updated_at"))
    marks = nations.where("n_nationkey % 5 = 0").select(name("N", "n_nationkey").alias("parent_code"), F.lit(NOW).alias("fetched_at"))
    # customers without parts of their own have no answer: their requests fail and stay open
    return collect.sync_divisions(cached, marks, lambda codes: answers.join(codes, "code", "left_semi"), F.lit(NOW)).divisions.select("code", "name", "parent_code", "level")


@query(
    """WITH c AS (
        SELECT left(c_mktsegment, 1) AS keyword, n_regionkey, 'N' || n_nationkey AS code, c_custkey // 1000 + 2 AS page, (c_custkey // 4)::VARCHAR AS source_id FROM customer JOIN nation ON c_nationkey = n_nationkey
    ), t AS (SELECT r_name AS task, r_regionkey AS own, unnest(string_split(r_name, '')) AS keyword, unnest(range(length(r_name))) AS p FROM region),
    w AS (SELECT task, own, keyword, min(p) AS rank FROM t WHERE keyword <> ' ' GROUP BY ALL),
    split AS (SELECT keyword, n_regionkey FROM c GROUP BY ALL HAVING count(*) > 10), leaf AS (SELECT keyword, code, count(*) AS total FROM c GROUP BY ALL)
    SELECT task, source_id, arg_max(keyword, (rank, code)) AS keyword, arg_max(code, (rank, code)) AS partition_code
    FROM c JOIN w USING (keyword) JOIN split USING (keyword, n_regionkey) JOIN leaf USING (keyword, code)
    WHERE (own = 0 OR own = n_regionkey) AND page <= total GROUP BY task, source_id"""
)
def search_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = F.concat(F.lit("R"), "n_regionkey")
    nation = F.concat(F.lit("N"), "n_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", region.alias("region"), nation.alias("nation"))
    rows = table(spark, sf_dir, "customer").join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.substring("c_mktsegment", 1, 1).alias("keyword"), "region", "nation", "c_custkey")
    # first pages tell the totals, the pages behind them hold at most 1,000 records of a nation
    record = F.struct(F.floor(F.col("c_custkey") / 4).cast("string").alias("id"))
    page = (F.floor(F.col("c_custkey") / 1000) + 2).cast("long")
    pages = rows.groupBy("keyword", F.col("nation").alias("code"), page.alias("page")).agg(F.to_json(F.struct(F.collect_list(record).alias("records"))).alias("payload"))
    total = F.to_json(F.struct(F.count("*").alias("total"))).alias("payload")
    firsts = [rows.groupBy("keyword", F.col(c).alias("code")).agg(total).withColumn("page", F.lit(1).cast("long")) for c in ("region", "nation")]
    answers = reduce(DataFrame.unionByName, firsts, pages)
    divisions = nations.select(F.col("nation").alias("code"), F.col("region").alias("parent_code")).unionByName(nations.select(F.col("region").alias("code"), F.lit("0").alias("parent_code")).distinct())
    # a task for each region: the letters of its name, in the region itself (the first one: in all)
    key = F.col("r_regionkey")
    own = F.when(key != 0, F.array(F.concat(F.lit("R"), key)))
    tasks = table(spark, sf_dir, "region").select(F.col("r_name").alias("task"), F.col("r_name").alias("chars"), own.alias("provinces"), F.lit("total").alias("total_path"), F.array(F.lit("csv")).alias("formats"))
    return collect.collect_tasks(answers, divisions, tasks, F.lit(NOW), threshold=10, size=1).places.select("task", "source_id", "keyword", "partition_code")


def _detail(key: str) -> tuple[int, str]:
    """A transport: by the number of the id a fault, a refusal, a broken body or a record."""
    n = int(key)
    if n % 11 == 0:
        raise TimeoutError
    if n % 7 == 0:
        return 404, ""
    if n % 5 == 0:
        return 200, "<html>"
    return 200, json.dumps({"standard_name": f"place {n}"})


@query(
    "SELECT c_custkey::VARCHAR AS id, c_custkey % 11 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 AS ok, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 404 ELSE 200 END AS status_code, CASE WHEN c_custkey % 11 = 0 THEN '请求超时' WHEN c_custkey % 7 = 0 THEN 'HTTP 404' WHEN c_custkey % 5 = 0 THEN 'JSON 解析失败' END AS kind, CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 THEN '{\"standard_name\": \"place ' || c_custkey || '\"}' END AS data FROM customer"
)
def detail_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = replay.fetch_details(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id")), _detail)
    return got.select("id", "ok", "status_code", F.split_part("error", F.lit(":"), F.lit(1)).alias("kind"), "data")


@query("SELECT c_custkey::VARCHAR AS id, CASE WHEN c_custkey % 11 = 0 OR c_custkey % 7 = 0 OR c_custkey % 5 = 0 THEN 'failed' ELSE 'done' END AS status, CASE WHEN c_custkey % 11 = 0 OR c_custkey % 7 = 0 OR c_custkey % 5 = 0 THEN NULL ELSE 'place ' || c_custkey END AS standard_name FROM customer")
def detail_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    run = details.run_details(spark, scratch(spark, "run"), _detail, "r", ids, batch=1_000_000, attempts=1, most_attempts=1)
    return run.tasks.select("id", "status").join(run.master.select("id", "standard_name"), "id", "left")


def _limited(key: str) -> tuple[int, str]:
    """A transport that refuses ids beyond 20 and fails for every fourth of the others."""
    n = int(key)
    return (429, "") if n > 20 else (500, "") if n % 4 == 0 else (200, "{}")


@query("SELECT qps::DOUBLE AS qps, count(*) AS total, count(*) FILTER (n_nationkey <= 20 AND n_nationkey % 4 <> 0) AS ok, count(*) FILTER (n_nationkey > 20) AS status_429, count(*) FILTER (n_nationkey <= 20 AND n_nationkey % 4 = 0) AS status_5xx, NULL::DOUBLE AS safe_qps FROM nation, (VALUES (500)) v(qps) GROUP BY qps")
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ladder over the nations; some calls of its first level are refused, so it is the last."""
    ids = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"))
    got = details.calibrate(ids, _limited, ladder=(500, 1000), seconds=1)
    return got.levels.select("qps", "total", "ok", "status_429", "status_5xx").join(got.rate.select("safe_qps"))


def _page(url: str) -> str:
    """A transport of division pages: every fifth is missing."""
    number = int(url.rsplit("/", 1)[1][:9])
    if number % 5 == 0:
        raise OSError("missing")
    return f'<h3>同级行政区划</h3><table><tr><td><a href="/x/{number:09}.html">n</a></td><td>正常</td></tr></table>'


@query("SELECT lpad(n_nationkey::VARCHAR, 9, '0') || '000' AS code, 'https://example.org/' || lpad(n_nationkey::VARCHAR, 9, '0') || '.html' AS url FROM nation WHERE n_nationkey % 5 <> 0")
def page_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.fetch_pages(_codes(spark, sf_dir), _page, "https://example.org").select("code", "url")


@query("SELECT lpad(n_nationkey::VARCHAR, 9, '0') || '000' AS code FROM nation WHERE n_nationkey % 5 <> 0")
def seed_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.seed_codes(replay.fetch_pages(_codes(spark, sf_dir), _page, "https://example.org"), "999999999000")


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.concat(F.lpad(F.col("n_nationkey").cast("string"), 9, "0"), F.lit("000")).alias("code"))


def _search(keyword: str, code: str, page: int) -> tuple[int, str]:
    """A transport of searches: regions of even number have too much to read, other regions and the nations some pages of ten."""
    region = code.startswith("r")
    n = int(code[1:])
    total = (5000 if n % 2 == 0 else 25) if region else n * 7 % 45
    records = [{"id": f"{keyword}{code}-{k}", "standard_name": code} for k in range((page - 1) * 10, min(page * 10, total))]
    return 200, json.dumps({"total": total, "records": records})


@query(
    "SELECT k || c || '-' || i AS source_id, k AS keyword, c AS partition_code FROM (SELECT 'r' || r_regionkey AS c, 25 AS total FROM region WHERE r_regionkey % 2 = 1 UNION ALL SELECT 'n' || n_nationkey, n_nationkey * 7 % 45 FROM nation WHERE n_regionkey % 2 = 0), (VALUES ('a'), ('b')) v(k), LATERAL (SELECT unnest(range(total)) AS i)"
)
def live_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("code"), F.lit("0").alias("parent_code"))
    nations = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("code"), F.concat(F.lit("r"), "n_regionkey").alias("parent_code"))
    divisions = regions.unionByName(nations)
    answers = collect.search_live(divisions, ["a", "b"], _search, threshold=3000, size=10, parallel=4)
    return collect.collect_places(answers, divisions, ["a", "b"], F.lit(NOW), threshold=3000, size=10).places.select("source_id", "keyword", "partition_code")


def _detail_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"), F.lit("{}").alias("raw_json"), F.col("event_type").alias("place_code"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("fetched_at"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("worker_id"), F.lit(1).alias("attempt"),
    )
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.DETAIL])


@query("SELECT user_id::VARCHAR AS id, arg_max(event_type, (ts, event_id)) AS place_code, lpad(arg_max(event_id, (ts, event_id))::VARCHAR, 12, '0') AS source_worker_id FROM events GROUP BY 1")
def merge_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, root = scratch(spark, "details"), scratch(spark, "master")
    _detail_rows(spark, sf_dir).write.parquet(source)
    rows = spark.readStream.schema(schemas.DETAIL).option("maxFilesPerTrigger", 1000).parquet(source)
    control.await_within(control.merge_stream(rows, root, scratch(spark, "mark"), "r"), 600)
    return master.read(spark, root).select("id", "place_code", "source_worker_id")


@query("SELECT event_id, event_type, value FROM events")
def flush_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, out = scratch(spark, "events"), scratch(spark, "flushed")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    events.unionByName(events).write.parquet(source)  # each event twice
    rows = control.latest_events(spark.readStream.schema(events.schema).parquet(source), "100000 days")
    control.await_within(control.flush_stream(rows, out, scratch(spark, "mark"), 1000), 600)
    return spark.read.parquet(out).select("event_id", "event_type", "value")


@query("SELECT n_nationkey, k AS call, round(1 / CASE WHEN n_regionkey = 0 THEN 0.1::DOUBLE ELSE n_regionkey END, 6) AS wait FROM nation, (VALUES (1), (2), (3)) v(k)")
def bucket_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waits of three calls in a row at a rate of the region's number, by a clock that only the waits move."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, calls, waits = [], [], []
            for key, qps in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                now = [0.0]
                bucket = control.TokenBucket(float(qps), clock=lambda now=now: now[0], sleep=lambda s, now=now: now.__setitem__(0, now[0] + s))
                for call in (1, 2, 3):
                    keys.append(key)
                    calls.append(call)
                    waits.append(bucket.acquire())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(calls, pa.int32()), pa.array(waits, pa.float64())], names=["n_nationkey", "call", "wait"])

    return table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").mapInArrow(run, "n_nationkey int, call int, wait double").withColumn("wait", F.round("wait", 6))


@query("SELECT event_id, value AS plain, true AS inside FROM events")
def jitter_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumns({"plain": scalar.jitter(F.col("value"), 0.0, 0.0), "moved": scalar.jitter(F.col("value"), 0.5, 1.5, 7)})
    return rows.select("event_id", "plain", F.col("moved").between(F.col("value") + 0.5, F.col("value") + 1.5).alias("inside"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS at FROM events")
def utc_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", scalar.iso_utc(F.col("ts")).alias("at"))


@query("SELECT DISTINCT 't' || p_partkey AS task, c AS keyword FROM (SELECT p_partkey, unnest(string_split(p_name, '')) AS c FROM part) WHERE c NOT IN (' ', ',', ';', chr(10), chr(9), '，', '、', '；') AND c <> ''")
def task_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = table(spark, sf_dir, "part").select(F.concat(F.lit("t"), "p_partkey").alias("task"), F.col("p_name").alias("chars"), F.lit("total").alias("total_path"), F.array(F.lit("csv")).alias("formats"))
    return collect.task_partitions(tasks)


@query("SELECT * FROM (VALUES ('size', '7'), ('name', 'c'), ('mode', 'contain'), ('extra', 'x')) v(key, value)")
def settings_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _folder(spark)
    with open(f"{folder}/task.json", "w", encoding="utf-8") as out:
        json.dump({"size": 7, "name": None}, out)
    with open(f"{folder}/.env", "w", encoding="utf-8") as out:
        out.write("# settings\nAPP_NAME='b'\nAPP_EXTRA=x\n")
    env = files.prefixed(files.env_file(f"{folder}/.env"), "APP_")
    merged = files.merged_settings({"size": 5, "name": "a", "mode": "contain"}, env, files.task(f"{folder}/task.json"), {"name": "c", "mode": None})
    return spark.createDataFrame([(k, str(v)) for k, v in merged.items()], "key string, value string")


@query(
    "SELECT o_custkey::VARCHAR AS source_id, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS standard_name, CASE WHEN o_custkey % 2 = 0 THEN 'before' ELSE max(strftime(o_orderdate, '%Y-%m-%d')) END AS captured_at FROM orders GROUP BY o_custkey"
)
def upsert_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        F.col("o_custkey").cast("string").alias("source_id"), F.col("o_orderstatus").alias("standard_name"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("captured_at"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lpad(F.col("o_orderkey").cast("string"), 15, "0")).alias("updated_at"),
    )
    old = orders.where("o_custkey % 2 = 0").select(F.col("o_custkey").cast("string").alias("source_id"), F.lit("old").alias("standard_name"), F.lit("before").alias("captured_at"), F.lit("0").alias("updated_at")).distinct()
    return upsert.upsert_places(old, rows).select("source_id", "standard_name", "captured_at")
