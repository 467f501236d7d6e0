"""Queries over code hierarchies, names and keyword search. Regions, nations and their customers or suppliers stand for provinces, cities and places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions import scalar
from gazetta.operators import hierarchy, scan, search, stats, tasks
from gazetta.plans.registry import query, table
from gazetta.sources import files


def _edges(spark: SparkSession, sf_dir: str, leaves: str, key: str, nation: str) -> DataFrame:
    """code, name, parent_code, level: regions have 2 characters, nations 4, places 12."""
    regions = table(spark, sf_dir, "region").select("r_regionkey", F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("r"), F.col("r_name").alias("name"))
    nations = table(spark, sf_dir, "nation").join(F.broadcast(regions.select("r_regionkey", "r")), F.col("n_regionkey") == F.col("r_regionkey"))
    nations = nations.select("n_nationkey", "n_name", "r", F.concat("r", F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("n"))
    places = table(spark, sf_dir, leaves).join(F.broadcast(nations), F.col(nation) == F.col("n_nationkey"))  # the 25 nations are fixed in number
    places = places.select(F.concat("n", F.lpad(F.col(key).cast("string"), 8, "0")).alias("code"), F.col(f"{leaves[0]}_name").alias("name"), F.col("n").alias("parent_code"))
    rows = regions.select(F.col("r").alias("code"), "name", F.lit("0").alias("parent_code")).unionByName(nations.select(F.col("n").alias("code"), F.col("n_name").alias("name"), F.col("r").alias("parent_code"))).unionByName(places)
    return rows.withColumn("level", scalar.level_from_length(F.col("code")))


def _edges_sql(leaves: str, key: str, nation: str) -> str:
    return f"""
    cities AS (SELECT n_nationkey, n_name, lpad(n_regionkey::VARCHAR, 2, '0') AS r, lpad(n_regionkey::VARCHAR, 2, '0') || lpad(n_nationkey::VARCHAR, 2, '0') AS n FROM nation),
    edges AS (
        SELECT lpad(r_regionkey::VARCHAR, 2, '0') AS code, r_name AS name, '0' AS parent_code, 'province' AS level FROM region
        UNION ALL SELECT n, n_name, r, 'city' FROM cities
        UNION ALL SELECT n || lpad({key}::VARCHAR, 8, '0'), {leaves[0]}_name, n, 'town' FROM {leaves} JOIN cities ON {nation} = n_nationkey
    )"""


CUSTOMERS, SUPPLIERS = ("customer", "c_custkey", "c_nationkey"), ("supplier", "s_suppkey", "s_nationkey")


@query(
    f"""WITH RECURSIVE {_edges_sql(*CUSTOMERS)}, walk AS (
        SELECT code, parent_code, level, 1 AS depth, code AS path FROM edges WHERE parent_code = '0'
        UNION ALL SELECT e.code, e.parent_code, e.level, w.depth + 1, w.path || '/' || e.code FROM edges e JOIN walk w ON e.parent_code = w.code
    ) SELECT code, parent_code, level, depth, path FROM walk"""
)
def hierarchy_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    walk = hierarchy.descend(_edges(spark, sf_dir, *CUSTOMERS))
    return walk.select("code", "parent_code", scalar.level_from_length(F.col("code")).alias("level"), "depth", F.array_join("path", "/").alias("path"))


@query(
    f"""WITH RECURSIVE {_edges_sql(*SUPPLIERS)}, walk AS (
        SELECT code, parent_code, level, 0 AS depth FROM edges WHERE parent_code = '0'
        UNION ALL SELECT e.code, e.parent_code, e.level, w.depth + 1 FROM edges e JOIN walk w ON e.parent_code = w.code AND w.level <> 'town'
    ) SELECT code, parent_code, depth FROM walk"""
)
def hierarchy_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = _edges(spark, sf_dir, *SUPPLIERS)
    return hierarchy.expand(edges, edges.where("parent_code = '0'"), stop_levels=("district", "town"))


@query(f"WITH {_edges_sql(*CUSTOMERS)} SELECT level, count(*) AS n FROM edges GROUP BY level")
def count_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.count_by(_edges(spark, sf_dir, *CUSTOMERS), "level")


@query(f"WITH {_edges_sql(*CUSTOMERS)} SELECT code, name, level FROM edges WHERE parent_code = '01' ORDER BY code")
def children_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.children_of(_edges(spark, sf_dir, *CUSTOMERS), "01").select("code", "name", "level")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey IN (1, 5, 8)")
def province_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = search.in_provinces(table(spark, sf_dir, "customer"), [1, 5, 8], "c_nationkey")
    return customers.join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


_KEYWORDS = ["ring", "bolt", "hot", "gear"]


@query("SELECT p_partkey, p_name, k AS keyword FROM part JOIN (VALUES ('ring'), ('bolt'), ('hot'), ('gear')) v(k) ON contains(p_name, k)")
def keyword_contain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "part").select("p_partkey", "p_name"), _KEYWORDS, "contain", "p_name")


@query("SELECT p_partkey, p_name, k AS keyword FROM part JOIN (VALUES ('small ring'), ('red widget'), ('blue')) v(k) ON p_name = k")
def keyword_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "part").select("p_partkey", "p_name"), ["small ring", "red widget", "blue"], "exact", "p_name")


@query("SELECT doc_id, k AS keyword FROM documents JOIN (VALUES ('ción'), ('heit'), ('éreau'), ('thing')) v(k) ON contains(text, k)")
def keyword_in_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents").select("doc_id", "text"), ["ción", "heit", "éreau", "thing"], "contain", "text").select("doc_id", "keyword")


@query("SELECT k AS keyword, n_nationkey::VARCHAR AS code FROM nation, (VALUES ('东'), ('村'), ('山')) v(k)")
def keyword_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.keyword_partitions(["东", "村", "山"], table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("code")))


@query(
    """SELECT p_partkey, list_aggregate(list_transform(list_sort(list_transform(list_distinct(list_filter(string_split(p_name, ''), lambda c: c NOT IN (' ', ',', ';', chr(10), chr(9), '，', '、', '；') AND c <> '')), lambda c: {'at': instr(p_name, c), 'c': c})), lambda s: s.c), 'string_agg', '') AS chars FROM part"""
)
def distinct_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(scalar.distinct_chars(F.col("p_name")), "").alias("chars"))


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(keyword, code, parent_code, total): customers of each segment in the country, its regions and its nations."""
    rows = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.groupBy("c_mktsegment", "n_regionkey", "n_nationkey").agg(F.count("*").alias("n"))
    region, nation = F.concat(F.lit("r"), "n_regionkey"), F.concat(F.lit("n"), "n_nationkey")
    keyword = F.col("c_mktsegment").alias("keyword")
    nations = rows.groupBy(keyword, nation.alias("code"), region.alias("parent_code")).agg(F.sum("n").alias("total"))
    regions = rows.groupBy(keyword, region.alias("code"), F.lit("").alias("parent_code")).agg(F.sum("n").alias("total"))
    country = rows.groupBy(keyword).agg(F.sum("n").alias("total")).select("keyword", F.lit("").alias("code"), F.lit(None).cast("string").alias("parent_code"), "total")
    return country.unionByName(regions).unionByName(nations)


@query(
    """WITH rows AS (SELECT c_mktsegment AS keyword, 'n' || n_nationkey AS n, 'r' || n_regionkey AS r FROM customer JOIN nation ON c_nationkey = n_nationkey),
    leaf AS (SELECT keyword, r, n, count(*) AS total FROM rows GROUP BY ALL), mid AS (SELECT keyword, r, sum(total)::BIGINT AS total FROM leaf GROUP BY ALL), top AS (SELECT keyword, sum(total)::BIGINT AS total FROM mid GROUP BY ALL),
    done AS (
        SELECT keyword, '' AS code, total FROM top WHERE total <= 60
        UNION ALL SELECT m.keyword, r, m.total FROM mid m JOIN top t ON m.keyword = t.keyword AND t.total > 60 WHERE m.total <= 60
        UNION ALL SELECT l.keyword, n, l.total FROM leaf l JOIN mid m ON l.keyword = m.keyword AND l.r = m.r AND m.total > 60 JOIN top t ON t.keyword = l.keyword AND t.total > 60
    ) SELECT keyword, code, total, unnest(range(1, greatest(1, (total + 9) // 10) + 1)) AS page FROM done"""
)
def adaptive_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.adaptive_partitions(_counts(spark, sf_dir), threshold=60, size=10)


@query("SELECT event_type, total, unnest(range(1, greatest(1, (total + 99) // 100) + 1)) AS page FROM (SELECT event_type, count(*) AS total FROM events GROUP BY 1)")
def page_enumeration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("total"))
    return rows.select("event_type", "total", F.explode(hierarchy.pages_of(F.col("total"), 100)).alias("page"))


@query("SELECT conv_id, turn, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3 + 1 AS page FROM conversations WHERE turn >= 0")
def turn_pagination(spark: SparkSession, sf_dir: str) -> DataFrame:
    # running counts by ranges, so that a conversation of any length is in many tasks and turns may have gaps
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn").where("turn >= 0")
    numbered = scan.sum_before(turns, ["conv_id"], ["turn"], F.lit(1).cast("long"), "before")
    return numbered.select("conv_id", "turn", (F.floor(F.col("before") / 3) + 1).cast("long").alias("page"))


@query("SELECT n_nationkey::VARCHAR AS code, n_name, CASE WHEN n_nationkey % 4 = 0 THEN n_regionkey * 10.0 WHEN n_nationkey IN (1, 6, 11) THEN 116.25 END::DOUBLE AS longitude, CASE WHEN n_nationkey % 4 = 0 THEN n_nationkey * 1.5 WHEN n_nationkey IN (1, 6, 11) THEN 39.5 END::DOUBLE AS latitude FROM nation")
def geocode_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.createDataFrame([(str(k), 116.25, 39.5) for k in (1, 4, 6, 8, 11)], "code string, lon double, lat double")
    there = F.col("n_nationkey") % 4 == 0
    regions = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("code"), "n_name", F.when(there, F.col("n_regionkey") * F.lit(10.0)).alias("longitude"), F.when(there, F.col("n_nationkey") * F.lit(1.5)).alias("latitude"))
    return hierarchy.fill_coordinates(regions, known).select("code", "n_name", "longitude", "latitude")


@query("SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN '全国' ELSE coalesce(n_name, c_nationkey::VARCHAR) END AS display_name FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 3) ON c_nationkey = n_nationkey")
def name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "nation").where("n_regionkey <> 3").select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_nationkey") == 0, "").otherwise(F.col("c_nationkey").cast("string")).alias("code"))
    return hierarchy.with_names(rows, F.broadcast(names)).select("c_custkey", "display_name")


@query(
    "SELECT n_nationkey, lpad(n_nationkey::VARCHAR, 6, '0') || '000000' AS padded6, lpad(n_nationkey::VARCHAR, 9, '0') || '000' AS padded9, 'x' || n_nationkey AS other, lpad(n_nationkey::VARCHAR, 6, '0') AS short_of_6, lpad(n_nationkey::VARCHAR, 9, '0') AS short_of_9 FROM nation"
)
def code_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    six, nine = F.lpad(key, 6, "0"), F.lpad(key, 9, "0")
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", scalar.padded_code(F.concat(F.lit(" "), six)).alias("padded6"), scalar.padded_code(nine).alias("padded9"), scalar.padded_code(F.concat(F.lit("x"), key, F.lit("\n"))).alias("other"),
        scalar.short_code(scalar.padded_code(six)).alias("short_of_6"), F.substring(scalar.padded_code(nine), 1, 9).alias("short_of_9"),
    )


@query("SELECT c_custkey, CASE WHEN length(c_custkey::VARCHAR) <= 2 THEN 'province' WHEN length(c_custkey::VARCHAR) <= 4 THEN 'city' WHEN length(c_custkey::VARCHAR) <= 6 THEN 'district' ELSE 'town' END AS level FROM customer")
def level_from_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", scalar.level_from_length(F.col("c_custkey").cast("string")).alias("level"))


@query(
    "SELECT n_nationkey, ['省(自治区)', ' 市', '县（市辖区）', '街道', '村'][n_nationkey % 5 + 1] AS level_text, ['province', 'city', 'district', 'town', 'unknown'][n_nationkey % 5 + 1] AS level FROM nation"
)
def level_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = F.array(*[F.lit(t) for t in ("省(自治区)", " 市", "县（市辖区）", "街道", "村")])
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.get(texts, F.col("n_nationkey") % 5).alias("level_text"))
    return rows.withColumn("level", scalar.level_from_text(F.col("level_text")))


_UNICODE = " UNION ALL ".join(f"SELECT unnest(range({a}, {b + 1}))::INTEGER AS cp" for a, b in files.HAN_RANGES)


@query(f'SELECT cp, chr(cp) AS "char" FROM ({_UNICODE})')
def unicode_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.han_characters(spark)


@query("SELECT o_orderkey, ((row_number() OVER (ORDER BY o_orderdate, o_orderkey)) - 1) % 7 AS worker_id FROM orders")
def round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return tasks.round_robin(rows, 7, ["o_orderdate", "o_orderkey"]).select("o_orderkey", F.col("worker_id").cast("long"))


@query("SELECT o_orderkey, worker FROM (SELECT o_orderkey, o_custkey % 7 AS worker, row_number() OVER (PARTITION BY o_custkey % 7 ORDER BY o_orderkey) AS k FROM orders) WHERE k <= 5")
def sample_per_worker(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 7).alias("worker"))
    return tasks.first_of_each(rows, "worker", ["o_orderkey"], 5)
