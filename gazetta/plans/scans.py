"""Queries over running values, interval labels, many keywords, and merges that count in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.operators import hierarchy, scan, search, tasks, upsert
from gazetta.operators.lineage import cut
from gazetta.plans.logs import _DAYS
from gazetta.plans.registry import query, table
from gazetta.plans.storage import _detail_rows

#: Microseconds between two calls of one user.
GAP = 4 * 3600 * 1_000_000


@query(f"""
WITH k AS (SELECT event_id, user_id, epoch_us(ts) AS arrives, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events)
SELECT event_id, user_id, arrives, i * {GAP} + max(arrives - i * {GAP}) OVER (PARTITION BY user_id ORDER BY i) AS departs FROM k
""")
def departure_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When each event may leave if a user's events are four hours apart at least."""
    ts = F.col("ts")
    micros = (F.unix_date(ts.cast("date")).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60) * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    calls = table(spark, sf_dir, "events").select("event_id", "user_id", micros.alias("arrives"))
    return scan.departures(calls, "user_id", F.col("arrives"), ["event_id"], F.lit(GAP))


@query("""
WITH nodes AS (
    SELECT 'r' || r_regionkey AS code, NULL AS parent_code, 'r' || r_regionkey AS path, 0 AS depth FROM region
    UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'r' || n_regionkey || '/n' || n_nationkey, 1 FROM nation
    UNION ALL SELECT 'c' || c_custkey, 'n' || n_nationkey, 'r' || n_regionkey || '/n' || n_nationkey || '/c' || c_custkey, 2 FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT 'o' || o_orderkey, 'c' || c_custkey, 'r' || n_regionkey || '/n' || n_nationkey || '/c' || c_custkey || '/o' || o_orderkey, 3 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), placed AS (
    SELECT *, row_number() OVER (ORDER BY path) - 1 AS first FROM nodes
), sizes AS (
    SELECT code, count(*) AS n FROM (SELECT unnest(string_split(path, '/')) AS code FROM nodes) GROUP BY code
)
SELECT code, parent_code, depth::BIGINT AS depth, first, first + n - 1 AS last FROM placed JOIN sizes USING (code)
""")
def hierarchy_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations, customers and orders as one hierarchy, labelled by intervals."""

    def level(name: str, key: str, parent: str | None, letters: str) -> DataFrame:
        above = F.concat(F.lit(letters[1]), F.col(parent)) if parent else F.lit(None).cast("string")
        return table(spark, sf_dir, name).select(F.concat(F.lit(letters[0]), F.col(key)).alias("code"), above.alias("parent_code"))

    edges = level("region", "r_regionkey", None, "r").union(level("nation", "n_nationkey", "n_regionkey", "nr")).union(level("customer", "c_custkey", "c_nationkey", "cn")).union(level("orders", "o_orderkey", "o_custkey", "oc"))
    return hierarchy.intervals(edges)


@query("""
WITH nodes AS (SELECT c_custkey, n_nationkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
below AS (SELECT 'n' || n_nationkey AS code FROM nation WHERE n_regionkey = 2 UNION ALL SELECT 'c' || c_custkey FROM nodes WHERE n_regionkey = 2)
SELECT code FROM below
""")
def hierarchy_below(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nations and customers below one region, by a filter on the labels."""
    nation = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("code"), F.concat(F.lit("r"), "n_regionkey").alias("parent_code"))
    region = table(spark, sf_dir, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("code"), F.lit(None).cast("string").alias("parent_code"))
    customer = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("code"), F.concat(F.lit("n"), "c_nationkey").alias("parent_code"))
    return hierarchy.below(hierarchy.intervals(region.union(nation).union(customer)), "r2").select("code")


@query("""
WITH words AS (SELECT unnest(string_split(text, ' ')) AS keyword FROM documents),
k AS (SELECT keyword FROM words WHERE keyword <> '' GROUP BY keyword ORDER BY count(*) DESC, keyword LIMIT 5000)
SELECT 'part' AS "table", keyword, count(*) AS n FROM k JOIN part ON contains(p_name, keyword) GROUP BY keyword
UNION ALL SELECT 'documents', keyword, count(*) FROM k JOIN documents ON contains(text, keyword) GROUP BY keyword
""")
def keyword_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many part names and texts each of the 5,000 most frequent words stands, as a part of words too."""
    documents, part = table(spark, sf_dir, "documents"), table(spark, sf_dir, "part")
    words = documents.select(F.explode(F.split("text", " ")).alias("keyword")).where("keyword <> ''")
    keywords = cut(words.groupBy("keyword").count().orderBy(F.desc("count"), "keyword").limit(5000).select("keyword"))  # both tables are searched for them
    found = [search.search_many(names.withColumn("table", F.lit(name)), keywords, column="name", keep=["table"]).groupBy("table", "keyword").agg(F.count("*").alias("n")) for name, names in (("part", part.select(F.col("p_name").alias("name"))), ("documents", documents.select(F.col("text").alias("name"))))]
    return found[0].unionByName(found[1])


@query("SELECT p_partkey, p_name AS name, p_name AS keyword FROM part WHERE p_name IN (SELECT p_name FROM part WHERE p_size > 25)")
def keyword_many_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    names = part.select("p_partkey", F.col("p_name").alias("name"))
    return search.search_many(names, part.where("p_size > 25").select(F.col("p_name").alias("keyword")), "exact")


@query(f"""
WITH e AS (SELECT user_id::VARCHAR || event_type AS id, ts < TIMESTAMP '{_DAYS[0]}' AS early FROM events)
SELECT count(*) AS rows_read, n AS inserted, count(*) - n AS updated
FROM e, (SELECT count(DISTINCT id) AS n FROM e WHERE id NOT IN (SELECT id FROM e WHERE early)) GROUP BY n
""")
def worker_merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details of all events merged into a master table that has the early ones; what was read, inserted and updated."""
    rows = _detail_rows(spark, sf_dir).withColumn("id", F.concat("id", "place_code"))
    early = upsert.last_wins(rows.where(F.col("fetched_at") < _DAYS[0]), ["id"], ["fetched_at", "worker_id"])
    master = upsert.master_rows(early, F.lit("r0"), F.lit("t0"))
    return upsert.merge_workers(master, rows, F.lit("r1"), F.lit("t1"), ["fetched_at", "worker_id", "attempt"])[1]


@query("SELECT doc_id FROM documents ORDER BY md5('11|' || doc_id) LIMIT 100")
def exact_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tasks.exact_sample(table(spark, sf_dir, "documents").select("doc_id"), 100, seed=11)
