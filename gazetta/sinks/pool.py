"""A pool of ids in buckets, with a Bloom filter of each bucket beside it.

Ids to put in meet the filters, which have a word of 64 bits for some six ids; only ids that a filter may know meet the pool, and
only the buckets of these are read.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.operators.lineage import cut
from gazetta.sinks import commits

BUCKETS = 64
#: Bits that an id sets in the filter of its bucket.
PROBES = 4
#: Words of a bucket's filter; at 10 bits an id 2**16 of them serve 400,000 ids, and more ids let more pass, which only costs reading.
WORDS = 1 << 16
#: Filters of more runs than this are put together.
MOST_RUNS = 16


class State(NamedTuple):
    buckets: int
    words: int
    runs: list[tuple[str, list[int]]]  #: folder and buckets of each run of ids
    filters: list[str]  #: folders of (bucket, word, bits)


class Inserted(NamedTuple):
    added: int
    existed: int
    total: int
    read: list[int]  #: buckets of the pool that were read


def state(spark: SparkSession, root: str) -> State:
    out = State(BUCKETS, WORDS, [], [])
    for _, info in commits.history(spark, root):
        runs, filters = ([tuple(r) for r in info["whole"]], []) if "whole" in info else (out.runs, out.filters)
        if "folder" in info:
            runs = [*runs, (info["folder"], info["in"])]
        out = State(info.get("buckets", out.buckets), info.get("words", out.words), runs, [*filters, info["filter"]] if "filter" in info else filters)
    return out


def create(spark: SparkSession, root: str, buckets: int = BUCKETS, words: int = WORDS) -> None:
    """A new pool; one that is there stays as it is."""
    if commits.last_version(spark, root) < 0:
        try:
            commits.commit(spark, root, 0, {"buckets": buckets, "words": words})
        except commits.Conflict:
            pass


def _bucket(n: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")


def _probes(words: int) -> Column:
    """The PROBES bits of an id, as an array of (word, bit), from two hashes."""
    n = F.lit(words * 64)
    one, two = F.pmod(F.xxhash64("id", F.lit(1)), n), F.pmod(F.xxhash64("id", F.lit(2)), n)
    at = [F.pmod(one + k * two, n) for k in range(PROBES)]
    return F.array(*[F.struct(F.shiftright(p, 6).cast("int").alias("word"), (p % 64).cast("int").alias("bit")) for p in at])


def _filter(ids: DataFrame, words: int) -> DataFrame:
    """(bucket, word, bits) of ids (id, bucket)."""
    bits = ids.select("bucket", F.explode(_probes(words)).alias("p"))
    return bits.groupBy("bucket", "p.word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p.bit"))).alias("bits"))


def read(spark: SparkSession, root: str, buckets: list[int] | None = None) -> DataFrame:
    """All ids, or those of some buckets."""
    paths = [f"{root}/{folder}/bucket={b}" for folder, own in state(spark, root).runs for b in own if buckets is None or b in buckets]
    return spark.read.schema("id string").parquet(*paths) if paths else spark.createDataFrame([], "id string")


def _filters(spark: SparkSession, root: str, now: State) -> DataFrame:
    parts = [spark.read.schema("bucket int, word int, bits long").parquet(f"{root}/{f}") for f in now.filters]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "bucket int, word int, bits long")


def possible(ids: DataFrame, filters: DataFrame, words: int) -> DataFrame:
    """The ids (id, bucket) of which the filters have all bits; all that are in the pool, and few others."""
    probes = ids.select("id", "bucket", F.posexplode(_probes(words)).alias("k", "p"))
    met = probes.join(filters, (probes["bucket"] == filters["bucket"]) & (F.col("p.word") == filters["word"])).where(F.getbit("bits", "p.bit") == 1)
    return met.select("id", probes["bucket"], "k").groupBy("id", "bucket").agg(F.count_distinct("k").alias("n")).where(F.col("n") == PROBES).select("id", "bucket")


def insert_ignore(ids: DataFrame, root: str) -> Inserted:
    """Puts ids into the pool that it lacks, as upsert.insert_ignore does; null ids are left out but counted, repeated new ids count as existing.

    The pool takes one writer at a time: a commit that was overtaken raises Conflict and adds nothing.
    """
    spark = ids.sparkSession
    create(spark, root)
    before = commits.last_version(spark, root)  # read first: whatever comes after it makes the commit fail
    now = state(spark, root)
    new = cut(ids.select("id").where("id is not null").distinct().withColumn("bucket", _bucket(now.buckets)))
    maybe = cut(possible(new, _filters(spark, root, now), now.words))
    touched = sorted(r.bucket for r in maybe.select("bucket").distinct().collect())  # as many as there are buckets
    known = maybe.join(read(spark, root, touched), "id", "left_semi").select("id")
    added = cut(new.join(known, "id", "left_anti").select("id", "bucket"))
    counts = {r.bucket: r["count"] for r in added.groupBy("bucket").count().collect()}
    total, n = ids.count(), sum(counts.values())
    if n:
        folder, path = commits.data_folder(root)
        added.repartition("bucket").sortWithinPartitions("bucket", "id").write.partitionBy("bucket").parquet(path)
        bits, bits_path = commits.data_folder(root)
        _filter(added, now.words).write.parquet(bits_path)
        info = {"buckets": now.buckets, "words": now.words, "folder": folder, "in": sorted(counts), "filter": bits}
        old = now.filters
        if len(old) >= MOST_RUNS:
            both, both_path = commits.data_folder(root)
            _filters(spark, root, now).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits")).unionByName(spark.read.parquet(bits_path)).write.parquet(both_path)
            info |= {"whole": [list(r) for r in now.runs], "filter": both}
        commits.commit(spark, root, before + 1, info)
        if "whole" in info:
            commits.forget(spark, root, before + 1)
            for f in [*old, bits]:
                commits.delete(spark, f"{root}/{f}")
    return Inserted(n, total - n, total, touched)
