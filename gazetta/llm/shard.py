"""Sharding by weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.llm.common import written

#: Slots are numbered in this many independent blocks per shard, so no task sorts a whole shard.
BLOCKS = 1024
#: Rows that one inner sequence expands; equal rows are carried as counts until the last step.
CHUNK = 65_536


def unit(key: Column, shard: int) -> Column:
    """A number in (0, 1) from key and shard: the first 52 bits of their MD5."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f"#{shard}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / F.lit(2.0**52)


def score(key: Column, shard: int, weight: float) -> Column:
    """Weighted rendezvous: the largest of -w / ln(u) wins shard with a chance of its share of the weights."""
    return -F.lit(float(weight)) / F.log(unit(key, shard))


def pick(key: Column, weights: Sequence[float]) -> Column:
    """Index of the winning shard; a tie goes to the lower index. Adding a shard moves rows only into it."""
    best = F.array_max(F.array(*[F.struct(score(key, s, w).alias("v"), F.lit(-s).alias("s")) for s, w in enumerate(weights)]))
    return (-best["s"]).cast("int")


def assign(documents: DataFrame, weights: Sequence[float], grown_weight: float = 1.0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document.

    Law `key`: doc_id and the weights alone decide; grown_shard is the shard after one more shard of
    grown_weight joins. A null text counts as empty (size 1), a null doc_id is a key of its own,
    and rows that repeat get slots of their own. Slots run gapless from 0 in each shard: equal rows are
    counted before the shuffle, hashed blocks of a shard are numbered apart and shifted by the small
    table of block counts. Other columns are ignored, and so may have any names.
    """
    text = F.coalesce("text", F.lit(""))
    rows = documents.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    groups = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("_n"))
    groups = groups.withColumn("shard", pick(F.col("doc_id"), weights)).withColumn("_all", pick(F.col("doc_id"), [*weights, grown_weight]))
    whole = F.concat_ws("#", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size", "text_crc32")
    groups = groups.withColumn("_block", (F.conv(F.substring(F.md5(whole), 1, 8), 16, 10).cast("long") % BLOCKS).cast("int"))
    groups = written(groups, "shards")  # counted and numbered below, without reading the texts again
    order = ["doc_id", "size", "text_crc32"]
    inside = Window.partitionBy("shard", "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    counts = groups.groupBy("shard", "_block").agg(F.sum("_n").alias("_rows"))  # at most BLOCKS rows a shard
    shift = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_block", F.coalesce(F.sum("_rows").over(shift), F.lit(0)).alias("_start"))
    slots = groups.join(F.broadcast(starts), ["shard", "_block"])
    slots = slots.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / CHUNK).cast("long"))))
    first = F.col("_chunk") * CHUNK
    slots = slots.withColumn("_k", F.explode(F.sequence(first, F.least(first + CHUNK, F.col("_n")) - 1)))
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_start") + F.col("_before") + F.col("_k")).cast("long").alias("slot"), F.col("_all").alias("grown_shard")
    )
