"""Mixing sources to target weights: tokens are summed per source, targets become repetition rates, and hashes decide the fractions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import written
from gazetta.llm.shard import unit
from gazetta.operators.tasks import numbered

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: No source is repeated more often than this.
MOST = 3
SEED = 11
#: Rows that one inner sequence expands.
CHUNK = 65_536
#: Tables of sources up to this many rows are broadcast; a row has a name, three numbers and no text.
FEW_SOURCES = 20_000


def keyed(documents: DataFrame) -> DataFrame:
    """_row (all columns), doc_id, source, size (words) and _key, which is the same for rows equal in doc_id, source and text only."""
    text = F.coalesce("text", F.lit(""))
    key = F.concat_ws("#", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.concat(F.lit("s"), "source")), F.md5(text))
    return documents.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"), F.md5(key).alias("_key"))


def counted(documents: DataFrame) -> DataFrame:
    """One row (no text) for each group of rows equal in doc_id, source and text, with their number _n."""
    return keyed(documents).groupBy("_key", "_id", "_source", "_size").agg(F.count("*").alias("_n"))


def targets(groups: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> tuple[DataFrame, bool]:
    """(source, source_size, target, rate) of every source, and whether there are few of them.

    Sources in code point order, null last, take the weights in turn and share the tokens of the whole corpus. A
    target stops at `most` times its source; what is over goes to the others by weight, until none is above. Each of
    these rounds is one sum over the table of sources; all comparisons are between whole numbers.
    """
    sizes = groups.groupBy(F.col("_source").alias("source")).agg(F.sum(F.col("_size") * F.col("_n")).alias("source_size"))
    order = numbered(sizes.withColumn("_last", F.col("source").isNull()), ["_last", "source"], "_rank")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = written(order.select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    first = sources.agg(F.count("*").alias("n"), F.sum("source_size").alias("total"), F.sum("weight").alias("weight")).first()
    total, rest, weight_left = first.total or 0, first.total or 0, first.weight or 1
    bound = F.col("source_size") * most
    wide = lambda c: c.cast("decimal(19,0)")  # noqa: E731  products of two longs stay exact
    while True:
        over = wide(bound) * wide(F.lit(weight_left)) < wide(F.col("weight")) * wide(F.lit(rest))
        got = sources.agg(F.coalesce(F.sum(F.when(over, bound)), F.lit(0)).alias("held"), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(1)).alias("left")).first()
        if (total - got.held, got.left) == (rest, weight_left):
            break
        rest, weight_left = total - got.held, got.left
    target = F.when(over, bound.cast("double")).otherwise((F.col("weight") * rest).cast("double") / F.lit(float(weight_left)))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size").cast("double")).otherwise(0.0)
    return sources.select("source", "source_size", target.alias("target"), F.least(rate, F.lit(float(most))).alias("rate")), first.n <= FEW_SOURCES


def copies(rate: Column, key: Column, seed: int) -> Column:
    """floor(rate), and one more with the chance of the fraction, which the key's hash draws."""
    return (F.floor(rate) + (unit(key, seed) < rate - F.floor(rate)).cast("long")).cast("long")


def _rated(rows: DataFrame, rates: DataFrame, few: bool) -> DataFrame:
    return rows.join(F.broadcast(rates) if few else rates, F.col("_source").eqNullSafe(F.col("source")))


def _numbered(groups: DataFrame, n: str) -> DataFrame:
    """Each row n times, with _k from 0; a large n is dealt in chunks."""
    groups = groups.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / CHUNK).cast("long"))))
    first = F.col("_c") * CHUNK
    return groups.withColumn("_k", F.explode(F.sequence(first, F.least(first + CHUNK, F.col(n)) - 1))).drop("_c")


def decide(documents: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, rate, copies and taken (copies * size) of every document.

    A null text has no words and a null source is a source of its own; a source without words has the target 0. Rows equal in doc_id,
    source and text are counted before the shuffle and then drawn one by one, each with its number, so that repeats
    of one row don't share one fate. Other columns are ignored and may have any names; no documents give no rows.
    """
    groups = written(counted(documents), "mix")  # summed, ranked and drawn from below, without reading the texts again
    rates, few = targets(groups, weights, most)
    drawn = _numbered(_rated(groups, rates, few), "_n").withColumn("_copies", copies(F.col("rate"), F.concat_ws("#", "_key", "_k"), seed))
    return drawn.select(F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", "rate", F.col("_copies").alias("copies"), (F.col("_copies") * F.col("_size")).alias("taken"))


def emit(documents: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The mixed corpus: every document as often as `decide` takes it, with all its columns.

    Texts don't move, but for rows that repeat a doc_id, source and text: of these one stands for all, and is emitted as often as all together.
    """
    groups = written(counted(documents), "mix")
    rates, few = targets(groups, weights, most)
    repeated = _numbered(_rated(groups.where("_n > 1"), rates, few), "_n")
    repeated = repeated.groupBy("_key").agg(F.sum(copies(F.col("rate"), F.concat_ws("#", "_key", "_k"), seed)).alias("_times"))
    rows = keyed(documents)
    alone = _rated(rows.join(repeated.select("_key"), "_key", "left_anti"), rates, few)
    alone = alone.select("_row", copies(F.col("rate"), F.concat_ws("#", "_key", F.lit(0)), seed).alias("_times"))
    one = rows.join(repeated.select("_key"), "_key", "left_semi").groupBy("_key").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
    both = alone.unionByName(one.join(repeated, "_key").select("_row", "_times"))
    return _numbered(both.where("_times > 0"), "_times").select("_row.*")
