"""Conflict-constrained best-fit packing of documents into bins of a token capacity.

Open bins are kept by their residual capacity, each with a bitmap of the sources and one of the
duplicate clusters that it holds. An item asks for the smallest residual that fits and goes on to the
successor until a bin shares neither source nor cluster with it; without one it opens a bin.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import written

CAPACITY = 2048
#: Pieces that are packed together, on average and at most twice as many. Pieces are dealt to blocks by hash; no text is shuffled.
BLOCK = 4096
#: Bins filled less than this are emptied after the first pass, and their pieces of all blocks packed anew.
POOR = 0.98


def best_fit(items: list[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item (size, source, cluster); sizes are 1 to capacity. None conflicts with nothing.

    Items go in by falling size, ties in their order. Among bins of equal residual the oldest that is compatible is taken.
    """
    bit: dict[tuple[str, object], int] = {}

    def bitmap(kind: str, value: object) -> int:
        return 0 if value is None else 1 << bit.setdefault((kind, value), len(bit))

    residuals: list[int] = []  # distinct, sorted
    open_bins: dict[int, list[int]] = {}  # residual: bins, oldest first
    held: list[int] = []  # bitmap of each bin's sources and clusters
    used: list[int] = []
    out: list[tuple[int, int]] = [(-1, -1)] * len(items)
    for k in sorted(range(len(items)), key=lambda i: -items[i][0]):
        size, source, cluster = items[k]
        own = bitmap("s", source) | bitmap("c", cluster)
        chosen = None
        for at in range(bisect_left(residuals, size), len(residuals)):
            left = residuals[at]
            chosen = next((b for b in open_bins[left] if not held[b] & own), None)
            if chosen is not None:
                open_bins[left].remove(chosen)
                if not open_bins[left]:
                    del open_bins[left], residuals[at]
                break
        if chosen is None:
            chosen, left = len(held), capacity
            held.append(0)
            used.append(0)
        out[k] = (chosen, used[chosen])
        held[chosen] |= own
        used[chosen] += size
        left -= size
        if left:
            if left not in open_bins:
                open_bins[left] = []
                insort(residuals, left)
            insort(open_bins[left], chosen)
    return out


def dealt(rows: DataFrame, n: int, salt: int) -> DataFrame:
    """Rows with a block of 0 to n - 1 by a hash of what they hold, each block sorted and in one partition."""
    block = F.pmod(F.xxhash64(F.lit(salt), *COLUMNS), F.lit(n))
    tasks = max(1, min(n, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return rows.select(block.alias("block"), *COLUMNS).repartition(tasks, "block").sortWithinPartitions("block", F.desc("n_tokens"), "doc_id", "piece", "source", "cluster")


COLUMNS = ("doc_id", "piece", "n_tokens", "source", "cluster")
PLACED = "doc_id long, piece long, n_tokens long, bin_id long, bin_offset long, source string, cluster long, poor boolean"


def placed(rows: DataFrame, capacity: int, block: int, base: int) -> DataFrame:
    """bin_id and bin_offset of dealt rows; poor marks those in a bin filled less than POOR. base is added to block numbers."""
    arrow = {"doc_id": pa.int64(), "piece": pa.int64(), "n_tokens": pa.int64(), "bin_id": pa.int64(), "bin_offset": pa.int64(), "source": pa.string(), "cluster": pa.int64(), "poor": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, turn, waiting = None, 0, []
        for batch in batches:
            for number, *row in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if waiting and (number != now or len(waiting) >= 2 * block):
                    yield packed(waiting, ((base + now) << 18) + turn)
                    waiting, turn = [], turn + 1 if number == now else 0
                now = number
                waiting.append(row)
        if waiting:
            yield packed(waiting, ((base + now) << 18) + turn)

    def packed(part: list[list], number: int) -> pa.RecordBatch:
        loose = [k for k, row in enumerate(part) if 0 < row[2] < capacity]
        place = dict(zip(loose, best_fit([(part[k][2], part[k][3], part[k][4]) for k in loose], capacity), strict=True))
        fill: dict[int, int] = {}
        for k, (own, _) in place.items():
            fill[own] = fill.get(own, 0) + part[k][2]
        last = max(fill, default=-1)
        out: list[tuple] = []
        for k, (doc_id, piece, size, source, cluster) in enumerate(part):
            own, offset = place.get(k, (-1, 0))
            if size == capacity:
                own = last = last + 1
            out.append((doc_id, piece, size, (number << 20) + own if size else -1, offset, source, cluster, k in place and fill[own] < POOR * capacity))
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), arrow.values(), strict=True)], names=list(arrow))

    return rows.mapInArrow(run, PLACED)


def pack(documents: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, clusters: DataFrame | None = None) -> DataFrame:
    """doc_id, piece, n_tokens, bin_id, bin_offset, source and cluster of every piece of every document.

    Tokens are the words [^\\x20\\x09-\\x0D]+ of the whole text. A document longer than a bin is cut:
    pieces that fill a bin stand alone, the rest is packed like any other. No bin holds two packed pieces
    of one source or of one duplicate cluster (texts with the same words, A-Z lower-cased); pieces of one
    document have its source and so never meet. A null source conflicts with nothing. Null, empty and
    wordless texts are one piece of 0 tokens in bin -1. Rows that repeat are packed each on its own.
    clusters (doc_id, cluster), such as the components of minhash.near_duplicates, widens clusters to near
    copies: texts whose ids have one cluster there never share a bin; ids that it lacks keep their own.
    Blocks are dealt by a hash of the rows, so files and partitions don't decide what meets; pieces in
    poorly filled bins of all blocks are dealt and packed again. bin_id is unique: it is made of the
    block and the bin. Other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    plain = F.trim(F.regexp_replace(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[ \\t\\n\\x0B\\f\\r]+", " "))
    words = F.when(plain == "", F.lit(0)).otherwise(F.length(plain) - F.length(F.replace(plain, F.lit(" "))) + 1)
    rows = documents.select("doc_id", "source", words.cast("long").alias("n"), F.xxhash64(plain).alias("cluster"))
    if clusters is not None:
        given = clusters.where("doc_id is not null").groupBy("doc_id").agg(F.min("cluster").cast("long").alias("_given"))
        own = F.when(F.col("_given").isNull(), F.col("cluster")).otherwise(F.xxhash64(F.lit("given"), "_given"))
        rows = rows.join(given, "doc_id", "left").select("doc_id", "source", "n", own.alias("cluster"))
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("n") / capacity), F.lit(1)).cast("long") - 1))
    rows = rows.select("doc_id", cut.alias("piece"), "n", "source", "cluster")
    rows = rows.withColumn("n_tokens", F.least(F.lit(capacity), F.col("n") - F.col("piece") * capacity).cast("long")).select(*COLUMNS)
    rows = written(rows, "pieces")
    n = max(1, -(-rows.count() // block))
    first = written(placed(dealt(rows, n, 1), capacity, block, 0), "packed")
    poor = first.where("poor")
    again = placed(dealt(poor, max(1, -(-poor.count() // block)), 2), capacity, block, n)
    return first.where("not poor").drop("poor").union(again.drop("poor"))


def bins(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row a bin: how many pieces and tokens it has, and its fill."""
    rows = packed.where("bin_id >= 0").groupBy("bin_id").agg(F.count("*").alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"))
    return rows.withColumn("fill", F.col("n_tokens") / capacity)
