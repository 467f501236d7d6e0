"""Near-duplicate detection by b-bit MinHash.

Every text becomes a set of 64-bit word-shingle hashes and a row of MinHash minima. Bands of minima
give candidate pairs; the low bits of all minima, packed into longs, estimate the similarity of a
pair by counting equal fields and correcting for chance collisions; pairs that pass (five standard
deviations below the threshold) are confirmed on their full shingle sets.

No step emits all pairs of a group. Equal sets are one class from the start. First each member of a
band bucket is compared with the bucket's leader only. The members of a bucket that are still in
different components are then dealt to blocks of bounded size: the largest component's rows to blocks of
their own, which meet only the blocks of the rest. Signatures (no texts) are compared in pairs of blocks,
each pair of documents in the first band that it shares; the rows with a candidate then meet with their
texts, and products of membership matrices give all exact intersections, of which only a forest of the
links leaves the task. So no link between different sets that banding finds is lost, and a group
of thousands of copies costs its blocks, not its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import map_batches, scratch, small_batches, sorted_groups, written

MINIMA = 128
BITS = 2  #: kept of each minimum
ROWS = 4  #: most minima in a band; low thresholds take fewer
PER_LONG = 64 // BITS
#: The chance that banding misses a pair at the threshold stays below this.
MISS = 1e-6

_random = np.random.Generator(np.random.PCG64(20240229))
_MULTIPLY = _random.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _random.integers(0, 2**63, MINIMA, dtype=np.uint64)
_POSITION = _random.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on all input bits (murmur's finaliser)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct `width`-word shingles of the text, A-Z lower-cased; of fewer words, the whole sequence is one."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(tokens), seed=len(tokens))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    n = len(h) - width + 1
    total = h[:n] * _POSITION[0]
    for k in range(1, width):
        total = total + h[k : n + k] * _POSITION[k]
    return np.unique(mixed(total))


def minima(shingles: np.ndarray) -> np.ndarray:
    low = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 512):
        np.minimum(low, (shingles[k : k + 512, None] * _MULTIPLY + _ADD).min(axis=0), out=low)
    return mixed(low)  # low bits of a minimum must not lean to small values


def bands_for(threshold: float) -> tuple[int, int]:
    """(bands, minima in each): as many minima a band as leave the chance of a miss at the threshold under MISS."""
    for rows in range(ROWS, 0, -1):
        if threshold >= 1:
            return 1, rows
        bands = math.ceil(math.log(MISS) / math.log(1 - threshold**rows)) if threshold > 0 else MINIMA + 1
        if bands * rows <= MINIMA:
            return bands, rows
    raise ValueError(f"{MINIMA} minima are too few for a threshold of {threshold}")


def may_split(threshold: float, bands: int, rows: int) -> bool:
    """Whether the chance that a pair shares one of the bands and no other of all that the minima make is under MISS too (else no bucket is split)."""
    return bands * threshold**rows * (1 - threshold**rows) ** (MINIMA // rows - 1) <= MISS


def most_mismatches(threshold: float) -> int:
    """Unequal fields at which a pair of the threshold's similarity lies five standard deviations out."""
    chance = 2.0**-BITS
    match = chance + (1 - chance) * threshold
    return math.ceil(MINIMA * (1 - match) + 5 * math.sqrt(MINIMA * match * (1 - match)))


def mismatches(a: Column, b: Column) -> Column:
    """Unequal fields of two packed signatures (arrays of longs), counted bit-parallel."""
    total = F.lit(0)
    for k in range(MINIMA // PER_LONG):
        x = a[k].bitwiseXOR(b[k])
        total = total + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total


def similarity(a: Column, b: Column) -> Column:
    """Collision-corrected estimate of the Jaccard similarity from two packed signatures."""
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (1 - mismatches(a, b) / MINIMA - chance) / (1 - chance))


def sketches(documents: DataFrame, width: int, bands: int, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, the 128-bit hash of the set (hi, lo), band keys and the packed signature; the last four null for an empty set."""
    shift = np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS)

    def sketch(batch: dict) -> dict:
        out: dict[str, list] = {"doc_id": batch["doc_id"], "n_shingles": [], "hi": [], "lo": [], "bands": [], "sig": []}
        for text in batch["text"]:
            s = shingle_set(text, width)
            out["n_shingles"].append(len(s))
            if not len(s):
                for name in ("hi", "lo", "bands", "sig"):
                    out[name].append(None)
                continue
            hi, lo = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
            low = minima(s)
            keys = [np.frombuffer(xxhash.xxh3_64_digest(low[k * rows : (k + 1) * rows].tobytes(), seed=k), np.int64)[0] for k in range(bands)]
            fields = (low & np.uint64(2**BITS - 1)).reshape(-1, PER_LONG) << shift
            out["hi"].append(int(hi))
            out["lo"].append(int(lo))
            out["bands"].append(np.array(keys))
            out["sig"].append(np.bitwise_or.reduce(fields, axis=1).view(np.int64))
        return out

    return map_batches(documents.select("doc_id", "text"), sketch, "doc_id long, n_shingles long, hi long, lo long, bands array<long>, sig array<long>")


#: Members of one leader that meet in a task; a leader with more is sent to several.
STAR_ROWS = 1024


def star_links(stars: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (lead, id) with 100 * intersection >= percent * union of their full shingle sets.

    Members are dealt to cells of about STAR_ROWS; each cell gets the leader's text once and before its members'.
    """
    cells = stars.groupBy("lead").agg(F.ceil(F.count("*") / STAR_ROWS).cast("int").alias("n"))
    rows = stars.join(cells, "lead").select("lead", F.pmod(F.xxhash64("id"), F.col("n")).cast("int").alias("cell"), "id")
    heads = cells.select("lead", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("cell"), F.col("lead").alias("id"))
    rows = rows.unionByName(heads).join(texts, "id").select("lead", "cell", "id", "text")
    rows = rows.repartition("lead", "cell").sortWithinPartitions("lead", "cell", F.col("id") != F.col("lead"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept = None, np.empty(0, np.uint64)
        for batch in batches:
            good = []
            for lead, i, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                own = shingle_set(text.as_py(), width)
                if i == lead:
                    now, kept = lead, own
                    good.append(False)
                    continue
                both = len(kept) + len(own)
                common = both - len(np.union1d(kept, own)) if now == lead else 0
                good.append(100 * common >= percent * (both - common))
            yield batch.select([0, 2]).filter(pa.array(good, pa.bool_()))

    small_batches(stars.sparkSession)
    return rows.mapInArrow(run, "lead long, id long").select(F.col("lead").alias("a"), F.col("id").alias("b"))


def is_star(edges: DataFrame) -> bool:
    """Whether every a has one b, and no b is itself an a: then each b is the least id of its component."""
    out = edges.groupBy("a").agg(F.count("*").alias("n"))
    bad = out.where("n > 1").select("a").union(out.select("a").join(edges.select(F.col("b").alias("a")), "a", "left_semi"))
    return bad.isEmpty()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every end of the links (a, b): component is the smallest id that can be reached.

    Alternating large-star and small-star steps on the distributed edge list; each round is a grouped
    minimum and a join, so a vertex with very many links is never gathered in one task.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    for _ in range(rounds):
        if is_star(edges):
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b")))
        edges = written(small.distinct(), "edges")
    raise RuntimeError(f"components have not settled after {rounds} rounds")


def block_links(rows: pa.Table, width: int, percent: int) -> pa.Table:
    """Links (a, b) between components of one block of rows (comp, text), enough to join all that its exact links join."""
    comp = rows.column("comp").to_numpy()
    sets = [shingle_set(t, width) for t in rows.column("text").to_pylist()]
    m, sizes = len(sets), np.array([len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), sizes)
    common = count[column] > 1  # shingles of one set only add to no intersection
    row, column = row[common], np.cumsum(count > 1)[column[common]] - 1
    inter = np.zeros((m, m), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        lo, hi = np.searchsorted(column, [first, first + 4096])
        part = np.zeros((m, 4096), np.float32)
        part[row[lo:hi], column[lo:hi] - first] = 1
        inter += part @ part.T
    link = (100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter)) | (comp[:, None] == comp[None, :])
    label, before = np.arange(m), None
    while before is None or (label != before).any():
        before = label
        label = np.where(link, label[None, :], m).min(axis=1)
        label = np.minimum(label, label[label])
    ends = np.unique(np.stack([comp, comp[label]], axis=1), axis=0)
    ends = ends[ends[:, 0] != ends[:, 1]]
    return pa.table({"a": pa.array(ends[:, 0], pa.int64()), "b": pa.array(ends[:, 1], pa.int64())})


#: A block has at most so many shingles and rows, on average over an even hash split; two blocks meet in a task.
BLOCK_SHINGLES, BLOCK_ROWS = 500_000, 1024
#: Pairs of signatures that are compared at once.
PAIRS = 1 << 18
#: A bucket whose rows outside its largest component fill more blocks than this is split by further minima first.
HOT_BLOCKS = 8


def cells_of(apart: DataFrame) -> DataFrame:
    """(key, cell, big, n_big, n_rest) of rows (key, cell, id, comp, n): the largest component of each cell of a bucket, and how many blocks it and the rest fill.

    n_rest is 0 where all rows fit in one block. A cell that holds one component only is left out.
    """
    sizes = apart.groupBy("key", "cell", "comp").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    sizes = sizes.groupBy("key", "cell").agg(F.max(F.struct("rows", "n", "comp")).alias("big"), F.sum("rows").alias("rows"), F.sum("n").alias("n"))
    sizes = sizes.where(F.col("rows") > F.col("big.rows"))
    blocks = lambda rows, n: F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(n / BLOCK_SHINGLES)).cast("int")
    rest = F.when(blocks(F.col("rows"), F.col("n")) > 1, blocks(F.col("rows") - F.col("big.rows"), F.col("n") - F.col("big.n"))).otherwise(0)
    return sizes.select("key", "cell", F.col("big.comp").alias("big"), blocks(F.col("big.rows"), F.col("big.n")).alias("n_big"), rest.alias("n_rest"))


def further_bands(hot: DataFrame, texts: DataFrame, width: int, rows: int) -> DataFrame:
    """(id, sig, bands, more) of the ids of hot rows: more holds the keys of all bands that the minima make, from the texts."""
    ids = hot.groupBy("id").agg(F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    wanted = texts.join(ids.select("id"), "id").select(F.col("id").alias("doc_id"), "text")
    more = sketches(wanted, width, MINIMA // rows, rows).select(F.col("doc_id").alias("id"), F.col("bands").alias("more"))
    return ids.join(more, "id")


def further_cells(hot: DataFrame, wide: DataFrame) -> DataFrame:
    """(key, cell, id, comp, n) of hot rows, once for each band behind the one of the key: a cell is the key of that band.

    The key is that of the first band that a pair shares; a pair at the threshold shares one behind it too, but for a
    chance under MISS (may_split).
    """
    behind = F.slice("more", F.array_position("bands", F.col("key")).cast("int") + 1, F.size("more"))
    return hot.select("key", "id", "comp", "n").join(wide, "id").select("key", F.explode(behind).alias("cell"), "id", "comp", "n")


def in_blocks(apart: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows (key, cell, id, comp, ...) with the pairs of blocks (i, j) in which they are compared, and their own block.

    Blocks 0 to n_big - 1 hold the cell's largest component, whose rows need not be compared with one another;
    n_rest blocks hold all other rows. cells: those of cells_of.
    """
    rows = apart.join(cells, ["key", "cell"])
    big = F.col("comp") == F.col("big")
    own = F.when(F.col("n_rest") == 0, F.lit(0)).when(big, F.pmod(F.xxhash64("id"), F.col("n_big"))).otherwise(F.col("n_big") + F.pmod(F.xxhash64("id"), F.greatest("n_rest", F.lit(1))))
    rows = rows.withColumn("own", own.cast("int"))
    first = F.when(big, F.col("n_big")).otherwise(F.lit(0))  # rows of the largest component meet the others only
    others = F.when(F.col("n_rest") == 0, F.array(F.lit(0))).otherwise(F.sequence(first, F.col("n_big") + F.col("n_rest") - 1))
    rows = rows.withColumn("other", F.explode(others)).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    return rows.select("key", "cell", "i", "j", "own", *[c for c in apart.columns if c not in ("key", "cell")])


def near_rows(rows: DataFrame, most: int, percent: int, bands_each: int) -> DataFrame:
    """(key, cell, i, j, id, comp) of those rows of in_blocks that have a candidate in their pair of blocks.

    A candidate is in another component, of a size that the threshold allows, and unlike in at most `most` fields
    of the signature. A pair that shares several buckets is a candidate only in the first band that it shares, and
    in a bucket split by further minima (more than bands_each keys) only in the next one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, at in sorted_groups(batches, 4):
            key, cell, own, comp, n = (part.column(c).to_numpy() for c in ("key", "cell", "own", "comp", "n"))
            block = part.column("i").to_numpy() + part.column("j").to_numpy()
            sig = part.column("sig").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(key), -1)
            bands = part.column("bands").combine_chunks().flatten().to_numpy().reshape(len(key), -1)
            tail = np.repeat(at[1:], np.diff(at)) - np.arange(len(key)) - 1  # rows of the group behind each row
            near = np.zeros(len(key), bool)
            ends = np.cumsum(tail)
            lo = 0
            while lo < len(key):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS, side="right")))
                times = tail[lo:hi]
                x = np.repeat(np.arange(lo, hi), times)
                y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(times) - times, times)
                small, large = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
                good = (comp[x] != comp[y]) & (own[x] + own[y] == block[x]) & (100 * small >= percent * large)
                x, y = x[good], y[good]
                differ = sig[x] ^ sig[y]
                differ = (differ | differ >> np.uint64(1)) & np.uint64(0x5555555555555555)
                good = np.bitwise_count(differ).sum(axis=1) <= most
                x, y = x[good], y[good]
                same = bands[x] == bands[y]
                band = same[:, :bands_each].argmax(axis=1)
                good = bands[x, band] == key[x]
                if bands.shape[1] > bands_each:
                    behind = same[:, bands_each:] & (np.arange(bands.shape[1] - bands_each) > band[:, None])
                    good &= bands[x, bands_each + behind.argmax(axis=1)] == cell[x]
                near[x[good]] = near[y[good]] = True
                lo = hi
            out = part.select(["key", "cell", "i", "j", "id", "comp"]).filter(pa.array(near))
            yield from out.to_batches()

    small_batches(rows.sparkSession)
    dealt = rows.repartition("key", "cell", "i", "j").sortWithinPartitions("key", "cell", "i", "j")
    return dealt.select("key", "cell", "i", "j", "own", "id", "comp", "n", "sig", "bands").mapInArrow(run, "key long, cell long, i int, j int, id long, comp long")


def links_in_blocks(near: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components, by the full sets of the rows that near_rows leaves in each pair of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, at in sorted_groups(batches, 4):
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                yield from block_links(part.slice(lo, hi - lo), width, percent).to_batches()

    small_batches(near.sparkSession)
    rows = near.join(texts, "id").repartition("key", "cell", "i", "j").sortWithinPartitions("key", "cell", "i", "j")
    return rows.select("key", "cell", "i", "j", "comp", "text").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Documents are linked if 100 * intersection >= percent * union of their sets of `width`-word
    shingles; component_id is the smallest doc_id that links reach, and kept marks it. A null, empty or
    wordless text has an empty set and links with nothing. A row with a null doc_id is not linked
    (component_id null, kept). Rows that repeat a doc_id are one node, linked by the least of their texts.
    Other columns don't matter. A percentage so low that the minima cannot serve it is an error.
    """
    threshold = percent / 100
    most, (bands, rows) = most_mismatches(threshold), bands_for(threshold)
    sketch = written(sketches(documents, width, bands, rows), "sketch")
    filled = sketch.where("doc_id is not null and hi is not null")
    # equal sets are one class, whose rows are equal but for doc_id
    reps = written(filled.groupBy("hi", "lo").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")), "reps")
    with scratch() as keep:
        buckets = reps.select("id", F.explode("bands").alias("key"))
        shared = keep(buckets.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last")).where("lead < last").select("key", "lead"), "shared")
        members = keep(buckets.join(shared, "key").select("key", "id", "lead"), "members")
        ids = members.select("id").distinct()
        texts = keep(documents.select(F.col("doc_id").alias("id"), "text").join(ids, "id").groupBy("id").agg(F.min("text").alias("text")), "texts")

        # each member against its bucket's leader
        sig = reps.select("id", "n", "sig")
        lead_sig = reps.select(F.col("id").alias("lead"), F.col("n").alias("lead_n"), F.col("sig").alias("lead_sig"))
        stars = members.where("id <> lead").select("lead", "id").distinct().join(sig, "id").join(lead_sig, "lead")
        alike = (mismatches(F.col("sig"), F.col("lead_sig")) <= most) & (100 * F.least("n", "lead_n") >= percent * F.greatest("n", "lead_n"))
        stars = keep(stars.where(alike).select("lead", "id"), "stars")
        place = components(star_links(stars, texts, width, percent))

        # members of a bucket that are still apart
        placed = members.select("key", "id").join(place, "id", "left").select("key", "id", F.coalesce("component", "id").alias("comp"))
        split = keep(placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key"), "split")
        apart = keep(placed.join(split, "key").join(reps.select("id", "n", "sig", "bands"), "id").select("key", "id", "comp", "n", "sig", "bands"), "apart")
        apart = apart.withColumn("cell", F.lit(0).cast("long"))
        cells = keep(cells_of(apart), "cells")
        is_hot = (F.col("n_rest") > HOT_BLOCKS) & F.lit(may_split(threshold, bands, rows))
        near = near_rows(in_blocks(apart, cells.where(~is_hot)), most, percent, bands)
        hot = cells.where(is_hot).select("key")
        if not hot.isEmpty():
            hot = apart.drop("cell").join(hot, "key")
            wide = keep(further_bands(hot, texts, width, rows), "wide")
            parts = keep(further_cells(hot, wide), "parts")
            pairs = in_blocks(parts, cells_of(parts)).join(wide.select("id", "sig", F.concat("bands", "more").alias("bands")), "id")
            near = near.unionByName(near_rows(pairs, most, percent, bands))
        joined = components(links_in_blocks(near, texts, width, percent))  # (component, its new component)

    joined = joined.select(F.col("id").alias("component"), F.col("component").alias("whole"))
    classes = reps.select("hi", "lo", F.col("id").alias("rep")).join(place, F.col("rep") == place["id"], "left")
    classes = classes.select("hi", "lo", F.coalesce("component", "rep").alias("component")).join(joined, "component", "left").select("hi", "lo", F.coalesce("whole", "component").alias("whole"))
    result = sketch.select("doc_id", "n_shingles", "hi", "lo").join(classes, ["hi", "lo"], "left")
    result = result.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("whole", "doc_id")).alias("component_id"))
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
