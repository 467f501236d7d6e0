"""Code hierarchies: recursive walks, frontier expansion, lookups, and the planning of adaptive partitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.operators.lineage import cut, drop, drop_at_end, stored
from gazetta.operators.scan import sum_before


def children_of(edges: DataFrame, parent: str, key: str = "parent_code", order: str = "code") -> DataFrame:
    return edges.where(F.col(key) == parent).orderBy(order)


def descend(edges: DataFrame, root: str = "0", most: int = 100) -> DataFrame:
    """(code, parent_code, depth, path) of all descendants of root; a code already on its path is not entered again.

    One join of the last level with the edges for each level, however many rows it has; deeper than `most` levels is an error.
    """
    step = edges.select("code", "parent_code")
    level = cut(step.where(F.col("parent_code") == root).select("code", "parent_code", F.lit(1).alias("depth"), F.array("code").alias("path")))
    levels = [level]
    for _ in range(most):
        above = level.select(F.col("code").alias("_above"), F.col("depth").alias("_depth"), F.col("path").alias("_path"))
        below = step.join(above, F.col("parent_code") == F.col("_above")).where(~F.array_contains("_path", F.col("code")) & (F.col("code") != root))
        level = cut(below.select("code", "parent_code", (F.col("_depth") + 1).alias("depth"), F.array_append("_path", F.col("code")).alias("path")))
        if level.isEmpty():
            return reduce(DataFrame.union, levels)
        levels.append(level)
    raise RuntimeError(f"the hierarchy is deeper than {most} levels")


def expand(edges: DataFrame, seeds: DataFrame, stop_levels: tuple[str, ...] = (), most: int = 100) -> DataFrame:
    """(code, parent_code, depth) reached from the seeds (code, parent_code), breadth first; a code once reached is not entered again.

    Nodes of the stop levels (column `level` of edges) are reached but not expanded. Every round is one join
    of the frontier with the edges; each level is checkpointed once.
    """
    open_edges = edges.where(~F.col("level").isin(*stop_levels)) if stop_levels else edges
    step = edges.select("code", "parent_code")
    may_grow = open_edges.select(F.col("code").alias("grows")).distinct()
    frontier = cut(seeds.select("code", "parent_code").groupBy("code").agg(F.min("parent_code").alias("parent_code")).withColumn("depth", F.lit(0)))
    reached = [frontier]
    for depth in range(1, most + 1):
        visited = reduce(DataFrame.union, reached)  # the written levels; none is written again
        start = frontier.select("code") if depth == 1 else frontier.join(may_grow, F.col("code") == F.col("grows"), "left_semi").select("code")
        found = step.join(start.withColumnRenamed("code", "_from"), F.col("parent_code") == F.col("_from")).select("code", "parent_code")
        frontier = cut(found.join(visited, "code", "left_anti").groupBy("code").agg(F.min("parent_code").alias("parent_code")).withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            return visited
        reached.append(frontier)
    raise RuntimeError(f"the hierarchy is deeper than {most} levels")


def _double(state: DataFrame, sums: tuple[str, ...], up: str | None = None) -> DataFrame:
    """One round of pointer doubling over (code, parent_code, anc, ...): anc goes twice as far up, each of `sums` takes in what anc has on the way.

    `up` goes the other way: anc takes in what all that point to it have.
    """
    above = state.select(F.col("code").alias("_code"), F.col("anc").alias("_anc"), *[F.col(c).alias(f"_{c}") for c in sums])
    both = state.join(above, F.col("anc") == F.col("_code"), "left")
    next_ = both.select("code", "parent_code", F.col("_anc").alias("anc"), *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums], *([up] if up else []))
    if not up:
        return next_
    given = state.where("anc is not null").groupBy(F.col("anc").alias("_code")).agg(F.sum(up).alias("_given"))
    return next_.join(given, F.col("code") == F.col("_code"), "left").withColumn(up, F.col(up) + F.coalesce("_given", F.lit(0))).drop("_code", "_given")


def _doubled(state: DataFrame, sums: tuple[str, ...], up: str | None, nodes: int) -> tuple[DataFrame, str, int]:
    """_double until nobody points further up, (result, its path, rounds); each round's table goes when the next is written."""
    spark = state.sparkSession
    state, path = stored(state, "double")
    for done in range(max(nodes, 1).bit_length() + 1):
        if state.where("anc is not null").isEmpty():
            return state, path, done
        state, after = stored(_double(state, sums, up), "double")
        drop(spark, path)
        path = after
    drop(spark, path)
    raise ValueError("the hierarchy has a cycle")


def intervals(edges: DataFrame) -> DataFrame:
    """(code, parent_code, depth, first, last): each node's place in a walk that takes children by code, and that of the last node below it.

    A node lies below another if its `first` is in that one's range, so "all below X" is a filter (see below). Nodes
    whose parent is null or unknown are roots, of depth 0. Sizes of subtrees, depths and places come from pointer doubling:
    twice about log2(depth) rounds of joins instead of one round a level. Codes must be unique; a cycle is an error.
    """
    known = edges.select(F.col("code").alias("_known"))
    nodes = edges.select("code", "parent_code").join(known, F.col("parent_code") == F.col("_known"), "left").select("code", "parent_code", F.col("_known").alias("anc"))
    spark, n = edges.sparkSession, edges.count()
    state, sized_at, _ = _doubled(nodes.withColumns({"depth": F.when(F.col("anc").isNotNull(), 1).otherwise(0).cast("long"), "nodes": F.lit(1).cast("long")}), ("depth",), "nodes", n)
    parents = state.select(F.col("code").alias("_known"))
    sized = state.drop("anc").join(parents, F.col("parent_code") == F.col("_known"), "left").withColumnRenamed("_known", "anc")
    placed = sum_before(sized, ["anc"], ["code"], F.col("nodes"), "place")
    placed = placed.withColumn("place", F.col("place") + F.when(F.col("anc").isNotNull(), 1).otherwise(0))
    walked, path, _ = _doubled(placed.select("code", "parent_code", "anc", "place"), ("place",), None, n)
    out = walked.select("code", F.col("place").alias("first")).join(state.select("code", "parent_code", "depth", "nodes"), "code")
    drop_at_end(spark, sized_at)
    drop_at_end(spark, path)
    return out.select("code", "parent_code", "depth", "first", (F.col("first") + F.col("nodes") - 1).alias("last"))


def below(labelled: DataFrame, code: str) -> DataFrame:
    """All nodes below a code, by the intervals of `intervals`: the node's own row is looked up, and the rest is one filter."""
    own = labelled.where(F.col("code") == code).select(F.col("first").alias("_first"), F.col("last").alias("_last"))  # one row
    return labelled.join(F.broadcast(own), (F.col("first") > F.col("_first")) & (F.col("first") <= F.col("_last"))).drop("_first", "_last")


def fill_coordinates(regions: DataFrame, known: DataFrame) -> DataFrame:
    """Longitude and latitude from a lookup (code, lon, lat), only where either is missing and the code is known."""
    rows = regions.join(known.select("code", F.col("lon").alias("_lon"), F.col("lat").alias("_lat"), F.lit(True).alias("_hit")), "code", "left")
    fill = (F.col("longitude").isNull() | F.col("latitude").isNull()) & F.coalesce("_hit", F.lit(False))
    rows = rows.withColumns({"longitude": F.when(fill, F.col("_lon")).otherwise(F.col("longitude")), "latitude": F.when(fill, F.col("_lat")).otherwise(F.col("latitude"))})
    return rows.drop("_lon", "_lat", "_hit")


def with_names(rows: DataFrame, names: DataFrame, code: str = "code", out: str = "display_name") -> DataFrame:
    """The name of each code, the code itself where it is unknown, and the whole country for an empty code."""
    found = names.select(F.col("code").alias(code), F.col("name").alias("_name"))
    return rows.join(found, code, "left").withColumn(out, F.when(F.col(code) == "", F.lit("全国")).otherwise(F.coalesce("_name", code))).drop("_name")


def pages_of(total: Column, size: int) -> Column:
    """Page numbers 1 to the least that holds `total` items, one at least."""
    return F.sequence(F.lit(1).cast("long"), F.greatest(F.lit(1).cast("long"), F.ceil(total / size).cast("long")))


def adaptive_partitions(counts: DataFrame, threshold: int = 3000, size: int = 100, completed: DataFrame | None = None, most: int = 100) -> DataFrame:
    """(keyword, code, total, page) of the partitions to read, from counts (keyword, code, parent_code, total).

    A node with more than `threshold` items and with children is split into them; every other node whose
    ancestors are all split is read page by page. Roots have a null parent_code. Nodes among the completed
    (keyword, code) are left out at every level, with all that lies below them. A hierarchy deeper than
    `most` levels, or a cycle, is an error.
    """
    # children of one node are listed per keyword, so a node has children if any row names it as a parent
    parents = counts.select("keyword", F.col("parent_code").alias("code")).where("code is not null").distinct().withColumn("_splits", F.lit(True))
    nodes = counts.join(parents, ["keyword", "code"], "left").withColumn("splits", F.coalesce("_splits", F.lit(False)) & (F.col("total") > threshold)).select("keyword", "code", "parent_code", "total", "splits")
    if completed is not None:
        nodes = nodes.join(completed.select("keyword", "code"), ["keyword", "code"], "left_anti")
    nodes = cut(nodes)
    level = nodes.where("parent_code is null")
    done = [level.where("not splits")]
    for _ in range(most):
        above = level.where("splits").select("keyword", F.col("code").alias("parent_code"))
        level = cut(nodes.join(above, ["keyword", "parent_code"], "left_semi").select("keyword", "code", "parent_code", "total", "splits"))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, done).select("keyword", "code", "total", F.explode(pages_of(F.col("total"), size)).alias("page"))
        done.append(level.where("not splits"))
    raise RuntimeError(f"partitions are split more than {most} times")
