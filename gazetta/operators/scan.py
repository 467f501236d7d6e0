"""Running values along each key's order, however many rows one key has: ranges are scanned apart, and one row for each key and range carries over."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.operators.lineage import cut


def ranged(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """rows with _p, the number of their range in (by, order); cut from their lineage, since later steps must see the same ranges."""
    return cut(rows.repartitionByRange(*by, *order).withColumn("_p", F.spark_partition_id()))


def _inside(by: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*by, "_p").orderBy(*order)


def _before(by: Sequence[str]) -> Window:
    return Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)


def _with_carry(rows: DataFrame, carry: DataFrame, by: Sequence[str]) -> DataFrame:
    """rows with the carry of their key and range; keys may be null."""
    there = carry.select(*[F.col(c).alias(f"_{c}_") for c in by], F.col("_p").alias("_p_"), *[c for c in carry.columns if c not in (*by, "_p")])
    match = F.col("_p") == F.col("_p_")
    for c in by:
        match &= F.col(c).eqNullSafe(F.col(f"_{c}_"))
    return rows.join(there, match, "left").drop("_p_", *[f"_{c}_" for c in by])


def sum_before(rows: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """rows with the sum of `value` over the rows of their key that come before them; `order` must tell rows of a key apart."""
    placed = ranged(rows.withColumn("_v", value), by, order)
    inside = _inside(by, order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_own", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    carry = placed.groupBy(*by, "_p").agg(F.sum("_v").alias("_s"))
    carry = carry.withColumn("_carry", F.coalesce(F.sum("_s").over(_before(by)), F.lit(0))).drop("_s")
    return _with_carry(local, carry, by).withColumn(name, F.col("_carry") + F.col("_own")).drop("_p", "_v", "_own", "_carry")


def departures(calls: DataFrame, key: str, at: Column, order: Sequence[str], gap: Column) -> DataFrame:
    """calls with `departs`, in microseconds: no call of a key leaves before it arrives nor sooner than `gap` after the one before.

    at and gap are microseconds, gap is the same for all calls of a key, and calls are taken in the order of arrival and
    then of `order`. The k-th call leaves at k * gap + max(at - j * gap) over the calls j up to k, which is a running maximum: no clock, no loop.
    """
    order = ["_at", *order]
    placed = ranged(calls.withColumns({"_at": at.cast("long"), "_gap": gap.cast("long")}), [key], order)
    inside = _inside([key], order)
    local = placed.withColumn("_i", F.row_number().over(inside).cast("long") - 1)
    local = local.withColumn("_own", F.max(F.col("_at") - F.col("_i") * F.col("_gap")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    carry = local.groupBy(key, "_p").agg(F.count("*").alias("_n"), F.max("_own").alias("_most"), F.max("_gap").alias("_step"))
    carry = carry.withColumn("_start", F.coalesce(F.sum("_n").over(_before([key])), F.lit(0)))
    carry = carry.withColumn("_carry", F.max(F.col("_most") - F.col("_start") * F.col("_step")).over(_before([key]))).select(key, "_p", "_start", "_carry")
    both = _with_carry(local, carry, [key])
    first = F.greatest(F.col("_own") - F.col("_start") * F.col("_gap"), F.col("_carry"))  # greatest passes over nulls
    return both.withColumn("departs", (F.col("_start") + F.col("_i")) * F.col("_gap") + first).drop("_p", "_i", "_own", "_start", "_carry", "_at", "_gap")
