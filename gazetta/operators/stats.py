"""Counts, latency summaries and throughput figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.operators.lineage import cut


def count_by(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def total_counts(**tables: DataFrame) -> DataFrame:
    """(table, n) of each table, and the total of all."""
    parts = [t.select(F.lit(name).alias("table")) for name, t in tables.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    base = union.sparkSession.createDataFrame([(n,) for n in tables], "table string")
    counted = base.join(union.groupBy("table").agg(F.count("*").alias("n")), "table", "left").select("table", F.coalesce("n", F.lit(0)).alias("n"))
    return counted.unionByName(counted.agg(F.sum("n").alias("n")).select(F.lit("total").alias("table"), "n"))


def exclusive_quantiles(rows: DataFrame, by: Sequence[str], value: str, cuts: dict[str, tuple[float, int]]) -> DataFrame:
    """Exact quantiles by the exclusive method, for cuts name: (p, least rows); with fewer rows the maximum. Nulls do not count.

    Values are counted before the shuffle and dealt out by ranges; running counts within a range are shifted by
    the counts of the ranges before it, one small row each. So neither equal values nor the values of a group
    ever meet in one task.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    ranges = cut(counted.repartitionByRange(*by, value).withColumn("_p", F.spark_partition_id()))
    sums = ranges.groupBy(*by, "_p").agg(F.sum("_c").alias("_s"))
    group = Window.partitionBy(*by)
    sums = sums.select(*by, "_p", F.coalesce(F.sum("_s").over(group.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_s").over(group).alias("_all"))
    inside = F.sum("_c").over(Window.partitionBy(*by, "_p").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranges.withColumn("_to", inside).join(sums, [*by, "_p"]).withColumn("_to", F.col("_to") + F.col("_before"))

    def at(place: Column) -> Column:
        return F.min(F.when(F.col("_to") >= place, F.col(value)))

    aggs = [F.max("_all").alias("_n"), F.max(value).alias("_max")]
    for name, (p, _) in cuts.items():
        h = F.least(F.greatest(F.lit(p) * (F.col("_all") + 1), F.lit(1.0)), F.col("_all").cast("double"))
        low = F.least(F.floor(h), F.col("_all") - 1).cast("long")
        aggs += [at(F.greatest(low, F.lit(1))).alias(f"_{name}_a"), at(F.greatest(low, F.lit(1)) + 1).alias(f"_{name}_b"), F.max(h - F.greatest(low, F.lit(1))).alias(f"_{name}_f")]
    out = ranked.groupBy(*by).agg(*aggs)
    values = [F.when(F.col("_n") >= least, F.col(f"_{n}_a") + (F.coalesce(f"_{n}_b", F.lit(0.0)) - F.col(f"_{n}_a")) * F.when(F.col(f"_{n}_b").isNull(), 0.0).otherwise(F.col(f"_{n}_f"))).otherwise(F.col("_max")).alias(n) for n, (_, least) in cuts.items()]
    return out.select(*by, *values)


def latency_summary(calls: DataFrame, by: Sequence[str]) -> DataFrame:
    """Calls (ok, status_code, error, elapsed_ms) by level: counts, success rate, mean, median, p95 and p99 (0 without latencies)."""
    fail = ~F.col("ok")
    key = F.trim(F.split_part("error", F.lit(":"), F.lit(1)))
    rows = calls.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if(F.col("ok")).alias("ok"), F.count_if(fail).alias("fail"), F.avg("elapsed_ms").alias("avg_ms"),
        F.count_if(fail & (F.col("status_code") == 429)).alias("status_429"), F.count_if(fail & (F.col("status_code") == 403)).alias("status_403"), F.count_if(fail & (F.col("status_code") >= 500)).alias("status_5xx"),
        F.count_if(fail & (key == "请求超时")).alias("timeouts"), F.count_if(fail & F.col("error").contains("JSON")).alias("json_failures"),
    )
    rows = rows.withColumn("success_rate", percent(F.col("ok"), F.col("total")))
    quantiles = exclusive_quantiles(calls, by, "elapsed_ms", {"p50_ms": (0.5, 1), "p95_ms": (0.95, 20), "p99_ms": (0.99, 100)})
    rows = rows.join(quantiles, list(by), "left").fillna(0.0, ["avg_ms", "p50_ms", "p95_ms", "p99_ms"])
    return rows.select(*by, "total", "ok", "fail", "avg_ms", "p50_ms", "status_429", "status_403", "status_5xx", "timeouts", "json_failures", "success_rate", "p95_ms", "p99_ms")


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def safe_rate(levels: DataFrame, qps: str = "qps", least: float = 95.0, factor: float = 0.7) -> DataFrame:
    """safe_qps: `factor` times the last good level before the first with a 429 or 403; null if no level is good. levels is a short ladder."""
    bad = (F.col("status_429") > 0) | (F.col("status_403") > 0)
    first_bad = levels.agg(F.min(F.when(bad, F.col(qps))).alias("_stop"))
    tried = levels.join(first_bad).where(F.col("_stop").isNull() | (F.col(qps) <= F.col("_stop")))  # one row
    good = tried.where((F.col("success_rate") >= least) & ~bad)
    return good.agg((F.max(qps) * factor).alias("safe_qps"), F.max(qps).alias("stable_qps"))


def error_kinds(calls: DataFrame) -> DataFrame:
    return calls.where("not ok and error is not null").groupBy(F.trim(F.split_part("error", F.lit(":"), F.lit(1))).alias("kind")).agg(F.count("*").alias("n"))


def throughput(runs: DataFrame) -> DataFrame:
    """Rates and averages of runs (fetched_total, elapsed_seconds, flush_count, written_rows, written_seconds); 0 where nothing was flushed."""
    seconds = F.greatest(F.col("elapsed_seconds").cast("double"), F.lit(0.000001))
    return runs.withColumns(
        {
            "per_hour": F.col("fetched_total") / seconds * 3600, "per_minute": F.col("fetched_total") / seconds * 60,
            "avg_batch_size": ratio(F.col("written_rows"), F.col("flush_count")), "avg_write_seconds": ratio(F.col("written_seconds"), F.col("flush_count")),
        }
    )


def sorted_places(places: DataFrame, other: DataFrame | None = None) -> DataFrame:
    """By province, city, area, name and id; nulls first, or as empty texts once two tables are merged."""
    order = ["province_name", "city_name", "area_name", "standard_name", "source_id"]
    if other is None:
        return places.orderBy(*order)
    return places.unionByName(other, allowMissingColumns=True).orderBy(*[F.coalesce(c, F.lit("")) for c in order])


def by_task(results: DataFrame) -> DataFrame:
    return results.orderBy(F.coalesce("task_json", F.lit("")))
