"""Tables bucketed and sorted by their key, so that an upsert moves the new rows only: the old table is joined where it lies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gazetta.operators import upsert
from gazetta.operators.upsert import Rule


def store(rows: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """rows as a table of the catalog, one file a bucket."""
    rows.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return rows.sparkSession.table(name)


def buckets_of(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type) if rows else 0


def put_in(spark: SparkSession, old: str, out: str, new: DataFrame, keys: Sequence[str], keep: Sequence[str] = (), rules: dict[str, Rule] | None = None) -> DataFrame:
    """Table `out` with table `old` and new rows (keys unique and not null) put in, see upsert.upsert; bucketed as `old` is.

    Only the new rows are shuffled, to the buckets of the old table. The joined rows lie in those buckets already, so writing them moves none.
    """
    n = buckets_of(spark, old)
    merged = upsert.upsert(spark.table(old), new.repartition(n, *keys), keys, keep, rules)
    merged.write.mode("overwrite").bucketBy(n, *keys).sortBy(*keys).saveAsTable(out)
    return spark.table(out)
