"""Total tables over many runs: places with one coordinate pair and places with several, each run put into both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from gazetta import schemas
from gazetta.operators import projection, upsert
from gazetta.sinks import commits


def _schema(columns: list[str]) -> StructType:
    return StructType([schemas.PLACE[c] for c in columns])


SINGLE, MULTI = _schema(schemas.SINGLE_COLUMNS), _schema(schemas.MULTI_COLUMNS)


def read(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(single, multi) as the last run left them."""
    found = commits.history(spark, root)
    if not found:
        return spark.createDataFrame([], SINGLE), spark.createDataFrame([], MULTI)
    path = f"{root}/{found[-1].info['folder']}"
    return spark.read.schema(SINGLE).parquet(f"{path}/single"), spark.read.schema(MULTI).parquet(f"{path}/multi")


def put(places: DataFrame, root: str, tries: int = 20) -> int:
    """Puts a run's places into both total tables; returns the version. Of runs that end at one time the later is put in again.

    The tables before the last stay for readers until the next run.
    """
    spark = places.sparkSession
    for _ in range(tries):
        before = commits.last_version(spark, root)  # read first: whatever comes after it makes the commit fail
        history = commits.history(spark, root)
        single, multi = upsert.upsert_totals(*read(spark, root), projection.route(places))
        name, path = commits.data_folder(root)
        single.select(*SINGLE.fieldNames()).write.parquet(f"{path}/single")
        multi.select(*MULTI.fieldNames()).write.parquet(f"{path}/multi")
        try:
            commits.commit(spark, root, before + 1, {"whole": True, "folder": name, "before": history[-1].info["folder"] if history else None})
        except commits.Conflict:
            commits.delete(spark, path)
            continue
        if history and history[-1].info["before"]:
            commits.delete(spark, f"{root}/{history[-1].info['before']}")
        return before + 1
    raise commits.Conflict(f"{tries} commits to {root} were overtaken")
