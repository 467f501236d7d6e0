"""Cutting the lineage of what later steps read more than once, and scratch folders that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a local master may leave it unset; it then gets a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        master = spark.sparkContext.master
        if master.split("[")[0] != "local":
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        where = f"file://{tempfile.mkdtemp(prefix='gazetta-')}"
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def _drop(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the session may have ended before the interpreter does
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder. It goes when the driver's interpreter ends, since lazy results may read it."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_drop, spark, path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """df as it is now, checkpointed in the shared folder."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df as a table in the shared folder, and its path: for rounds that drop the table of the round before (see drop)."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    _drop(spark, path)


def drop_at_end(spark: SparkSession, path: str) -> None:
    """For the table of the last round, which the lazy result reads."""
    atexit.register(_drop, spark, path)
