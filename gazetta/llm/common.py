"""Small helpers that several operators share: reading tables, scratch tables, word splitting."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Code points one slice of an Arrow batch may hold before it is processed; bounds worker memory.
SLICE_CHARS = 400_000

#: Bytes of one Arrow batch between the JVM and a Python worker, where the session keeps Spark's default (256 MB).
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local master may leave it unset; it then gets a temporary one."""
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


def _write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = f"{shared_dir(df.sparkSession)}/scratch-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, read again: cuts the lineage and survives lost executors.

    The folder goes when the driver's interpreter ends, since results that read it may be lazy.
    """
    out, path = _write(df, name)
    atexit.register(_drop, df.sparkSession, path)
    return out


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """As `written`, for tables that no lazy result reads: their folders go when the block ends."""
    made: list[tuple[SparkSession, str]] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        out, path = _write(df, name)
        made.append((df.sparkSession, path))
        return out

    try:
        yield keep
    finally:
        for spark, path in made:
            _drop(spark, path)


def small_batches(spark: SparkSession) -> None:
    """Bounds the bytes of an Arrow batch, so that long texts meet in small numbers; a session's own setting stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) in (None, str(256 << 20), "256MB", "256m", "268435456b"):
        spark.conf.set(name, str(BATCH_BYTES))


def map_parts(df: DataFrame, keep: Callable[[pa.RecordBatch], pa.Array], text: str = "text") -> DataFrame:
    """The rows of df, whole, for which keep(slice) is true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(keep(part))

    small_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows that come sorted by their first `keys` columns of integers, as tables of whole groups, with the place of each group's start and the end."""
    waiting: list[pa.RecordBatch] = []

    def starts(rows: pa.Table) -> np.ndarray:
        new = np.zeros(max(rows.num_rows - 1, 0), bool)
        for k in range(keys):
            v = rows.column(k).to_numpy()
            new |= v[1:] != v[:-1]
        return np.concatenate([[0], np.flatnonzero(new) + 1])

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        if len(waiting) > 1 and all(batch.column(k)[-1] == waiting[0].column(k)[0] for k in range(keys)):
            continue  # still the same group
        rows = pa.Table.from_batches(waiting)
        at = starts(rows)
        if len(at) > 1:
            yield rows.slice(0, at[-1]), at
            waiting = rows.slice(at[-1]).to_batches()
    if waiting:
        rows = pa.Table.from_batches(waiting)
        yield rows, np.append(starts(rows), rows.num_rows)


def map_batches(df: DataFrame, rows: Callable[[dict[str, list]], dict[str, Any]], schema: str, text: str = "text") -> DataFrame:
    """df.mapInArrow by slices of at most SLICE_CHARS code points of column `text` (one row at least).

    rows gets a dict of Python lists and returns a dict of lists or arrays in the order of the schema.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                got = rows(part.to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type, from_pandas=False) for f in arrow], schema=arrow)

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    column = batch.column(batch.schema.get_field_index(text))
    sizes = [0] * batch.num_rows if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type) else [n or 0 for n in pc.binary_length(column).to_pylist()]
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and (total + n > SLICE_CHARS or i - start >= 2000):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ as UTF-8: bytes.split() parts at exactly these six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []
