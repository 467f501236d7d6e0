"""SQLite tables as a Python data source: rows are read in batches by ranges of rowid, only the columns asked for."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BATCH = 10_000
_TYPES = {"INTEGER": "long", "REAL": "double"}


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]):
        self.path, self.table, self.columns, self.splits = options["path"], options["table"], columns, int(options.get("splits", "8"))

    def partitions(self) -> list[InputPartition]:
        with _open(self.path) as db:
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
        if low is None:
            return [InputPartition((0, -1))]
        step = -(-(high - low + 1) // self.splits)
        return [InputPartition((a, min(a + step - 1, high))) for a in range(low, high + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        names = ", ".join(map(_quoted, self.columns))
        with _open(self.path) as db:
            cursor = db.execute(f"SELECT {names} FROM {_quoted(self.table)} WHERE rowid BETWEEN ? AND ?", partition.value)
            while rows := cursor.fetchmany(BATCH):
                yield from rows


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        wanted = [c for c in self.options.get("columns", "").split(",") if c]
        with _open(self.options["path"]) as db:
            have = {r[1]: _TYPES.get(r[2].upper(), "string") for r in db.execute(f"PRAGMA table_info({_quoted(self.options['table'])})")}
        return ", ".join(f"`{c}` {have[c]}" for c in wanted or have)

    def reader(self, schema: Any) -> DataSourceReader:
        return SqliteReader(self.options, schema.fieldNames())


def table(spark: SparkSession, path: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A table of a database file that all executors can read; only `columns` if given."""
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite_table").options(path=path, table=name, columns=",".join(columns or [])).load()
