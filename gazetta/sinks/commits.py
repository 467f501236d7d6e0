"""A numbered log of commits beside a table's data folders. Data are written first, to a folder of their own; a commit then
makes them part of the table by creating the marker of its number, which only one writer can do."""

from __future__ import annotations

import json
import time
import uuid
from typing import Any, NamedTuple

from pyspark.sql import SparkSession

#: Every so many commits one holds the whole state, and older markers may go.
WHOLE = 32
#: Seconds after which a marker without content counts as left by a writer that died.
PATIENCE = 10.0


class Conflict(RuntimeError):
    """Another writer made this commit first."""


class Commit(NamedTuple):
    version: int
    info: dict[str, Any]


def _fs(spark: SparkSession, path: str) -> tuple[Any, Any]:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is missing."""
    fs, at = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder."""
    fs, at = _fs(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def _read(spark: SparkSession, path: str) -> str:
    fs, at = _fs(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> None:
    """Creates a file with this text, or raises Conflict if it is there. A local file system has no such call in Hadoop, so Java makes the empty file there."""
    fs, at = _fs(spark, path)
    fs.mkdirs(at.getParent())
    local = at.toUri().getScheme() in (None, "file") and fs.getUri().getScheme() == "file"
    if local and not spark._jvm.java.io.File(at.toUri().getPath()).createNewFile():
        raise Conflict(path)
    try:
        out = fs.create(at, local)
    except Exception as e:  # noqa: BLE001  py4j has one class for all of Java's
        if fs.exists(at):
            raise Conflict(path) from e
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def data_folder(root: str) -> tuple[str, str]:
    """(name, path) of a new data folder; what a writer without a commit leaves there is part of no table."""
    name = f"data-{uuid.uuid4().hex}"
    return name, f"{root}/{name}"


def _marker(root: str, version: int) -> str:
    return f"{root}/_commits/{version:012}.json"


def last_version(spark: SparkSession, root: str) -> int:
    """The highest number that is taken, -1 if there is none."""
    return max((int(n[:12]) for n in listed(spark, f"{root}/_commits") if n.endswith(".json") and n[:12].isdigit()), default=-1)


def history(spark: SparkSession, root: str, patience: float | None = None) -> list[Commit]:
    """Commits in order, from the newest that holds the whole state (`whole` in its info) or the first.

    A marker that stays empty for PATIENCE seconds belongs to a writer that died; its number stays taken and it says nothing.
    """
    numbers = sorted((int(n[:12]) for n in listed(spark, f"{root}/_commits") if n.endswith(".json") and n[:12].isdigit()), reverse=True)
    out: list[Commit] = []
    until = time.monotonic() + (PATIENCE if patience is None else patience)
    for version in numbers:
        text = _read(spark, _marker(root, version))
        while not text and time.monotonic() < until:
            time.sleep(0.2)
            text = _read(spark, _marker(root, version))
        if text:
            out.append(Commit(version, json.loads(text)))
            if "whole" in out[-1].info:
                break
    return out[::-1]


def commit(spark: SparkSession, root: str, version: int, info: dict[str, Any]) -> None:
    """Makes commit `version`, or raises Conflict if that number is taken."""
    _create(spark, _marker(root, version), json.dumps(info, ensure_ascii=False))


def forget(spark: SparkSession, root: str, before: int) -> None:
    """Drops the markers of commits that a later one holds whole."""
    for name in listed(spark, f"{root}/_commits"):
        if name[:12].isdigit() and int(name[:12]) < before:
            delete(spark, f"{root}/_commits/{name}")
