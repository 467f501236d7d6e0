"""File sources: id lists, character sets, generated characters, settings, and the built-in sample regions."""

from __future__ import annotations

import io
import json
import os
import re
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from pathlib import Path
from typing import Any
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta import schemas
from gazetta.functions import scalar

# Inclusive ranges of CJK ideographs.
HAN_RANGES = (
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFA6D), (0xFA70, 0xFAD9), (0x20000, 0x2A6DF), (0x2A700, 0x2B81D), (0x2B820, 0x2CEAD),
    (0x2CEB0, 0x2EBE0), (0x2EBF0, 0x2EE5D), (0x2F800, 0x2FA1D), (0x30000, 0x3134A), (0x31350, 0x323AF), (0x323B0, 0x33479),
)

# One sample region a level (code, name, full name, level, parent, province, city, district, town) and the coordinates known for them.
SAMPLE_REGIONS = (
    ("110000", "北京市", "北京市", "province", None, "110000", None, None, None),
    ("110100", "市辖区", "北京市市辖区", "city", "110000", "110000", "110100", None, None),
    ("110101", "东城区", "北京市市辖区东城区", "district", "110100", "110000", "110100", "110101", None),
    ("110101001", "东华门街道", "北京市市辖区东城区东华门街道", "town", "110101", "110000", "110100", "110101", "110101001"),
)
SAMPLE_POINTS = (("110000", 116.4074, 39.9042), ("110101", 116.4164, 39.9288), ("110101001", 116.4039, 39.9147))


def ids(spark: SparkSession, *paths: str) -> DataFrame:
    """Ids of text files, one a line, stripped, without blank lines; files are not merged, so repeated ids stay. A missing file raises."""
    return spark.read.text(list(paths)).select(scalar.strip(F.col("value")).alias("id")).where("id <> ''")


def count_lines(spark: SparkSession, path: str) -> int:
    """Physical lines, blank ones included."""
    return spark.read.text(path).count()


def characters(spark: SparkSession, literal_or_path: str, root: str = ".") -> DataFrame:
    """One row with the distinct characters of a literal, or of the file it names (under root first, then as given)."""
    for path in (Path(root) / literal_or_path, Path(literal_or_path)):
        if len(literal_or_path) < 1024 and path.is_file():
            return spark.read.text(str(path), wholetext=True).select(scalar.distinct_chars(F.col("value")).alias("chars"))
    return spark.range(1).select(scalar.distinct_chars(F.lit(literal_or_path)).alias("chars"))


def sheet_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, row, cells) of the first sheet of XLSX workbooks as `sinks.exports.write_xlsx` writes them: a null for each cell left out, a file is read by one task."""
    space = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"

    def place(at: str) -> int:
        n = 0
        for c in re.match("[A-Z]+", at)[0]:
            n = n * 26 + ord(c) - 64
        return n - 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                numbers, values = [], []
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open("xl/worksheets/sheet1.xml") as sheet:
                    for _, row in ElementTree.iterparse(sheet):
                        if row.tag != f"{space}row":
                            continue
                        cells: list[str | None] = []
                        for cell in row:
                            at = place(cell.get("r"))
                            cells += [None] * (at - len(cells)) + ["".join(cell.itertext())]
                        numbers.append(int(row.get("r")))
                        values.append(cells)
                        row.clear()
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(numbers), pa.string()), pa.array(numbers, pa.int32()), pa.array(values, pa.list_(pa.string()))], names=["file", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(rows, "file string, row int, cells array<string>")


def han_characters(spark: SparkSession, ranges: Sequence[tuple[int, int]] = HAN_RANGES) -> DataFrame:
    """(cp, char) of every code point in the ranges."""
    bounds = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ranges])
    cps = spark.range(1).select(F.explode(bounds).alias("r")).select(F.explode(F.sequence("r.a", "r.b")).alias("cp"))
    return cps.select("cp", F.decode(F.unhex(F.lpad(F.hex("cp"), 8, "0")), "UTF-32").alias("char"))


def sample_regions(spark: SparkSession, now: str, source: str = "sample", version: str = "sample") -> DataFrame:
    rows = [(*r, None, None, source, "", version, now, now) for r in SAMPLE_REGIONS]
    return spark.createDataFrame(rows, schemas.REGION)


def sample_points(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SAMPLE_POINTS), "code string, lon double, lat double")


def task(path: str) -> dict[str, Any]:
    """A task file: its top level must be a JSON object."""
    got = json.loads(Path(path).read_text("utf-8"))
    if not isinstance(got, dict):
        raise ValueError(f"{path}: the top level is no object")
    return got


def yaml_settings(path: str, sections: Sequence[str]) -> dict[str, Any]:
    """Settings of a YAML file, the keys of known sections lifted to the top; {} if there is no such file."""
    if not os.path.exists(path):
        return {}
    import yaml

    got = yaml.safe_load(Path(path).read_text("utf-8")) or {}
    flat = {k: v for k, v in got.items() if k not in sections}
    for name in sections:
        if isinstance(got.get(name), dict):
            flat |= got[name]
    return flat


def env_file(path: str) -> dict[str, str]:
    if not os.path.exists(path):
        return {}
    pairs = (line.split("=", 1) for line in Path(path).read_text("utf-8").splitlines() if "=" in line and not line.lstrip().startswith("#"))
    return {k.strip(): v.strip().strip("'\"") for k, v in pairs}


def merged_settings(*layers: Mapping[str, Any]) -> dict[str, Any]:
    """Later layers win; their nulls don't. Order them defaults, YAML, env file, environment, command line."""
    out: dict[str, Any] = {}
    for layer in layers:
        out |= {k: v for k, v in layer.items() if v is not None or k not in out}
    return out


def prefixed(env: Mapping[str, str], prefix: str) -> dict[str, str]:
    return {k[len(prefix) :].lower(): v for k, v in env.items() if k.startswith(prefix)}
