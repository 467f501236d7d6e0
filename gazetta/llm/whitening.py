"""Embedding whitening from an exact integer scatter matrix.

Entries become whole numbers. Each task adds up their products in digits of radix 2**21, Spark adds up the digits, and
the driver forms n * X'X - S S' in Python's integers; floats come in only when that is divided and decomposed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.llm.common import small_batches

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
#: Radix of the digits; products of balanced digits, at most 2**40, stay exact in a float matrix product of ROWS rows.
BITS = 21
ROWS = 4096
#: Digits of a sum of products: entries have at most 63 bits, so 2**126 for each of fewer than 2**60 rows.
DIGITS = 9
#: Entries beyond this are held at it, as a long is.
LARGEST = float(1 << 62)
RADIX = 1 << BITS


class Whitening(NamedTuple):
    n: int
    sums: list[int]  #: of x, for each dimension
    vectors: np.ndarray  #: unit eigenvectors, one column a component, by falling eigenvalue
    values: np.ndarray  #: their eigenvalues; 0 where there is no variance left
    explained: np.ndarray  #: eigenvalue over trace
    identity_error: float  #: the largest entry of the whitened rows' covariance minus the identity


def whole(column: pa.ListArray, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the rows that stay, their entries as x): rows of another length, null, or with a null or non-finite entry go."""
    column = column.cast(pa.list_(pa.float64()))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)  # nulls are NaN
    rows = np.flatnonzero(np.diff(offsets) == dimensions)
    if column.null_count:
        rows = rows[column.is_valid().to_numpy(zero_copy_only=False)[rows]]
    c = values[offsets[rows][:, None] + np.arange(dimensions)] if len(rows) else np.zeros((0, dimensions))
    finite = np.isfinite(c).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(c[finite] * SCALE), -LARGEST, LARGEST)
    return rows[finite], scaled.astype(np.int64) + OFFSET


def digits(y: np.ndarray) -> list[np.ndarray]:
    """y as balanced digits of radix 2**21, lowest first, in floats; as many as y needs."""
    out, half = [], RADIX >> 1
    while True:
        low = ((y + half) & (RADIX - 1)) - half
        out.append(low.astype(np.float64))
        y = (y - low) >> BITS
        if not y.any():
            return out


def add_products(total: np.ndarray, y: np.ndarray) -> None:
    """total (DIGITS, d, d) plus y'y, exactly; carries go up, so every digit but the last stays below the radix."""
    for start in range(0, len(y), ROWS):
        parts = digits(y[start : start + ROWS])
        for a, left in enumerate(parts):
            for b, right in enumerate(parts):
                total[a + b] += (left.T @ right).astype(np.int64)
        for k in range(DIGITS - 1):
            total[k + 1] += total[k] >> BITS
            total[k] &= RADIX - 1


def scatter_parts(embeddings: DataFrame, column: str, dimensions: int, shift: int) -> DataFrame:
    """(i, j, d0 .. d8): for each task one row for each pair of dimensions. Dimension 0 is a column of ones, so counts and sums come along."""
    i, j = np.triu_indices(dimensions + 1)
    names = ["i", "j", *(f"d{k}" for k in range(DIGITS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((DIGITS, dimensions + 1, dimensions + 1), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                _, x = whole(batch.column(0).slice(start, ROWS), dimensions)
                add_products(total, np.hstack([np.ones((len(x), 1), np.int64), x - shift]))
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), *(pa.array(d[i, j]) for d in total)], names=names)

    small_batches(embeddings.sparkSession)
    return embeddings.select(column).mapInArrow(run, ", ".join(f"{c} long" for c in names))


def fit(embeddings: DataFrame, column: str = "embedding", components: int = COMPONENTS, shift: int = OFFSET) -> Whitening | None:
    """The whitening of all vectors that stay, None if there is none. `shift` is taken off before multiplying; it changes no result, small numbers only need fewer digits.

    What reaches the driver is a row for each pair of dimensions, however many vectors there are.
    """
    usual = embeddings.where(F.size(column) > 0).groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not usual:
        return None
    d = usual[0].d
    parts = scatter_parts(embeddings, column, d, shift).groupBy("i", "j").agg(*[F.sum(f"d{k}").alias(f"d{k}") for k in range(DIGITS)])
    total = np.zeros((d + 1, d + 1), dtype=object)
    for row in parts.collect():
        total[row.i, row.j] = total[row.j, row.i] = sum(row[f"d{k}"] << (BITS * k) for k in range(DIGITS))
    n = total[0, 0]
    if not n:
        return None
    shifted = total[0, 1:]
    scatter = n * total[1:, 1:] - np.outer(shifted, shifted)
    covariance = np.array([[v / (n * n) for v in row] for row in scatter], dtype=np.float64)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components].copy(), vectors[:, ::-1][:, :components]
    values[values <= d * np.finfo(float).eps * values[0]] = 0.0
    trace = sum(scatter[k, k] for k in range(d)) / (n * n)
    return Whitening(n, [int(s) + n * shift for s in shifted], vectors, values, values / trace if trace else values, _identity_error(scatter, n, vectors, values))


def _identity_error(scatter: np.ndarray, n: int, vectors: np.ndarray, values: np.ndarray) -> float:
    """W V W' minus the identity, with V as exact as it is: no further pass over the rows."""
    some = np.flatnonzero(values)
    whole = np.array([[int(math.ldexp(float(v), 80)) for v in row] for row in vectors[:, some]], dtype=object)
    if not len(some):
        return 0.0
    products = whole.T.dot(scatter).dot(whole)
    scale = np.sqrt(np.outer(values[some], values[some]))
    found = np.array([[v / (n * n << 160) for v in row] for row in products], dtype=np.float64) / scale
    return float(np.abs(found - np.eye(len(some))).max())


def deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(n * x - S, the sum of its squares), exact: in longs where these suffice, else in Python's integers."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    fits = most < 1 << 62
    dev = n * x - np.array(sums) if fits else n * x.astype(object) - np.array(sums, dtype=object)
    largest = int(np.abs(dev).max(initial=0))
    if not (fits and largest * largest * max(x.shape[1], 1) < 1 << 63):
        dev = dev.astype(object)
    return dev, (dev * dev).sum(axis=1)


def transform(embeddings: DataFrame, model: Whitening | None, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """A row for each vector that stays and component: vec_id, component, n, deviation, whitened, explained and identity_error.

    Rows with a null vector, a null or non-finite entry, or another number of entries than most have, are left out; rows that
    repeat count and come out as often as they are there, null ids too. A component without variance gives 0.
    deviation is null where its exact value needs more than a long. Other columns are ignored; an empty table gives no rows.
    """
    schema = f"{key} {embeddings.schema[key].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    d = len(model.sums) if model else 0
    k = len(model.values) if model else 0
    inverse = np.divide(1.0, np.sqrt(model.values), out=np.zeros(k), where=model.values > 0) if model else np.zeros(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if model else ():
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                rows, x = whole(part.column(1), d)
                dev, square = deviations(x, model.n, model.sums)
                white = (dev / model.n).astype(np.float64) @ model.vectors * inverse
                m = len(rows)
                exact = [v if -(1 << 63) <= v < 1 << 63 else None for v in square.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                        pa.array(exact, pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(white.ravel()), pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, model.identity_error)),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    small_batches(embeddings.sparkSession)
    return embeddings.select(key, column).mapInArrow(run, schema)


def whiten(embeddings: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    return transform(embeddings, fit(embeddings, column, components), column, key)
