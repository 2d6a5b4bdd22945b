"""Embedding whitening: exact sums, centred covariance, QDWH components, projections under a broadcast basis.

Four passes over the vectors, none of which shuffles them: sums for each dimension, the covariance,
the covariance of the result, and the rows. Only tables of dimensions by dimensions meet anywhere.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy
from .qdwh import eigen

#: An entry c becomes the whole number floor(SCALE * c) + SHIFT; beyond this it stays at the edge.
SCALE, SHIFT, EDGE = 1024, 100_000, 1 << 52


def fixed_point(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows whose vector has this length and finite entries alone, and their entries as whole numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == length)
    entries = column.take(pa.array(rows)).flatten().cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    entries = entries.reshape(len(rows), length)
    whole = np.isfinite(entries).all(1)
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(SCALE * entries[whole]), -EDGE, EDGE).astype(np.int64) + SHIFT
    return rows[whole], x


def _sums(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """(length, n, sum of each dimension) of the vectors of the length that most have, of several such the greatest; exact."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(0)), -1).to_numpy(zero_copy_only=False)
            for length in np.unique(sizes[sizes > 0]).tolist():
                _, x = fixed_point(batch.column(0), length)
                if len(x):
                    n, high, low = held.get(length, (0, 0, 0))
                    held[length] = (n + len(x), high + (x >> 26).sum(0), low + (x & (1 << 26) - 1).sum(0))
        for length, (n, high, low) in held.items():
            yield pa.record_batch(
                [pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()), pa.array([n] * length, pa.int64()), pa.array(high), pa.array(low)],
                ["length", "dim", "n", "high", "low"],
            )

    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = vectors.mapInArrow(tidy(run), "length int, dim int, n long, high long, low long").groupBy("length", "dim").agg(exact("n"), exact("high"), exact("low"))
    sums = sums.cache()
    try:
        top = sums.where("dim = 0").orderBy(F.desc("n"), F.desc("length")).first()
        if top is None:
            return 0, 0, []
        found = sums.where(F.col("length") == top["length"]).orderBy("dim").collect()  # a row a dimension
    finally:
        sums.unpersist()
    return top["length"], int(top["n"]), [(int(r["high"]) << 26) + int(r["low"]) for r in found]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x less the mean: the whole part of the mean goes first, exactly, then the rest."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(float) - rest


def _covariance(vectors: DataFrame, length: int, n: int, sums: list[int], project: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the centred vectors, or of their projections, with divisor n; each task sends a matrix, summed in the order of tasks."""

    def run(batches):
        total = 0
        for batch in batches:
            _, x = fixed_point(batch.column(0), length)
            y = _centred(x, n, sums)
            y = y if project is None else y @ project
            total = total + y.T @ y
        if not np.isscalar(total):
            k = len(total)
            part = TaskContext.get().partitionId()
            yield pa.record_batch([pa.array(range(k), pa.int32()), pa.array([part] * k, pa.int32()), pa.array([row.tobytes() for row in total], pa.binary())], ["dim", "part", "line"])

    def add(key, pdf):
        lines = np.stack([np.frombuffer(b) for b in pdf.sort_values("part")["line"]])
        return pd.DataFrame({"dim": [key[0]], "line": [lines.sum(0).tobytes()]})

    # few tasks, so that few matrices travel
    few = vectors.coalesce(4 * vectors.sparkSession.sparkContext.defaultParallelism)
    lines = few.mapInArrow(tidy(run), "dim int, part int, line binary").groupBy("dim").applyInPandas(add, "dim int, line binary")
    found = lines.orderBy("dim").collect()  # a row a dimension
    return np.stack([np.frombuffer(r["line"]) for r in found]) / n


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 8) -> DataFrame:
    """A row for each kept vector and each of the first k components: id, component, n, deviation, whitened, explained, identity_error.

    A vector is dropped if it is null or empty, holds null or non-finite entries, or has another
    length than most vectors have (of several such lengths the greatest counts). Entries become
    whole numbers, x = floor(1024 c) + 100000; c beyond 2^52 / 1024 counts as that. Components are unit
    eigenvectors of the covariance of all kept vectors, by falling eigenvalue; those whose
    eigenvalue is zero to rounding can't be scaled and are left out, so equal vectors give no row. deviation
    is exact, a decimal of 38 digits. Repeated rows and ids stay as they are, null ids too;
    other columns are not read. Eager: three passes run when it is called, the fourth gives the rows.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    only = vectors.select(vec_col)
    length, n, sums = _sums(only)
    if not n:
        return vectors.sparkSession.createDataFrame([], schema)
    cov = _covariance(only, length, n, sums)
    values, basis = eigen(cov, k)
    held = values > max(values[0], 0) * length * np.finfo(float).eps
    values, basis = values[held], basis[:, held]
    if not len(values):
        return vectors.sparkSession.createDataFrame([], schema)
    project, explained = basis / np.sqrt(values), values / np.trace(cov)
    error = float(np.abs(_covariance(only, length, n, sums, project) - np.eye(len(values))).max())
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    c = len(values)

    def deviations(x: np.ndarray) -> pa.Array:
        far = np.abs(x - whole).max(initial=0)
        if (float(n) * (far + 1)) ** 2 * length < 9e18:
            d = n * (x - whole) - rest
            return pa.array((d * d).sum(1)).cast(pa.decimal128(38, 0))
        totals = [sum((n * a - b) ** 2 for a, b in zip(row, rest.tolist())) for row in (x - whole).tolist()]
        return pa.array([Decimal(t) if t < 10**38 else None for t in totals], pa.decimal128(38, 0))

    def run(batches):
        for batch in batches:
            rows, x = fixed_point(batch.column(1), length)
            if not len(rows):
                continue
            each = np.repeat(np.arange(len(rows)), c)
            out = _centred(x, n, sums) @ project
            same = lambda v: pa.array(np.full(len(each), v))
            columns = [
                batch.column(0).take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), len(rows))), same(np.int64(n)),
                deviations(x).take(pa.array(each)), pa.array(out.ravel()), pa.array(np.tile(explained, len(rows))), same(error),
            ]
            yield pa.record_batch(columns, [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(id_col, vec_col).mapInArrow(tidy(run), schema)
