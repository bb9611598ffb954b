"""Embedding whitening: blockwise TSQR, then a one-sided Jacobi SVD of R.

Every task folds its share of the centred rows into one triangle R by QR
factorisations of blocks; triangles are combined sixteen at a time until one is
left, whose size is the dimension's alone. Plane rotations of its columns, in
rounds of disjoint pairs, go on until all columns are orthogonal: the columns'
norms are the standard deviations (times the root of n), and the accumulated
rotations the components. The covariance matrix is never formed, so small
deviations keep their accuracy.

Statistics are fitted on each distinct integer vector once; identical vectors
meet in a pre-aggregated distinct. Sums and deviations are exact integers, and
rows are centred in integers before the one division.

Defined results: rows that whole_vectors leaves out give no rows; null and
repeated ids are rows like any other. Components without variance (also those
of a single distinct vector) have a null ``whitened``; without any variance
``explained`` and ``identity_error`` are null. A deviation beyond 64 bits is
null. Each component's largest coordinate is positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors
from .common import stored

#: Rows that a task factorises at once, triangles that one task combines.
ROWS, FAN = 4096, 16


def jacobi(r: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right vectors as columns), falling: rotations orthogonalise the columns of ``r``."""
    d = r.shape[1]
    u, v = r.T.copy(), np.eye(d)  # columns as rows
    # a tournament: every pair once a sweep, disjoint pairs at a time
    seats = list(range(d)) + [-1] * (d % 2)
    rounds = []
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], seats[half:][::-1], strict=True) if a >= 0 and b >= 0]
        rounds.append(tuple(np.array(x) for x in zip(*pairs, strict=True)) if pairs else ())
        seats = [seats[0], seats[-1], *seats[1:-1]]
    eps = np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for p, q in filter(None, rounds):
            up, uq = u[p], u[q]
            a, b, g = (up * up).sum(1), (uq * uq).sum(1), (up * uq).sum(1)
            need = np.abs(g) > eps * np.sqrt(a * b)
            if not need.any():
                continue
            turned = True
            z = np.where(need, (b - a) / np.where(need, 2 * g, 1), 0)
            t = np.where(need, np.where(z >= 0, 1, -1) / (np.abs(z) + np.hypot(1, z)), 0)
            c = 1 / np.hypot(1, t)
            s = (c * t)[:, None]
            c = c[:, None]
            u[p], u[q] = c * up - s * uq, s * up + c * uq
            vp, vq = v[p], v[q]
            v[p], v[q] = c * vp - s * vq, s * vp + c * vq
        if not turned:
            break
    sigma = np.sqrt((u * u).sum(1))
    order = np.argsort(-sigma, kind="stable")
    return sigma[order], v[order].T


@dataclass
class Whitening:
    """A fit: n, integer sums, components as columns, eigenvalues and their total."""

    n: int
    greatest: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once."""
        return centred(x, self.n, self.sums, self.greatest)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Coordinates on the components; nan where a component has no variance."""
        e = np.where(self.eigenvalues > 0, self.eigenvalues, np.nan)
        return self.centred(x) @ self.components / np.sqrt(e)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact."""
        if len(self.sums) * (2 * self.n * self.greatest) ** 2 < 1 << 63:
            return (((self.n * x.astype(np.int64) - np.array(self.sums, np.int64)) ** 2).sum(1)).tolist()
        total = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(1)
        return [t if t < 1 << 63 else None for t in total.tolist()]


def centred(x: np.ndarray, n: int, sums: list[int], greatest: int) -> np.ndarray:
    if 2 * n * greatest < 1 << 53:
        return (n * x.astype(float) - np.array(sums, float)) / n
    return ((n * x.astype(object) - np.array(sums, object)) / n).astype(float)


def _blocks(batches: Iterator[pa.RecordBatch], d: int, dtype: str) -> Iterator[np.ndarray]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield vectors.unpacked(b.column(0).slice(at, ROWS), d, dtype)


def _sums(fit: DataFrame, d: int, dtype: str) -> dict[int, int]:
    """Exact sums by dimension, and the number of rows at -1."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * d, 0
        for x in _blocks(batches, d, dtype):
            held = x.sum(0, dtype=np.int64) if dtype != "<i8" else x.astype(object).sum(0)
            total, n = [a + int(b) for a, b in zip(total, held, strict=True)], n + len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(d)], pa.int32()), pa.array([Decimal(v) for v in (n, *total)], pa.decimal128(38, 0))], ["j", "s"])

    rows = fit.mapInArrow(part, "j int, s decimal(38,0)").groupBy("j").agg(F.sum("s").alias("s"))
    return {r["j"]: int(r["s"]) for r in rows.collect()}  # one row a dimension


def _triangle(fit: DataFrame, d: int, dtype: str, n: int, sums: list[int], greatest: int) -> np.ndarray:
    """R of all centred rows; d columns, at most d rows."""

    def fold(blocks: Iterator[np.ndarray]) -> np.ndarray:
        r = np.zeros((0, d))
        for x in blocks:
            r = np.linalg.qr(np.concatenate((r, x)), mode="r")
        return r

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = fold(centred(x, n, sums, greatest) for x in _blocks(batches, d, dtype))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["at", "r"])

    def combine(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        r = fold(np.frombuffer(x, float).reshape(-1, d) for x in t["r"].to_pylist())
        return pa.table({"at": pa.array([t["at"][0].as_py() // FAN], pa.int64()), "r": pa.array([r.tobytes()], pa.binary())})

    parts = stored(fit.mapInArrow(part, "at long, r binary"), "whitening-triangles")
    last = parts.agg(F.max("at")).first()[0]
    while True:
        parts, last = parts.groupBy(F.floor(F.col("at") / FAN).alias("g")).applyInArrow(combine, "at long, r binary"), last // FAN
        if not last:
            return np.frombuffer(parts.first()["r"], float).reshape(-1, d)


def fit(rows: DataFrame, d: int, greatest: int, k: int) -> tuple[Whitening, float | None] | None:
    """A fit on the distinct vectors ``raw`` of ``rows``, and the largest entry of the whitened covariance minus the identity."""
    dtype = vectors.kind(greatest)
    distinct = stored(rows.select("raw").distinct(), "whitening-fit")
    total = _sums(distinct, d, dtype)
    if not total:
        return None
    n, sums = total[-1], [total[j] for j in range(d)]
    sigma, v = jacobi(_triangle(distinct, d, dtype, n, sums, greatest))
    sigma = np.where(sigma > d * np.finfo(float).eps * sigma[0], sigma, 0)
    v = v * np.where(np.take_along_axis(v, np.abs(v).argmax(0)[None], 0) < 0, -1, 1)
    e = sigma * sigma / n
    found = Whitening(n, greatest, sums, v[:, :k], e[:k], float(e.sum()))
    live = int((found.eigenvalues > 0).sum())
    if not live:
        return found, None
    model = rows.sparkSession.sparkContext.broadcast(found)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((live + 1, live))
        for x in _blocks(batches, d, dtype):
            w = model.value.whitened(x)[:, :live]
            held += np.concatenate((w.sum(0)[None], w.T @ w))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(held.size, dtype=np.int32)), pa.array(held.ravel())], ["j", "s"])

    at = {r["j"]: r["s"] / n for r in distinct.mapInArrow(moments, "j int, s double").groupBy("j").agg(F.sum("s").alias("s")).collect()}
    held = np.array([at[j] for j in range((live + 1) * live)]).reshape(live + 1, live)
    return found, float(np.abs(held[1:] - np.outer(held[0], held[0]) - np.eye(live)).max())


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 4) -> DataFrame:
    """One row for each remaining row and component up to ``k``: id, component, n, deviation, whitened, explained, identity_error."""
    ddl = f"`{key}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    clean, d, greatest = vectors.whole_vectors(df, vector, i=F.col(key).cast("long"))
    empty = df.sparkSession.createDataFrame([], ddl)
    if not d:
        return empty

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), vectors.packed(vectors.integers(b.column(1), d, greatest))], ["i", "raw"])

    rows = clean.mapInArrow(pack, "i long, raw binary")
    found = fit(rows, d, greatest, k)
    if found is None:
        return empty
    model, error, dtype = df.sparkSession.sparkContext.broadcast(found[0]), found[1], vectors.kind(greatest)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = model.value
        c = len(f.eigenvalues)
        for b in batches:
            for part in (b.slice(at, ROWS) for at in range(0, b.num_rows, ROWS)):
                x, m = vectors.unpacked(part.column(1), d, dtype), part.num_rows
                w = f.whitened(x).ravel()
                each = pa.array(np.repeat(np.arange(m), c))
                explained = [e / f.trace for e in f.eigenvalues] if f.trace else [None] * c
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(each), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), m)), pa.array(np.full(m * c, f.n)), pa.array(f.deviations(x), pa.int64()).take(each), pa.array(w, pa.float64(), mask=np.isnan(w)), pa.array(explained * m, pa.float64()), pa.array([error] * (m * c), pa.float64())],
                    names=["i", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, ddl.replace(f"`{key}`", "i", 1)).withColumnRenamed("i", key)


def query(spark, sf_dir: str) -> DataFrame:
    """op13: four whitened coordinates of every vector."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
