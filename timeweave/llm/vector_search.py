"""Approximate nearest neighbours by cosine: adaptive dimension scan of inverted lists.

Unit vectors are turned by a random rotation and assigned to k-means lists
(centroids fitted on a bounded sample, every row indexed). A list is cut into
blocks of bounded size, so a list holding a third of all rows is many tasks.
Every query scans its nearest list first and takes the k-th distance found there
along to its other lists. Within a block the rotated vectors are scanned in
blocks of columns: after d of D columns the squared partial distance, scaled by
D/d, estimates the whole with a known deviation (a share of a random rotation
follows a beta distribution), and a candidate is abandoned when that estimate
exceeds the query's current k-th distance by SLACK deviations. Survivors are
measured exactly, in double precision, on the original vectors.

Defined results: vectors that are null, zero, of another length than most, or
that hold null or non-finite values take no part. Rows with the query's own id
aren't its candidates; an id that occurs more than once is one query (its least
vector) and appears once among a query's neighbours, by its best score. Ties go
to the smaller id.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Rows the centroids are fitted on (chosen by a hash of the id), at most so many lists.
SAMPLE, MAX_LISTS = 16_384, 4096
#: A query probes as many lists as held this share of the true neighbours of TRIALS rows within the sample ...
TARGET, TRIALS = 0.96, 256
#: ... and at least so many lists and candidates.
MIN_LISTS, MIN_CANDIDATES = 8, 512
#: Rows of a block, columns of a step, and the deviations that a candidate may exceed (more: fewer wrong abandonments).
BLOCK, STEP, SLACK = 4096, 8, 2.4
#: Candidates looked at before the k-th distance is brought up to date: without one from another list, and with one.
FIRST_ROUND, ROUND = 32, 512


def rotation(d: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def centroids(x: np.ndarray, lists: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Spherical k-means; an emptied list takes a random row."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(lists, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
        c = np.where(norm > 0, total / np.where(norm > 0, norm, 1), x[rng.integers(0, len(x), len(c))])
    return c


def probes_needed(x: np.ndarray, c: np.ndarray, k: int) -> int:
    """Lists to probe, nearest first, to meet TARGET of the k nearest of the first TRIALS rows of ``x`` among all of ``x``."""
    trial = x[:TRIALS]
    s = trial @ x.T
    s[np.arange(len(trial)), np.arange(len(trial))] = -np.inf
    near = np.argpartition(-s, min(k, len(x) - 1), axis=1)[:, :k]
    place = np.argsort(np.argsort(-(trial @ c.T), axis=1, kind="stable"), axis=1)
    at = np.take_along_axis(place, np.argmax(x @ c.T, axis=1)[near], axis=1)
    return int(np.quantile(at, TARGET)) + 1


def scan(q: np.ndarray, qi: np.ndarray, q_raw: np.ndarray, x: np.ndarray, xi: np.ndarray, x_raw: np.ndarray, k: int, known: np.ndarray | None = None, done: Counter | None = None) -> Iterator[tuple[int, int, float]]:
    """(query, candidate, cosine) of each query's best k in one block, as far as they may be among its best k at all.

    ``q`` and ``x`` are rotated unit vectors, ``known`` the least cosine of k
    neighbours found before (nan: none). ``done`` counts candidates, those
    abandoned, and columns of candidates looked at.
    """
    d = x.shape[1]
    norms = np.sqrt((x_raw * x_raw).sum(axis=1))
    steps = [(at, min(d, at + STEP)) for at in range(0, d, STEP)]
    slack = [1 + SLACK * np.sqrt(2 * (d - to) / (to * (d + 2))) for _, to in steps]
    for a in range(len(q)):
        best_i, best_s = np.zeros(0, np.int64), np.zeros(0)
        start = np.nan if known is None else known[a]
        kth = np.inf if np.isnan(start) else max(0.0, 2 - 2 * start) + 1e-12
        own = np.sqrt((q_raw[a] * q_raw[a]).sum())
        at, size = 0, FIRST_ROUND if kth == np.inf else ROUND
        while at < len(x):
            left = np.flatnonzero(xi[at : at + size] != qi[a]) + at
            at, size, met = at + size, min(2 * size, ROUND), len(left)
            part, looked = np.zeros(len(left)), 0
            for (low, high), most in zip(steps, slack, strict=True):
                diff = x[left, low:high] - q[a, low:high]
                part = part + (diff * diff).sum(axis=1)
                looked += len(left) * (high - low)
                if high < d and kth < np.inf:
                    stay = part * (d / high) <= kth * most
                    left, part = left[stay], part[stay]
                if not len(left):
                    break
            if done is not None:
                done.update(candidates=met, abandoned=met - len(left), columns=looked)
            if not len(left):
                continue
            s = (x_raw[left] * q_raw[a]).sum(axis=1) / (norms[left] * own)
            best_i, best_s = np.concatenate((best_i, xi[left])), np.concatenate((best_s, s))
            order = np.lexsort((best_i, -best_s))
            _, first = np.unique(best_i[order], return_index=True)
            order = order[np.sort(first)][:k]
            best_i, best_s = best_i[order], best_s[order]
            if len(best_s) == k:
                kth = min(kth, max(0.0, 2 - 2 * best_s[-1]) + 1e-12)
        yield from zip([int(qi[a])] * len(best_i), best_i.tolist(), best_s.tolist(), strict=True)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, d)


def _probes(x: np.ndarray, c: np.ndarray, sizes: np.ndarray, least: int) -> list[np.ndarray]:
    order = np.argsort(-(x @ c.T), axis=1, kind="stable")
    enough = (np.cumsum(sizes[order], axis=1) < MIN_CANDIDATES).sum(axis=1) + 1
    return [o[: max(least, n)] for o, n in zip(order, enough, strict=True)]


def search(vectors: DataFrame, is_query: F.Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", max_lists: int = MAX_LISTS, everything: bool = False) -> DataFrame:
    """The k nearest found of each query row among all rows: query_id, rank, vec_id, score.

    ``everything`` probes all lists: then only the test can lose a neighbour.
    """
    spark = vectors.sparkSession
    clean = vectors.select(F.col(key).cast("long").alias("i"), F.col(vector).cast("array<double>").alias("v"), is_query.alias("q"))
    clean = clean.where("i is not null and v is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)")
    shape = clean.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not shape:
        return empty
    d, n = shape[0]["d"], shape[0]["count"]
    clean = clean.where(F.size("v") == d)
    turn = rotation(d)
    sample = clean.orderBy(F.xxhash64("i", "v"), "i").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks().flatten().to_numpy().reshape(-1, d)
    turned = unit(sample) @ turn
    c = centroids(turned, min(max_lists, max(1, round(n**0.5))))
    least = len(c) if everything else max(min(MIN_LISTS, len(c)), probes_needed(turned, c, k))
    model = spark.sparkContext.broadcast((c, turn))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, turn = model.value
        for b in batches:
            v = b.column(1).flatten().to_numpy().reshape(-1, d)
            near = np.argmax((unit(v) @ turn) @ c.T, axis=1).astype(np.int32)
            raw = pa.array([r.tobytes() for r in np.ascontiguousarray(v, "<f8")], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(near), raw, b.column(2)], ["i", "list", "raw", "q"])

    index = stored(clean.mapInArrow(assign, "i long, list int, raw binary, q boolean"), "vector-index")
    # one row a list, at most MAX_LISTS rows
    sizes = np.zeros(len(c), np.int64)
    for r in index.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, turn = model.value
        for b in batches:
            for part in (b.slice(at, 1024) for at in range(0, b.num_rows, 1024)):
                to = _probes(unit(_matrix(part.column(1), d)) @ turn, c, sizes, least)
                row = np.repeat(np.arange(part.num_rows), [len(t) for t in to])
                nearest = np.concatenate([np.arange(len(t)) == 0 for t in to])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(np.concatenate(to).astype(np.int32)), part.column(1).take(pa.array(row)), pa.array(nearest)], ["i", "list", "raw", "nearest"])

    asked = index.where("q").groupBy("i").agg(F.min("raw").alias("raw")).mapInArrow(probe, "i long, list int, raw binary, nearest boolean")
    asked = stored(asked, "vector-probes")
    first = stored(_scanned(index, asked.where("nearest").withColumn("known", F.lit(None).cast("double")), sizes, model, d, k), "vector-nearest")
    known = first.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("known"))
    others = asked.where("not nearest").join(known, F.col("i") == F.col("query_id"), "left").select("i", "list", "raw", "known")
    rest = _scanned(index, others, sizes, model, d, k)
    return _ranked(first.drop("rank").unionByName(rest.drop("rank")), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scanned(index: DataFrame, asked: DataFrame, sizes: np.ndarray, model, d: int, k: int) -> DataFrame:
    """Each query's best k of the lists that it asks (i, list, raw, known): query_id, rank, vec_id, score."""
    spark = index.sparkSession
    asked = stored(asked, "vector-asked")
    # one row a list, at most as many as there are lists
    n_asked = {r["list"]: r["count"] for r in asked.groupBy("list").count().collect()}
    grid = spark.createDataFrame([(i, max(1, -(-int(s) // BLOCK)), -(-n_asked.get(i, 0) // BLOCK)) for i, s in enumerate(sizes)], "list int, xb int, qb int").where("qb > 0")
    grid = F.broadcast(grid)
    # blocks of candidates by blocks of queries: each side goes once to every block of the other
    left = index.join(grid, "list").select("i", "raw", "list", F.pmod(F.xxhash64("i", "raw"), F.col("xb")).alias("x"), F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("y"))
    right = asked.join(grid, "list").select("i", "raw", "known", "list", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("xb") - 1).cast("long"))).alias("x"), F.pmod(F.xxhash64("i"), F.col("qb")).cast("int").alias("y"))

    def block(xs: pa.Table, qs: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if xs.num_rows and qs.num_rows:
            turn = model.value[1]
            x_raw, q_raw = _matrix(xs["raw"], d), _matrix(qs["raw"], d)
            rows = list(scan(unit(q_raw) @ turn, qs["i"].to_numpy(), q_raw, unit(x_raw) @ turn, xs["i"].to_numpy(), x_raw, k, qs["known"].to_numpy()))
        q, v, s = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    found = left.groupBy("list", "x", "y").cogroup(right.groupBy("list", "x", "y")).applyInArrow(block, "query_id long, vec_id long, score double")
    return _ranked(found, k)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: the 5 nearest of every vector whose id is divisible by 50, among all vectors."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, F.col("vec_id") % 50 == 0)
