"""Hard negatives: product quantisation with stored residual norms, exact integer rerank.

Vectors are integers. Each is stored as one byte for every two dimensions (the
nearest of 256 integer centroids, fitted on a bounded sample) and as the norms
of what the centroids leave, by groups of dimensions. For an anchor, a lookup
table gives its product with any quantised vector, and the anchor's own norms
times the stored ones bound the rest (Cauchy-Schwarz): the true score lies
within lookup plus or minus bound. A *window* asks for the k best rows of a
range of scores. Of the rows whose interval meets the range, those go that k
others beat for certain; the remaining ones are scored exactly, in integers. So
the codebook decides the speed, never the result.

Rows are dealt to blocks of bounded size by a hash of the id, anchors likewise,
and each pair of blocks is one task. A first pass over the square root of all
blocks gives every window a k-th score that the rest must reach, so that what
the blocks return per window grows with that root, not with the blocks.

Defined results: rows with a null id or label take no part, nor do vectors that
whole_vectors leaves out. Rows that share an id are one row, that of the least
label and vector. An anchor is neither its own positive nor its own negative;
without positives it gives no rows. Scores beyond 64 bits are an error.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import vectors
from .common import stored

#: Rows that the centroids are fitted on (chosen by a hash of id and vector), rounds of fitting.
SAMPLE, ROUNDS = 8192, 5
#: Dimensions of a code byte, groups of dimensions with a residual norm of their own.
WIDTH, GROUPS = 2, 8
#: Rows and anchors of a block, least number of row blocks, anchors scored at once within a task.
ROWS, ANCHORS, LEAST_BLOCKS, TILE = 8192, 2048, 8, 64


class Codebook:
    """Integer centroids of each pair of dimensions."""

    def __init__(self, x: np.ndarray, greatest: int, seed: int = 7):
        self.d, self.greatest, rng = x.shape[1], greatest, np.random.default_rng(seed)
        self.parts = [slice(a, min(self.d, a + WIDTH)) for a in range(0, self.d, WIDTH)]
        self.groups = [g for g in np.array_split(np.arange(self.d), min(GROUPS, self.d)) if len(g)]
        self.centroids = []
        for part in self.parts:
            points, weight = np.unique(x[:, part].astype(float), axis=0, return_counts=True)
            c = points[rng.choice(len(points), min(256, len(points)), replace=False)]
            for _ in range(ROUNDS):
                near = self._nearest(points, c)
                total = np.stack([np.bincount(near, weight * p, len(c)) for p in points.T], axis=1)
                held = np.bincount(near, weight, len(c))[:, None]
                c = np.where(held > 0, total / np.maximum(held, 1), c)
            self.centroids.append(np.rint(c))

    @staticmethod
    def _nearest(points: np.ndarray, c: np.ndarray) -> np.ndarray:
        half = (c * c).sum(1) / 2
        return np.concatenate([np.argmax(points[a : a + 4096] @ c.T - half, axis=1) for a in range(0, len(points), 4096)])

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and residual norms rounded up."""
        x = x.astype(float)
        codes = np.stack([self._nearest(x[:, p], c) for p, c in zip(self.parts, self.centroids, strict=True)], axis=1).astype(np.uint8)
        rest = x - np.concatenate([c[k] for c, k in zip(self.centroids, codes.T, strict=True)], axis=1)
        norms = np.sqrt(np.stack([(rest[:, g] ** 2).sum(1) for g in self.groups], axis=1)) * (1 + 1e-9)
        return codes, np.nextafter(norms.astype("<f4"), np.float32(np.inf))

    def bounds(self, a: np.ndarray, codes: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor in ``a`` with each coded row."""
        a = a.astype(float)
        near = np.zeros((len(a), len(codes)))
        for part, c, k in zip(self.parts, self.centroids, codes.T, strict=True):
            near += np.take(a[:, part] @ c.T, k, axis=1)
        own = np.sqrt(np.stack([(a[:, g] ** 2).sum(1) for g in self.groups], axis=1))
        # what rounding can do to sums of d products
        off = own @ norms.T.astype(float) * (1 + 1e-9) + 1e-13 * self.d * self.greatest * np.abs(a).sum(1)[:, None]
        return near - off, near + off


def score(x: np.ndarray, a: np.ndarray, greatest: int) -> np.ndarray:
    """Integer inner products, exact: in doubles where those hold every partial sum, else in Python's integers."""
    if len(a) * greatest * greatest < 1 << 53:
        return (x.astype(float) @ a.astype(float)).astype(np.int64)
    return np.array((x.astype(object) @ a.astype(object)).tolist(), np.int64)


def best_of_windows(book: Codebook, anchors: Iterator[tuple], ai: np.ndarray, al: np.ndarray, a: np.ndarray, xi: np.ndarray, xl: np.ndarray, x: np.ndarray, codes: np.ndarray, norms: np.ndarray, k: int, same: bool, done: Counter | None = None) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, window, row, score): each window's k best of a block.

    ``anchors`` gives each anchor's windows as (names, least, greatest scores).
    ``done`` counts rows met and rows scored.
    """
    order = np.argsort(xi, kind="stable")
    xi, xl, x, codes, norms = xi[order], xl[order], x[order], codes[order], norms[order]
    for at in range(0, len(a), TILE):
        least, most = book.bounds(a[at : at + TILE], codes, norms)
        for j, (low, high) in enumerate(zip(least, most, strict=True), at):
            names, starts, ends = next(anchors)
            fits = ((xl == al[j]) == same) & (xi != ai[j])
            wanted = []
            for lo, hi in zip(starts, ends, strict=True):
                may = fits & (high >= lo) & (low <= hi)
                sure = low[may & (low >= lo) & (high <= hi)]
                if len(sure) >= k:
                    may &= high >= np.partition(sure, -k)[-k]
                wanted.append(may)
            rows = np.flatnonzero(np.logical_or.reduce(wanted)) if wanted else []
            if done is not None:
                done.update(met=int(fits.sum()), scored=len(rows))
            if not len(rows):
                continue
            exact = score(x[rows], a[j], book.greatest)
            for name, lo, hi, may in zip(names, starts, ends, wanted, strict=True):
                held = np.flatnonzero(may[rows] & (exact >= lo) & (exact <= hi))
                held = held[np.argsort(-exact[held], kind="stable")][:k]
                yield from zip([int(ai[j])] * len(held), [name] * len(held), xi[rows[held]].tolist(), exact[held].tolist(), strict=True)


def index(df: DataFrame, key: Column, label: Column, vector: str) -> tuple[DataFrame, Codebook] | None:
    """Rows i, label, raw, codes, norms, one an id, as a written table; None without rows."""
    clean, d, greatest = vectors.whole_vectors(df, vector, i=key.cast("long"), label=label.cast("long"))
    if not d:
        return None
    clean = clean.where("i is not null and label is not null")
    sample = clean.orderBy(F.xxhash64("i", "v"), "i").limit(SAMPLE).select("v").toArrow()["v"].combine_chunks()
    if not len(sample):
        return None
    book = Codebook(vectors.integers(sample, d, greatest), greatest)
    model = df.sparkSession.sparkContext.broadcast(book)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in (b.slice(at, 4096) for at in range(0, b.num_rows, 4096)):
                x = vectors.integers(part.column(2), d, greatest)
                codes, norms = model.value.encode(x)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), vectors.packed(x), vectors.packed(codes), vectors.packed(norms)], ["i", "label", "raw", "codes", "norms"])

    rows = clean.mapInArrow(encode, "i long, label long, raw binary, codes binary, norms binary")
    rows = rows.groupBy("i").agg(F.min(F.struct("label", "raw", "codes", "norms")).alias("r")).select("i", "r.*")
    return stored(rows, "pq-index"), book


def search(rows: DataFrame, book: Codebook, asked: DataFrame, k: int, same: bool) -> DataFrame:
    """The k best rows of each window, of the anchor's label or (not ``same``) of others: i, name, id, score, rank.

    ``asked``: i, label, raw, windows (array of structs name, lo, hi), one row an anchor.
    """
    spark = rows.sparkSession
    model, dtype = spark.sparkContext.broadcast(book), vectors.kind(book.greatest)
    n, m = rows.count(), asked.count()
    xb, yb = max(LEAST_BLOCKS, -(-n // ROWS)), max(1, -(-m // ANCHORS))

    def block(xs: pa.Table, asks: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if xs.num_rows and asks.num_rows:
            d, sizes = model.value.d, (len(model.value.parts), len(model.value.groups))
            windows = ([[w[f] for w in ws] for f in ("name", "lo", "hi")] for ws in asks["windows"].to_pylist())
            own = asks["i"].to_numpy(), asks["label"].to_numpy(), vectors.unpacked(asks["raw"], d, dtype)
            found = list(best_of_windows(model.value, windows, *own, xs["i"].to_numpy(), xs["label"].to_numpy(), vectors.unpacked(xs["raw"], d, dtype), vectors.unpacked(xs["codes"], sizes[0], "u1"), vectors.unpacked(xs["norms"], sizes[1], "<f4"), k, same))
        columns = zip(*found, strict=True) if found else ((),) * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["i", "name", "id", "score"])

    x, y = F.pmod(F.xxhash64("i"), F.lit(xb)).cast("int"), F.pmod(F.xxhash64("i"), F.lit(yb)).cast("int")

    def scan(first: int, last: int, asks: DataFrame) -> DataFrame:
        left = rows.withColumn("x", x).where(F.col("x").between(first, last)).withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(yb - 1))))
        right = asks.withColumns({"y": y, "x": F.explode(F.sequence(F.lit(first), F.lit(last)))})
        found = left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInArrow(block, "i long, name long, id long, score long")
        return ranked(found)

    def ranked(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("i", "name").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    pilot = max(1, round(xb**0.5))
    first = stored(scan(0, pilot - 1, asked), "pq-pilot")
    if pilot == xb:
        return first
    # an anchor has few windows, so its thresholds are one short list
    reached = first.where(F.col("rank") == k).groupBy("i").agg(F.map_from_entries(F.collect_list(F.struct("name", "score"))).alias("reached"))
    raised = F.transform("windows", lambda w: F.struct(w["name"].alias("name"), F.greatest(w["lo"], F.try_element_at("reached", w["name"])).alias("lo"), w["hi"].alias("hi")))
    asked = asked.join(reached, "i", "left").withColumn("windows", F.when(F.col("reached").isNull(), F.col("windows")).otherwise(raised)).drop("reached")
    rest = scan(pilot, xb - 1, stored(asked, "pq-asked"))
    return ranked(first.drop("rank").unionByName(rest.drop("rank")))


def mine(df: DataFrame, is_anchor: Column, key: Column, label: Column, vector: str, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """For each anchor and each of its best ``positives`` of the same label: the best ``negatives`` of other labels that score from ``least`` to ``most`` per cent of the positive.

    ``is_anchor`` is a condition on ``i``, the id. Percentages of a negative
    positive score bound an empty range.
    """
    built = index(df, key, label, vector)
    if built is None:
        return df.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    rows, book = built
    anchors = rows.where(is_anchor).select("i", "label", "raw")
    every = F.expr(f"array(struct(0L as name, {-(1 << 62)}L as lo, {1 << 62}L as hi))")
    same = stored(search(rows, book, stored(anchors.withColumn("windows", every), "pq-anchors"), positives, True), "pq-positives")

    # ceiling and floor of the percentages, by hundreds and the rest: no product leaves 64 bits
    hundreds, rest = "((score - pmod(score, 100L)) div 100)", "pmod(score, 100L)"
    bounds = F.expr(f"{least} * {hundreds} + ({least} * {rest} + 99) div 100").alias("lo"), F.expr(f"{most} * {hundreds} + ({most} * {rest}) div 100").alias("hi")
    windows = F.collect_list(F.struct(F.col("id").alias("name"), *bounds))
    asked = stored(anchors.join(same.groupBy("i").agg(windows.alias("windows")), "i"), "pq-anchors")
    other = search(rows, book, asked, negatives, False)
    scores = same.select("i", F.col("id").alias("name"), F.col("score").alias("positive_score"))
    return other.join(scores, ["i", "name"]).select(F.col("i").alias("anchor_id"), F.col("name").alias("positive_id"), "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def query(spark, sf_dir: str) -> DataFrame:
    """op11: hard negatives of every vector whose id is divisible by 100, among all labelled vectors."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(df, F.col("i") % 100 == 0, F.col("vec_id"), label, "embedding")


SQL = """
with r as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, [floor(256 * x::double) for x in embedding] as v
  from embeddings where label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x::double)]) = 0
), s as (
  select a.vec_id as a, b.vec_id as b, a.label = b.label as same, list_dot_product(a.v, b.v)::bigint as score
  from (select * from r where vec_id % 100 = 0) a join r b on a.vec_id <> b.vec_id
), p as (
  select a, b, score from s where same qualify row_number() over (partition by a order by score desc, b) <= 5
)
select p.a as anchor_id, p.b as positive_id, row_number() over (partition by p.a, p.b order by s.score desc, s.b)::int as rank, s.b as negative_id, p.score as positive_score, s.score as negative_score
from p join s on s.a = p.a and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score
qualify row_number() over (partition by p.a, p.b order by s.score desc, s.b) <= 10
"""
