"""Quality classifier: a factorisation machine over hashed words, structure statistics and lengths.

The score of a row x is sigma(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j).
The pairwise part takes linear time by the sum-of-squares identity:
half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

It is fitted on the driver from at most ``TRAIN_ROWS`` labelled rows; scoring
runs over whole texts where they lie. Defined results: null and empty texts are
scored by the structure statistics alone; repeated rows score alike; without
labelled rows every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _U, bytes_word_hashes, map_rows, mix, text_function
from .language_id import remainder

#: Hash buckets of words, factors, and the bound of labelled rows that are fitted (chosen by a hash of the key).
BUCKETS, FACTORS, TRAIN_ROWS = 1 << 14, 8, 6000
EPOCHS, RATE, DECAY = 14, 0.05, 1e-4
#: Weight of all hashed words of a text together, next to the statistics.
WORD_NORM = 1.0

_CLASS = np.full(256, 7, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 blank, 4 new line, 5 common mark, 6 other mark, 7 beyond ASCII
_CLASS[:128] = 6
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[32, 9]], _CLASS[[10, 13]] = 3, 4
_CLASS[[ord(c) for c in ".,;:'-"]] = 5

STATS = (
    "share_upper share_digit share_blank share_line share_mark share_odd share_wide distinct_words top_word repeats mean_word "
    "long_words lines_per_word distinct_lines length short_text odd_words upper_words bars bangs"
).split()


def features(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket numbers and values of the words (log counts, scaled to norm 1), and the statistics, each about 0..1."""
    stats = np.zeros(len(STATS))
    stats[14] = 0.0
    if not text:
        stats[15] = 1.0
        return np.zeros(0, np.int64), np.zeros(0), stats
    data = text.encode("utf-8", "surrogatepass")
    b = np.frombuffer(data, np.uint8)
    share = np.bincount(_CLASS[b], minlength=8) / len(b)
    h = bytes_word_hashes(data.lower())
    n = max(1, len(h))
    words, times = np.unique(h, return_counts=True)
    kind = _CLASS[b]
    lines = data.split(b"\n")
    raw = data.split()
    stats[:7] = share[1], share[2], share[3], share[4], share[5], share[6], share[7]
    stats[7] = len(words) / n
    stats[8] = (times.max() / n) if len(times) else 0.0
    stats[9] = float(np.mean(h[1:] == h[:-1])) if len(h) > 1 else 0.0
    stats[10] = min(1.0, len(b) / n / 20)
    stats[11] = sum(len(w) > 14 for w in raw) / n
    stats[12] = min(1.0, len(lines) / n)
    stats[13] = len(set(lines)) / len(lines)
    stats[14] = min(1.0, np.log1p(n) / 10)
    stats[15] = float(n < 10)
    stats[16] = min(1.0, np.count_nonzero(kind == 6) / n)
    stats[17] = sum(w.isupper() for w in raw) / n
    stats[18] = data.count(b"|") / n
    stats[19] = min(1.0, data.count(b"!") / n)
    bucket, at = np.unique((mix(words) & _U(BUCKETS - 1)).astype(np.int64), return_inverse=True)
    value = np.bincount(at, weights=np.log1p(times), minlength=len(bucket)) if len(words) else np.zeros(0)
    norm = np.sqrt((value**2).sum()) or 1.0
    return bucket, WORD_NORM * value / norm, stats


@dataclass
class Machine:
    """Words use rows 0..BUCKETS-1, statistics the rows after them."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def row(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        bucket, value, stats = features(text)
        x = np.clip((stats - self.mean) / self.scale, -4, 4) / np.sqrt(len(STATS))
        return np.concatenate((bucket, BUCKETS + np.arange(len(STATS)))), np.concatenate((value, x))

    def margin(self, index: np.ndarray, x: np.ndarray) -> float:
        v = self.factors[index] * x[:, None]
        pair = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return self.bias + float(self.linear[index] @ x) + pair

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(*self.row(text)), -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], seed: int = 7) -> Machine:
    """Logistic loss by AdaGrad over single rows, in a fixed shuffled order; ``rows`` hold features and the label."""
    size = BUCKETS + len(STATS)
    rng = np.random.default_rng(seed)
    if not rows:
        return Machine(0.0, np.zeros(size), np.zeros((size, FACTORS)), np.zeros(len(STATS)), np.ones(len(STATS)))
    table = np.array([s for _, _, s, _ in rows])
    m = Machine(0.0, np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)), table.mean(axis=0), table.std(axis=0) + 1e-6)
    positive = min(max(sum(y for *_, y in rows) / len(rows), 1e-3), 1 - 1e-3)
    m.bias = float(np.log(positive / (1 - positive)))
    seen = [(np.concatenate((b, BUCKETS + np.arange(len(STATS)))), np.concatenate((v, np.clip((s - m.mean) / m.scale, -4, 4) / np.sqrt(len(STATS)))), y) for b, v, s, y in rows]
    sum_w, sum_v, sum_b = np.full(size, 1e-4), np.full((size, FACTORS), 1e-4), 1e-4
    for _ in range(EPOCHS):
        for at in rng.permutation(len(seen)):
            index, x, y = seen[at]
            v = m.factors[index]
            vx = v * x[:, None]
            total = vx.sum(axis=0)
            z = m.bias + float(m.linear[index] @ x) + 0.5 * float((total**2 - (vx**2).sum(axis=0)).sum())
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
            gw = g * x + DECAY * m.linear[index]
            gv = g * (x[:, None] * total - v * (x**2)[:, None]) + DECAY * v
            sum_w[index] += gw**2
            sum_v[index] += gv**2
            sum_b += g * g
            m.linear[index] -= RATE * gw / np.sqrt(sum_w[index])
            m.factors[index] -= RATE * gv / np.sqrt(sum_v[index])
            m.bias -= RATE * g / np.sqrt(sum_b)
    return m


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS) -> Machine:
    """Fit on the ``rows`` labelled rows of least key hash; conflicting labels of one key are all used."""
    want = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).orderBy(F.xxhash64("k"), "k", "y").limit(rows)
    # at most ``rows`` pairs are broadcast
    known = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(want), "k")

    def extract(rows_: Iterator[tuple]) -> Iterator[tuple]:
        for k, t, y in rows_:
            b, v, s = features(t)
            yield k, y, b.astype("<i2").tobytes(), v.astype("<f4").tobytes(), s.astype("<f4").tobytes()

    kinds = pa.schema([("k", pa.int64()), ("y", pa.int32()), ("b", pa.binary()), ("v", pa.binary()), ("s", pa.binary())])
    got = map_rows(known.withColumn("k", F.xxhash64("k")), kinds, "k long, y int, b binary, v binary, s binary", extract, ["k", "t", "y"]).toArrow().sort_by([("k", "ascending"), ("y", "ascending"), ("b", "ascending")])
    return fit(
        [
            (np.frombuffer(b, "<i2").astype(np.int64), np.frombuffer(v, "<f4").astype(float), np.frombuffer(s, "<f4").astype(float), int(y > 0))
            for y, b, v, s in zip(*(got[c].to_pylist() for c in ("y", "b", "v", "s")), strict=True)
        ]
    )


def score_documents(docs: DataFrame, machine: Machine, text: str = "text", out: str = "score") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((machine.bias, machine.linear, machine.factors, machine.mean, machine.scale))

    def judge(rows: Iterator[tuple]) -> Iterator[float]:
        own = Machine(*shared.value)
        for (t,) in rows:
            yield own.score(t)

    return docs.withColumn(out, text_function(judge, "double")(F.col(text)))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: quality of every document, learned from labels whose remainder mod 5 isn't 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rest = remainder(F.col("doc_id"), 5)
    machine = train(docs, labels.where(rest != 0))
    return score_documents(docs, machine).select("doc_id", (rest == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
