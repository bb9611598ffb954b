"""Offsets of clips in recordings by the character runs that both hold, voted cell by cell.

The pairs of equal runs are many more than the votes. They are therefore never
rows: clips and recordings are dealt into blocks, each block of clips meets each
block of recordings in one cell, and a cell counts its pairs in a matrix of
places before it forms offsets. What is shuffled are the texts, once for each
block of the other side.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.grams import hashes

#: Characters of a block of texts, and blocks of either side at least.
BLOCK, LEAST = 8 << 20, 4
#: Entries of the matrix of places, and pairs that are counted at once.
PLACES, PAIRS = 1 << 21, 1 << 22


class Side:
    """The places of one side of a cell: ids in order, and of each place its id's number, its time and its runs."""

    def __init__(self, rows: list[tuple], n: int, max_freq: int | None = None):
        rows.sort(key=lambda r: (r[0], r[1]))
        self.ids, self.of, times, runs = [], [], [], []
        for ident, group in groupby(rows, key=lambda r: r[0]):
            own = [(t, hashes(text, n)) for _, t, text in group]
            if max_freq is not None:
                _, where, counts = np.unique(np.concatenate([h for _, h in own]), return_inverse=True, return_counts=True)
                rare = np.split(counts[where] <= max_freq, np.cumsum([len(h) for _, h in own])[:-1])
                own = [(t, h[keep]) for (t, h), keep in zip(own, rare, strict=True)]
            self.of += [len(self.ids)] * len(own)
            self.ids.append(ident)
            times += [t for t, _ in own]
            runs += [h for _, h in own]
        self.of, self.times, self.sizes = np.array(self.of), np.array(times), np.array([len(h) for h in runs])
        self.runs = np.concatenate(runs) if runs else np.zeros(0, np.int64)
        self.ends = np.cumsum(self.sizes)


def tiles(clips: Side, width: int) -> Iterator[tuple[int, int]]:
    """Ranges of places, whole clips each, whose matrix against ``width`` places has about PLACES entries."""
    at, firsts = 0, [*np.flatnonzero(np.diff(clips.of, prepend=-1)).tolist(), len(clips.of)]
    for place, nxt in zip(firsts[1:], [*firsts[2:], None], strict=True):
        if nxt is None or (nxt - at) * width > PLACES:
            yield at, place
            at = place


def votes_of(clips: Side, recs: Side, bin_s: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(clip, rec, bin, votes) tile by tile, ids by number, in that order."""
    order = np.argsort(recs.runs, kind="stable")
    runs, place = recs.runs[order], np.repeat(np.arange(len(recs.of)), recs.sizes)[order]
    width = len(recs.of)
    for at, stop in tiles(clips, width):
        own = slice(clips.ends[at] - clips.sizes[at], clips.ends[stop - 1])
        inner = np.argsort(clips.runs[own], kind="stable")
        sought, rows = clips.runs[own][inner], np.repeat(np.arange(stop - at) * width, clips.sizes[at:stop])[inner]
        lo = np.searchsorted(runs, sought, "left")
        met = np.searchsorted(runs, sought, "right") - lo
        total, seen = np.cumsum(met), np.zeros((stop - at) * width, np.int64)
        a = 0
        while a < len(met):
            before = int(total[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(total, before + PAIRS, "right")))
            found = np.arange(int(total[b - 1]) - before) + np.repeat(lo[a:b] - (total[a:b] - met[a:b] - before), met[a:b])
            seen += np.bincount(place[found] + np.repeat(rows[a:b], met[a:b]), minlength=len(seen))
            a = b
        some = np.flatnonzero(seen)
        if len(some):
            u, v = np.divmod(some, width)
            u += at
            bins = np.rint((recs.times[v] - clips.times[u]) / bin_s).astype(np.int64)
            least, c0 = bins.min(), clips.of[at]
            across = int(bins.max() - least) + 1
            key = ((clips.of[u] - c0) * len(recs.ids) + recs.of[v]) * across + (bins - least)
            if key.max() < 8 * len(key) + PLACES:
                summed = np.bincount(key, weights=seen[some]).astype(np.int64)
                key = np.flatnonzero(summed)
                summed = summed[key]
            else:
                key, where = np.unique(key, return_inverse=True)
                summed = np.bincount(where, weights=seen[some]).astype(np.int64)
            pair, b = np.divmod(key, across)
            c, r = np.divmod(pair, len(recs.ids))
            yield c + c0, r, b + least, summed


def best_of(c: np.ndarray, r: np.ndarray, b: np.ndarray, votes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each clip the first row with the most votes within one bin to either side, and those votes."""
    beside = (c[1:] == c[:-1]) & (r[1:] == r[:-1]) & (b[1:] == b[:-1] + 1)
    smooth = votes.copy()
    smooth[1:] += votes[:-1] * beside
    smooth[:-1] += votes[1:] * beside
    firsts = np.flatnonzero(np.diff(c, prepend=-1))
    most = np.repeat(np.maximum.reduceat(smooth, firsts), np.diff(firsts, append=len(c)))
    top = np.flatnonzero(smooth == most)
    top = top[np.diff(c[top], prepend=-1) != 0]
    return c[top], r[top], b[top], smooth[top]


def _cells(clips: DataFrame, recs: DataFrame, n: int, bin_s: int, max_freq: int, best: bool) -> DataFrame:
    sides = []
    for df, key in ((clips, "clip"), (recs, "rec")):
        rows = df.where(F.col("text").isNotNull() & F.col("t").isNotNull() & F.col(key).isNotNull()).select(F.col(key), "t", F.regexp_replace("text", "\\s+", "").alias("text")).where(F.length("text") >= n)
        chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
        sides.append((rows, key, max(LEAST, -(-chars // BLOCK))))
    (c, _, cs), (r, _, rs) = sides
    block = lambda key, of: F.pmod(F.xxhash64(key), F.lit(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    ones = c.select(block("clip", cs).alias("i"), every(rs).alias("j"), "clip", F.lit(None).cast(r.schema["rec"].dataType).alias("rec"), "t", "text")
    twos = r.select(every(cs).alias("i"), block("rec", rs).alias("j"), F.lit(None).cast(c.schema["clip"].dataType).alias("clip"), "rec", "t", "text")
    kinds = [to_arrow_type(c.schema["clip"].dataType), to_arrow_type(r.schema["rec"].dataType)]
    names = ["clip", "rec", "offset_s", "votes"]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(x.to_pylist() for x in batch.columns), strict=True)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(rows_of(batches), key=lambda x: x[:2]):
            held: tuple[list, list] = ([], [])
            for _, _, clip, rec, t, text in group:
                held[clip is None].append((rec if clip is None else clip, t, text))
            if not (held[0] and held[1]):
                continue
            one, two = Side(held[0], n), Side(held[1], n, max_freq)
            ids = [pa.array(s.ids, k) for s, k in zip((one, two), kinds, strict=True)]
            for found in votes_of(one, two, bin_s):
                c, r, b, v = best_of(*found) if best else found
                for at in range(0, len(c), 1 << 16):
                    s = slice(at, at + (1 << 16))
                    yield pa.RecordBatch.from_arrays([ids[0].take(pa.array(c[s])), ids[1].take(pa.array(r[s])), pa.array(b[s] * bin_s), pa.array(v[s])], names)

    ddl = f"clip {c.schema['clip'].dataType.simpleString()}, rec {r.schema['rec'].dataType.simpleString()}, offset_s long, votes long"
    return ones.unionByName(twos).repartition(cs * rs, "i", "j").sortWithinPartitions("i", "j").mapInArrow(vote, ddl)


def offset_votes(clips: DataFrame, recs: DataFrame, n: int = 6, bin_s: int = 5, max_freq: int = 4) -> DataFrame:
    """Votes for the offset of a clip in a recording, in bins of ``bin_s`` seconds to the nearest (halves to the even bin).

    Inputs: (clip|rec, t, text). Each run of n characters (white space left out)
    of a clip votes with each equal run of a recording; runs seen more than
    ``max_freq`` times in a recording are left out of it. Runs are compared by
    64-bit hashes. Rows without id, time or text take no part. A clip or a
    recording must fit a worker.
    """
    return _cells(clips, recs, n, bin_s, max_freq, best=False)


def best_offset(clips: DataFrame, recs: DataFrame, n: int = 6, bin_s: int = 5, max_freq: int = 4, min_votes: int = 40) -> DataFrame:
    """Per clip the recording and offset with the most of ``offset_votes`` within one bin to either side (ties to the lesser); few votes are low confidence.

    Each cell gives the best of its recordings, so that the votes stay where they are counted.
    """
    best = Window.partitionBy("clip").orderBy(F.desc("votes"), "rec", "offset_s")
    found = _cells(clips, recs, n, bin_s, max_freq, best=True)
    return found.withColumn("__tw_at", F.row_number().over(best)).where("__tw_at = 1").select("clip", "rec", "offset_s", "votes", (F.col("votes") < min_votes).alias("low_confidence"))
