"""Benchmark decontamination: every passage of every document queries a BM25 index of the test items.

Impacts are BM25 weights of an item's terms, with document frequencies counted
over all documents, divided by the item's score for its own text: a passage's
score for an item is the share of that item's own score. All items at or above
MIN_SCORE are retrieved by block-max WAND: items of like length form blocks; the
sums of the terms' greatest impacts in every block are taken for all passages of
a document at once, and a passage walks the lists only within the blocks whose
sum reaches MIN_SCORE (terms that occur in many blocks count with their greatest
impact anywhere). Each retrieved item is verified: its question (all but the last sentence) and its
answer (the last sentence) must each have MIN_OVERLAP of their words covered by
five-word shingles that the passage holds too.

Items are indexed in shards of bounded number and bytes; each shard is one pass, so that the
broadcast index never grows with the benchmark.

Defined results: null and empty texts and items match nothing; a repeated row or
item matches each time; of a single sentence the last third is the answer.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _U, bytes_word_hashes, free, map_rows, shingle_hashes, text_function

K1, B = 1.2, 0.75
MIN_SCORE, MIN_OVERLAP, SHINGLE = 0.6, 0.8, 5
#: Items of an index shard and of a block; a term of more than this share of the blocks is wide.
SHARD_ITEMS, BLOCK_ITEMS, WIDE = 50_000, 4, 0.5
#: Bytes of item texts in a shard: what is collected for one index and broadcast with it.
SHARD_BYTES = 16 << 20
#: Cells (passage, block) whose sums are taken in one step.
CELLS = 1 << 20
#: Least words of a passage; it is twice the longest item, so that every item lies whole within one.
PASSAGE = 64

_BLANK = bytes(32 if i < 128 and not chr(i).isalnum() else i for i in range(256))
_SENTENCE = re.compile(r"[.!?]\s+|\n+")


def terms(text: str | None) -> np.ndarray:
    """Hashes of the words of ``text``, lower-cased, ASCII marks taken as blanks."""
    return bytes_word_hashes(text.lower().encode("utf-8", "surrogatepass").translate(_BLANK)) if text else np.zeros(0, _U)


class Index:
    """Inverted index of items with block maxima; item numbers ascend in every list."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[int, int], n_docs: int):
        kept = [(i, t, terms(t)) for i, t in items]
        kept = sorted((k for k in kept if len(k[2])), key=lambda k: len(k[2]))
        self.ids = [k[0] for k in kept]
        self.words = [k[2] for k in kept]
        self.split = [self._answer_at(t, len(w)) for _, t, w in kept]
        self.shingles = [shingle_hashes(w, SHINGLE) for w in self.words]
        lengths = np.array([len(w) for w in self.words] or [1])
        self.passage = max(PASSAGE, 2 * int(lengths.max()))
        self.vocabulary = np.unique(np.concatenate(self.words)) if kept else np.zeros(0, _U)
        df = np.array([frequency.get(int(v), 0) for v in self.vocabulary.view(np.int64)], float)
        idf = np.log1p((max(n_docs, 1) - df + 0.5).clip(0.5) / (df + 0.5))
        lists: list[list[tuple[int, float]]] = [[] for _ in self.vocabulary]
        for i, w in enumerate(self.words):
            t, tf = np.unique(np.searchsorted(self.vocabulary, w), return_counts=True)
            weight = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / lengths.mean()))
            for term, x in zip(t.tolist(), (weight / weight.sum()).tolist(), strict=True):
                lists[term].append((i, x))
        self.items = [[i for i, _ in p] for p in lists]
        self.impact = [[x for _, x in p] for p in lists]
        self.most = np.array([max(x) for x in self.impact] or [0.0])
        self.n_blocks = -(-len(kept) // BLOCK_ITEMS)
        maxima: list[dict[int, float]] = []
        for p, x in zip(self.items, self.impact, strict=True):
            by: dict[int, float] = {}
            for i, v in zip(p, x, strict=True):
                by[i // BLOCK_ITEMS] = max(v, by.get(i // BLOCK_ITEMS, 0.0))
            maxima.append(by)
        self.wide = np.array([len(m) > max(4, WIDE * self.n_blocks) for m in maxima] or [False])
        narrow = [{} if w else m for m, w in zip(maxima, self.wide.tolist(), strict=False)]
        self.first = np.concatenate(([0], np.cumsum([len(m) for m in narrow]))).astype(np.int64)
        self.block = np.array([b for m in narrow for b in m], np.int64)
        self.block_max = np.array([v for m in narrow for v in m.values()], float)

    @staticmethod
    def _answer_at(text: str, n: int) -> int:
        """Words before the answer."""
        cuts = [m.end() for m in _SENTENCE.finditer(text)]
        counts = [c for c in (len(terms(text[:at])) for at in cuts) if 0 < c < n]
        return counts[-1] if counts else n - -(-n // 3)

    def passages(self, words: np.ndarray) -> Iterator[tuple[int, int, list[int], list[int]]]:
        """(start, end, known terms, blocks to walk) of the passages that may reach MIN_SCORE somewhere."""
        v, half = len(self.vocabulary), self.passage // 2
        if not v or not len(words):
            return
        at = np.minimum(np.searchsorted(self.vocabulary, words), v - 1)
        place = np.flatnonzero(self.vocabulary[at] == words)
        n = max(1, -(-len(words) // half) - 1)
        # a word lies in two passages; a term counts once in each
        of = np.concatenate((place // half, place // half - 1))
        pairs = np.unique((of * v + np.tile(at[place], 2))[(of >= 0) & (of < n)])
        passage, term = pairs // v, pairs % v
        edge = np.searchsorted(passage, np.arange(n + 1))
        step = max(1, CELLS // self.n_blocks)
        for lo in range(0, n, step):
            hi = min(n, lo + step)
            p, t = passage[edge[lo] : edge[hi]] - lo, term[edge[lo] : edge[hi]]
            anywhere = np.bincount(p, np.where(self.wide[t], self.most[t], 0.0), hi - lo)
            size = self.first[t + 1] - self.first[t]
            entry = np.repeat(self.first[t] - np.cumsum(size) + size, size) + np.arange(size.sum())
            sums = np.bincount(np.repeat(p, size) * self.n_blocks + self.block[entry], self.block_max[entry], (hi - lo) * self.n_blocks).reshape(hi - lo, -1)
            sums = sums + anywhere[:, None]
            rows, blocks = np.nonzero(sums >= MIN_SCORE - 1e-9)
            for r in np.unique(rows).tolist():
                k = lo + r
                yield k * half, len(words) if k == n - 1 else k * half + self.passage, term[edge[k] : edge[k + 1]].tolist(), blocks[rows == r].tolist()

    def retrieve(self, query: list[int], block: int, least: float = MIN_SCORE) -> list[tuple[int, float]]:
        """WAND over one block: all (item number, score) with score >= least."""
        out: list[tuple[int, float]] = []
        stop, slack, most = (block + 1) * BLOCK_ITEMS, 1e-9, self.most
        cursor: list[list[int]] = []  # current item, place, term

        def advance(c: list[int], target: int) -> bool:
            """Move to the first item >= target; False when the block's part of the list ends."""
            items = self.items[c[2]]
            c[1] = bisect_left(items, target, c[1])
            if c[1] == len(items) or items[c[1]] >= stop:
                return False
            c[0] = items[c[1]]
            return True

        for t in query:
            c = [-1, 0, t]
            if advance(c, block * BLOCK_ITEMS):
                cursor.append(c)
        while cursor:
            cursor.sort()
            total, pivot = 0.0, -1
            for p, c in enumerate(cursor):
                total += most[c[2]]
                if total >= least - slack:
                    pivot = p
                    break
            if pivot < 0:
                break
            item = cursor[pivot][0]
            if cursor[0][0] == item:
                on = [c for c in cursor if c[0] == item]
                score = sum(self.impact[c[2]][c[1]] for c in on)
                if score >= least - slack:
                    out.append((item, score))
                cursor = [c for c in cursor if c[0] != item or advance(c, item + 1)]
            else:
                cursor = [c for c in cursor if c[0] >= item or advance(c, item)]
        return out

    def overlaps(self, i: int, window: np.ndarray) -> tuple[float, float]:
        """Shares of the question's and of the answer's words covered by shingles of ``window``."""
        words, held = self.words[i], shingle_hashes(window, SHINGLE)
        covered = np.zeros(len(words), bool)
        if len(words) < SHINGLE:
            runs = np.lib.stride_tricks.sliding_window_view(window, len(words)) if len(window) >= len(words) else np.zeros((0, len(words)), _U)
            covered[:] = bool((runs == words).all(axis=1).any())
        else:
            for at in np.flatnonzero(np.isin(self.shingles[i], held)).tolist():
                covered[at : at + SHINGLE] = True
        cut = self.split[i]
        question = float(covered[:cut].mean()) if cut else 1.0
        return question, float(covered[cut:].mean())

    def match(self, text: str | None) -> list[tuple[int, float, float, float]]:
        """(item id, score, question overlap, answer overlap) of the verified items, each by its best passage."""
        words = terms(text)
        best: dict[int, tuple[int, float, float, float]] = {}
        for a, b, found, blocks in self.passages(words):
            for i, score in (hit for block in blocks for hit in self.retrieve(found, block)):
                q, r = self.overlaps(i, words[a:b])
                if min(q, r) >= MIN_OVERLAP and (i not in best or score > best[i][1]):
                    best[i] = (self.ids[i], min(score, 1.0), q, r)
        return [best[i] for i in sorted(best)]


def build_indexes(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", shard_items: int = SHARD_ITEMS, shard_bytes: int = SHARD_BYTES) -> Iterator[Index]:
    """One index a shard of items; document frequencies are counted over all of ``docs``."""
    usable = items.where(F.col(item_text).isNotNull()).select(F.col(item_key).cast("long").alias("i"), F.col(item_text).alias("t"))
    n_items, size = usable.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    shards = max(1, -(-n_items // shard_items), -(-size // shard_bytes))
    for s in range(shards):
        table = usable.where(F.pmod(F.xxhash64("i", "t"), F.lit(shards)) == s).orderBy("i", "t").toArrow()
        own = list(zip(table["i"].to_pylist(), table["t"].to_pylist(), strict=True))
        found = [terms(t) for _, t in own]
        vocabulary = docs.sparkSession.sparkContext.broadcast(np.unique(np.concatenate([np.zeros(0, _U), *found])))

        def count(rows: Iterator[tuple], vocabulary=vocabulary) -> Iterator[tuple]:
            v = vocabulary.value
            total, n = np.zeros(len(v) + 1, np.int64), 0
            for (t,) in rows:
                n += 1
                w = np.unique(terms(t))
                if len(w) and len(v):
                    at = np.minimum(np.searchsorted(v, w), len(v) - 1)
                    total[at[v[at] == w]] += 1
            yield -1, n
            yield from ((k, c) for k, c in enumerate(total.tolist()) if c)

        sums = map_rows(docs, pa.schema([("k", pa.int64()), ("n", pa.int64())]), "k long, n long", count, [text]).groupBy("k").agg(F.sum("n").alias("n")).toArrow()
        n = dict(zip(sums["k"].to_pylist(), sums["n"].to_pylist(), strict=True))
        names = vocabulary.value.view(np.int64).tolist()
        yield Index(own, {names[k]: c for k, c in n.items() if k >= 0}, n.get(-1, 0))


def find_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item_id, score, question_overlap, answer_overlap): a row for each document and item found in it."""

    def search(index: Index) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def match(rows: Iterator[tuple]) -> Iterator[tuple]:
            own = shared.value
            for k, t in rows:
                for hit in own.match(t):
                    yield (k, *hit)

        kinds = pa.schema([(key, pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])
        return map_rows(docs.select(F.col(key).cast("long").alias(key), F.col(text)), kinds, f"`{key}` long, item_id long, score double, question_overlap double, answer_overlap double", match, [key, text])

    return reduce(DataFrame.unionByName, [search(i) for i in build_indexes(docs, items, text, item_key, item_text)])


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without those that hold an item."""
    columns = docs.columns
    for index in build_indexes(docs, items, text, item_key, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def hits(rows: Iterator[tuple], shared=shared) -> Iterator[int]:
            for (t,) in rows:
                yield len(shared.value.match(t))

        found = free(columns, "_found")
        docs = docs.withColumn(found, text_function(hits, "long")(F.col(text))).where(F.col(found) == 0).select(*columns)
    return docs


def query(spark, sf_dir: str) -> DataFrame:
    """op5: every benchmark item found in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark item go; the rest stay as they are."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
