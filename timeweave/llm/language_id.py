"""Language identification by bit-sliced Bloom filters over character n-grams.

Every slot of one table holds a bit per language, in as many words as that
takes. Looking an n-gram up in its
slots and AND-ing the words gives all languages whose filter contains it at
once. A text's answer is the language whose popcount over the text's n-grams,
corrected for that filter's false positives, is largest.

Defined results: null or empty text and text without letters give ``und`` with
score 0; ties go to the language that sorts first; with no learned language
everything is ``und``. Repeated rows are judged alike. Columns of the input are
kept as they are; only the two named result columns are added (or replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _ODD, _U, free, map_arrays, mix, text_function

#: Lengths of the n-grams, with a blank at either end of a word.
SIZES = (2, 3, 4)
#: Rows learned from for each language, in expectation (rows are chosen by a hash of the text's id).
TRAIN_ROWS = 1500
#: An n-gram joins a language's filter when seen this often there ...
MIN_COUNT = 5
#: ... and at this share of its relative frequency in the language that uses it most.
MIN_SHARE = 0.34
#: Slots for each stored pair of n-gram and language; two probes a lookup.
SLOTS_PER_ENTRY = 16
#: N-grams of the learned rows that a task holds before it passes their counts on.
HELD = 1 << 20
#: The pipeline rejects a text when its language's filter holds less than this share of its n-grams.
LEAST_KNOWN = 0.05
#: Code points of a text looked at in one step (whole texts are processed, step by step).
STEP = 1 << 18

_LETTER = np.zeros(1 << 16, bool)
_LETTER[[i for i in range(1 << 16) if chr(i).isalpha()]] = True


def grams(text: str) -> Iterator[np.ndarray]:
    """Arrays of hashes of the n-grams of ``text``, case-folded by ``lower``, with every run of non-letters one blank, and a blank at either end.

    Long texts are taken step by step; a step carries what its predecessor's
    last n-grams left open, so that the steps give the n-grams of the whole.
    """
    low = text.lower()
    held = np.array([32], _U)  # the characters before this step, of the text with its blanks joined
    lettered = False
    for at in range(0, len(low), STEP):
        cps = np.frombuffer(low[at : at + STEP].encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = np.where(cps < 1 << 16, _LETTER[np.minimum(cps, (1 << 16) - 1)], False)
        if (high := np.flatnonzero(cps >= 1 << 16)).size:
            letter[high] = [chr(c).isalpha() for c in cps[high].tolist()]
        lettered = lettered or bool(letter.any())
        last = at + STEP >= len(low)
        c = np.concatenate((held[-1:], np.where(letter, cps, 32), [32] if last else [])).astype(_U)
        c = np.concatenate((held[:-1], c[:1], c[1:][(c[1:] != 32) | (c[:-1] != 32)]))
        for n in SIZES if lettered else ():
            # n-grams that end in what this step adds
            first = max(0, len(held) - n + 1)
            m = len(c) - n + 1
            if m > first:
                h = np.full(m - first, _U(n), _U)
                for j in range(n):
                    h += c[first + j : j + m] * _ODD[j]
                yield mix(h)
        held = c[-max(SIZES) :]


@dataclass
class Filters:
    """``table[slot, i // 64]`` has bit i % 64 set when language i put an n-gram there; up to 64 languages ``table[slot]`` is one word."""

    languages: list[str]
    table: np.ndarray
    false_positive: np.ndarray

    def masks(self, h: np.ndarray) -> np.ndarray:
        top = _U(len(self.table) - 1)
        return self.table[h & top] & self.table[(h >> _U(32)) & top]

    def rates(self, text: str) -> np.ndarray | None:
        """Corrected share of the text's n-grams found, for each language; None when it has no letters."""
        n, hits = 0, np.zeros(len(self.languages))
        for h in grams(text):
            n += len(h)
            masks = self.masks(h)
            for w, column in enumerate(masks.T if masks.ndim > 1 else [masks]):
                found, times = np.unique(column, return_counts=True)
                part = hits[64 * w : 64 * (w + 1)]
                for i in range(len(part)):
                    part[i] += times[(found >> found.dtype.type(i)) & found.dtype.type(1) == 1].sum()
        if not n:
            return None
        return np.clip((hits / n - self.false_positive) / (1 - self.false_positive), 0, 1)

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, score in 0..1 (its share of the two best rates), corrected share of known n-grams."""
        r = self.rates(text) if text and self.languages else None
        if r is None:
            return "und", 0.0, 0.0
        best = int(np.argmax(r))
        second = float(np.max(np.delete(r, best))) if len(r) > 1 else 0.0
        total = float(r[best]) + second
        return self.languages[best], float(r[best]) / total if total else 0.0, float(r[best])


def build_filters(counts: dict[str, list[tuple[int, int]] | np.ndarray]) -> Filters:
    """Filters from (n-gram hash, count) lists of each language."""
    languages = sorted(counts)
    pairs = {l: np.array(counts[l], np.int64).reshape(-1, 2) for l in languages}
    totals = {l: int(pairs[l][:, 1].sum()) or 1 for l in languages}
    known = np.unique(np.concatenate([np.empty(0, np.int64), *(p[:, 0] for p in pairs.values())]))
    most = np.zeros(len(known))
    for l, p in pairs.items():
        np.maximum.at(most, np.searchsorted(known, p[:, 0]), p[:, 1] / totals[l])
    sets = {l: p[(p[:, 1] >= MIN_COUNT) & (p[:, 1] / totals[l] >= MIN_SHARE * most[np.searchsorted(known, p[:, 0])]), 0] for l, p in pairs.items()}
    size = 1 << max(12, (SLOTS_PER_ENTRY * max([1, *map(len, sets.values())]) - 1).bit_length())
    kind = next((t for t, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32)) if len(languages) <= bits), np.uint64)
    table, rate = np.zeros((size, max(1, -(-len(languages) // 64))), kind), np.zeros(len(languages))
    for i, l in enumerate(languages):
        h, word, bit = sets[l].view(_U), table[:, i // 64], kind(i % 64)
        for slot in (h & _U(size - 1), (h >> _U(32)) & _U(size - 1)):
            word[slot] |= kind(1) << bit
        rate[i] = np.count_nonzero((word >> bit) & kind(1)) / size
    if table.shape[1] == 1:
        table = table[:, 0]
    return Filters(languages, table, rate**2)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", row_key: str = "doc_id", rows: int = TRAIN_ROWS) -> Filters:
    """Learn from rows with text and language; about ``rows`` of each language, chosen by a hash of ``row_key``."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("l"), F.col(text).alias("t"), F.pmod(F.xxhash64(F.col(row_key)), F.lit(1 << 30)).alias("h"))
    sizes = known.groupBy("l").count().collect()
    if not sizes:
        return Filters([], np.zeros(1, np.uint8), np.zeros(0))
    below = docs.sparkSession.createDataFrame([(r["l"], int(min(1.0, rows / r["count"]) * (1 << 30))) for r in sizes], "l string, below long")
    chosen = known.join(F.broadcast(below), "l").where("h < below").select("l", "t")

    def count(rows: Iterator[tuple]) -> Iterator[tuple]:
        parts: dict[str, list[np.ndarray]] = {}
        size = 0

        def counts() -> Iterator[tuple]:
            for l, of in parts.items():
                if of:
                    g, n = np.unique(np.concatenate(of), return_counts=True)
                    yield np.full(len(g), l, object), g.view(np.int64), n

        for l, t in rows:
            new = list(grams(t))
            parts.setdefault(l, []).extend(new)
            size += sum(map(len, new))
            if size > HELD:
                yield from counts()
                parts, size = {}, 0
        yield from counts()

    schema = pa.schema([("l", pa.string()), ("g", pa.int64()), ("n", pa.int64())])
    table = map_arrays(chosen, schema, "l string, g long, n long", count, ["l", "t"]).groupBy("l", "g").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT).toArrow()
    counts = {r["l"]: np.empty((0, 2), np.int64) for r in sizes}
    of = table["l"].combine_chunks().dictionary_encode()
    pairs, at = np.column_stack([table["g"].to_numpy(), table["n"].to_numpy()]).astype(np.int64), of.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(at, kind="stable")
    ends = np.cumsum(np.bincount(at, minlength=len(of.dictionary)))
    for l, rows_ in zip(of.dictionary.to_pylist(), np.split(order, ends[:-1]), strict=True) if len(at) else []:
        counts[l] = pairs[rows_]
    return build_filters(counts)


def identify(docs: DataFrame, filters: Filters, text: str = "text", out: tuple[str, str, str] = ("lang_pred", "score", "known")) -> DataFrame:
    """``docs`` with the predicted language, its score and the known share of the text's n-grams."""
    shared = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.table, filters.false_positive))

    def judge(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = Filters(*shared.value)
        for (t,) in rows:
            yield own.judge(t)

    tmp = free([*docs.columns, *out], "_language")
    kept = docs.withColumn(tmp, text_function(judge, "lang string, score double, known double")(F.col(text)))
    return kept.withColumns({o: F.col(f"{tmp}.{f}") for o, f in zip(out, ("lang", "score", "known"), strict=True)}).drop(tmp)


def remainder(key: Column, mod: int) -> Column:
    """crc32 of the key written as text, modulo ``mod``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % mod


def query(spark, sf_dir: str) -> DataFrame:
    """op10: language of every document, learned from those whose remainder mod 4 isn't 2.

    A null doc_id has held_out null and isn't learned from.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rest = remainder(F.col("doc_id"), 4)
    filters = train(docs.where(rest != 2))
    return identify(docs.select("doc_id", "text"), filters).select("doc_id", (rest == 2).alias("held_out"), "lang_pred", "score", "known")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without an identified language go; the rest stay as they are.

    Those are texts without letters, and texts of whose n-grams the best
    language's filter holds less than LEAST_KNOWN. The filters are learned from
    this stage's own input; where nothing could be learned, every document goes.
    """
    columns = docs.columns
    out = tuple(free(columns, n) for n in ("_pred", "_score", "_known"))
    judged = identify(docs, train(docs), out=out)
    return judged.where((F.col(out[0]) != "und") & (F.col(out[2]) >= LEAST_KNOWN)).select(*columns)
