"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, takes accents off, maps homoglyphs to Latin letters, undoes
digit and sign substitutions inside and at the edges of words and leaves words
separated by single blanks. Lexicon entries are whole words or word beginnings;
their weights are log ratios of the shares of toxic and of other labelled texts
that hold them. The longest entry at a word counts, unless an exception phrase
covers it: two neighbouring words, one of them in the lexicon, that other texts
hold at least as often as toxic ones. The hits' weight, normalised by length,
goes through a small fitted logistic curve. All of it is learned.

Learning uses at most ``TRAIN_ROWS`` labelled rows. Defined results: null and
empty texts have no hits and get the curve's score for none; repeated rows score
alike; without labelled rows the lexicon is empty and every score is 0.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stored, text_function
from .language_id import remainder

#: Bound of the labelled rows learned from, chosen by a hash of the key.
TRAIN_ROWS = 12_000
#: An entry occurs in this many toxic texts at least, its share of them is this many times its share of the others,
#: and the likelihood ratio of the two shares is beyond chance (12: one form in two thousand).
MIN_TEXTS, MIN_RATIO, MIN_SURPRISE, MAX_ENTRIES = 3, 8.0, 12.0, 2000
#: An exception phrase occurs in this many texts that aren't toxic.
MIN_HARMLESS = 3
PREFIXES = range(4, 9)

# Letters that look like Latin ones, and digits and signs written for letters.
HOMOGLYPHS = str.maketrans(
    "аеорсухіјѕԁԛԝһӏвкмнтгпиьзαβγεηικνορτυχωσοսոհցքıɑɡƒøłđðþæœß",
    "aeopcyxijsdqwhlbkmhtrnubzabyenikvoptuxwoounhgpiagfoldepaos",
)
SIGNS = str.maketrans("013457@$!|", "oieastasil")
HIDDEN = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
MARKS = re.compile("[\u0300-\u036f]")
# between letters, or one or two of them at a word's edge (more are decoration; a final ! is a mark)
SWAPPED = re.compile(r"(?<=[^\W\d_])[013457@$!|]{1,2}(?=[^\W\d_])|(?<![\w@$!|])[013457@$]{1,2}(?=[^\W\d_])|(?<=[^\W\d_])[013457@$]{1,2}(?![\w@$])")
WORD = re.compile(r"[^\W\d_]+")


def fold(text: str | None) -> str:
    """The folded words of ``text``, one blank before and after each."""
    if not text:
        return " "
    low = text.lower()
    if not low.isascii():
        low = MARKS.sub("", unicodedata.normalize("NFKD", HIDDEN.sub("", low))).translate(HOMOGLYPHS)
    low = SWAPPED.sub(lambda m: m[0].translate(SIGNS), low)
    return f" {' '.join(WORD.findall(low))} "


def candidates(word: str) -> list[str]:
    """Lexicon forms of a word: `` word `` itself and its beginnings `` wor``."""
    return [f" {word} ", *(f" {word[:n]}" for n in PREFIXES if n <= len(word))]


class Lexicon:
    """``entries``: form to weight; ``curve``: weights of the logistic features, constant last."""

    def __init__(self, entries: dict[str, float], exceptions: tuple[str, ...] = (), curve: tuple[float, ...] | None = None):
        import ahocorasick

        self.entries, self.exceptions, self.curve = entries, exceptions, curve
        self.machine = ahocorasick.Automaton()
        for form, weight in entries.items():
            self.machine.add_word(form, (len(form), weight))
        for phrase in exceptions if entries else ():
            self.machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
        self.machine.make_automaton()

    def hits(self, folded: str) -> list[float]:
        """Weights of the words hit, each by its longest entry, without those inside an exception phrase."""
        return [w for _, w in self.places(folded)]

    def places(self, folded: str) -> list[tuple[int, float]]:
        """The same with the place of the blank before each word."""
        if not self.entries:
            return []
        best: dict[int, tuple[int, float]] = {}
        excused: list[tuple[int, int]] = []
        for end, (size, weight) in self.machine.iter(folded):
            start = end - size + 1
            if weight is None:
                excused.append((start, end))
            elif size > best.get(start, (0, 0.0))[0]:
                best[start] = (size, weight)
        # one sweep: a phrase covers its words' first letters; the blank after it begins the next word
        excused.sort(reverse=True)
        kept, reach = [], -1
        for start in sorted(best):
            while excused and excused[-1][0] <= start:
                reach = max(reach, excused.pop()[1] - 1)
            if start >= reach:
                kept.append((start, best[start][1]))
        return kept

    def features(self, text: str | None) -> list[float]:
        folded = fold(text)
        found, words = self.hits(folded), folded.count(" ") - 1
        total = sum(found)
        return [float(np.log1p(100 * total / max(words, 20))), float(np.log1p(total)), float(len(found) > 1), float(np.log1p(words)) / 10]

    def score(self, text: str | None) -> float:
        if self.curve is None:
            return 0.0
        z = sum(w * x for w, x in zip(self.curve, [*self.features(text), 1.0], strict=True))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def surprise(a: int, b: int, n_a: int, n_b: int) -> float:
    """Likelihood ratio statistic of a of n_a texts and b of n_b holding a form, against one share for all."""

    def part(k: int, n: int) -> float:
        return k * log(k / n) if k else 0.0

    return 2 * (part(a, n_a) + part(n_a - a, n_a) + part(b, n_b) + part(n_b - b, n_b) - part(a + b, n_a + n_b) - part(n_a + n_b - a - b, n_a + n_b))


def phrases(folded: str, lexicon: Lexicon) -> set[str]:
    """Pairs of neighbouring words of which one is hit."""
    out: set[str] = set()
    for start, _ in lexicon.places(folded):
        end = folded.index(" ", start + 1)
        before = folded.rfind(" ", 0, start)
        after = folded.find(" ", end + 1)
        if before >= 0:
            out.add(folded[before + 1 : end])
        if after >= 0:
            out.add(folded[start + 1 : after])
    return out


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps; the constant is the last weight."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS, most: int = MAX_ENTRIES) -> Lexicon:
    """Learn at most ``most`` entries, their weights and the curve from the ``rows`` labelled rows of least key hash."""
    want = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("k"), (F.col(label) > 0).cast("int").alias("y")).orderBy(F.xxhash64("k"), "k", "y").limit(rows)
    # at most ``rows`` pairs are broadcast
    known = stored(docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(want), "k").select("t", "y"), "toxic-train")

    kinds = pa.schema([("form", pa.string()), ("other", pa.int64()), ("toxic", pa.int64())])

    def counted(df: DataFrame, forms_of: Callable[[str], Iterable[str]]) -> DataFrame:
        """(form, other, toxic): texts of either kind that hold a form; the form "" counts all texts."""

        def tally(rows_: Iterator[tuple]) -> Iterator[tuple]:
            seen: dict[str, list[int]] = {"": [0, 0]}
            for t, y in rows_:
                for form in ("", *forms_of(fold(t))):
                    seen.setdefault(form, [0, 0])[y] += 1
            yield from ((f, *s) for f, s in seen.items())

        return map_rows(df, kinds, "form string, other long, toxic long", tally, ["t", "y"]).groupBy("form").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))

    def all_forms(folded: str) -> set[str]:
        return {c for w in set(folded.split()) for c in candidates(w)}

    # forms of toxic texts first, so that only those are counted elsewhere; the sample bounds both
    wanted = frozenset(counted(known.where("y = 1"), all_forms).where((F.col("toxic") >= MIN_TEXTS) & (F.col("form") != "")).select("form").toArrow()["form"].to_pylist())
    if not wanted:
        return Lexicon({})
    rows_ = {r["form"]: (r["toxic"], r["other"]) for r in counted(known, lambda folded: all_forms(folded) & wanted).collect()}
    n_toxic, n_other = rows_.pop("")
    entries: dict[str, float] = {}
    for form, (a, b) in rows_.items():
        ratio = ((a + 0.5) / (n_toxic + 1)) / ((b + 0.5) / (n_other + 1))
        if a >= MIN_TEXTS and ratio >= MIN_RATIO and surprise(a, b, n_toxic, n_other) >= MIN_SURPRISE:
            entries[form] = float(np.log(ratio))
    best = sorted(entries, key=lambda f: (-entries[f] * rows_[f][0], f))[:most]
    lexicon = Lexicon({f: entries[f] for f in sorted(best)})
    words = docs.sparkSession.sparkContext.broadcast(lexicon.entries)
    harmless = counted(known, lambda folded: phrases(folded, lexicon_of(words))).where((F.col("form") != "") & (F.col("other") >= MIN_HARMLESS))
    quiet = sorted(r["form"] for r in harmless.where(F.col("toxic") * max(n_other, 1) <= F.col("other") * max(n_toxic, 1)).collect())
    lexicon = Lexicon(lexicon.entries, tuple(quiet))
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.entries, lexicon.exceptions))

    def extract(rows__: Iterator[tuple]) -> Iterator[tuple]:
        own = Lexicon(*shared.value)
        for t, y in rows__:
            yield (*own.features(t), y)

    names = ["a", "b", "c", "d", "y"]
    got = map_rows(known, pa.schema([*((n, pa.float64()) for n in names[:4]), ("y", pa.int32())]), "a double, b double, c double, d double, y int", extract, ["t", "y"]).toArrow()
    x = np.column_stack([got[n].to_numpy() for n in names])
    # in one order, however the rows came
    x = x[np.lexsort(x.T)]
    lexicon.curve = fit_curve(x[:, :4], x[:, 4])
    return lexicon


def lexicon_of(words) -> Lexicon:
    """The lexicon of a broadcast's entries, built once a worker."""
    if getattr(lexicon_of, "of", None) is not words.value:
        lexicon_of.of, lexicon_of.built = words.value, Lexicon(words.value)
    return lexicon_of.built


def score_documents(docs: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "score") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.entries, lexicon.exceptions, lexicon.curve))

    def judge(rows: Iterator[tuple]) -> Iterator[float]:
        own = Lexicon(*shared.value)
        for (t,) in rows:
            yield own.score(t)

    return docs.withColumn(out, text_function(judge, "double")(F.col(text)))


def query(spark, sf_dir: str) -> DataFrame:
    """op7: toxicity of every document, learned from labels whose remainder mod 3 isn't 1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rest = remainder(F.col("doc_id"), 3)
    lexicon = train(docs, labels.where(rest != 1))
    return score_documents(docs, lexicon).select("doc_id", (rest == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
