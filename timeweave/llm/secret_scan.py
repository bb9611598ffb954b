"""Secret scan: fixed patterns, and a guess-cost program for values in credential context.

The patterns give the base spans. The method adds ``guess`` spans: a value that
stands in credential context but outside every base span, and whose cheapest
segmentation into known words, dates, repeats, keyboard walks and brute-force
spans still takes at least 10**MIN_LOG_GUESSES guesses. The cost program also
grades the values of the base assignments (``max_log_guesses``).

A value's guesses are the product of its segments' guesses and, for each
segment, of the number of kinds. A repeat takes the guesses of its unit's own
cheapest segmentation times the copies; a brute-force span ranges over the
character classes that it holds. The program finds the least product over all
segmentations, of values of any length, whole. Known words are a short list of
what guessers try first, followed by the corpus's own words by their number.

Defined results: null and empty texts have no spans; repeated rows are scanned
alike; a table without words leaves the short list.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from math import inf, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, text_function

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "guess")

#: Words before a value that make it a credential candidate.
CONTEXT = re.compile(
    r"""\b(?:password|passwd|passphrase|passcode|pwd|secret|token|credentials?|api[ _-]?key|access[ _-]?key|private[ _-]?key|auth(?:orization)?|login|bearer)["']?"""
    r"""(?:\s{0,3}(?:[:=]{1,2}>?|->)\s{0,3}(?:bearer\s{1,3})?|\s{1,3}(?:is|was)\s{0,3}[:=]?\s{0,3}|(?<=bearer)\s{1,3})["'`]?([^\s"'`<>,;]{8,})""",
    re.I | re.A,
)
#: Texts without any of these can't hold a context or an assignment.
CUES = ("passw", "passp", "passc", "pwd", "secret", "token", "credential", "api", "key", "auth", "login", "bearer")
MIN_LOG_GUESSES = 10.0
#: Words of the corpus that are known, the most frequent ones, and distinct words that a task counts before it passes them on.
CORPUS_WORDS, COUNTED = 20_000, 200_000

# Words that guessers try first, most likely first.
WORDS = """password admin welcome login master dragon monkey letmein qwerty iloveyou princess sunshine football baseball
shadow superman batman trustno hello freedom whatever michael jordan secret token example changeme default guest root user
test demo sample dummy none null true false required invalid missing expired reset your here value string hidden redacted
the and for with that this from have not you are was will can all one time people year day good new first last long great
little own other old right big high different small large next early young important few public bad same able love house
summer winter spring autumn monday tuesday wednesday thursday friday saturday sunday january february march april may june
july august september october november december pass key access private service server database""".split()
LEET = str.maketrans("013457@$!", "oleastasi")
# Neighbouring keys, row by row, and the two orders everyone knows.
WALKS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik9ol0p", "abcdefghijklmnopqrstuvwxyz")
STEPS = {p for w in WALKS for a, b in zip(w, w[1:], strict=False) for p in (a + b, b + a)}
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:19|20)?\d\d|(?:19|20)\d\d")


#: Units of repeats up to this long are costed at each of their rotations.
LONG_UNIT = 64

YEAR = re.compile(r"(?:19|20)\d\d")
WORD = re.compile("[a-z]{3,}")

#: Character classes, by the bits of a set of them, and how many characters each has.
SIZES = (10, 26, 26, 33, 100)
ALPHABETS = [log10(sum(n for i, n in enumerate(SIZES) if s >> i & 1)) if s else 0.0 for s in range(1 << len(SIZES))]
#: What a segment takes besides its own guesses: which of the five kinds it is.
KIND = log10(5)
DAYS, YEARS = log10(365 * 120), log10(120)
WALKING = log10(2 * sum(map(len, WALKS)))


def class_bit(c: str) -> int:
    """1 digit, 2 lower, 4 upper, 8 other ASCII, 16 beyond ASCII."""
    if not c.isascii():
        return 16
    return 1 if c.isdigit() else 2 if c.islower() else 4 if c.isupper() else 8


def runs(v: str) -> list[tuple[int, int, int]]:
    """(start, end, period) of the maximal stretches that repeat a unit at least twice, each with its least period."""
    n = len(v)
    codes = np.frombuffer(v.encode("utf-32-le", "surrogatepass"), np.uint32)
    found: list[tuple[int, int, int]] = []
    whole = 0  # least period of all of v
    for p in range(1, n // 2 + 1):
        if whole and p % whole == 0:
            continue
        step = max(1, p // 4)
        # a stretch of p equal pairs holds three sampled ones in a row
        same = codes[p::step] == codes[:-p:step]
        if p >= 4 and not (same[2:] & same[1:-1] & same[:-2]).any() or not same.any():
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([False], codes[p:] == codes[:-p], [False])).view(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if b - a >= p and not any(p % q == 0 and x <= a and b + p <= y for x, y, q in found):
                found.append((a, b + p, p))
                if b + p - a == n:
                    whole = p
    return found


class Costs:
    """Guess costs with the known ``words``, most likely first."""

    def __init__(self, words: Iterable[str] = WORDS):
        self.rank: dict[str, int] = {}
        for w in words:
            self.rank.setdefault(w, len(self.rank) + 1)
        self.lengths = sorted({len(w) for w in self.rank})
        self.log_guesses = lru_cache(4096)(self._log_guesses)

    def word(self, span: str) -> float | None:
        """log10 guesses of ``span`` as a known word, its case and its substituted letters guessed too."""
        low = span.lower()
        plain = low.translate(LEET)
        rank = self.rank.get(plain)
        if rank is None or len(low) != len(span):
            return None
        cased = 0.0 if span == low else log10(2) if span[1:] == low[1:] else (len(span) - 1) * log10(2)
        return log10(rank + 1) + cased + 0.3 * sum(a != b for a, b in zip(low, plain, strict=True))

    def _log_guesses(self, v: str) -> float:
        """log10 of the guesses that the cheapest segmentation of ``v`` takes."""
        n, low = len(v), v.lower()
        if len(low) != n:
            low = v
        bits = [class_bit(c) for c in v]
        held = 0
        for b in bits:
            held |= b
        sets = [s for s in range(1, held + 1) if s & held == s]
        best, brute = [0.0] + [inf] * n, dict.fromkeys(sets, inf)
        step_end = list(range(1, n + 1))  # end of the longest walk from each place
        for i in range(n - 2, -1, -1):
            if low[i : i + 2] in STEPS:
                step_end[i] = step_end[i + 1]
        # a long unit is costed as it first stands: what its rotations cost differs by the segment that the cut splits
        first_unit: dict[tuple[int, int], float] = {}
        opened: list[tuple[int, int, int, dict[int, list[tuple[float, int, float]]]]] = []
        waiting = sorted(runs(v), reverse=True)
        for i in range(n + 1):
            # repeats that end here: the copies since each start that is still worth keeping
            while waiting and waiting[-1][0] <= i:
                opened.append((*waiting.pop(), {}))
            if opened:
                opened = [r for r in opened if r[1] >= i]
            for _, _, p, starts in opened:
                for cost, at, until in starts.get(i % p, ()):
                    if at + max(3, 2 * p) <= i < until and (c := cost + log10((i - at) // p)) < best[i]:
                        best[i] = c
            if i == n:
                break
            here = best[i] + KIND
            for begin, end, p, starts in opened:
                first = i + max(3, 2 * p)
                if first <= end:
                    if p <= LONG_UNIT:
                        unit = self.log_guesses(v[i : i + p])
                    elif (begin, p) in first_unit:
                        unit = first_unit[begin, p]
                    else:
                        unit = first_unit[begin, p] = self.log_guesses(v[begin : begin + p])
                    cost, kept = here + unit, starts.get(i % p, [])
                    # an earlier start has more copies at any end, and the longer the end the less they matter:
                    # one that is no dearer at the first common end stays so, one that is dearer before its copies, too
                    if not any(c + log10((first - at) // p) <= cost + log10((first - i) // p) and first < until for c, at, until in kept):
                        starts[i % p] = [(c, at, min(until, first) if c >= cost else until) for c, at, until in kept if i < until] + [(cost, i, inf)]
            for s in sets:
                open_ = min(brute[s], here) + ALPHABETS[s] if bits[i] & s else inf
                brute[s] = open_
                if open_ < best[i + 1]:
                    best[i + 1] = open_
            for size in self.lengths:
                j = i + size
                if j > n:
                    break
                c = self.word(v[i:j])
                if c is not None and here + c < best[j]:
                    best[j] = here + c
            if v[i].isdigit():
                for j in range(i + 4, min(n, i + 10) + 1):
                    c = YEARS if YEAR.fullmatch(v, i, j) else DAYS if DATE.fullmatch(v, i, j) else inf
                    if here + c < best[j]:
                        best[j] = here + c
            for j in range(i + 3, step_end[i] + 1):
                c = here + WALKING + log10(j - i)
                if c < best[j]:
                    best[j] = c
        return best[n]


COSTS = Costs()


def learn_words(docs: DataFrame, text: str = "text", most: int = CORPUS_WORDS) -> list[str]:
    """The short list, and the ``most`` most frequent words of three letters or more in all documents."""

    def tally(rows: Iterator[tuple]) -> Iterator[tuple]:
        seen: Counter[str] = Counter()
        for (t,) in rows:
            if t:
                seen.update(WORD.findall(t.lower()))
                if len(seen) > COUNTED:
                    yield from seen.items()
                    seen.clear()
        yield from seen.items()

    counts = map_rows(docs, pa.schema([("w", pa.string()), ("n", pa.int64())]), "w string, n long", tally, [text], out_rows=1 << 14).groupBy("w").agg(F.sum("n").alias("n"))
    return [*WORDS, *counts.orderBy(F.desc("n"), "w").limit(most).select("w").toArrow()["w"].to_pylist()]


def secret_like(value: str, costs: Costs = COSTS) -> bool:
    """Costly to guess, and not a plain word: it mixes digits, cases or marks inside."""
    return (any(map(str.isdigit, value)) or (value != value.lower() and value[1:] != value[1:].lower() and value != value.upper())) and costs.log_guesses(value) >= MIN_LOG_GUESSES


def scan(text: str | None, costs: Costs = COSTS) -> tuple[list[tuple[str, int, int, int]], float]:
    """Spans (kind, start, end, start of the value itself), by start and then kind; and the costliest assigned value."""
    if not text:
        return [], 0.0
    found: list[tuple[str, int, int, int]] = []
    cost, low = 0.0, text.lower()
    cued = any(c in low for c in CUES)
    if cued:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_ASSIGN:
                found.append(("assign", m.start(), m.end(), m.start(2)))
                cost = max(cost, costs.log_guesses(m[2]))
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    if cued:
        taken = [(a, b) for _, a, b, _ in found]
        for m in CONTEXT.finditer(text):
            value = m[1].rstrip(".:!?)]}")
            a, b = m.start(1), m.start(1) + len(value)
            if len(value) >= 8 and not any(a < y and x < b for x, y in taken) and secret_like(value, costs):
                found.append(("guess", a, b, a))
                cost = max(cost, costs.log_guesses(value))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2])), cost


def redact(text: str, mark: str = "[SECRET]", costs: Costs = COSTS) -> str:
    """``text`` with the value of every span replaced by ``mark``; overlapping spans become one."""
    out, at = [], 0
    for a, b in sorted((v, end) for _, _, end, v in scan(text, costs)[0]):
        if a < at:
            if b > at:
                at = b
            continue
        out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]]) if out else text


def joined(spans: list[tuple[str, int, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans)


def _shared(docs: DataFrame, words: list[str]) -> Callable[[], Costs]:
    """The worker's costs over the ``words`` (their number is bounded)."""
    held = docs.sparkSession.sparkContext.broadcast(tuple(words))
    return lambda: costs_of(held.value)


@lru_cache(1)
def costs_of(words: tuple[str, ...]) -> Costs:
    return Costs(words)


def scan_documents(docs: DataFrame, text: str = "text", out: str = "secrets", words: list[str] | None = None) -> DataFrame:
    """``docs`` with a struct ``out``: counts by kind, digest of the base spans, all spans, greatest cost."""
    known = _shared(docs, learn_words(docs, text) if words is None else words)

    def judge(rows: Iterator[tuple]) -> Iterator[tuple]:
        costs = known()
        for (t,) in rows:
            spans, cost = scan(t, costs)
            n = [sum(s[0] == k for s in spans) for k in KINDS]
            base = joined([s for s in spans if s[0] != "guess"])
            yield (*n, sha256(base.encode()).hexdigest(), joined(spans), cost)

    kind = "n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string, max_log_guesses double"
    return docs.withColumn(out, text_function(judge, kind)(F.col(text)))


def redact_documents(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", words: list[str] | None = None) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced by ``mark``; null stays null."""
    known = _shared(docs, learn_words(docs, text) if words is None else words)

    def clean(rows: Iterator[tuple]) -> Iterator[str | None]:
        costs = known()
        for (t,) in rows:
            yield redact(t, mark, costs) if t else t

    return docs.withColumn(text, text_function(clean, "string")(F.col(text)))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: secrets of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan_documents(docs, out="_s").select("doc_id", "_s.*")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays, its secrets are masked and ``n_chars`` follows the text."""
    columns = docs.columns
    clean = redact_documents(docs)
    if "n_chars" in columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*columns)
