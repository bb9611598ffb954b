"""Degenerate repetition within a window's lines. Arrow-batched: one set of n-grams a window, without an array of them."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from .text import MARKS

_MARKS = re.compile(MARKS)
_INNER = re.compile(r"(.{3,14}?)\1{3,}")
_NUMBER = re.compile(r"[0-9%.]+")
# What a note's payload leaves out, in this order, and marks that begin a line.
FRONT_MATTER, EMBED, LINK, CITED_TIME, ADDRESS = r"^---\n.*?\n---\n", r"!\[\[[^\]]+\]\]", r"\[\[([^\]|]+)(\|[^\]]+)?\]\]", r"`?\([^()]{0,30}\d{1,2}:\d{2}\)`?", r"https?://\S+"
LINE_MARKS = r"^[\s>*\-#\d.、]+"
_FRONT, _MARKED, _BLANK = re.compile(FRONT_MATTER, re.S), re.compile(LINE_MARKS), re.compile(r"\s+")
_INSIDE = [(re.compile(p), to) for p, to in ((EMBED, ""), (LINK, r"\1"), (CITED_TIME, ""), (ADDRESS, ""))]
_REPEATS = pa.struct([("repeats", pa.int32()), ("diversity", pa.float64()), ("chars", pa.int64()), ("degenerate", pa.bool_())])
_KINDS = pa.struct([("max_line_repeats", pa.int32()), ("inline_repeat_count", pa.int32()), ("ngram_diversity", pa.float64()), ("loop", pa.bool_())])


def squashed(line: str) -> str:
    """The form for comparison: compatible forms unified, lower case, without white space and marks."""
    return _MARKS.sub("", unicodedata.normalize("NFKC", line).lower())


def repeats_inside(line: str) -> int:
    """The greatest number of times that a unit of 3 to 14 characters follows itself, 4 at least, else 0; numbers don't count."""
    return max((len(m[0]) // len(m[1]) for m in _INNER.finditer(line) if not _NUMBER.fullmatch(m[1])), default=0)


def squash(text: Column) -> Column:
    """The form for comparison (squashed); null stays null."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else squashed(t) for t in texts.to_pylist()], pa.string())

    return arrow_udf(run, "string")(text)


def squash_lines(lines: Column) -> Column:
    """The same of an array's lines."""

    def run(rows: pa.Array) -> pa.Array:
        parts = [pa.array([None if r is None else [None if x is None else squashed(x) for x in r] for r in rows.slice(at, 64).to_pylist()], pa.list_(pa.string())) for at in range(0, len(rows), 64)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return arrow_udf(run, "array<string>")(lines)


def payload(text: str) -> str:
    """A note without front matter, embeds, link syntax, cited times and addresses."""
    t = _FRONT.sub("", text, count=1)
    for pattern, to in _INSIDE:
        t = pattern.sub(to, t)
    return t


def payload_repetition(text: Column, repeats: int = 4, min_line: int = 12, n: int = 8, least: float = 0.70, min_chars: int = 500) -> Column:
    """Whether a note repeats itself: struct repeats, diversity, chars, degenerate.

    ``repeats`` counts the most frequent line of content: list marks, code marks
    and white space aside, ``min_line`` characters at least, no table row and no
    callout's head. ``diversity`` is the share of distinct character n-grams of
    the payload without white space (1 without any). Degenerate: a line that
    often, or a share under ``least`` in a payload of ``min_chars`` and more. A
    null note counts as empty.
    """

    def judge(note: str | None) -> dict:
        body = payload(note or "")
        lines: Counter = Counter()
        for line in body.split("\n"):
            bare = line.strip()
            if "|" not in bare and not bare.lstrip("> ").startswith("[!"):
                bare = _BLANK.sub("", _MARKED.sub("", bare).replace("`", ""))
                if len(bare) >= min_line:
                    lines[bare] += 1
        top = max(lines.values(), default=0)
        flat = _BLANK.sub("", body)
        grams = len(flat) - n + 1
        diversity = len({flat[i : i + n] for i in range(grams)}) / grams if grams > 0 else 1.0
        return {"repeats": top, "diversity": diversity, "chars": len(flat), "degenerate": top >= repeats or (len(flat) >= min_chars and diversity < least)}

    def run(notes: pa.Array) -> pa.Array:
        # a slice at a time: notes may be long
        parts = [pa.array([judge(t) for t in notes.slice(at, 64).to_pylist()], _REPEATS) for at in range(0, len(notes), 64)]
        return pa.concat_arrays(parts) if parts else pa.array([], _REPEATS)

    return arrow_udf(run, "repeats int, diversity double, chars long, degenerate boolean")(text)


def loop_info(lines: Column, min_chars: int = 4, n: int = 8, min_grams: int = 30, repeats: int = 3, least: float = 0.5, inline: bool = True) -> Column:
    """Degenerate repetition in a window's lines (an array), compared in their squashed form.

    A struct: the greatest count of one line (of ``min_chars`` and more), the
    greatest repeat inside a line (null unless ``inline``), the share of distinct
    character n-grams of all lines together (null with few of them), and whether
    any of them says loop. Null lines are left out; a null array has no lines.
    """

    def judge(window: list[str | None] | None) -> dict:
        flat = [squashed(x) for x in window or () if x is not None]
        top = max(Counter(x for x in flat if len(x) >= min_chars).values(), default=0)
        inner = max(map(repeats_inside, flat), default=0) if inline else None
        joined = "".join(flat)
        grams = len(joined) - n + 1
        diversity = len({joined[i : i + n] for i in range(grams)}) / grams if grams >= min_grams else None
        loop = top >= repeats or (inner or 0) >= 4 or (diversity is not None and diversity < least)
        return {"max_line_repeats": top, "inline_repeat_count": inner, "ngram_diversity": None if diversity is None else round(diversity, 3), "loop": loop}

    def run(windows: pa.Array) -> pa.Array:
        # a slice at a time: windows may be long
        parts = [pa.array([judge(w) for w in windows.slice(at, 64).to_pylist()], _KINDS) for at in range(0, len(windows), 64)]
        return pa.concat_arrays(parts) if parts else pa.array([], _KINDS)

    return arrow_udf(run, "max_line_repeats int, inline_repeat_count int, ngram_diversity double, loop boolean")(lines)
