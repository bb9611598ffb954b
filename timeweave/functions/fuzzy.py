"""Fuzzy search of short keywords in texts, by the best aligned stretch. Arrow-batched."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .text import word_start_hit

# The least score of each kind of keyword, and the length up to which keywords must match exactly.
LEAST = {"drug": 90.0, "medical_term": 85.0, "general": 88.0}
EXACT = 7


def common(masks: dict[str, int], size: int, text: str) -> int:
    """Length of the longest common subsequence of the masked string and ``text``, all places of one at a time in bits."""
    full = (1 << size) - 1
    v = full
    for c in text:
        u = v & masks.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def partial_ratio(a: str | None, b: str | None) -> float:
    """0..100: how alike the shorter string is to the stretch of the longer one that fits it best.

    Likeness is 200 * common subsequence / both lengths; stretches are all of
    the shorter one's length, and shorter ones at either end. 0 when one is empty.
    """
    short, long = sorted((a or "", b or ""), key=len)
    if not short:
        return 0.0
    if short in long:
        return 100.0
    masks: dict[str, int] = {}
    for i, c in enumerate(short):
        masks[c] = masks.get(c, 0) | 1 << i
    n, best = len(short), 0.0
    for end in range(1, len(long) + n):
        piece = long[max(0, end - n) : end]
        # no stretch is better than its characters that occur at all
        if 200 * min(len(piece), n) / (n + len(piece)) > best and (piece[-1] in masks or piece[0] in masks):
            best = max(best, 200 * common(masks, n, piece) / (n + len(piece)))
    return best


def _ratio(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([partial_ratio(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.float64())


def subset_ratio(a: Column, b: Column) -> Column:
    """0..1: how far one text lies within the other; 0 when one is blank."""
    return arrow_udf(_ratio, "double")(F.trim(F.coalesce(a, F.lit(""))), F.trim(F.coalesce(b, F.lit("")))) / 100


def keyword_score(text: Column, keyword: Column) -> Column:
    return arrow_udf(_ratio, "double")(F.lower(text), F.lower(keyword))


def keyword_hit(text: Column, keyword: Column, kind: Column) -> Column:
    """Whether a keyword is heard in one segment: short ones at a word's start, longer ones by the score that their kind needs."""
    needed = F.lit(None).cast("double")
    for name, least in LEAST.items():
        needed = F.when(kind == name, least).otherwise(needed)
    return F.when(F.length(keyword) <= EXACT, word_start_hit(text, keyword)).otherwise(keyword_score(text, keyword) >= needed)
