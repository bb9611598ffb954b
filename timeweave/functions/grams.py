"""Hashes of character n-grams, all of a batch's texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

_U = np.uint64
#: Characters of texts that are hashed at once.
STEP = 1 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def hashes(text: str, n: int) -> np.ndarray:
    """Of every run of n characters, in order; none for shorter texts."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(_U)
    size = len(codes) - n + 1
    if size < 1:
        return np.zeros(0, np.int64)
    out = np.zeros(size, _U)
    for i in range(n):
        out = _mixed(out + codes[i : i + size] + _U(0x9E3779B97F4A7C15))
    return out.view(np.int64)


def gram_hashes(text: Column, n: int) -> Column:
    """Array of the hashes of a text's n-grams; empty for null."""

    def run(texts: pa.Array) -> pa.Array:
        # texts side by side, so that short ones don't cost a call each; runs that cross a border are left out
        held = ["" if t is None else t for t in texts.to_pylist()]
        parts, at = [], 0
        while at < len(held):
            stop, size = at, 0
            while stop < len(held) and (stop == at or size + len(held[stop]) <= STEP):
                size, stop = size + len(held[stop]), stop + 1
            lengths = np.array([len(t) for t in held[at:stop]])
            found = hashes("".join(held[at:stop]), n)
            counts = np.maximum(lengths - n + 1, 0)
            starts = np.cumsum(lengths) - lengths
            kept = np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
            parts.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(found[kept])))
            at = stop
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    return arrow_udf(run, "array<long>")(text)
