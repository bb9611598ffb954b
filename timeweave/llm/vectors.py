"""Integer vectors: rows whose vectors are whole and finite, as floor(256 * x) packed in bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of at least this size have no integer in 64 bits.
TOO_LARGE = float(1 << 55)


def whole_vectors(df: DataFrame, vector: str, **columns: Column) -> tuple[DataFrame, int, int]:
    """(rows, length, greatest integer): ``columns`` and the vector as ``v``, an array of doubles.

    Left out: vectors that are null, empty, of another length than most (ties:
    the shorter is kept), or that hold an entry that is null, not finite, or too
    large for a 64-bit integer. Length 0 where nothing remains.
    """
    rows = df.select(*(c.alias(n) for n, c in columns.items()), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(f"v is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) >= {TOO_LARGE:.1f}D)")
    # one row a length that occurs, and of those the first
    shape = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(F.expr("aggregate(v, 0D, (a, x) -> greatest(a, abs(x)))")).alias("m")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not shape:
        return rows.limit(0), 0, 0
    return rows.where(F.size("v") == shape[0]["d"]), shape[0]["d"], int(256 * shape[0]["m"]) + 1


def kind(greatest: int) -> str:
    """The narrowest integers that hold values up to ``greatest`` on either side."""
    return next((k for k, bits in (("<i2", 15), ("<i4", 31)) if greatest < 1 << bits), "<i8")


def doubles(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def integers(column: pa.Array, d: int, greatest: int) -> np.ndarray:
    return np.floor(256 * doubles(column, d)).astype(kind(greatest))


def packed(x: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, d: int, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, d)
