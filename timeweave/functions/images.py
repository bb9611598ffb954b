"""Signals of pictures: hashes of any width, sharpness and structural similarity, on grids of grey pixels.

A picture is its grey pixels (binary, one byte each, row by row) and its width.
Arrow-batched: pictures of one shape are one stack of matrices, and resizing is
two products with a matrix of weights. A picture that is null, empty or doesn't
fill its rows has null signals, but a sharpness of zero.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

#: Pixels of a stack: bounds the memory of a step.
STACK = 1 << 22


def grey_pixels(values: Column) -> Column:
    """The bytes of an array of grey levels (cut to 0..255, null as 0)."""

    def run(rows: pa.Array) -> pa.Array:
        def bytes_of(v: list | None) -> bytes | None:
            return None if v is None else np.clip(np.nan_to_num(np.array(v, float)), 0, 255).astype(np.uint8).tobytes()

        return pa.array([bytes_of(v) for v in rows.to_pylist()], pa.binary())

    return arrow_udf(run, "binary")(values)


# ---------------------------------------------------------------- resizing


def _cubic(x: np.ndarray) -> np.ndarray:
    """The Catmull-Rom kernel (a = -1/2)."""
    x = np.abs(x)
    return np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0))


def _lanczos(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0)


KERNELS: dict[str, tuple[Callable[[np.ndarray], np.ndarray], float]] = {"cubic": (_cubic, 2), "lanczos": (_lanczos, 3)}


@lru_cache(maxsize=256)
def weights(size: int, to: int, kernel: str) -> np.ndarray:
    """(to, size): each new pixel's weights; the kernel widens with the step, so that shrinking averages whole areas."""
    shape, reach = KERNELS[kernel]
    step = size / to
    wide = max(step, 1)
    centre = (np.arange(to)[:, None] + 0.5) * step
    low = np.maximum(np.floor(centre - reach * wide + 0.5), 0)
    high = np.minimum(np.floor(centre + reach * wide + 0.5), size)
    at = np.arange(size)[None]
    w = np.where((at >= low) & (at < high), shape((at + 0.5 - centre) / wide), 0)
    return w / w.sum(1, keepdims=True)


def resized(stack: np.ndarray, height: int, width: int, kernel: str = "cubic") -> np.ndarray:
    """A stack (n, h, w) of grey pictures in another size, rounded to whole levels after each direction."""
    level = lambda x: np.clip(np.floor(x + 0.5), 0, 255)
    out = stack.astype(float)
    if stack.shape[2] != width:
        out = level(out @ weights(stack.shape[2], width, kernel).T)
    if stack.shape[1] != height:
        out = level(weights(stack.shape[1], height, kernel) @ out)
    return out


# ---------------------------------------------------------------- kernels on stacks


def average_bits(stack: np.ndarray, size: int, crop: float) -> np.ndarray:
    """Bits of a centre crop in size x size: lighter than its mean."""
    _, h, w = stack.shape
    left, right, top, bottom = (int(n * (1 + s * crop) / 2) for n, s in ((w, -1), (w, 1), (h, -1), (h, 1)))
    small = resized(stack[:, top:bottom, left:right], size, size)
    return (small > small.mean((1, 2), keepdims=True)).reshape(len(stack), -1)


def difference_bits(stack: np.ndarray, size: int) -> np.ndarray:
    """Bits of the whole picture in size rows of size + 1: lighter than the pixel to the left."""
    small = resized(stack, size, size + 1, "lanczos")
    return (small[:, :, 1:] > small[:, :, :-1]).reshape(len(stack), -1)


def laplacian_variances(stack: np.ndarray, most: int) -> np.ndarray:
    """Variance of the 3 x 3 Laplacian of pictures at most ``most`` wide; 0 under three pixels."""
    _, h, w = stack.shape
    if w > most:
        stack = resized(stack, max(1, int(h * most / w)), most)
    if min(stack.shape[1:]) < 3:
        return np.zeros(len(stack))
    x = stack.astype(float)
    out = x[:, 1:-1, :-2] + x[:, 1:-1, 2:] + x[:, :-2, 1:-1] + x[:, 2:, 1:-1] - 4 * x[:, 1:-1, 1:-1]
    return out.var((1, 2))


def _window_sums(x: np.ndarray, win: int) -> np.ndarray:
    """Sums over all win x win windows, by summed-area tables."""
    area = np.zeros((len(x), x.shape[1] + 1, x.shape[2] + 1))
    np.cumsum(np.cumsum(x, axis=1), axis=2, out=area[:, 1:, 1:])
    return area[:, win:, win:] - area[:, :-win, win:] - area[:, win:, :-win] + area[:, :-win, :-win]


def structural_similarities(a: np.ndarray, b: np.ndarray, win: int = 7, span: float = 255) -> np.ndarray:
    """Mean structural similarity of two stacks: uniform windows wholly inside, sample covariances, constants 0.01 and 0.03."""
    n = win * win
    a, b = a.astype(float), b.astype(float)
    ma, mb = _window_sums(a, win) / n, _window_sums(b, win) / n
    va, vb, vab = ((_window_sums(p * q, win) / n - mp * mq) * n / (n - 1) for p, q, mp, mq in ((a, a, ma, ma), (b, b, mb, mb), (a, b, ma, mb)))
    c1, c2 = (0.01 * span) ** 2, (0.03 * span) ** 2
    return ((2 * ma * mb + c1) * (2 * vab + c2) / ((ma * ma + mb * mb + c1) * (va + vb + c2))).mean((1, 2))


# ---------------------------------------------------------------- columns


def _stacks(pictures: list[tuple[pa.Array, pa.Array]]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Places in a batch and stacks of pixels, for rows whose pictures (one or several columns) are whole, by shape."""
    shapes: dict[tuple, list[int]] = {}
    columns = [(p.to_pylist(), w.to_pylist()) for p, w in pictures]
    for at in range(len(columns[0][0])):
        shape = []
        for pixels, widths in columns:
            p, w = pixels[at], widths[at]
            shape.append((len(p) // w, w) if p and w and w > 0 and len(p) % w == 0 else None)
        if None not in shape:
            shapes.setdefault(tuple(shape), []).append(at)
    for shape, places in shapes.items():
        step = max(1, STACK // max(h * w for h, w in shape))
        for first in range(0, len(places), step):
            part = places[first : first + step]
            yield part, [np.frombuffer(b"".join(pixels[at] for at in part), np.uint8).reshape(len(part), h, w) for (pixels, _), (h, w) in zip(columns, shape, strict=True)]


def _signal(fn: Callable[..., list], ddl: str, kind: pa.DataType, missing=None) -> Callable[..., Column]:
    def run(*columns: pa.Array) -> pa.Array:
        out = [missing] * len(columns[0])
        for places, stacks in _stacks(list(zip(columns[::2], columns[1::2], strict=True))):
            for at, value in zip(places, fn(*stacks), strict=True):
                out[at] = value
        return pa.array(out, kind)

    def one(pixels: pa.Array, width: pa.Array) -> pa.Array:
        return run(pixels, width)

    def two(pixels: pa.Array, width: pa.Array, other: pa.Array, other_width: pa.Array) -> pa.Array:
        return run(pixels, width, other, other_width)

    return lambda *c: arrow_udf(two if len(c) == 4 else one, ddl)(*(c if len(c) == 4 else (c[0], c[1].cast("int"))))


def _packed(bits: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in np.packbits(bits, axis=1)]


def average_hash(pixels: Column, width: Column, size: int = 32, crop: float = 0.65) -> Column:
    """size x size bits, as bytes, of the centre of a picture: those lighter than its mean."""

    def bits(stack: np.ndarray) -> list:
        if min(int(n * (1 + crop) / 2) - int(n * (1 - crop) / 2) for n in stack.shape[1:]) < 1:
            return [None] * len(stack)
        return _packed(average_bits(stack, size, crop))

    return _signal(bits, "binary", pa.binary())(pixels, width)


def difference_hash(pixels: Column, width: Column, size: int = 8) -> Column:
    """size x size bits, as bytes, of the whole picture: those lighter than their left neighbour."""
    return _signal(lambda stack: _packed(difference_bits(stack, size)), "binary", pa.binary())(pixels, width)


def laplacian_variance(pixels: Column, width: Column, most: int = 512) -> Column:
    """Sharpness: variance of the Laplacian, to two places; 0 for small and unreadable pictures."""
    return _signal(lambda stack: [round(float(v), 2) for v in laplacian_variances(stack, most)], "double", pa.float64(), 0.0)(pixels, width)


def structural_similarity(pixels: Column, width: Column, other: Column, other_width: Column, size: int | None = 256) -> Column:
    """Structural similarity of two pictures, both first made size x size (None: as they are; null unless of one shape, 7 pixels at least)."""

    def similar(a: np.ndarray, b: np.ndarray) -> list:
        if size:
            a, b = resized(a, size, size), resized(b, size, size)
        if a.shape != b.shape or min(a.shape[1:]) < 7:
            return [None] * len(a)
        return structural_similarities(a, b).tolist()

    return _signal(similar, "double", pa.float64())(pixels, width.cast("int"), other, other_width.cast("int"))


def changed_fraction(pixels: Column, width: Column, other: Column, other_width: Column, delta: int = 24, height: int = 180, wide: int = 320) -> Column:
    """Share of pixels whose grey moved by more than ``delta``, both pictures made wide x height."""

    def moved(a: np.ndarray, b: np.ndarray) -> list:
        return (np.abs(resized(a, height, wide) - resized(b, height, wide)) > delta).mean((1, 2)).tolist()

    return _signal(moved, "double", pa.float64())(pixels, width.cast("int"), other, other_width.cast("int"))


def hamming_bytes(a: Column, b: Column) -> Column:
    """Bits that differ between two hashes of equal length of any width; null for unequal ones."""

    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        out = [None if p is None or q is None or len(p) != len(q) else (int.from_bytes(p) ^ int.from_bytes(q)).bit_count() for p, q in zip(x.to_pylist(), y.to_pylist(), strict=True)]
        return pa.array(out, pa.int32())

    return arrow_udf(run, "int")(a, b)


# ---------------------------------------------------------------- ink profiles

# Ink levels and gaps (shares of the height) that are tried in turn, and the least band that is a slide.
LEVELS, GAPS, LEAST_ROWS, LEAST_COLUMNS = (5, 8, 12, 18, 25, 35), (0.015, 0.025, 0.04), 0.06, 0.10

_BAND = pa.struct([("start", pa.float64()), ("end", pa.float64())])
_GRID = pa.struct([("rows", pa.list_(_BAND)), ("cols", pa.list_(_BAND))])


def bands(inked: np.ndarray, gap: int) -> list[tuple[int, int]]:
    """Runs of true with fewer than ``gap`` false between them as one; a shorter gap at the end belongs to the last."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inked.view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return []
    apart = starts[1:] - ends[:-1] >= max(gap, 1)
    starts, ends = starts[np.append(True, apart)], ends[np.append(apart, True)]
    if len(inked) - ends[-1] < gap:
        ends[-1] = len(inked)
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def grid(rows: np.ndarray, cols: np.ndarray, expected: tuple[int | None, int | None] = (None, None)) -> tuple[list, list] | None:
    """Row and column bands of a page from its ink profiles: the first setting of level and gap that scores best, None if none finds both."""
    h, w = len(rows), len(cols)
    best, found = -np.inf, None
    for level in LEVELS:
        for share in GAPS:
            gap = int(share * h)
            down = [b for b in bands(rows > level, gap) if b[1] - b[0] > LEAST_ROWS * h]
            across = [b for b in bands(cols > level, max(gap, int(GAPS[0] * w))) if b[1] - b[0] > LEAST_COLUMNS * w]
            if down and across:
                off = sum(abs(len(got) - n) for got, n in zip((down, across), expected, strict=True) if n is not None)
                score = 5 * (len(down) <= 4 and len(across) <= 4) - 10 * off
                if score > best:
                    best, found = score, (down, across)
    return found


def page_grid(pixels: Column, width: Column, rows: int | None = None, cols: int | None = None) -> Column:
    """Bands of slides on a page as shares of its height and width (struct rows, cols); null where none is found."""

    def find(stack: np.ndarray) -> list:
        _, h, w = stack.shape
        out = []
        for down, across in zip(255 - stack.mean(2), 255 - stack.mean(1), strict=True):
            got = grid(down, across, (rows, cols))
            out.append(None if got is None else {k: [{"start": a / n, "end": b / n} for a, b in side] for k, side, n in zip(("rows", "cols"), got, (h, w), strict=True)})
        return out

    band = "array<struct<start:double,end:double>>"
    return _signal(find, f"struct<rows:{band},cols:{band}>", _GRID)(pixels, width)
