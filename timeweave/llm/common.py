"""Shared parts of the operators: scratch storage, Arrow mapping, hashing of words."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.util import PythonEvalType

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None

#: Rows that a Python worker takes from an input batch at once, and turns into one output batch.
OUT_ROWS = 512
#: Bytes of an input slice, and characters or list entries of an output batch, beyond which fewer rows are taken.
SLICE_BYTES, OUT_WEIGHT = 4 << 20, 1 << 19
#: Rows of the batches that Spark sends to a Python worker: bounds its memory where texts are long.
IN_ROWS = 1024


# ---------------------------------------------------------------- scratch


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; where it is unset, a temporary one for a local master only."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root is None:
        held = sc._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="timeweave-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(root)
    return root


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the JVM may be gone already
        pass


#: Paths of the tables written within each open ``scratch`` block, innermost last.
_blocks: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored within the block are removed at its end, but for those kept."""
    _blocks.append([])
    try:
        yield
    finally:
        for path in _blocks.pop():
            _remove(spark, path)


def scratch_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A new path for a written intermediate table; it is removed when its ``scratch`` block or else the driver ends."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    if _blocks and not keep:
        _blocks[-1].append(path)
    else:
        atexit.register(_remove, spark, path)
    return path


def free(taken: Iterable[str], name: str) -> str:
    """``name``, lengthened until it differs from all of ``taken`` (column names are compared without case)."""
    held = {t.lower() for t in taken}
    while name.lower() in held:
        name += "_"
    return name


#: Where scratch lies on a mounted file system: no checksum files beside the tables, so fewer files and fewer
#: processes that Hadoop starts to set their modes. Other stores don't read these settings.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def stored(df: DataFrame, name: str, keep: bool = False, **options: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder, with the writer's ``options``, and read it back: lineage ends there."""
    path = scratch_path(df.sparkSession, name, keep)
    df.write.options(**PLAIN_FILES, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- Arrow mapping


def bounded_batches(spark: SparkSession) -> None:
    """Let the session send at most IN_ROWS rows at once to Python (a smaller setting stays)."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= IN_ROWS:
        spark.conf.set(name, IN_ROWS)


def map_rows(df: DataFrame, schema: pa.Schema, ddl: str, fn: Callable[[Iterator[tuple]], Iterator[tuple]], columns: list[str], out_rows: int = OUT_ROWS) -> DataFrame:
    """mapInArrow over ``columns``: ``fn`` maps an iterator of row tuples to output tuples, streamed in small batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for row in fn(in_rows(batches)):
            held.append(row)
            size += weight(row)
            if len(held) >= out_rows or size >= OUT_WEIGHT:
                yield to_batch(held, schema)
                held, size = [], 0
        if held:
            yield to_batch(held, schema)
        give_back()

    bounded_batches(df.sparkSession)
    return df.select(*columns).mapInArrow(run, ddl)


def map_arrays(df: DataFrame, schema: pa.Schema, ddl: str, fn: Callable[[Iterator[tuple]], Iterator[tuple]], columns: list[str], out_rows: int = 1 << 15) -> DataFrame:
    """As map_rows, for an ``fn`` that gives tuples of equally long arrays, one an output column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

        for part in fn(in_rows(batches)):
            held.append(part)
            size += len(part[0])
            if size >= out_rows:
                yield batch()
                held, size = [], 0
        if size:
            yield batch()
        give_back()

    bounded_batches(df.sparkSession)
    return df.select(*columns).mapInArrow(run, ddl)


def in_rows(batches: Iterator[pa.RecordBatch | list[pa.Array]]) -> Iterator[tuple]:
    """Rows of batches as tuples, a bounded slice at a time."""
    for b in batches:
        columns = b.columns if isinstance(b, pa.RecordBatch) else b
        n, size = len(columns[0]), sum(c.nbytes for c in columns)
        step = max(1, min(OUT_ROWS, n * SLICE_BYTES // max(size, 1)))
        for at in range(0, n, step):
            yield from zip(*(c.slice(at, step).to_pylist() for c in columns), strict=True)


def give_back() -> None:
    """Return the memory that a task has freed to the system: workers are reused, and other stages need it."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def weight(value) -> int:
    """Characters, bytes and list entries in a value or in the values of a tuple."""
    if isinstance(value, tuple):
        return sum(map(weight, value))
    return len(value) if isinstance(value, str | bytes | list) else 1


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


# ---------------------------------------------------------------- hashing

_U = np.uint64
_R = _U(0x9E3779B97F4A7C15)
_R_INV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_pows: tuple[np.ndarray, np.ndarray] = (np.ones(0, _U), np.ones(0, _U))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=_U) * _R)
_ODD = mix(np.arange(1, 65, dtype=_U)) | _U(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pows
    if len(_pows[0]) < n:
        m = max(n, 1 << 16)
        up, down = np.full(m, _R, _U), np.full(m, _R_INV, _U)
        up[0] = down[0] = 1
        _pows = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return _pows


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words ``[^ \\t-\\r]+`` of ``text`` with A-Z lower-cased, in order."""
    return bytes_word_hashes(text.encode("utf-8", "surrogatepass").lower()) if text else np.zeros(0, _U)


def bytes_word_hashes(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.zeros(0, _U)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[b], [True])).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = _powers(len(b))
    total = np.zeros(len(b) + 1, _U)
    np.cumsum(_BYTE[b] * up[: len(b)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; with fewer words, of the whole sequence; none without words."""
    n = len(words)
    if not n:
        return words
    k = min(n, size)
    out = np.full(n - k + 1, _U(n if n < size else 0), _U)
    for j in range(k):
        out += words[j : n - k + 1 + j] * _ODD[j]
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# ---------------------------------------------------------------- scalar functions


def text_function(fn: Callable[[Iterator[tuple]], Iterator[tuple | int | float | str | None]], ddl: str):
    """A column function that streams its argument columns through ``fn`` (an iterator of argument tuples to values).

    It is marked non-deterministic, so that a later filter doesn't compute it twice.
    """
    from pyspark.sql.functions import arrow_udf
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType

    kind = to_arrow_type(DataType.fromDDL(ddl))

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        sizes: list[int] = []

        def counted() -> Iterator[list[pa.Array]]:
            for b in batches:
                sizes.append(len(b[0]))
                yield list(b)

        held: list = []
        parts: list[pa.Array] = []
        left = 0
        names = [kind.field(i).name for i in range(kind.num_fields)] if pa.types.is_struct(kind) else None
        size = 0
        for value in fn(in_rows(counted())):
            if sizes:
                left += sizes.pop(0)
            held.append(dict(zip(names, value, strict=True)) if names and value is not None else value)
            size += weight(value)
            left -= 1
            if len(held) >= OUT_ROWS or size >= OUT_WEIGHT or left == 0:
                parts.append(pa.array(held, kind))
                held, size = [], 0
            if left == 0:
                yield pa.concat_arrays(parts)
                parts = []
        give_back()

    def wrap(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        return run(batches)

    def one(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run((b,) for b in batches)

    def column(*cols):
        bounded_batches(SparkSession.active())
        many = arrow_udf(wrap if len(cols) > 1 else one, DataType.fromDDL(ddl), PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF).asNondeterministic()
        return many(*cols)

    return column

