"""Models behind one surface: named engines, honest errors when one isn't installed, retries and smaller batches."""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

from pyspark.sql import DataFrame

T = TypeVar("T")


class NotInstalled(RuntimeError):
    """The engine's library isn't here: nothing was processed, and nothing looks as if it were."""


class Transient(RuntimeError):
    """A failure that another try may mend; ``kind`` as in functions.text.transient_error."""

    def __init__(self, kind: str, status: int | None = None):
        super().__init__(f"{kind} {status or ''}".strip())
        self.kind, self.status = kind, status


#: Engines by name: the library that each needs, and a function that makes its ``texts -> answers`` function from that library.
_engines: dict[str, tuple[str, Callable]] = {}


def register(name: str, library: str, make: Callable) -> None:
    _engines[name] = (library, make)


def engine(name: str) -> Callable[[list], list]:
    """The engine's function from a list of inputs to a list of answers."""
    if name not in _engines:
        raise NotInstalled(f"no engine is named {name!r}; registered: {sorted(_engines) or 'none'}")
    library, make = _engines[name]
    try:
        return make(importlib.import_module(library))
    except ModuleNotFoundError as missing:
        if (missing.name or "").split(".")[0] != library.split(".")[0]:
            raise
        raise NotInstalled(f"engine {name!r} needs the library {library!r}, which isn't installed") from missing


def with_retries(call: Callable[[], T], tries: int = 3, base_s: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """``call``'s answer; after a transient failure it waits base_s, base_s squared, ... and tries again. Other failures aren't retried."""
    for n in range(1, tries + 1):
        try:
            return call()
        except Transient:
            if n == tries:
                raise
            sleep(base_s**n)
    raise ValueError("at least one try is needed")


def in_batches(items: Iterable, run: Callable[[list], list], sizes: tuple[int, ...] = (16, 8, 4, 2, 1)) -> Iterator:
    """Answers for all items in order; where a batch needs more memory than there is, the next smaller size is used from there on."""
    left, at = list(items), 0
    while left:
        try:
            yield from run(left[: sizes[at]])
            left = left[sizes[at] :]
        except MemoryError:
            if at + 1 == len(sizes):
                raise
            at += 1


def answers(df: DataFrame, name: str, key: str, value: str) -> DataFrame:
    """(key, answer): each value through the engine, within the workers; an engine that isn't installed is an error before any job runs."""
    engine(name)
    library, make = _engines[name]

    def run(batches):
        import pyarrow as pa

        made = make(importlib.import_module(library))
        for b in batches:
            out = [with_retries(lambda x=x: made([x])[0]) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], [key, "answer"])

    return df.select(key, value).mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, answer string")
