"""Work that can be stopped and taken up again, and updates that keep what was there.

Rows are dealt to parts by a hash of their key. Each part is written as a table
of its own and then entered into the manifest by one rename, so a part is either
finished or not there for a reader, and a rerun does exactly the parts that are
missing. All file operations go through Hadoop's file systems: any store that
Spark writes to will do.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class _Store:
    """A path's Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(path).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(folder))] if self.exists(folder) else []

    def rename(self, path: str, to: str) -> None:
        if not self.fs.rename(self._path(path), self._path(to)):
            raise OSError(f"{path} can't become {to}")

    def remove(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def copy(self, path: str, to: str) -> None:
        self.jvm.org.apache.hadoop.fs.FileUtil.copy(self.fs, self._path(path), self.fs, self._path(to), False, self.conf)

    def read(self, path: str) -> str:
        data = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
        finally:
            data.close()

    def commit(self, path: str, text: str) -> None:
        """Write a small file that is whole as soon as it is there."""
        own = f"{path}.{uuid.uuid4().hex}.tmp"
        out = self.fs.create(self._path(own), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.exists(path):  # another run was as fast: its file says the same
            self.remove(own)
        else:
            self.rename(own, path)


def _plan(store: _Store, path: str, plan: dict) -> None:
    """Enter the plan of a folder's parts, or compare it with the one that is there."""
    at = f"{path}/_manifest/plan.json"
    if store.exists(at):
        held = json.loads(store.read(at))
        if held != plan:
            raise ValueError(f"{path} holds parts of another plan: {held}, not {plan}")
    else:
        store.commit(at, json.dumps(plan))


def finished(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the parts in the manifest."""
    names = _Store(spark, path).names(f"{path}/_manifest")
    return sorted(int(n.removeprefix("part-")) for n in names if n.startswith("part-") and not n.endswith(".tmp"))


def process(df: DataFrame, key: str, path: str, work: Callable[[DataFrame], DataFrame], parts: int) -> Iterator[int]:
    """Do ``work`` on the rows of each part that isn't finished, in order; gives the number of each part done.

    Rows of one key are in one part (null keys too). ``work`` must depend on its
    part's rows alone. A part that was written but not entered is written anew.
    The number of parts and the key belong to the folder: other ones are an error.
    """
    spark = df.sparkSession
    store = _Store(spark, path)
    _plan(store, path, {"key": key, "parts": parts})
    done = set(finished(spark, path))
    for part in range(parts):
        if part not in done:
            rows = df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part)
            work(rows).write.mode("overwrite").parquet(f"{path}/data/part={part}")
            store.commit(f"{path}/_manifest/part-{part}", json.dumps({"finished": time.time()}))
            yield part


def result(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all finished parts; an error where there is none."""
    parts = finished(spark, path)
    if not parts:
        raise ValueError(f"{path} has no finished part")
    return spark.read.parquet(*(f"{path}/data/part={p}" for p in parts))


def update_in_place(df: DataFrame, path: str, kind: str = "parquet", dated: bool = False) -> str:
    """Replace the table at ``path`` by ``df``, which may be made from it; gives the path of the copy of what was there.

    The first update keeps the table as ``path.orig``, later ones leave that as
    it is; ``dated`` keeps one more for each update, by its time. The new rows are
    written whole beside the table before it goes, so a failed write leaves it.
    """
    store, stamp = _Store(df.sparkSession, path), time.strftime("%Y%m%d-%H%M%S")
    fresh, first = f"{path}.{uuid.uuid4().hex}.new", f"{path}.orig"
    df.write.format(kind).save(fresh)
    kept = first
    if store.exists(path):
        if not store.exists(first):
            whole = f"{first}.{uuid.uuid4().hex}.tmp"
            store.copy(path, whole)
            store.rename(whole, first)
        kept = f"{path}.{stamp}-{uuid.uuid4().hex[:6]}.bak" if dated else first
        gone = kept if dated else f"{path}.{uuid.uuid4().hex}.old"
        store.rename(path, gone)
        store.rename(fresh, path)
        if not dated:
            store.remove(gone)
    else:
        store.rename(fresh, path)
    return kept
