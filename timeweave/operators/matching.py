"""Names in texts: every name of a list found in every text in one pass."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of names that one automaton is built from (about forty times that in memory); more names take more passes.
SHARD_BYTES = 4 << 20
#: Finds of an output batch.
OUT_ROWS = 1 << 14

#: The automaton that this worker built last, by the search that it belongs to: later tasks use it again.
_built: dict[str, object] = {}


def _automaton(search: str, names: list[str]):
    if search not in _built:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for n in names:
            machine.add_word(n, n)
        machine.make_automaton()
        _built.clear()
        _built[search] = machine
    return _built[search]


def mentions(texts: DataFrame, ident: str, text: str, names: DataFrame, name: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(ident, name, pos): the first place, from 1, of every name that stands in a text.

    The distinct names are broadcast as an Aho-Corasick automaton; beyond
    ``shard_bytes`` they are dealt by hash into shards, each one pass over the
    texts, so that what is broadcast stays bounded. Empty and null names are
    found nowhere; null texts hold nothing.
    """
    known = names.select(F.col(name).alias("n")).where("n <> ''").distinct()
    size = known.agg(F.sum(F.octet_length("n"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    kind = dict(texts.dtypes)[ident]
    kinds = pa.schema([("i", to_arrow_type(texts.schema[ident].dataType)), ("n", pa.string()), ("p", pa.int32())])

    def found(shard: int) -> DataFrame:
        own = known if shards == 1 else known.where(F.pmod(F.xxhash64("n"), F.lit(shards)) == shard)
        shared = texts.sparkSession.sparkContext.broadcast(sorted(own.toArrow()["n"].to_pylist()))

        search = uuid.uuid4().hex

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            machine = _automaton(search, shared.value) if shared.value else None
            rows: list[tuple] = []
            for b in batches:
                for i, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    first: dict[str, int] = {}
                    for end, n in machine.iter(t) if t and machine else ():
                        first.setdefault(n, end - len(n) + 2)
                    rows += [(i, n, p) for n, p in first.items()]
                    if len(rows) >= OUT_ROWS:
                        yield batch(rows)
                        rows = []
            if rows:
                yield batch(rows)

        return texts.select(F.col(ident).alias("i"), F.col(text).alias("t")).mapInArrow(scan, f"i {kind}, n string, p int")

    return reduce(DataFrame.unionByName, map(found, range(shards))).select(F.col("i").alias(ident), F.col("n").alias(name), F.col("p").alias("pos"))
