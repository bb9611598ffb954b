"""Byte-level BPE encoding and decoding of whole texts, in overlapping chunks.

A text is cut into overlapping chunks of ``CHUNK`` characters that are
pre-tokenised in parallel; a text within one chunk is encoded where it lies.
Matching depends only on what follows a match's start, so two chunks agree from
the first boundary that both see; there the text is cut into pieces, each piece
is encoded on its own, and the pieces' ids are put together in order. A text
whose chunks never agree (one match longer than the overlap) is encoded whole.
Decoding concatenates the bytes of the ids.

Defined results: null and empty texts have no ids; equal texts (repeated rows)
get equal ids, and long ones are encoded once. A column named as the result is
replaced; all others stay.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free, map_rows, stored, text_function

CHUNK, OVERLAP = 1 << 14, 1 << 10
#: Rows of chunk boundaries (sha256, number, two positions: 100 bytes) that are broadcast; beyond it they are joined.
BROADCAST_ROWS = 500_000
#: Distinct pre-tokens whose ids a worker keeps.
KEPT = 200_000


class Pieces(dict):
    """Ids of pre-tokens, encoded when first met."""

    def __init__(self, encoding):
        self.encoding = encoding

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= KEPT:
            self.clear()
        ids = self[piece] = tuple(self.encoding.encode_ordinary(piece))
        return ids


class Codec:
    """Ranks from a file of ``base64 rank`` lines, with the pre-token pattern."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        # the library takes what it is given as one pre-token: texts are cut here
        self.pieces = Pieces(tiktoken.Encoding("own", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={}))
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.text = {rank: str(rank) for rank in ranks.values()}
        self.match = regex.compile(pattern)

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.match.findall(text)))) if text else []

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def boundaries(self, text: str, last: bool) -> list[int]:
        """Ends of the matches in ``text``; of a chunk that isn't the last, without those that its end may have cut."""
        return [e for e in (m.end() for m in self.match.finditer(text)) if last or e < len(text)]

    def row(self, ids: list[int], with_ids: bool) -> tuple:
        told = ",".join(map(self.text.__getitem__, ids))
        row = (len(ids), sha256(told.encode()).hexdigest(), sha256(self.decode(ids)).hexdigest())
        return (*row, ids) if with_ids else row


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "bpe", with_ids: bool = False, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` with a struct ``out``: n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256 and, on demand, ids."""
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def direct(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = codec(path, pattern)
        for (t,) in rows:
            yield own.row(own.encode(t), with_ids)

    rest = [c for c in docs.columns if c.lower() != out.lower()]
    is_long = F.coalesce(F.length(text), F.lit(0)) > chunk
    sha, row = free([*docs.columns, out], "sha"), free([*docs.columns, out], "row")
    short = docs.where(~is_long).withColumn(row, text_function(direct, fields)(F.col(text)))
    long_docs = docs.where(is_long).withColumn(sha, F.sha2(F.col(text), 256))
    coded = encode_long(long_docs.select(F.col(sha).alias("sha"), F.col(text).alias("text")), path, pattern, fields, with_ids, chunk, overlap)
    joined = long_docs.join(coded.select(F.col("sha").alias(sha), F.col("_row").alias(row)), sha)
    return short.select(*rest, F.col(row).alias(out)).unionByName(joined.select(*rest, F.col(row).alias(out)))


def encode_long(texts: DataFrame, path: str, pattern: str, fields: str, with_ids: bool, chunk: int, overlap: int) -> DataFrame:
    """Rows (sha, _row) of the distinct ``texts`` (sha, text), by overlapping chunks."""

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        seen: set[str] = set()
        for sha, t in rows:
            if sha in seen:
                continue
            seen.add(sha)
            for k, at in enumerate(range(0, len(t), chunk)):
                yield sha, k, at, at + chunk + overlap >= len(t), t[at : at + chunk + overlap]
                if at + chunk + overlap >= len(t):
                    break

    kinds = pa.schema([("sha", pa.string()), ("k", pa.int32()), ("at", pa.int64()), ("last", pa.bool_()), ("part", pa.string())])
    # copies in several partitions are merged chunk by chunk
    chunks = map_rows(texts, kinds, "sha string, k int, at long, last boolean, part string", cut, ["sha", "text"], out_rows=64).dropDuplicates(["sha", "k"])

    def ends(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = codec(path, pattern)
        for at, last, part in rows:
            seen = [at + e for e in own.boundaries(part, last)]
            yield [e for e in seen if e < at + overlap], [e for e in seen if e >= at + chunk]

    seen = stored(chunks.withColumn("ends", text_function(ends, "head array<long>, tail array<long>")("at", "last", "part")), "bpe-chunks")
    w = Window.partitionBy("sha").orderBy("k")
    # the first chunk starts at 0; each other one where it and the chunk before first agree
    joint = F.when(F.col("k") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect(F.lag("ends.tail").over(w), F.col("ends.head"))))
    starts = seen.select("sha", "k", "ends").withColumn("start", joint)
    spans = starts.withColumn("stop", F.lead("start").over(w)).withColumn("torn", F.max(F.col("start").isNull()).over(Window.partitionBy("sha"))).select("sha", "k", "start", "stop", "torn")
    spans = stored(spans, "bpe-spans")
    torn = spans.where("torn").select("sha").distinct()
    whole_spans = spans.where(~F.col("torn")).drop("torn")
    if spans.count() <= BROADCAST_ROWS:
        whole_spans = F.broadcast(whole_spans)

    def encode(rows: Iterator[tuple]) -> Iterator[list[int]]:
        own = codec(path, pattern)
        for part, at, start, stop in rows:
            yield own.encode(part[start - at : None if stop is None else stop - at])

    pieces = seen.select("sha", "k", "at", "part").join(whole_spans, ["sha", "k"])
    coded = pieces.select("sha", "k", text_function(encode, "array<int>")("part", "at", "start", "stop").alias("ids")).groupBy("sha").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))

    def digest(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = codec(path, pattern)
        for (ids,) in rows:
            yield own.row(ids, with_ids)

    coded = coded.select("sha", text_function(digest, fields)("ids").alias("_row"))
    if torn.isEmpty():
        return coded

    def whole(rows: Iterator[tuple]) -> Iterator[tuple]:
        own = codec(path, pattern)
        for (t,) in rows:
            yield own.row(own.encode(t), with_ids)

    once = texts.join(torn, "sha", "left_semi").dropDuplicates(["sha"])
    return coded.unionByName(once.select("sha", text_function(whole, fields)("text").alias("_row")))


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def query(spark, sf_dir: str) -> DataFrame:
    """op9: ids and decoded bytes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_documents(docs, *default_vocabulary()).select("doc_id", "bpe.*")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: the ids of every document that was kept."""
    return encode_documents(docs.select("doc_id", "text"), *default_vocabulary(), with_ids=True).select("doc_id", "bpe.*")
