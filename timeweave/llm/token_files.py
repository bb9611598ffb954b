"""Token ids in patched frame-of-reference blocks, written in key order and read back.

A shard holds the documents of one key range, in ascending order, as segments;
a segment is one binary value: header, document lengths, block index, packed
blocks, exception lists. A block holds ``BLOCK`` ids: its minimum is subtracted,
the rest is packed at the width that ``PERCENTILE`` of them fit in, and the
others are stored as exceptions (position, full difference). The index gives
each block's first byte, by which ``read_ids`` unpacks the blocks of a range of
ids alone. Segments are rows of a Parquet table, so that Spark's writers commit
them on any shared store.

Defined results: null and empty texts have the end id only; rows with a null key
come first, rows with equal keys are ordered by their texts. The vocabulary's
added tokens in a text get their own ids, as the library gives them by default.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stored

BLOCK, PERCENTILE = 128, 0.98
#: Ids in a segment, unless one document has more.
SEGMENT = 1 << 18
MAGIC = b"PFR1"
#: Words of one generation of a worker's memory (about 150 bytes each); it holds two.
KEPT = 600_000


# ---------------------------------------------------------------- blocks


def pack(ids: np.ndarray) -> bytes:
    """uint32 ids to blocks: count, index, packed area, exceptions."""
    n = len(ids)
    nb = -(-n // BLOCK)
    x = np.empty(nb * BLOCK, np.uint32)
    x[:n] = ids
    x[n:] = ids[-1] if n else 0
    x = x.reshape(nb, BLOCK)
    low = x.min(axis=1) if nb else np.zeros(0, np.uint32)
    off = x - low[:, None]
    bits = np.frexp(np.partition(off, int(PERCENTILE * (BLOCK - 1)), axis=1)[:, int(PERCENTILE * (BLOCK - 1))].astype(np.float64))[1].astype(np.uint8) if nb else np.zeros(0, np.uint8)
    size = bits.astype(np.int64) * (BLOCK // 8)
    first = np.concatenate(([0], np.cumsum(size)))
    area = np.zeros(int(first[-1]), np.uint8)
    out = off > ((np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    for w in np.unique(bits).tolist():
        if w:
            rows = np.flatnonzero(bits == w)
            wide = 16 if w <= 16 else 32
            v = (off[rows] & np.uint32((1 << w) - 1)).astype(f">u{wide // 8}").view(np.uint8).reshape(len(rows), BLOCK, wide // 8)
            # whole words need no shifting of bits
            packed = v.reshape(len(rows), -1) if w == wide else np.packbits(np.unpackbits(v, axis=2)[:, :, wide - w :].reshape(len(rows), -1), axis=1)
            area[(first[rows][:, None] + np.arange(packed.shape[1])).ravel()] = packed.ravel()
    block, place = np.nonzero(out)
    parts = [low.astype("<u4"), bits, first[:-1].astype("<u4"), np.bincount(block, minlength=nb).astype(np.uint8), area, place.astype(np.uint8), off[out].astype("<u4")]
    return struct.pack("<QQQ", n, len(area), len(place)) + b"".join(p.tobytes() for p in parts)


def unpack(data: bytes) -> np.ndarray:
    n, area_size, n_out = struct.unpack_from("<QQQ", data)
    nb = -(-n // BLOCK)
    at = 24

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        a = np.frombuffer(data, kind, count, at)
        at += a.nbytes
        return a

    low, bits, first, outs = take("<u4", nb), take("u1", nb), take("<u4", nb), take("u1", nb)
    area, place, value = take("u1", area_size), take("u1", n_out), take("<u4", n_out)
    off = np.zeros((nb, BLOCK), np.uint32)
    for w in np.unique(bits).tolist():
        if w:
            rows = np.flatnonzero(bits == w)
            raw = area[(first[rows].astype(np.int64)[:, None] + np.arange(w * BLOCK // 8)).ravel()].reshape(len(rows), -1)
            wide = 16 if w <= 16 else 32
            if w == wide:
                off[rows] = raw.view(f">u{wide // 8}")
                continue
            b = np.zeros((len(rows), BLOCK, wide), np.uint8)
            b[:, :, wide - w :] = np.unpackbits(raw, axis=1).reshape(len(rows), BLOCK, w)
            off[rows] = np.packbits(b, axis=2).view(f">u{wide // 8}")[:, :, 0]
    off[np.repeat(np.arange(nb), outs), place] = value
    return (off + low[:, None]).ravel()[:n]


def unpack_block(data: bytes, b: int) -> np.ndarray:
    """The ids of block ``b`` alone, found through the index."""
    n, area_size, n_out = struct.unpack_from("<QQQ", data)
    nb = -(-n // BLOCK)
    if not 0 <= b < nb:
        raise IndexError(f"block {b} of {nb}")
    lows, widths, firsts, counts = 24, 24 + 4 * nb, 24 + 5 * nb, 24 + 9 * nb
    area, w = 24 + 10 * nb, data[widths + b]
    off = np.zeros(BLOCK, np.uint32)
    if w:
        (first,) = struct.unpack_from("<I", data, firsts + 4 * b)
        wide = 16 if w <= 16 else 32
        bits = np.zeros((BLOCK, wide), np.uint8)
        bits[:, wide - w :] = np.unpackbits(np.frombuffer(data, np.uint8, w * BLOCK // 8, area + first)).reshape(BLOCK, w)
        off[:] = np.packbits(bits, axis=1).view(f">u{wide // 8}")[:, 0]
    before = int(np.frombuffer(data, np.uint8, b, counts).sum(dtype=np.int64))
    places, values = area + area_size, area + area_size + n_out
    off[np.frombuffer(data, np.uint8, data[counts + b], places + before)] = np.frombuffer(data, "<u4", data[counts + b], values + 4 * before)
    (low,) = struct.unpack_from("<I", data, lows + 4 * b)
    return (off + np.uint32(low))[: n - b * BLOCK]


def read_ids(segment_: bytes, start: int, count: int) -> np.ndarray:
    """``count`` ids of a segment from its id ``start`` on, unpacking the blocks that hold them and no others."""
    data = segment_[_header(segment_)[1] :]
    blocks = range(start // BLOCK, -(-(start + count) // BLOCK))
    return np.concatenate([np.zeros(0, np.uint32), *(unpack_block(data, b) for b in blocks)])[start % BLOCK :][:count]


def _header(data: bytes) -> tuple[int, int]:
    """Documents of a segment, and where its blocks begin."""
    if data[:4] != MAGIC:
        raise ValueError("not a segment of packed token ids")
    (n,) = struct.unpack_from("<Q", data, 4)
    return n, 12 + 13 * n


def segment(keys: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    known = np.array([k is not None for k in keys], np.uint8)
    keyed = np.array([k or 0 for k in keys], "<i8")
    return MAGIC + struct.pack("<Q", len(keys)) + known.tobytes() + keyed.tobytes() + np.array(lengths, "<u4").tobytes() + pack(ids)


def read_segment(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    n, blocks = _header(data)
    known, keyed = np.frombuffer(data, "u1", n, 12), np.frombuffer(data, "<i8", n, 12 + n)
    lengths = np.frombuffer(data, "<u4", n, 12 + 9 * n)
    keys = [k if has else None for k, has in zip(keyed.tolist(), known.tolist(), strict=True)]
    return keys, lengths, unpack(data[blocks:])


# ---------------------------------------------------------------- encoding


# The byte-level scheme's pattern; characters whose kinds all Unicode versions agree on, and the line feed.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
PLAIN = re.compile("[!-~\u00a1-\u00ac\u00ae-\u052f\n]+")
#: Stands before a word that no blank leads, where marks and line feeds are cut off their words (one byte, so that texts stay narrow).
BARE = "\x01"
STOPS = ".,"
# a stop that doesn't end a plain word or number: it may be one piece with the marks before it
JOINED = re.compile(f"[{STOPS}](?<![0-9A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af][{STOPS}])[ \n]")


class Words(dict):
    """Packed ids of words after a blank (``lead``) or at a text's start, encoded when first met.

    Of two generations of memory the older goes when the younger is full. A word
    that is empty or ends in white space has none: what follows decides there.
    """

    def __init__(self, own: Encoder, lead: str):
        self.own, self.lead, self.old, self.tokenize, self.one = own, lead, {}, own.tokenize, own.one
        self.mark = own.stand_in[32] if lead else ""

    def __missing__(self, word: str) -> bytes | None:
        ids = self.old.get(word)
        if ids is None:
            if word.isascii() and word.isalpha():
                one = self.one
                ids = b"".join([one[t.id] for t in self.tokenize(self.mark + word)])
            elif word[:1] == BARE:
                rest = word[1:]
                if rest != "\n" and (not rest or rest[0].isspace() or rest[-1].isspace()):
                    return None
                ids = self.own.marks[rest] if rest in "\n.,;:!?" else self.own.heads[rest]
            elif not word or word[-1].isspace():
                return None
            else:
                ids = self.composed(word)
                if "\n" in word:
                    return ids
        if len(self) >= KEPT:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def composed(self, word: str) -> bytes:
        own = self.own
        if not PLAIN.fullmatch(word):
            return b"".join([own.pack(p) for p, _ in own.split(self.lead + word)])
        if word.isalpha():
            return own.pack(self.mark + own.mapped(word))
        if word[-1] in ".,;:!?" and word[:-1].isalpha():
            return self[word[:-1]] + own.marks[word[-1]]
        before, line, after = word.partition("\n")
        if line and before and after and after[0] != "\n":
            return self[before] + own.marks[line] + own.heads[after]
        return b"".join([own.heads[p] if p.isalpha() else own.words[p[1:]] if p[0] == " " and p[1:].isalpha() else own.marks[p] for p in PIECES.findall(self.lead + word)])


class Marks(dict):
    """Packed ids of matches of the pattern that hold no letters; few differ, and more than KEPT are forgotten."""

    def __init__(self, own: Encoder):
        self.own = own

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        ids = self[piece] = self.own.pack(self.own.mapped(piece))
        return ids


def cut_apart(text: str) -> str:
    """``text`` with each stop before a blank, and each line feed, as a word of its own."""
    text = text.replace("\n", f" {BARE}\n {BARE}")
    for c in STOPS:
        text = text.replace(f"{c} ", f" {BARE}{c} ")
    return text


class Encoder:
    """The tokenizers library behind a memory of words.

    A text may be cut before any blank that follows a non-blank: every match of
    the byte-level pattern ends there. Texts with other white space before a
    blank, and those with added tokens, go to the library whole. Words of plain
    characters are cut by the pattern, so that their pieces are remembered too.
    """

    def __init__(self, path: str):
        # one thread a worker: Spark runs a worker a core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.one = [np.array([i], self.kind).tobytes() for i in range(self.library.get_vocab_size())]
        self.added = tuple(t.content for t in self.library.get_added_tokens_decoder().values())
        self.tokenize, self.split = self.library.model.tokenize, self.library.pre_tokenizer.pre_tokenize_str
        # The printable stand-in of each byte in byte-level vocabularies.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.stand_in = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*plain}))}
        self.words, self.heads, self.marks = Words(self, " "), Words(self, ""), Marks(self)

    def mapped(self, piece: str) -> str:
        """``piece`` with its bytes' stand-ins."""
        return piece.encode().decode("latin-1").translate(self.stand_in)

    def pack(self, mapped: str) -> bytes:
        """``mapped``: one match of the pattern, in stand-ins."""
        one = self.one
        return b"".join([one[t.id] for t in self.tokenize(mapped)])

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def packed(self, text: str | None) -> bytes:
        """Ids of ``text`` as an array of ``kind``."""
        if not text:
            return b""
        if not any(t in text for t in self.added):
            # with stops and line feeds apart, far fewer different words are met
            ids = self.joined(cut_apart(text)) if BARE not in text and not JOINED.search(text) else None
            if ids is None:
                ids = self.joined(text)
            if ids is not None:
                return ids
        return np.array(self.whole(text), self.kind).tobytes()

    def joined(self, text: str) -> bytes | None:
        """The words' ids; None where one has none of its own."""
        head, *rest = text.split(" ")
        parts = [self.heads[head], *map(self.words.__getitem__, rest)]
        return None if None in parts else b"".join(parts)

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), self.kind).tolist()


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def write_tokens(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text", shards: int | None = None) -> DataFrame:
    """Encode ``docs`` in ascending key order into packed segments: the written table (shard, at, n_ids, payload)."""
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    # texts of one key are dealt by their beginnings, in the order that they are sorted in
    ordered = rows.repartitionByRange(n, F.col("k").asc_nulls_first(), F.substring("t", 1, 64).asc_nulls_first()).sortWithinPartitions(F.col("k").asc_nulls_first(), "t")

    def encode(rows: Iterator[tuple]) -> Iterator[tuple]:
        own, shard, at = encoder(path), TaskContext.get().partitionId(), 0
        end, size = np.array([end_id], own.kind).tobytes(), own.kind.itemsize
        keys: list[int | None] = []
        lengths: list[int] = []
        parts: list[bytes] = []
        held = 0

        def packed() -> tuple:
            return shard, at, held, segment(keys, lengths, np.frombuffer(b"".join(parts), own.kind).astype(np.uint32))

        for k, t in rows:
            new = own.packed(t)
            keys.append(k)
            lengths.append(len(new) // size + 1)
            held += lengths[-1]
            parts += [new, end]
            if held >= SEGMENT:
                yield packed()
                at += held
                keys, lengths, parts, held = [], [], [], 0
        if keys:
            yield packed()

    kinds = pa.schema([("shard", pa.int32()), ("at", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())])
    return stored(map_rows(ordered, kinds, "shard int, at long, n_ids long, payload binary", encode, ["k", "t"], out_rows=4), "tokens")


def read_tokens(files: DataFrame, key: str = "doc_id") -> DataFrame:
    """Read segments back: per document its key, the ids before it, its number of ids and their crc32."""
    # one row a shard comes to the driver, as many as there are partitions
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    base, before = {}, 0
    for r in totals:
        base[r["shard"]] = before
        before += r["n"]

    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        for shard, at, payload in rows:
            keys, lengths, ids = read_segment(payload)
            here, raw, done = base[shard] + at, memoryview(ids.astype("<u4").tobytes()), 0
            for k, n in zip(keys, lengths.tolist(), strict=True):
                yield k, here + done, n, zlib.crc32(raw[4 * done : 4 * (done + n)])
                done += n

    kinds = pa.schema([(key, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    return map_rows(files, kinds, f"`{key}` long, start long, n_tokens long, ids_crc32 long", read, ["shard", "at", "payload"])


def query(spark, sf_dir: str) -> DataFrame:
    """op2: token files of every document, read back."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return read_tokens(write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2))
