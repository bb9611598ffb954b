"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections of a text.

A paragraph is a line with its line breaks. A section ends at a blank line, or
after a paragraph whose last hash says so. A paragraph is cut into pieces before
words, where the eight bytes before the word say so (at one word in eight on
average), so that an edit within a long paragraph stays an edit of a few pieces.
All cuts depend on the bytes next to them alone: what an edit doesn't touch is
cut as before. The pieces together are the whole text, so equal roots mean equal
texts, and from two roots downwards only branches that differ are opened: they
hold the edits.

A fingerprint writes the tree: the root (32 hexadecimal digits), a colon, and
eight digits of each piece's hash; a comma parts paragraphs, a semicolon
sections. Two fingerprints are as alike as twice the pieces that they share (as
bags) by the pieces of both; branches equal as a whole count without being
opened.

Defined results: null texts count as empty. An empty text has a root and no
pieces, is wholly like another empty one and unlike any other text. A run
without white space is one word, but characters from U+3000 on begin words.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, mix, stored, text_function

#: A word in so many begins a piece, a paragraph in so many ends a section.
WORDS, PARAGRAPHS = 8, 8
#: Bytes before a word that decide, bytes of a text whose cuts are found at once.
TAIL, STEP = 8, 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_WORD = re.compile(rb"(?<=[ \t-\r])(?=[^ \t-\r])|(?=[\xe3-\xf7])")
PIECE, PARAGRAPH, SECTION = 0, 1, 2


def _cuts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the pieces as byte offsets, and what ends there besides: a PARAGRAPH by a line break, a SECTION by a blank line."""
    ends, kinds, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while at < len(data):
        more = _WORD.search(data, at + STEP)
        stop = more.start() if more else len(data)
        low = max(0, at - TAIL)
        b = np.frombuffer(bytes(TAIL) * (not low) + data[low:stop], np.uint8)
        skip = at - low + TAIL * (not low)  # bytes of b before the step
        space = _SPACE[b]
        # words begin within the step, and where the next step does
        first = np.append(space[:-1] & ~space[1:] | (b[1:] >= 0xE3) & (b[1:] < 0xF8), True)
        spot = np.flatnonzero(first) + 1
        spot = spot[spot > skip]
        breaks = np.concatenate(([0], np.cumsum(b == 10, dtype=np.int32)))
        word_end = np.maximum.accumulate(np.where(space, 0, np.arange(1, len(b) + 1, dtype=np.int32)))
        lines = breaks[spot] - breaks[np.maximum(word_end[spot - 1], skip)]
        window = np.lib.stride_tricks.sliding_window_view(b, TAIL)[spot - TAIL]
        chosen = (lines > 0) | (mix(np.ascontiguousarray(window).view("<u8").ravel()) % np.uint64(WORDS) == 0)
        ends.append(spot[chosen] - skip + at)
        kinds.append(np.minimum(lines[chosen], SECTION))
        at = stop
    end, kind = np.concatenate(ends), np.concatenate(kinds)
    if data and (not len(end) or end[-1] != len(data)):
        end, kind = np.append(end, len(data)), np.append(kind, PIECE)
    return end, kind


@dataclass
class Node:
    """A section or paragraph: its hash, children (pieces' hashes at last) and the pieces before its end."""

    hash: bytes
    children: list
    end: int


@dataclass
class Tree:
    root: bytes
    sections: list[Node]
    ends: list[int]  # byte offsets of pieces

    def fingerprint(self) -> str:
        return self.root.hex() + ":" + ";".join(",".join(b"".join(h[:4] for h in p.children).hex() for p in s.children) for s in self.sections)


def _hash(kind: bytes, parts: list[bytes]) -> bytes:
    return blake2b(kind + b"".join(parts), digest_size=16).digest()


def tree(text: str | None) -> Tree:
    data = (text or "").encode("utf-8", "surrogatepass")
    ends, kinds = (x.tolist() for x in _cuts(data))
    sections: list[Node] = []
    paragraphs: list[Node] = []
    pieces: list[bytes] = []
    at = 0
    for n, (end, kind) in enumerate(zip(ends, kinds, strict=True), 1):
        pieces.append(blake2b(data[at:end], digest_size=16).digest())
        at = end
        if kind or end == len(data):
            paragraphs.append(Node(_hash(b"P", pieces), pieces, n))
            if kind == SECTION or end == len(data) or pieces[-1][0] % PARAGRAPHS == 0:
                sections.append(Node(_hash(b"S", [p.hash for p in paragraphs]), paragraphs, n))
                paragraphs = []
            pieces = []
    return Tree(_hash(b"T", [s.hash for s in sections]), sections, ends)


def fingerprint(text: str | None) -> str:
    return tree(text).fingerprint()


def _pieces(written: str) -> int:
    return (len(written) - written.count(",") - written.count(";")) // 8


def likeness(a: str, b: str) -> float:
    """From 0 to 1, of two fingerprints."""
    if a[:32] == b[:32]:
        return 1.0
    left, right = [a[33:]], [b[33:]]
    n, shared = _pieces(left[0]) + _pieces(right[0]), 0
    for split in (lambda x: x.split(";"), lambda x: x.split(","), lambda x: [x[i : i + 8] for i in range(0, len(x), 8)]):
        own, other = (Counter(part for x in side for part in split(x)) for side in (left, right))
        both = own & other
        shared += sum(_pieces(x) * c for x, c in both.items())
        left, right = list((own - both).elements()), list((other - both).elements())
    return 2 * shared / n


def _runs(a: list, b: list) -> Iterator[tuple[int, int, int, int]]:
    """Stretches of ``a`` and ``b`` between what they share in order: equal ends, then hashes that each holds once."""
    lo, ha, hb = 0, len(a), len(b)
    while lo < min(ha, hb) and a[lo] == b[lo]:
        lo += 1
    while ha > lo and hb > lo and a[ha - 1] == b[hb - 1]:
        ha, hb = ha - 1, hb - 1
    ca, cb = Counter(a[lo:ha]), Counter(b[lo:hb])
    place = {h: j for j, h in enumerate(b[lo:hb], lo) if cb[h] == 1 and ca[h] == 1}
    pairs = [(i, place[h]) for i, h in enumerate(a[lo:ha], lo) if h in place]
    # the longest rising sequence of places
    tops: list[int] = []
    held: list[int] = []
    back: list[int] = []
    for at, (_, j) in enumerate(pairs):
        k = bisect_left(tops, j)
        tops[k : k + 1], held[k : k + 1] = [j], [at]
        back.append(held[k - 1] if k else -1)
    chain, at = [], held[-1] if held else -1
    while at >= 0:
        chain.append(pairs[at])
        at = back[at]
    i, j = lo, lo
    for x, y in [*reversed(chain), (ha, hb)]:
        if x > i or y > j:
            yield i, x, j, y
        i, j = x + 1, y + 1


def edits(old: str | None, new: str | None) -> list[tuple[int, int, int, int]]:
    """(start, end, new start, new end) of the stretches of code points that differ, found from the roots downwards."""
    a, b = tree(old), tree(new)
    if a.root == b.root:
        return []
    data = [(t or "").encode("utf-8", "surrogatepass") for t in (old, new)]
    found = []

    def starts(nodes: list[Node], first: int) -> list[int]:
        return [first, *(x.end for x in nodes)]

    def descend(own: list, other: list, own_at: int, other_at: int) -> None:
        if not own or not other or isinstance(own[0], bytes):
            own_starts, other_starts = range(own_at, own_at + len(own) + 1), range(other_at, other_at + len(other) + 1)
            if own and isinstance(own[0], Node):
                own_starts = starts(own, own_at)
            if other and isinstance(other[0], Node):
                other_starts = starts(other, other_at)
            keys = [[x.hash if isinstance(x, Node) else x for x in side] for side in (own, other)]
            for i, x, j, y in _runs(*keys):
                found.append((own_starts[i], own_starts[x], other_starts[j], other_starts[y]))
            return
        own_starts, other_starts = starts(own, own_at), starts(other, other_at)
        for i, x, j, y in _runs([n.hash for n in own], [n.hash for n in other]):
            descend([c for n in own[i:x] for c in n.children], [c for n in other[j:y] for c in n.children], own_starts[i], other_starts[j])

    descend(a.sections, b.sections, 0, 0)
    offsets = []
    for t, d, cut in zip((a, b), data, zip(*((f[:2], f[2:]) for f in found), strict=True), strict=True):
        bounds = [0, *t.ends]
        chars = np.concatenate(([0], np.cumsum((np.frombuffer(d, np.uint8) & 0xC0) != 0x80)))
        offsets.append([(int(chars[bounds[p]]), int(chars[bounds[q]])) for p, q in cut])
    return [(*x, *y) for x, y in zip(*offsets, strict=True)]


# ---------------------------------------------------------------- columns and tables

def fingerprints(text: Column) -> Column:
    """The fingerprint of each text."""
    return text_function(lambda rows: (fingerprint(t) for (t,) in rows), "string")(text)


def likenesses(a: Column, b: Column) -> Column:
    """The likeness of two fingerprints, null where either is."""
    return text_function(lambda rows: (None if x is None or y is None else likeness(x, y) for x, y in rows), "double")(a, b)


def edit_spans(old: Column, new: Column) -> Column:
    """The stretches of code points that differ between two texts."""
    names = ("start", "end", "new_start", "new_end")
    return text_function(lambda rows: ([dict(zip(names, e, strict=True)) for e in edits(a, b)] for a, b in rows), "array<struct<start:long,end:long,new_start:long,new_end:long>>")(old, new)


_SCHEMA = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("key", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string())])
_DDL = "kind string, part int, key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, text string"


def _edited(part: int, key: int | None, text: str, mark: str, after: str, after_mark: str) -> tuple:
    half = len(text) // 2
    changed = text[: len(text) - half] + after[:half]
    changed_mark = fingerprint(changed)
    return "row", part, key, len(text), sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), mark, changed_mark, likeness(mark, changed_mark), likeness(mark, after_mark), None


def edited_by_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text's fingerprint, and that of the text with its second half replaced by the start of the next text in order of ``key``.

    Rows are dealt to sorted ranges, so that the next row is the next one read;
    only the last row of each range needs the first of another, and these few
    meet in a join. Rows of equal keys follow each other by a hash of their
    texts, null keys come last, and after the last row comes the first.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("key").asc_nulls_last(), F.col("h"), F.col("n")]
    # n splits a key that many equal rows share
    ranged = rows.withColumns({"h": F.xxhash64("text"), "n": F.monotonically_increasing_id()}).repartitionByRange(*order).sortWithinPartitions(*order)

    def walk(rows: Iterator[tuple]) -> Iterator[tuple]:
        part, held = TaskContext.get().partitionId(), None
        for k, t in rows:
            mark = fingerprint(t)
            yield ("first", part, k, None, None, mark, None, None, None, t) if held is None else _edited(part, *held, t, mark)
            held = k, t, mark
        if held:
            yield "last", part, held[0], None, None, held[2], None, None, None, held[1]

    def ends(rows: Iterator[tuple]) -> Iterator[tuple]:
        return (_edited(*r) for r in rows)

    walked = stored(map_rows(ranged, _SCHEMA, _DDL, walk, ["key", "text"]), "merkle-rows", compression="zstd")
    firsts = walked.where("kind = 'first'").select(F.col("part").alias("to"), F.col("text").alias("after"), F.col("fingerprint").alias("after_mark"))
    # one row a range
    places = walked.where("kind = 'first'").select("part").withColumn("next", F.lead("part").over(Window.orderBy("part")))
    lowest = walked.where("kind = 'first'").agg(F.min("part").alias("lowest"))
    places = places.crossJoin(lowest).select("part", F.coalesce("next", "lowest").alias("to"))
    edges = walked.where("kind = 'last'").select("part", "key", "text", "fingerprint").join(places, "part").join(firsts, "to")
    resolved = map_rows(edges, _SCHEMA, _DDL, ends, ["part", "key", "text", "fingerprint", "after", "after_mark"])
    out = walked.where("kind = 'row'").unionByName(resolved)
    return out.select(F.col("key").alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: fingerprints of all documents and of their edited texts."""
    return edited_by_next(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
