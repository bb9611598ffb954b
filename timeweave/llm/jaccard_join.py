"""Similarity join of documents on word n-grams by parity sketches.

A document is the set of its distinct shingles; documents with equal sets form a
class. Two classes link when 100 |A n B| >= THRESHOLD |A u B|. Then their set
sizes lie in the same or in neighbouring bands, and their symmetric difference
is at most d, which follows from the band.

* Pigeonhole keys: for a band, tokens are dealt into d + 1 + e buckets and each
  bucket's token hashes are XOR-ed. At most d buckets differ, so at least e + 1
  agree. Classes are joined on (band, bucket, XOR). Empty buckets give no key
  unless a class has more than e of them.
* A class leaves out its e most shared keys, less one for each empty bucket, in
  one order for all classes: of the e + 1 keys that linked classes share at
  least, the least shared one stays with both.
* Parity sketch: each token flips one of the sketch's bits, whose number follows
  the set's size; the Hamming distance of two sketches is at most the symmetric
  difference. Sketches of different sizes are folded to the smaller one.
* Pairs of a key aren't listed. Each class is first paired with the least class
  of the key that it shares most keys with. Then, in rounds, the members of each
  key whose components still differ are joined by the least spanning forest over
  the pairs that their sketches allow: fewer rows than members. Every round's
  pairs are verified on the whole sets and the components formed anew, until a
  round finds no link. What the sketches still allow between components after
  that (pairs just below the threshold) is listed once and verified.

Sets are computed where they are compared: no pair carries a text, and a class
with many partners is compared in blocks.

Defined results: texts without words (null, empty, blank) have an empty set and
link with nothing; documents with equal sets share a component; ids may repeat
or be null (a null id links like any other; a component's id is its least id
that isn't null, null if there is none).
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _U, free, map_arrays, map_rows, mix, shingle_hashes, signed, stored, word_hashes
from .components import components

SHINGLE, THRESHOLD = 4, 85
#: Least and greatest bits of a parity sketch, and its bits for each token that linked sets may differ in.
LEAST_BITS, MOST_BITS, BITS_PER_DIFFERENCE = 512, 1 << 16, 16
#: Classes compared by sketch in one cell (8 MB of sketches at most), and partners of a class verified in one.
BLOCK, PARTNERS = 512, 1024
#: Groups up to this many members are compared as one matrix.
SMALL = 48
#: Rows of wanted texts (24 bytes each) that are broadcast; beyond it they are joined.
BROADCAST_ROWS = 1_000_000


@lru_cache(8)
def bands(threshold: int, most: int = 1 << 40) -> tuple[int, ...]:
    """Least sizes of the bands: a set of one band can only link with sets of its own and the neighbouring bands."""
    low = [1]
    while low[-1] < most:
        low.append(low[-1] * 100 // threshold + 1)
    return tuple(low)


@lru_cache(1024)
def plan(band: int, threshold: int) -> tuple[int, int]:
    """d and the number of buckets for links whose smaller set lies in ``band``."""
    smaller = bands(threshold)[band + 1] - 1
    union = smaller * 100 // threshold
    d = union - -(-union * threshold // 100)
    return d, d + 1 + spare(d)


def spare(d: int) -> int:
    return 1 + d // 16 if d else 0


def shingle_set(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    return np.unique(shingle_hashes(word_hashes(text), size))


def class_of(shingles: np.ndarray) -> int:
    """64-bit name of the set."""
    if not len(shingles):
        return 0
    total = np.array([len(shingles)], _U) + mix(shingles ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U)
    return int(signed(mix(total))[0])


def sketch(shingles: np.ndarray, threshold: int = THRESHOLD) -> bytes:
    """Parity of the tokens that fall on each bit; the bits are a power of two."""
    d = plan(bisect_right(bands(threshold), len(shingles)) - 1, threshold)[0] if len(shingles) else 0
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_DIFFERENCE * d - 1).bit_length() if d else 0))
    flips = np.bincount((mix(shingles + _U(11)) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """The sketches as words, all with the bits of the smallest."""
    least = min(map(len, sketches)) // 8
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, least), axis=0) for s in sketches])


def keys(shingles: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """(keys, band, number of its most shared keys that the set leaves out in the band) for each band of a set."""
    n = len(shingles)
    own = bisect_right(bands(threshold), n) - 1
    for band in (own, own - 1):
        if band < 0:
            continue
        d, buckets = plan(band, threshold)
        if not d:
            continue  # only equal sets link: they are one class
        h = mix(shingles + _U(band + 101))
        bucket = ((h >> _U(32)) * _U(buckets) >> _U(32)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        dealt = bucket[order]
        first = np.flatnonzero(np.concatenate(([True], dealt[1:] != dealt[:-1])))
        at = dealt[first].astype(_U)
        xor = np.bitwise_xor.reduceat(mix(h)[order], first)
        empty = buckets - len(at)
        key = mix(xor + mix(at + _U(band << 32)))
        if empty > spare(d):
            gone = np.setdiff1d(np.arange(buckets), at.astype(np.int64))
            key = np.concatenate((key, mix((gone + (band << 32)).astype(_U) ^ _U(0xDB4F0B9175AE2165))))
        yield signed(key), band, max(0, spare(d) - empty)


def linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= threshold * (len(a) + len(b) - both)


def most_apart(n: np.ndarray, m: np.ndarray, threshold: int) -> np.ndarray:
    """Greatest symmetric difference of linked sets of sizes n and m: |A u B| <= 100 (n + m) / (100 + threshold)."""
    union = (n + m) * 100 // (100 + threshold)
    return union - -(-union * threshold // 100)


def weights(n: np.ndarray, m: np.ndarray, apart: np.ndarray, threshold: int) -> np.ndarray:
    """How near to the greatest difference that a link allows the sketches are, infinite beyond it."""
    most = most_apart(n, m, threshold)
    ok = (apart <= most) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * threshold)
    return np.where(ok, (apart + 1.0) / (most + 1.0), np.inf)


# ---------------------------------------------------------------- groups of one key


def allowed(n: np.ndarray, root: np.ndarray, bits: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (x > y) and weights of all pairs of a small group that the sketches allow between components."""
    x, y = np.tril_indices(len(n), -1)
    open_ = root[x] != root[y]
    x, y = x[open_], y[open_]
    w = weights(n[x], n[y], np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64), threshold)
    ok = np.isfinite(w)
    return x[ok], y[ok], w[ok]


def forest(n: np.ndarray, root: np.ndarray, bits: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Least spanning forest over the allowed pairs between components: places of at most (components - 1) pairs."""
    out: list[tuple[int, int]] = []
    if len(n) <= SMALL:
        x, y, w = allowed(n, root, bits, threshold)
        lead = {r: r for r in root.tolist()}

        def find(r: int) -> int:
            while lead[r] != r:
                r = lead[r]
            return r

        for p in np.argsort(w, kind="stable").tolist():
            a, b = find(int(root[x[p]])), find(int(root[y[p]]))
            if a != b:
                lead[a] = b
                out.append((int(x[p]), int(y[p])))
        return out
    # one member at a time joins the growing tree, the nearest first; members of one component are at distance 0
    best, parent, left = np.full(len(n), np.inf), np.zeros(len(n), np.int64), np.ones(len(n), bool)
    for _ in range(len(n)):
        rest = np.flatnonzero(left)
        at = int(rest[np.argmin(best[rest])])
        if 0 < best[at] < np.inf:
            out.append((at, int(parent[at])))
        left[at] = False
        best[left & (root == root[at])] = 0.0
        other = np.flatnonzero(left & (best > 0))
        if len(other):
            w = weights(n[other], n[at], np.bitwise_count(bits[other] ^ bits[at]).sum(axis=1, dtype=np.int64), threshold)
            nearer = other[w < best[other]]
            best[nearer], parent[nearer] = w[w < best[other]], at
    return out


def between(n: np.ndarray, root: np.ndarray, bits: np.ndarray, one: np.ndarray, two: np.ndarray, threshold: int) -> Iterator[tuple[int, int]]:
    """Places of all allowed pairs of different components with an end in ``one`` and an end in ``two``."""
    for x in one.tolist():
        y = two[root[two] != root[x]]
        if len(y):
            w = weights(n[y], n[x], np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64), threshold)
            yield from ((x, z) for z in y[np.isfinite(w)].tolist())


# ---------------------------------------------------------------- the join


class Corpus:
    """The documents' rows, and what is known of each: id, hash of its text, set size and class."""

    def __init__(self, docs: DataFrame, key: str, text: str, size: int, threshold: int):
        self.size, self.threshold = size, threshold
        self.rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("t"), F.xxhash64(text).alias("th"))
        kinds = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("n", pa.int64()), ("cls", pa.int64())])

        def measure(rows: Iterator[tuple]) -> Iterator[tuple]:
            for i, t, th in rows:
                s = shingle_set(t, size)
                yield i, th, len(s), class_of(s) if len(s) else None

        self.measured = stored(map_rows(self.rows, kinds, "id long, th long, n long, cls long", measure, ["id", "t", "th"], out_rows=1 << 12), "jaccard-sets")

    def keys(self) -> DataFrame:
        """(k, cls) of the keys that two classes or more use."""
        size, threshold = self.size, self.threshold

        def deal(rows: Iterator[tuple]) -> Iterator[tuple]:
            seen: set[int] = set()  # classes of this partition: a class deals its keys once in it
            for (t,) in rows:
                s = shingle_set(t, size)
                if len(s) and (c := class_of(s)) not in seen:
                    seen.add(c)
                    for k, band, out in keys(s, threshold):
                        yield k, np.full(len(k), c, np.int64), np.full(len(k), band, np.int32), np.full(len(k), out, np.int32)

        kinds = pa.schema([("k", pa.int64()), ("cls", pa.int64()), ("band", pa.int32()), ("out", pa.int32())])
        dealt = map_arrays(self.rows, kinds, "k long, cls long, band int, out int", deal, ["t"])
        # one exchange by key: exact copies are merged, then lone keys go
        dealt = dealt.repartition("k").groupBy("k", "cls").agg(F.min("band").alias("band"), F.min("out").alias("out"))
        of_key, most = Window.partitionBy("k"), Window.partitionBy("cls", "band").orderBy(F.desc("n"), "k")
        shared = dealt.withColumn("n", F.count("*").over(of_key)).where("n > 1")
        used = shared.withColumn("at", F.row_number().over(most)).where("at > out").select("k", "cls")
        # a partner is needed to be used by both
        return stored(used.withColumns({"rep": F.min("cls").over(of_key), "n": F.count("*").over(of_key)}).where("n > 1").select("k", "cls", "rep"), "jaccard-used")

    def texts(self, wanted: DataFrame) -> DataFrame:
        """``wanted`` (cls, ...) with a text ``t`` of each class; a row that is repeated gives its text each time."""
        address = self.measured.join(wanted.select("cls").distinct(), "cls", "left_semi").groupBy("cls").agg(F.min(F.struct("th", "id")).alias("at"))
        placed = stored(wanted.join(address.select("cls", "at.*"), "cls"), "jaccard-wanted")
        if placed.count() <= BROADCAST_ROWS:
            placed = F.broadcast(placed)
        rows = self.rows.withColumnsRenamed({"th": "own_th", "id": "own_id"})
        return rows.join(placed, (F.col("own_th") == F.col("th")) & F.col("own_id").eqNullSafe(F.col("id"))).drop("own_th", "own_id", "th", "id")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The ``pairs`` (a, b) of classes that link, by their whole sets; the partners of a ``b`` are dealt into blocks."""
        size, threshold = self.size, self.threshold
        blocks = pairs.groupBy("b").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("blocks"))
        ends = pairs.join(blocks, "b").select(F.col("a").alias("cls"), F.col("b").alias("cell"), F.pmod(F.xxhash64("a"), "blocks").cast("int").alias("block"), F.lit(1).alias("role"))
        centres = blocks.select(F.col("b").alias("cls"), F.col("b").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("role"))

        def describe(rows: Iterator[tuple]) -> Iterator[tuple]:
            seen: set[tuple] = set()
            for t, c, cell, block, role in rows:
                if (c, cell, block) not in seen:
                    seen.add((c, cell, block))
                    s = shingle_set(t, size)
                    if class_of(s) == c:
                        yield cell, block, role, c, s.tobytes()

        kinds = pa.schema([("cell", pa.int64()), ("block", pa.int32()), ("role", pa.int32()), ("cls", pa.int64()), ("s", pa.binary())])
        sets = map_rows(self.texts(ends.unionByName(centres)), kinds, "cell long, block int, role int, cls long, s binary", describe, ["t", "cls", "cell", "block", "role"], out_rows=64)
        dealt = sets.repartition("cell", "block").sortWithinPartitions("cell", "block", "role")

        def check(rows: Iterator[tuple]) -> Iterator[tuple]:
            for _, group in groupby(rows, key=lambda r: r[:2]):
                centre = None
                for cell, _, role, c, data in group:
                    s = np.frombuffer(data, _U)
                    if not role:
                        centre = s
                    elif centre is not None and linked(s, centre, threshold):
                        yield c, cell

        return stored(map_rows(dealt, pa.schema([("a", pa.int64()), ("b", pa.int64())]), "a long, b long", check, ["cell", "block", "role", "cls", "s"]).distinct(), "jaccard-links")

    def sketches(self, classes: DataFrame) -> DataFrame:
        """(cls, n, s) of ``classes`` (cls)."""
        size, threshold = self.size, self.threshold

        def describe(rows: Iterator[tuple]) -> Iterator[tuple]:
            seen: set[int] = set()
            for t, c in rows:
                if c not in seen:
                    seen.add(c)
                    s = shingle_set(t, size)
                    if class_of(s) == c:
                        yield c, len(s), sketch(s, threshold)

        found = map_rows(self.texts(classes), pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("s", pa.binary())]), "cls long, n long, s binary", describe, ["t", "cls"])
        return stored(found.dropDuplicates(["cls"]), "jaccard-sketches")

    def forests(self, members: DataFrame, sketches: DataFrame) -> DataFrame:
        """Pairs of the spanning forests of each key's members (k, cls, root, n_blocks), block by block."""
        threshold = self.threshold
        dealt = members.join(sketches, "cls").select("k", F.pmod(F.xxhash64("cls", "k"), "blocks").cast("int").alias("block"), "cls", "root", "n", "s")

        def join(rows: Iterator[tuple]) -> Iterator[tuple]:
            for _, group in groupby(rows, key=lambda r: r[:2]):
                _, _, cls, root, n, s = zip(*group, strict=True)
                if min(root) != max(root):
                    for x, y in forest(np.array(n), np.array(root), folded(s), threshold):
                        yield max(cls[x], cls[y]), min(cls[x], cls[y])

        ordered = dealt.repartition("k", "block").sortWithinPartitions("k", "block")
        return map_rows(ordered, pa.schema([("a", pa.int64()), ("b", pa.int64())]), "a long, b long", join, ["k", "block", "cls", "root", "n", "s"]).distinct()

    def leftovers(self, members: DataFrame, sketches: DataFrame) -> DataFrame:
        """All allowed pairs between components: members outside their key's largest component against every member, in blocks."""
        threshold = self.threshold
        main = members.groupBy("k", "root").agg(F.count("*").alias("m")).groupBy("k").agg(F.max_by("root", F.struct("m", "root")).alias("main"), (F.sum("m") - F.max("m")).alias("outside"))
        sides = members.join(main, "k").withColumn("outer", F.col("root") != F.col("main")).withColumn("across", F.ceil(F.col("outside") / BLOCK).cast("int"))
        block = lambda n: F.pmod(F.xxhash64("cls", "k"), F.col(n)).cast("int")
        ones = sides.where("outer").select("k", "cls", "root", block("across").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(1).alias("one"))
        twos = sides.select("k", "cls", "root", F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("i"), block("blocks").alias("j"), F.lit(0).alias("one"))
        dealt = ones.unionByName(twos).join(sketches, "cls")

        def compare(rows: Iterator[tuple]) -> Iterator[tuple]:
            for _, group in groupby(rows, key=lambda r: r[:3]):
                _, _, _, cls, root, n, s, one = zip(*group, strict=True)
                if min(root) != max(root):
                    side = np.array(one)
                    for x, y in between(np.array(n), np.array(root), folded(s), np.flatnonzero(side == 1), np.flatnonzero(side == 0), threshold):
                        yield max(cls[x], cls[y]), min(cls[x], cls[y])

        ordered = dealt.repartition("k", "i", "j").sortWithinPartitions("k", "i", "j")
        return map_rows(ordered, pa.schema([("a", pa.int64()), ("b", pa.int64())]), "a long, b long", compare, ["k", "i", "j", "cls", "root", "n", "s", "one"]).distinct()

    def open_members(self, used: DataFrame, roots: DataFrame) -> DataFrame:
        """(k, cls, root, blocks) of the keys whose members lie in different components; of keys with the same members, one."""
        placed = used.join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        same = [F.count("*").alias("m"), *[F.bit_xor(F.xxhash64("cls", F.lit(i))).alias(f"h{i}") for i in (1, 2)]]
        open_ = placed.groupBy("k").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), *same).where("lo <> hi").groupBy("m", "h1", "h2").agg(F.min("k").alias("k"))
        return stored(placed.join(open_.select("k", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "k").select("k", "cls", "root", "blocks"), "jaccard-open")

    def roots(self) -> DataFrame | None:
        """(node, root) of the classes that lie in a component with others."""
        used = self.keys()
        if used.isEmpty():
            return None
        top = Window.partitionBy("cls").orderBy(F.desc("votes"), "rep")
        first = used.where("cls <> rep").groupBy("cls", "rep").agg(F.count("*").alias("votes")).withColumn("at", F.row_number().over(top)).where("at = 1")
        tried = [stored(first.select(F.col("cls").alias("a"), F.col("rep").alias("b")), "jaccard-pairs")]
        links = [self.verified(tried[0])]
        roots, members, sketches = components(links[0]), used.select("k", "cls"), None
        while True:
            members = self.open_members(members.select("k", "cls"), roots)
            if members.isEmpty():
                return roots
            if sketches is None:
                sketches = self.sketches(members.select("cls").distinct())
            last = links[-1].isEmpty() and len(links) > 1
            pairs = stored((self.leftovers if last else self.forests)(members, sketches), "jaccard-allowed")
            if pairs.isEmpty():
                return roots
            new = stored(pairs.join(reduce(DataFrame.unionByName, tried), ["a", "b"], "left_anti"), "jaccard-pairs")
            tried.append(new)
            links.append(self.verified(new))
            if not links[-1].isEmpty():
                roots = components(reduce(DataFrame.unionByName, links))
            if last:
                return roots


def similarity_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """(id, th, n, cls, root): id, hash of the text, the set's size, its class and the root class of its component; null class without words."""
    corpus = Corpus(docs, key, text, size, threshold)
    roots = corpus.roots()
    if roots is None:
        return corpus.measured.withColumn("root", F.col("cls"))
    return corpus.measured.join(roots, F.col("cls") == F.col("node"), "left").select("id", "th", "n", "cls", F.coalesce("root", "cls").alias("root"))


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: key, n_shingles, component_id (least key of its component)."""
    placed = stored(similarity_classes(docs, key, text, size, threshold), "jaccard-placed")
    least = placed.where("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    joined = placed.join(least, "root", "left")
    return joined.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


def query(spark, sf_dir: str) -> DataFrame:
    """op3: components of the documents' 4-word shingle sets at 85 of 100."""
    return similar_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near duplicates (five words, similarity 0.8) one document stays.

    It is the one of least id (null ids come last), among repeated ids the one
    whose text's hash is least; of rows that repeat id and text, any one.
    Documents without words stay.
    """
    placed = stored(similarity_classes(docs, size=5, threshold=80), "jaccard-placed")
    rows = placed.where("root is not null").groupBy("root", "id", "th").agg(F.count("*").alias("copies"))
    least = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "th", "copies")).alias("w"))
    own = {c: free(docs.columns, f"_{c}") for c in ("id", "th", "copies")}
    winners = stored(least.select(*[F.col(f"w.{c}").alias(own[c]) for c in own]), "jaccard-winners")
    found = docs.join(winners, F.col("doc_id").eqNullSafe(F.col(own["id"])) & (F.xxhash64("text") == F.col(own["th"])), "left")
    wordless = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    once = found.where((F.col(own["copies"]) == 1) | wordless)
    again = found.where(F.col(own["copies"]) > 1).dropDuplicates([own["id"], own["th"]])
    return once.select(*docs.columns).unionByName(again.select(*docs.columns))
