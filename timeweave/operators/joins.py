"""Joins over time intervals, vocabularies, hashes and names.

Interval joins are bucketed: both sides are dealt to the time buckets that they
touch and joined on keys and bucket, so a long recording is many groups and no
plan needs a nested loop. A pair is kept only in its first common bucket.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .matching import mentions


def _bucket(col: Column, width: float) -> Column:
    return F.floor(col / F.lit(float(width)))


def interval_join(left: DataFrame, right: DataFrame, l: tuple[str, str], r: tuple[str, str], keys: list[str], width: float, closed: bool = True) -> DataFrame:
    """Pairs of rows of equal ``keys`` whose intervals overlap; touching ends count when ``closed``. Null ends match nothing."""
    a, b = left.alias("l"), right.alias("r")
    lb = F.explode(F.sequence(_bucket(F.col(l[0]), width), F.greatest(_bucket(F.col(l[1]), width), _bucket(F.col(l[0]), width))))
    rb = F.explode(F.sequence(_bucket(F.col(r[0]), width), F.greatest(_bucket(F.col(r[1]), width), _bucket(F.col(r[0]), width))))
    a = left.where(F.col(l[0]).isNotNull() & F.col(l[1]).isNotNull()).withColumn("__tw_b", lb).alias("l")
    b = right.where(F.col(r[0]).isNotNull() & F.col(r[1]).isNotNull()).withColumn("__tw_b", rb).alias("r")
    on = F.col("l.__tw_b") == F.col("r.__tw_b")
    for k in keys:
        on &= F.col(f"l.{k}") == F.col(f"r.{k}")
    lo, hi, rlo, rhi = (F.col(c) for c in (f"l.{l[0]}", f"l.{l[1]}", f"r.{r[0]}", f"r.{r[1]}"))
    meet = (rhi >= lo) & (rlo <= hi) if closed else (rhi > lo) & (rlo < hi)
    first = F.greatest(_bucket(lo, width), _bucket(rlo, width)) == F.col("l.__tw_b")
    out = [F.col(f"l.{c}") for c in left.columns] + [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return a.join(b, on & meet & first).select(*out)


def window_segments(slides: DataFrame, segments: DataFrame, keys: list[str], window_s: float = 20, width: float = 60) -> DataFrame:
    """Segments heard around each slide: its span widened by ``window_s``, never before 0."""
    wide = slides.withColumn("win_lo", F.greatest(F.lit(0), F.col("slide_start") - window_s)).withColumn("win_hi", F.col("slide_end") + window_s)
    return interval_join(wide, segments, ("win_lo", "win_hi"), ("start_s", "end_s"), keys, width)


def containing(points: DataFrame, intervals: DataFrame, t: str, lo: str, hi: str, keys: list[str], point_id: str, width: float, how: str = "left") -> DataFrame:
    """All intervals (closed) that hold each point; with ``how='left'`` points outside all of them stay, with nulls."""
    p = points.select(*keys, point_id, t)
    found = interval_join(p.withColumn("__tw_t", F.col(t)), intervals, (t, "__tw_t"), (lo, hi), keys, width).drop("__tw_t")
    if how != "left":
        return found
    extra = [c for c in intervals.columns if c not in keys]
    return p.join(found.select(point_id, *extra), point_id, "left")


def slice_by_plan(segments: DataFrame, plan: DataFrame, keys: list[str], t: str = "start_s", lo: str = "plan_lo", hi: str = "plan_hi", width: float = 60) -> DataFrame:
    """Segments whose start lies in a plan row's half-open span."""
    pairs = interval_join(segments.withColumn("__tw_t", F.col(t)), plan, (t, "__tw_t"), (lo, hi), keys, width)
    return pairs.where(F.col(t) < F.col(hi)).drop("__tw_t")


def overlap_pairs(df: DataFrame, ident: str, lo: str, hi: str, keys: list[str], width: float) -> DataFrame:
    """Pairs (id_a < id_b) of equal keys whose open intervals overlap, with the overlap's length."""
    a = df.select(*keys, F.col(ident).alias("id_a"), F.col(lo).alias("lo_a"), F.col(hi).alias("hi_a"))
    b = df.select(*keys, F.col(ident).alias("id_b"), F.col(lo).alias("lo_b"), F.col(hi).alias("hi_b"))
    pairs = interval_join(a, b, ("lo_a", "hi_a"), ("lo_b", "hi_b"), keys, width, closed=False).where("id_a < id_b")
    return pairs.select(*keys, "id_a", "id_b", (F.least("hi_a", "hi_b") - F.greatest("lo_a", "lo_b")).alias("overlap_s"))


def parallel_tracks(pairs: DataFrame, membership: DataFrame, member: str, group: str, min_s: float = 60) -> DataFrame:
    """Overlapping pairs longer than ``min_s`` that share no group."""
    a = membership.select(F.col(member).alias("id_a"), F.col(group).alias("g"))
    b = membership.select(F.col(member).alias("id_b"), F.col(group).alias("g"))
    long = pairs.where(F.col("overlap_s") > min_s)
    together = long.join(a, "id_a").join(b, ["id_b", "g"]).select("id_a", "id_b").distinct()
    return long.join(together, ["id_a", "id_b"], "left_anti")


def replace_overlapping(master: DataFrame, ranges: DataFrame, keys: list[str], width: float = 60, min_frac: float = 0.5) -> DataFrame:
    """Master segments covered to ``min_frac`` by a range give way to the ranges' texts.

    Both sides: keys, start_s, end_s, text. A range without text replaces nothing;
    segments without duration stay.
    """
    new = ranges.where(F.trim("text") != "").select(*keys, F.col("start_s").alias("n_lo"), F.col("end_s").alias("n_hi"))
    hit = interval_join(master.select(*keys, "start_s", "end_s"), new, ("start_s", "end_s"), ("n_lo", "n_hi"), keys, width, closed=False)
    share = (F.least("end_s", "n_hi") - F.greatest("start_s", "n_lo")) / (F.col("end_s") - F.col("start_s"))
    gone = hit.where(share >= min_frac).select(*keys, "start_s", "end_s").distinct()
    cols = [*keys, "start_s", "end_s", "text"]
    return master.select(*cols).join(gone, [*keys, "start_s", "end_s"], "left_anti").select(*cols).unionByName(ranges.where(F.trim("text") != "").select(*cols))


def suspect_tokens(tokens: DataFrame, known: list[DataFrame], min_len: int = 4) -> DataFrame:
    """Tokens (token, seg) of some length that are in none of the ``known`` vocabularies (token), with first segment and count."""
    left = tokens.where(F.length("token") >= min_len)
    counted = left.groupBy("token").agg(F.min("seg").alias("first_seg"), F.count("*").alias("n"))
    for vocabulary in known:
        counted = counted.join(vocabulary.select("token").distinct(), "token", "left_anti")
    return counted


def closest_terms(tokens: DataFrame, terms: DataFrame, top: int = 3, max_distance: int = 2) -> DataFrame:
    """Up to ``top`` terms within ``max_distance`` edits of each token.

    A term is cut into ``max_distance`` + 1 pieces: one of them stands unchanged
    in every token that near. Of the pieces that do, one has no more edits before
    it than its number and no more after it than the rest, which leaves it a few
    places only. The join is on (term's length, piece's number, piece), so that
    no pair without such a piece is compared. Order: distance, distance by length, term.
    """
    k = max_distance
    term = terms.select("term").where("term <> ''").distinct().withColumn("size", F.length("term"))
    start = lambda i, n: F.floor(i * n / (k + 1)).cast("int")
    cut = term.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(k))))
    cut = cut.withColumn("piece", F.substring("term", start(F.col("i"), F.col("size")) + 1, start(F.col("i") + 1, F.col("size")) - start(F.col("i"), F.col("size"))))
    own = tokens.select("token").where("token <> ''").distinct().withColumn("n", F.length("token"))
    own = own.withColumn("size", F.explode(F.sequence(F.greatest(F.col("n") - k, F.lit(1)), F.col("n") + k))).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(k))))
    own = own.withColumn("at", start(F.col("i"), F.col("size"))).withColumn("len", start(F.col("i") + 1, F.col("size")) - F.col("at"))
    more = F.col("n") - F.col("size")
    low = F.greatest(F.col("at") - F.col("i"), F.col("at") + more - (k - F.col("i")))
    high = F.least(F.col("at") + F.col("i"), F.col("at") + more + (k - F.col("i")))
    own = own.where(low <= high)
    places = F.filter(F.sequence(low, high), lambda p: (p >= 0) & (p + F.col("len") <= F.col("n")))
    keys = own.select("token", "size", "i", F.explode(F.array_distinct(F.transform(places, lambda p: F.substring("token", p + 1, F.col("len"))))).alias("piece"))
    near = keys.join(cut, ["size", "i", "piece"]).where("token <> term").select("token", "term", F.levenshtein("token", "term", k).alias("distance")).where(F.col("distance") >= 0).distinct()
    by = Window.partitionBy("token").orderBy("distance", F.col("distance") / F.greatest(F.length("token"), F.length("term")), "term")
    return near.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top).select("token", "term", "distance", "rank")


def hamming_nn(left: DataFrame, right: DataFrame, max_dist: int = 6, bands: int = 9, guard: Column | None = None) -> DataFrame:
    """Nearest hash within ``max_dist`` bits for (id, h) among (rid, rh), ties to the least rid: (id, rid, dist).

    The 64 bits are cut into ``bands`` > max_dist bands: two hashes that near
    agree in bands - max_dist of them, so the join is on all such choices of
    bands and loses no pair; with 9 bands a key has 21 bits. A hit that fails the
    ``guard`` (a condition on the columns of both sides) is no hit: rid is null.
    """
    if bands <= max_dist:
        raise ValueError("more bands than differing bits are needed")
    edges = [i * 64 // bands for i in range(bands + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    chosen = [sum(c) - (1 << 64 if sum(c) >> 63 else 0) for c in combinations(masks, bands - max_dist)]

    def parts(c: str) -> Column:
        return F.posexplode(F.transform(F.array(*[F.lit(m).cast("long") for m in chosen]), lambda m: F.col(c).bitwiseAND(m))).alias("choice", "bits")

    pairs = left.select("id", "h", parts("h")).join(right.select("rid", "rh", parts("rh")), ["choice", "bits"])
    near = pairs.withColumn("dist", F.bit_count(F.col("h").bitwiseXOR(F.col("rh")))).where(F.col("dist") <= max_dist)
    best = near.groupBy("id").agg(F.min(F.struct("dist", "rid")).alias("m")).select("id", F.col("m.rid").alias("rid"), F.col("m.dist").alias("dist"))
    if guard is None:
        return best
    held = best.join(left.drop("h"), "id").join(right.drop("rh"), "rid")
    return held.select("id", F.when(F.coalesce(guard, F.lit(False)), F.col("rid")).alias("rid"), "dist")


def resolve_unique(left: DataFrame, right: DataFrame, key: str, name: str) -> DataFrame:
    """Resolve ``key`` to ``name``: an exact match, else the only name that holds it, else null."""
    names = right.select(name).distinct()
    exact = left.select(key).distinct().join(names, F.col(key) == F.col(name), "left")
    rest = exact.where(F.col(name).isNull()).select(key)
    held = mentions(names, name, name, rest, key).groupBy(key).agg(F.min(name).alias(name), F.count("*").alias("__tw_n")).where("__tw_n = 1").drop("__tw_n")
    return exact.where(F.col(name).isNotNull()).unionByName(rest.join(held, key, "left"))


def explode_members(groups: DataFrame, members: DataFrame, group: str, array: str, member: str, value: str) -> DataFrame:
    """Values of a group's members, in the array's order: (group, values)."""
    rows = groups.select(group, F.posexplode(array).alias("__tw_pos", member)).join(members.select(member, value), member)
    return rows.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("__tw_pos", value))), lambda x: x[value]).alias("values"))


def names_in_text(df: DataFrame, names: DataFrame, ident: str, text: str, name: str = "name") -> DataFrame:
    """Names found in each text with their first position; a name inside a longer found name at the same place is left out."""
    hits = mentions(df, ident, text, names, name)
    longest = Window.partitionBy(ident, "pos").orderBy(F.desc(F.length(name)), name)
    return hits.withColumn("__tw_r", F.row_number().over(longest)).where("__tw_r = 1").drop("__tw_r").withColumn("nth", F.row_number().over(Window.partitionBy(ident).orderBy("pos")))


def claim_conflicts(claims: DataFrame, measured: DataFrame, key: str, claim: str, measure: str, tol_s: float = 5) -> DataFrame:
    """Claims next to measurements; a conflict when they differ by more than ``tol_s``. Nothing is rewritten."""
    return claims.join(measured, key).withColumn("delta_s", F.col(claim) - F.col(measure)).withColumn("conflict", F.abs("delta_s") > tol_s)


def caption_overlap(captions: DataFrame, frames: DataFrame, key: str, min_tokens: int = 3) -> DataFrame:
    """Shared tokens of caption and frame (arrays ``tokens``): fail without any, weak with one, skip with few frame tokens."""
    joined = captions.select(key, F.col("tokens").alias("ct")).join(frames.select(key, F.col("tokens").alias("ft")), key)
    both = F.size(F.array_intersect("ct", "ft")).alias("shared")
    status = F.when(F.size(F.array_distinct("ft")) < min_tokens, "skip").when(both == 0, "fail").when(both == 1, "weak").otherwise("ok")
    return joined.select(key, both, status.alias("status"))


def ref_integrity(refs: DataFrame, assets: DataFrame, ref: str, name: str, digest: str) -> DataFrame:
    """References: missing when no asset has the name, ambiguous when assets of the name differ, else ok."""
    known = assets.groupBy(F.col(name).alias(ref)).agg(F.count_distinct(digest).alias("__tw_d"))
    status = F.when(F.col("__tw_d").isNull(), "missing").when(F.col("__tw_d") > 1, "ambiguous").otherwise("ok")
    return refs.select(ref).distinct().join(known, ref, "left").select(ref, status.alias("status"))


def seek(blocks: DataFrame, keys: list[str], t: Column, lo: str, hi: str, prefer: list[Column], pad: float = 0.15) -> DataFrame:
    """The one block playing at ``t`` for every key, give or take ``pad``; the first by ``prefer``."""
    live = blocks.where((F.col(lo) - pad <= t) & (t < F.col(hi) + pad))
    return live.withColumn("__tw_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*prefer))).where("__tw_r = 1").drop("__tw_r")


def deep_links(links: DataFrame, files: DataFrame, link: str, file: str) -> DataFrame:
    """Resolve links to files: by exact name, else by the least name equal without regard to case."""
    exact = files.select(F.col(file).alias("__tw_f")).distinct()
    loose = exact.groupBy(F.lower("__tw_f").alias("__tw_k")).agg(F.min("__tw_f").alias("__tw_g"))
    out = links.join(exact, F.col(link) == F.col("__tw_f"), "left").join(loose, F.lower(link) == F.col("__tw_k"), "left")
    return out.withColumn("resolved", F.coalesce("__tw_f", "__tw_g")).drop("__tw_f", "__tw_k", "__tw_g")


def unmentioned(sources: DataFrame, texts: DataFrame, name: str, text: str) -> DataFrame:
    """Sources whose name stands in no text; one pass over the texts finds the names that do."""
    found = mentions(texts, text, text, sources, name).select(name).distinct()
    return sources.join(found, name, "left_anti")


def ingested(photos: DataFrame, slides: DataFrame, name: str) -> DataFrame:
    """Photos that are already slides."""
    return photos.join(slides.select(name).distinct(), name, "left_semi")


def cache_split(slides: DataFrame, cache: DataFrame, key: str, signals: str) -> DataFrame:
    """Slides with the cached ``signals`` of their key and ``status``: hit, or pending where the cache has none (or no key)."""
    held = cache.where(F.col(signals).isNotNull()).groupBy(key).agg(F.min(signals).alias("__tw_s"))
    out = slides.join(held, key, "left")
    return out.withColumn("status", F.when(F.col("__tw_s").isNotNull(), "hit").otherwise("pending")).withColumn(signals, F.col("__tw_s")).drop("__tw_s")
