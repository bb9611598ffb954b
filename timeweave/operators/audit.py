"""Audit of one transcript against another, window by window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.loops import loop_info, squash
from ..functions.numbers import numbers
from ..functions.text import bigram_jaccard
from .aggregates import window_of
from .joins import overlap_pairs


def window_lines(segments: DataFrame, keys: list[str], side: str, last: DataFrame, window_s: float) -> DataFrame:
    """(keys, window, lines): the texts of a side's segments in order, by the window of their midpoint (clamped to the last)."""
    rows = segments.where(F.trim("text") != "").join(last, keys)
    rows = rows.withColumn("window", F.least(window_of(F.col("start_s"), F.col("end_s"), window_s), F.col("__tw_last")))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("start_s", "end_s", "text"))), lambda x: F.trim(x["text"]))
    return rows.groupBy(*keys, "window").agg(lines.alias(side))


def compare_windows(primary: DataFrame, other: DataFrame, keys: list[str], window_s: float = 60, low_similarity: float = 0.4, gap_chars: int = 40, gap_ratio: float = 0.2) -> DataFrame:
    """A row for every window of two transcripts (keys, start_s, end_s, text) with its flags.

    LOOP_PRIMARY and LOOP_OTHER: degenerate repetition. GAP_PRIMARY: far fewer
    characters than the other side. NUMBER_MISMATCH: numbers of one side only,
    after those are excused that the other side has in a neighbouring window; a
    lone single digit isn't significant. LOW_SIM: few common character pairs.
    Where the other side loops, what compares with it is suppressed.
    """
    both = primary.select(*keys, "end_s").unionByName(other.select(*keys, "end_s"))
    last = both.groupBy(*keys).agg(F.greatest(F.ceil(F.max("end_s") / window_s).cast("long") - 1, F.lit(0).cast("long")).alias("__tw_last"))
    every = last.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), "__tw_last")).alias("window"))
    none = F.array().cast("array<string>")
    rows = every.join(window_lines(primary, keys, "p", last, window_s), [*keys, "window"], "left").join(window_lines(other, keys, "o", last, window_s), [*keys, "window"], "left")
    rows = rows.withColumns({"p": F.coalesce("p", none), "o": F.coalesce("o", none)})
    rows = rows.withColumns({"pn": numbers(F.array_join("p", "")), "on": numbers(F.array_join("o", ""))})
    w = Window.partitionBy(*keys).orderBy("window")
    beside = lambda c: F.concat(F.coalesce(F.lag(c).over(w), none), F.coalesce(F.lead(c).over(w), none))
    rows = rows.withColumns({"near_p": beside("pn"), "near_o": beside("on")})
    only_p, only_o = excess(F.col("pn"), F.col("on")), excess(F.col("on"), F.col("pn"))
    rows = rows.withColumns({"only_primary": F.filter(only_p, lambda x: ~F.array_contains("near_o", x)), "only_other": F.filter(only_o, lambda x: ~F.array_contains("near_p", x)), "excused": F.array_sort(F.concat(F.array_distinct(F.filter(only_p, lambda x: F.array_contains("near_o", x))), F.array_distinct(F.filter(only_o, lambda x: F.array_contains("near_p", x)))))})
    rows = rows.withColumns({"sp": squash(F.array_join("p", "")), "so": squash(F.array_join("o", "")), "lp": loop_info(F.col("p")), "lo": loop_info(F.col("o"))})
    rows = rows.withColumns({"primary_chars": F.length("sp"), "other_chars": F.length("so"), "similarity": F.round(bigram_jaccard(F.col("sp"), F.col("so")), 4)})
    np, no = F.size("only_primary"), F.size("only_other")
    telling = lambda xs: F.exists(xs, lambda x: (F.regexp_count(x, F.lit("[0-9]")) >= 2) | F.contains(x, F.lit("%")) | F.contains(x, F.lit(".")))
    significant = ((np > 0) & (no > 0)) | telling("only_primary") | telling("only_other")
    gap = (F.col("other_chars") >= gap_chars) & (F.col("primary_chars") < gap_ratio * F.col("other_chars"))
    tests = [
        ("LOOP_PRIMARY", F.col("lp.loop")),
        ("LOOP_OTHER", F.col("lo.loop")),
        ("GAP_PRIMARY", gap),
        ("NUMBER_MISMATCH", (F.col("primary_chars") > 0) & (F.col("other_chars") > 0) & (np + no > 0) & significant),
        ("LOW_SIM", F.coalesce(F.col("similarity") < low_similarity, F.lit(False)) & ~gap),
    ]
    raw = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in tests]))
    weak = F.array(*map(F.lit, ("GAP_PRIMARY", "NUMBER_MISMATCH", "LOW_SIM")))
    suppressed = F.when(F.col("lo.loop"), F.array_intersect(raw, weak)).otherwise(none)
    kind = F.when((np > 0) & (no > 0), "substitution").when(np > 0, "primary_only").when(no > 0, "other_only")
    out = [*keys, "window", "primary_chars", "other_chars", "similarity", "only_primary", "only_other", "excused"]
    return rows.select(*out, kind.alias("mismatch"), ((np + no > 0) & ~significant).alias("minor_only"), F.array_except(raw, suppressed).alias("flags"), suppressed.alias("suppressed"))


def excess(a: Column, b: Column) -> Column:
    """Values of ``a`` beyond their copies in ``b`` (two arrays as multisets), sorted."""
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    return F.flatten(F.transform(F.array_sort(F.array_distinct(a)), lambda x: F.array_repeat(x, F.greatest(count(a, x) - count(b, x), F.lit(0)))))


def segmentation_findings(sources: DataFrame, placed: DataFrame, course: str, ident: str, chain_s: float = 5, break_s: float = 480, parallel_s: float = 60, width_s: float = 3600) -> DataFrame:
    """(course, code, level, n): what a course's segments claim against its sources' real times; only what was found.

    ``sources``: course, ident, lo, hi (seconds; null: no known time), in real
    order by lo. ``placed``: course, ident, seg, display_order of the sources
    that lie in a segment. Segments must be blocks of the real order and play in
    it; sources that overlap for long must share a segment. Findings are advice.
    """
    timed = sources.where(F.col("lo").isNotNull())
    order = Window.partitionBy(course).orderBy("lo", ident)
    ranked = timed.withColumns({"pos": F.row_number().over(order) - 1, "gap": F.lead("lo").over(order) - F.col("hi")})
    joined = ranked.join(placed, [course, ident], "left")
    segs = joined.where(F.col("seg").isNotNull()).groupBy(course, "seg").agg(F.min("pos").alias("a"), F.max("pos").alias("b"), F.count("*").alias("m"), F.min("display_order").alias("shown"))
    moved = segs.withColumns({"play": F.row_number().over(Window.partitionBy(course).orderBy("shown", "seg")), "first": F.row_number().over(Window.partitionBy(course).orderBy("a"))})
    by_seg = moved.groupBy(course).agg(F.count_if(F.col("b") - F.col("a") + 1 != F.col("m")).alias("segments-noncontiguous"), F.count_if(F.col("play") != F.col("first")).alias("segments-display-order"))
    by_source = joined.groupBy(course).agg(F.count_if(F.col("seg").isNull()).alias("segments-uncovered"), F.count_if((F.col("gap") >= 0) & (F.col("gap") <= chain_s)).alias("split-recordings"), F.count_if(F.col("gap") >= break_s).alias("natural-breaks"))
    pairs = overlap_pairs(timed.where(F.col("hi").isNotNull()), ident, "lo", "hi", [course], width_s).where(F.col("overlap_s") > parallel_s)
    mate = lambda end: placed.select(course, F.col(ident).alias(f"id_{end}"), F.col("seg").alias(f"seg_{end}"))
    apart = pairs.join(mate("a"), [course, "id_a"], "left").join(mate("b"), [course, "id_b"], "left").where(~F.coalesce(F.col("seg_a") == F.col("seg_b"), F.lit(False)))
    unknown = sources.where(F.col("lo").isNull()).groupBy(course).agg(F.count("*").alias("n"))
    levels = {"segments-noncontiguous": "REGENERATE", "segments-uncovered": "REVIEW", "segments-display-order": "REVIEW", "split-recordings": "INFO", "natural-breaks": "INFO"}

    def told(df: DataFrame) -> DataFrame:
        codes = [c for c in df.columns if c in levels]
        rows = F.array(*[F.struct(F.lit(c).alias("code"), F.lit(levels[c]).alias("level"), F.col(f"`{c}`").alias("n")) for c in codes])
        return df.select(course, F.explode(rows).alias("f")).select(course, "f.*")

    def one(df: DataFrame, code: str) -> DataFrame:
        return df.select(course, F.lit(code).alias("code"), F.lit("REVIEW").alias("level"), "n")

    parallel = one(apart.groupBy(course).agg(F.count("*").alias("n")), "parallel-tracks")
    return told(by_seg).unionByName(told(by_source)).unionByName(parallel).unionByName(one(unknown, "unverifiable")).where("n > 0")
