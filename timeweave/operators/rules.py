"""Ordering, search, set operators and rule-based audits. Audits flag and never rewrite."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class EmptyInput(ValueError):
    """A stage had nothing to work on: that must not look like success."""


def chronological(df: DataFrame, start: str, name: str) -> DataFrame:
    """In order of time; rows without a time last, by name."""
    return df.orderBy(F.col(start).isNull(), start, name)


def top_keywords(hits: DataFrame, keys: list[str], word: str, hit: str, pos: str, n: int = 5) -> DataFrame:
    """Words that were heard first, then the rest, each by first position; ``n`` of them."""
    once = hits.groupBy(*keys, word).agg(F.max(F.col(hit).cast("int")).alias("hit"), F.min(pos).alias("pos"))
    return once.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("hit"), "pos"))).where(F.col("rank") <= n)


def search(blocks: DataFrame, text: str, terms: list[str], order: list[str], limit: int = 80) -> DataFrame:
    """The first ``limit`` blocks, in order, that hold all terms without regard to case."""
    holds = reduce(lambda a, b: a & b, [F.contains(F.lower(text), F.lit(t.lower())) for t in terms], F.lit(True))
    return blocks.where(holds).orderBy(*order).limit(limit)


def even_sample(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """``n`` rows of each group at even distances, both ends among them."""
    w = Window.partitionBy(*keys)
    r = df.withColumn("__tw_i", F.row_number().over(w.orderBy(order)) - 1).withColumn("__tw_n", F.count("*").over(w))
    picks = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.floor(k * (F.col("__tw_n") - 1) / F.lit(max(n - 1, 1)))))
    return r.where(F.array_contains(picks, F.col("__tw_i").cast("long"))).drop("__tw_i", "__tw_n")


def capped_list(df: DataFrame, keys: list[str], value: str, order: str, n: int) -> DataFrame:
    """The first ``n`` values of each group, joined, with the group's size."""
    w = Window.partitionBy(*keys).orderBy(order)
    first = df.withColumn("__tw_r", F.row_number().over(w))
    values = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("__tw_r") <= n, F.struct("__tw_r", value)))), lambda x: x[value].cast("string")), ",")
    return first.groupBy(*keys).agg(values.alias("examples"), F.count("*").alias("n"))


def multiset_difference(a: DataFrame, b: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Values with more copies on one side: (keys, value, only_a, only_b)."""
    x = a.groupBy(*keys, value).agg(F.count("*").alias("na"))
    y = b.groupBy(*keys, value).agg(F.count("*").alias("nb"))
    j = x.join(y, [*keys, value], "full").fillna(0, ["na", "nb"])
    return j.where("na <> nb").select(*keys, value, F.greatest(F.col("na") - F.col("nb"), F.lit(0)).alias("only_a"), F.greatest(F.col("nb") - F.col("na"), F.lit(0)).alias("only_b"))


def interleave(slides: DataFrame, segments: DataFrame, keys: list[str], t: str) -> DataFrame:
    """Both in one sequence by time, slides first on ties, numbered within the keys."""
    both = slides.withColumn("kind", F.lit("slide")).unionByName(segments.withColumn("kind", F.lit("speech")))
    return both.withColumn("n", F.row_number().over(Window.partitionBy(*keys).orderBy(t, F.col("kind") == "speech", "id")))


def ordered_distinct(df: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    return df.groupBy(*keys, value).agg(F.min(pos).alias(pos))


def pending(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows that aren't done yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def append_untimed(timeline: DataFrame, deck: DataFrame, t: str) -> DataFrame:
    """A deck after a timeline, without any claim of time."""
    return timeline.unionByName(deck.withColumn(t, F.lit(None).cast(timeline.schema[t].dataType)).select(*timeline.columns))


def findings(df: DataFrame, rules: list[tuple[str, str, Column, Column]]) -> DataFrame:
    """A row (level, check, detail) for each rule (level, check, condition, detail) and row that meets it; one pass over ``df``."""
    hits = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(level).alias("level"), F.lit(check).alias("check"), detail.cast("string").alias("detail"))) for level, check, cond, detail in rules]))
    return df.select(F.explode(hits).alias("f")).select("f.*")


def verdict(found: DataFrame, keys: list[str], levels: list[str]) -> DataFrame:
    """The gravest level of each group; ``levels`` from mild to grave."""
    rank = F.array_position(F.array(*map(F.lit, levels)), F.col("level"))
    return found.groupBy(*keys).agg(F.max(rank).alias("__tw_r"), F.count("*").alias("findings")).withColumn("verdict", F.element_at(F.array(*map(F.lit, levels)), F.col("__tw_r").cast("int"))).drop("__tw_r")


def embed_findings(refs: DataFrame, slides: DataFrame, key: str, tier: str) -> DataFrame:
    """References to unknown or tier-3 slides, and slides of tiers 1 and 2 that nothing refers to."""
    r, s = refs.select(key).distinct().withColumn("__tw_in", F.lit(1)), slides.select(key, tier).withColumn("__tw_known", F.lit(1))
    j = r.join(s, key, "full")
    status = F.when(F.col("__tw_known").isNull(), "unknown").when(F.col("__tw_in").isNotNull() & (F.col(tier) > 2), "removed").when(F.col("__tw_in").isNull() & (F.col(tier) <= 2), "missing")
    return j.select(key, status.alias("status")).where(F.col("status").isNotNull())


def snapshot_diff(expected: DataFrame, got: DataFrame, key: str, values: list[str], tol: float = 1e-3) -> DataFrame:
    """Rows on one side only, and values that differ by more than ``tol`` (null against a number differs)."""
    e = expected.select(key, F.lit(1).alias("__tw_e"), *[F.col(v).alias(f"{v}_want") for v in values])
    g = got.select(key, F.lit(1).alias("__tw_g"), *[F.col(v).alias(f"{v}_got") for v in values])
    far = F.lit(False)
    for v in values:
        far |= (F.col(f"{v}_want").isNull() != F.col(f"{v}_got").isNull()) | F.coalesce(F.abs(F.col(f"{v}_want") - F.col(f"{v}_got")) > tol, F.lit(False))
    kind = F.when(F.col("__tw_g").isNull(), "gone").when(F.col("__tw_e").isNull(), "new").when(far, "changed")
    return e.join(g, key, "full").withColumn("diff", kind).where(F.col("diff").isNotNull()).drop("__tw_e", "__tw_g")


def plan_steps(counts: DataFrame, rules: list[tuple[str, int, str]]) -> DataFrame:
    """Steps for the kinds of input present: rules (kind, least count, step), in the order given."""
    made = counts.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(rules, 1)], "step_no int, kind string, least int, step string")
    return counts.join(F.broadcast(made), "kind").where(F.col("n") >= F.col("least")).select("step_no", "kind", "step", "n")


def rename_refs(refs: DataFrame, names: DataFrame, ref: str, old: str, new: str) -> DataFrame:
    """References with their new names where the map has one."""
    return refs.join(names.select(F.col(old).alias(ref), F.col(new).alias("__tw_n")), ref, "left").withColumn("renamed", F.coalesce("__tw_n", ref)).drop("__tw_n")


def backfill(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill what is missing only; columns that don't exist are added."""
    return df.withColumns({c: F.coalesce(F.col(c), v) if c in df.columns else v for c, v in defaults.items()})


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``, or an error when it has no rows."""
    if df.isEmpty():
        raise EmptyInput(f"no {what}: nothing was processed")
    return df


def crop_rules(made: DataFrame) -> DataFrame:
    """Rules (slides ``1-100``, x, y, w, h) with their bounds ``lo`` and ``hi`` and what is wrong with them (``fault``, null if nothing).

    The few rules of one course are compared with each other: overlapping ranges are ambiguous.
    """
    bounds = lambda i: F.regexp_extract("slides", "^([1-9][0-9]*)(?:-([1-9][0-9]*))?$", i)
    r = made.withColumn("lo", F.nullif(bounds(1), F.lit("")).cast("int")).withColumn("hi", F.coalesce(F.nullif(bounds(2), F.lit("")), F.nullif(bounds(1), F.lit(""))).cast("int"))
    reach = F.max("hi").over(Window.partitionBy(F.lit(1)).orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1))
    box = (F.col("x") < 0) | (F.col("y") < 0) | (F.col("w") < 200) | (F.col("h") < 200)
    return r.withColumn("fault", F.when(F.col("lo").isNull(), "range").when((F.col("lo") > F.col("hi")) | F.coalesce(box, F.lit(True)), "bounds").when(F.coalesce(F.col("lo") <= reach, F.lit(False)), "overlap"))


def crop_boxes(slides: DataFrame, ident: str, made: DataFrame) -> DataFrame:
    """Slides with the box of the rule for their number; an error when a rule is wrong."""
    r = crop_rules(made)
    wrong = r.where("fault is not null").select("slides", "fault").limit(1).collect()
    if wrong:
        raise ValueError(f"crop rule for slides {wrong[0]['slides']}: {wrong[0]['fault']}")
    each = r.select(F.explode(F.sequence("lo", "hi")).alias("__tw_n"), "x", "y", "w", "h")
    return slides.join(each, slides[ident] == F.col("__tw_n"), "left").drop("__tw_n")


def suspects_first(suspects: DataFrame, n: str = "n", first: str = "first_seg") -> DataFrame:
    """Most frequent suspects first, then those met first."""
    return suspects.orderBy(F.desc(n), first)


def with_overview(content: DataFrame, overview: DataFrame) -> DataFrame:
    """Content and overview segments in one table, told apart by ``is_overview``."""
    return content.withColumn("is_overview", F.lit(False)).unionByName(overview.withColumn("is_overview", F.lit(True)))


def intro_then(intro: DataFrame, pages: DataFrame, order: str) -> DataFrame:
    """Introductory pages, then the others, numbered through in that order (``page_no`` from 1)."""
    both = intro.withColumn("__tw_part", F.lit(0)).unionByName(pages.withColumn("__tw_part", F.lit(1)))
    # pages of one deck
    return both.withColumn("page_no", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("__tw_part", order))).drop("__tw_part")


def merged_config(base: dict, own: dict) -> dict:
    """``base`` with the values of ``own``, section by section; null keeps what is there."""
    out = dict(base)
    for k, v in own.items():
        if isinstance(v, dict) and isinstance(out.get(k), dict):
            out[k] = merged_config(out[k], v)
        elif v is not None or k not in out:
            out[k] = v
    return out
