"""Aggregates over segments, windows, runs and votes. Partial sums go before every shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.loops import loop_info


def reference_density(hits: DataFrame, key: list[str], hit: str) -> DataFrame:
    """Share of a slide's keywords that were heard."""
    return hits.groupBy(*key).agg(F.avg(F.col(hit).cast("int")).alias("density"))


def boilerplate(docs: DataFrame, tokens: str, token: str = "token", ratio: float = 0.4, min_n: int = 5) -> DataFrame:
    """Tokens (of an array column) in more than ``ratio`` of the documents that have any, when there are ``min_n`` of those: (token, df, n_docs)."""
    some = docs.where(F.size(tokens) > 0)
    n = some.agg(F.count("*").alias("n_docs"))
    # a token counts once in a document before anything is shuffled
    df = some.select(F.explode(F.array_distinct(tokens)).alias(token)).groupBy(token).agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(n)).where((F.col("n_docs") >= min_n) & (F.col("df") > F.col("n_docs") * ratio))  # one row is broadcast


def supported_vocab(docs: DataFrame, book: str, tokens: str, token: str = "token", min_books: int = 3, approx: bool = False) -> DataFrame:
    """Tokens (of an array column) found in at least ``min_books`` different books; ``approx`` counts by sketch."""
    n = F.approx_count_distinct(book, 0.01) if approx else F.count_distinct(book)
    return docs.select(book, F.explode(F.array_distinct(tokens)).alias(token)).groupBy(token).agg(n.alias("books")).where(F.col("books") >= min_books)


def recording_start(offsets: DataFrame, key: str, start: str) -> DataFrame:
    """Median and spread of the starts that a recording's clips imply."""
    return offsets.groupBy(key).agg(F.median(start).alias("measured_start"), (F.max(start) - F.min(start)).alias("spread_s"), F.count("*").alias("n_clips"))


def window_of(start: Column, end: Column, window_s: float) -> Column:
    """Number of the window that a segment's midpoint lies in."""
    return F.greatest(F.floor((start + end) / 2 / window_s), F.lit(0).cast("long"))


def assign_windows(segments: DataFrame, keys: list[str], window_s: int = 60) -> DataFrame:
    """Segments' texts by the window of their midpoint, in time order; midpoints past the last whole window fall into it."""
    last = F.greatest(F.ceil(F.max("end_s").over(Window.partitionBy(*keys)) / window_s) - 1, F.lit(0))
    w = segments.withColumn("window", F.least(window_of(F.col("start_s"), F.col("end_s"), window_s), last))
    return w.groupBy(*keys, "window").agg(_ordered_text(F.struct("start_s", "text")), F.count("*").alias("n"))


def _ordered_text(by: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(by)), lambda x: x["text"]), " ").alias("text")


def bucket_text(segments: DataFrame, keys: list[str], width_s: int = 30) -> DataFrame:
    """Texts of segments by the bucket of their start, in time order."""
    b = segments.withColumn("bucket", F.floor(F.col("start_s") / width_s) * width_s)
    return b.groupBy(*keys, "bucket").agg(_ordered_text(F.struct("start_s", "text")))


def loops(windows: DataFrame, keys: list[str], lines: Column, **limits) -> DataFrame:
    """Degenerate repetition of each window's lines (an array), found within the row: nothing is shuffled. ``limits`` as in loop_info."""
    return windows.select(*keys, loop_info(lines, **limits).alias("__tw_l")).select(*keys, "__tw_l.*")


def coverage(notes: DataFrame, transcripts: DataFrame, key: str, chars: str, floor: float = 0.10) -> DataFrame:
    """Note characters over transcript characters; null without a transcript, and only known ratios can be low."""
    n = notes.groupBy(key).agg(F.sum(chars).alias("note"))
    t = transcripts.groupBy(key).agg(F.sum(chars).alias("heard"))
    ratio = F.when(F.col("heard") > 0, F.col("note") / F.col("heard"))
    return n.join(t, key, "left").withColumn("ratio", ratio).withColumn("low", F.coalesce(F.col("ratio") < floor, F.lit(False)))


def distribution(df: DataFrame, keys: list[str], value: str, cut: float) -> DataFrame:
    """Count, how many are under ``cut``, and linearly interpolated percentiles."""
    p = [F.percentile(value, F.lit(q / 100)).alias(f"p{q}") for q in (10, 50, 90)]
    return df.groupBy(*keys).agg(F.count(value).alias("n"), F.count_if(F.col(value) < cut).alias("low"), *p)


def collapse_share(segments: DataFrame, keys: list[str], is_short: Column, min_n: int = 20, share: float = 0.5, run: int = 12) -> DataFrame:
    """Share of short segments and the longest run of them; collapsed by share (of enough segments) or by run."""
    w = Window.partitionBy(*keys).orderBy("start_s")
    s = segments.withColumn("__tw_s", F.coalesce(is_short, F.lit(False)).cast("int"))
    s = s.withColumn("__tw_island", F.sum(1 - F.col("__tw_s")).over(w))
    runs = s.groupBy(*keys, "__tw_island").agg(F.sum("__tw_s").alias("__tw_r"), F.count("*").alias("__tw_c"))
    out = runs.groupBy(*keys).agg(F.sum("__tw_c").alias("n"), (F.sum("__tw_r") / F.sum("__tw_c")).alias("short_share"), F.max("__tw_r").alias("longest_run"))
    return out.withColumn("collapsed", ((F.col("n") >= min_n) & (F.col("short_share") >= share)) | (F.col("longest_run") >= run))


def vote_argmax(votes: DataFrame, keys: list[str], option: str, weight: str) -> DataFrame:
    """The option of the greatest total weight, ties to the lesser option."""
    total = votes.groupBy(*keys, option).agg(F.sum(weight).alias("weight"))
    w = Window.partitionBy(*keys).orderBy(F.desc("weight"), option)
    return total.withColumn("__tw_r", F.row_number().over(w)).where("__tw_r = 1").drop("__tw_r")


def chapters(blocks: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Bounds, size and first block of every section."""
    return blocks.groupBy(*keys).agg(F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"), F.count("*").alias("blocks"), F.min_by(order, F.struct("start_s", order)).alias("first_block"))


def segment_durations(blocks: DataFrame, key: str, file: str) -> DataFrame:
    """Sum over a segment's files of the time between first start and last end."""
    per = blocks.groupBy(key, file).agg((F.max("end_s") - F.min("start_s")).alias("s"))
    return per.groupBy(key).agg(F.sum("s").alias("duration_s"), F.count("*").alias("files"))


def engine_kpis(runs: DataFrame, engine: str, item: str, valid: Column, score: str, latency: str) -> DataFrame:
    """Per engine: valid rate, mean and greatest score, mean over items of the coefficient of variation, latency."""
    per = runs.groupBy(engine, item).agg(F.sum(valid.cast("int")).alias("v"), F.count("*").alias("c"), F.sum(score).alias("s"), F.max(score).alias("m"), F.sum(latency).alias("l"), (F.stddev_pop(score) / F.avg(score)).alias("cv"))
    return per.groupBy(engine).agg((F.sum("v") / F.sum("c")).alias("valid_rate"), (F.sum("s") / F.sum("c")).alias("mean_score"), F.max("m").alias("max_score"), F.avg("cv").alias("cv"), (F.sum("l") / F.sum("c")).alias("latency"))


def kpi_pivot(runs: DataFrame, rows: str, column: str, values: list[str], score: str) -> DataFrame:
    return runs.groupBy(rows).pivot(column, values).agg(F.avg(score))


def upper_median(df: DataFrame, keys: list[str], value: str, min_n: int = 5) -> DataFrame:
    """The element at place n // 2 of each group's sorted values; groups under ``min_n`` take that of all rows."""
    def of(frame: DataFrame, by: list[str]) -> DataFrame:
        # exact, and no group is gathered in one place: the place is found from counts of equal values
        counts = frame.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("c"))
        w = Window.partitionBy(*by)
        placed = counts.withColumn("upto", F.sum("c").over(w.orderBy(value))).withColumn("n", F.sum("c").over(w))
        return placed.where((F.col("upto") > F.floor(F.col("n") / 2)) & (F.col("upto") - F.col("c") <= F.floor(F.col("n") / 2))).select(*by, F.col(value).alias("m"), "n")

    everything = of(df.withColumn("__tw_all", F.lit(1)), ["__tw_all"]).select(F.col("m").alias("overall"))
    return of(df, keys).crossJoin(F.broadcast(everything)).select(*keys, F.when(F.col("n") >= min_n, F.col("m")).otherwise(F.col("overall")).alias("median"), "n")


def duration_stats(df: DataFrame, keys: list[str], value: Column, limit: float = 15) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias("mean_s"), F.max(value).alias("max_s"), F.count_if(value > limit).alias("over"))


def guard_ratio(df: DataFrame, keys: list[str], failed: Column, attempted: Column, limit: float = 0.2) -> DataFrame:
    """Failures over attempts; nothing attempted is a failure too: empty must not look clean."""
    g = df.groupBy(*keys).agg(F.count_if(attempted).alias("attempted"), F.count_if(failed & attempted).alias("failed"))
    return g.withColumn("ok", (F.col("attempted") > 0) & (F.col("failed") <= F.col("attempted") * limit))


def photos_per_recording(matches: DataFrame, photo: str, recording: str) -> DataFrame:
    """Photos per recording; the null recording holds those outside every one."""
    return matches.groupBy(recording).agg(F.count_distinct(photo).alias("photos"))


def first_mode(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Most frequent value, ties to the one that comes first."""
    c = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("o"))
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), "o")
    return c.withColumn("__tw_r", F.row_number().over(w)).where("__tw_r = 1").select(*keys, value, "n")


def days_covered(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(F.to_date(ts)).alias("days"))


def grid_consensus(samples: DataFrame, keys: list[str], shape: str, edge: str) -> DataFrame:
    """Modal shape (ties to the lesser), with median and sample deviation of the edge among samples of that shape."""
    modal = first_mode(samples, keys, shape, shape).select(*keys, shape)
    return samples.join(modal, [*keys, shape]).groupBy(*keys, shape).agg(F.median(edge).alias("edge"), F.stddev_samp(edge).alias("spread"), F.count("*").alias("n"))


def signal_cache(slides: DataFrame, key: str, signals: str, order: str) -> DataFrame:
    """The first known signals of every hash."""
    return slides.where(F.col(signals).isNotNull()).groupBy(key).agg(F.min_by(signals, order).alias(signals))


def sample_pages(pages: DataFrame, keys: list[str], page: str) -> DataFrame:
    """Pages of which a document's layout is judged: all of up to five, else five spread evenly after the first; ``page`` counts from 0."""
    n = F.count("*").over(Window.partitionBy(*keys))
    chosen = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.floor(1 + (n - 2) * i / 4))
    return pages.withColumn("__tw_keep", (n <= 5) | F.array_contains(chosen, F.col(page).cast("long"))).where("__tw_keep").drop("__tw_keep")


def band_consensus(samples: DataFrame, keys: list[str], page: str, grid: str, drift: float = 0.02) -> DataFrame:
    """A document's row and column bands: medians over the sampled pages of its most frequent shape's count.

    One row for each band: axis, band, start, end (medians), the sample
    deviations of both (0 for one page), pages, and whether it drifts by more
    than ``drift``. Ties of shapes go to the one that comes first.
    """
    shaped = samples.where(F.col(grid).isNotNull()).withColumn("__tw_shape", F.struct(F.size(f"{grid}.rows").alias("rows"), F.size(f"{grid}.cols").alias("cols")))
    modal = first_mode(shaped, keys, "__tw_shape", page).select(*keys, F.col("__tw_shape").alias("__tw_modal"))
    held = shaped.join(modal, keys)
    edges = []
    for axis in ("rows", "cols"):
        of = held.where(F.col(f"__tw_shape.{axis}") == F.col(f"__tw_modal.{axis}"))
        edges.append(of.select(*keys, F.lit(axis).alias("axis"), F.posexplode(f"{grid}.{axis}").alias("band", "__tw_b")))
    deviation = lambda c: F.coalesce(F.stddev_samp(c), F.lit(0.0))
    out = edges[0].unionByName(edges[1]).groupBy(*keys, "axis", "band").agg(F.median("__tw_b.start").alias("start"), F.median("__tw_b.end").alias("end"), deviation("__tw_b.start").alias("start_std"), deviation("__tw_b.end").alias("end_std"), F.count("*").alias("pages"))
    return out.withColumn("drifts", F.greatest("start_std", "end_std") > drift)


def crop_cells(pages: DataFrame, keys: list[str], page: str, grid: str, consensus: DataFrame, pad: float = 0.02) -> DataFrame:
    """Boxes of all pages' cells, row by row, padded, numbered through a document from 1.

    The document's bands hold for every page, but of more than five pages the
    first and the last, when they weren't sampled and show another shape or a
    single slide, keep their own.
    """
    def own(axis: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("axis") == axis, F.struct("band", "start", "end"))))

    agreed = consensus.groupBy(*keys).agg(*(F.transform(own(a), lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))).alias(f"__tw_{a}") for a in ("rows", "cols")))
    n = F.count("*").over(Window.partitionBy(*keys))
    sampled = F.array_contains(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.floor(1 + (n - 2) * i / 4)), F.col(page).cast("long"))
    at_edge = (n > 5) & ((F.col(page) == 0) | (F.col(page) == n - 1)) & ~sampled
    single = (F.size(f"{grid}.rows") == 1) & (F.size(f"{grid}.cols") == 1)
    differs = F.col(grid).isNotNull() & (single | (F.size(f"{grid}.rows") != F.size("__tw_rows")) | (F.size(f"{grid}.cols") != F.size("__tw_cols")))
    placed = pages.withColumn("__tw_edge", at_edge).join(agreed, keys)
    source = F.when(F.col("__tw_edge") & F.coalesce(differs, F.lit(False)), "page").otherwise("consensus")
    placed = placed.withColumn("layout", source).withColumns({a: F.when(F.col("layout") == "page", F.col(f"{grid}.{a}")).otherwise(F.col(f"__tw_{a}")) for a in ("rows", "cols")})
    per = F.size("rows") * F.size("cols")
    before = F.coalesce(F.sum(per).over(Window.partitionBy(*keys).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("__tw_before", before)
    cells = placed.select(*keys, page, "layout", "__tw_before", "cols", F.posexplode("rows").alias("__tw_i", "__tw_r")).select(*keys, page, "layout", (F.col("__tw_before") + F.col("__tw_i") * F.size("cols")).alias("__tw_before"), "__tw_r", F.posexplode("cols").alias("__tw_j", "__tw_c"))
    low = lambda c: F.greatest(F.lit(0.0), F.col(c) - pad)
    high = lambda c: F.least(F.lit(1.0), F.col(c) + pad)
    return cells.select(*keys, page, "layout", (F.col("__tw_before") + F.col("__tw_j") + 1).alias("slide_id"), low("__tw_r.start").alias("top"), high("__tw_r.end").alias("bottom"), low("__tw_c.start").alias("left"), high("__tw_c.end").alias("right"))
