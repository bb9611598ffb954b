"""Order-dependent operators: islands, merges, spans and alignments, each within its keys."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import script_class


def islands(df: DataFrame, keys: list[str], order: list, new: Column, name: str = "__tw_island") -> DataFrame:
    """Number the runs of rows between rows where ``new`` holds (null counts as true, so the first row opens one)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__tw_new", F.coalesce(new, F.lit(True)).cast("int")).withColumn(name, F.sum("__tw_new").over(w)).drop("__tw_new")


def adjacent_dedup(frames: DataFrame, keys: list[str], order: str, h: str = "h", step: int = 40, drift: int | None = None, changed: str | None = None, moved: float = 0.06) -> DataFrame:
    """Groups of neighbouring frames: a new one when the hash moved ``step`` bits from the previous frame or ``drift`` (twice ``step``) from the group's first.

    A hash is a 64-bit integer, or binary of any width that all frames share.
    With ``changed`` (share of pixels that differ from the previous frame) a
    share of more than ``moved`` opens a group, too. The second rule depends on
    the group so far, so each key's frames are folded in order, each once; the
    last frame of a group is kept with the group's size and first.
    """
    import numpy as np
    import pandas as pd

    drift = 2 * step if drift is None else drift
    binary = dict(frames.dtypes)[h] == "binary"

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        bits = np.frombuffer(b"".join(pdf[h]), np.uint8).reshape(len(pdf), -1) if binary else pdf[h].to_numpy(np.int64).view(np.uint8).reshape(-1, 8)
        far = np.bitwise_count(bits[1:] ^ bits[:-1]).sum(1, dtype=int) >= step
        if changed:
            far |= (pdf[changed].to_numpy(float) > moved)[1:]
        whole = [int.from_bytes(r) for r in bits]
        opens, first = [True], whole[0]
        for own, new in zip(whole[1:], far.tolist(), strict=True):
            new = new or (own ^ first).bit_count() >= drift
            opens.append(new)
            if new:
                first = own
        grp = pd.Series(np.cumsum(opens).astype(np.int32), index=pdf.index, name="grp")
        out = pdf.groupby(grp)[order].agg(["size", "first", "last"]).reset_index()
        out.columns = ["grp", "group_size", "first_frame", "kept_frame"]
        return pd.concat([pd.DataFrame({k: pdf[k].iloc[0] for k in keys}, index=out.index), out], axis=1)

    kinds = dict(frames.dtypes)
    ddl = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"grp int, group_size long, first_frame {kinds[order]}, kept_frame {kinds[order]}"])
    return frames.select(*keys, order, h, *([changed] if changed else [])).groupBy(*keys).applyInPandas(fold, ddl)


def semantic_groups(df: DataFrame, keys: list[str], order: str, same: Column, text: str) -> DataFrame:
    """Neighbours that are the ``same`` form groups; the longest text is canonical, ties to the latest."""
    g = islands(df, keys, [order], ~same, "grp")
    best = Window.partitionBy(*keys, "grp").orderBy(F.desc(F.length(text)), F.desc(order))
    span = Window.partitionBy(*keys, "grp")
    return g.withColumn("is_canonical", F.row_number().over(best) == 1).withColumn("grp_start", F.min("start_s").over(span)).withColumn("grp_end", F.max("end_s").over(span))


def drop_repeats(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Rows whose value differs from the row before."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("__tw_p", F.lag(value).over(w)).where(F.col("__tw_p").isNull() | ~F.col("__tw_p").eqNullSafe(F.col(value))).drop("__tw_p")


def block_end(blocks: DataFrame, keys: list[str], start: str, tail_s: float = 45) -> DataFrame:
    """A block ends where the next one starts; the last one after ``tail_s``."""
    w = Window.partitionBy(*keys).orderBy(start)
    return blocks.withColumn("block_end", F.coalesce(F.lead(start).over(w), F.col(start) + tail_s))


def cover_span(slides: DataFrame, keys: list[str], start: str) -> DataFrame:
    """A slide covers until the next slide starts; the last one is open."""
    return slides.withColumn("cover_end", F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))


def inherit_time(blocks: DataFrame, keys: list[str], order: str, start: str) -> DataFrame:
    """A block without a time takes the last known one before it in its section."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = blocks.withColumn("time_from", F.last(F.when(F.col(start).isNotNull(), F.col(order)), True).over(w)).withColumn("filled_start", F.last(start, True).over(w))
    source = F.when(F.col(start).isNotNull(), "precise").when(F.col("filled_start").isNotNull(), "inherited")
    return filled.withColumn("time_source", source)


def gap_classes(media: DataFrame, keys: list[str], lo: str, hi: str, chain_s: float = 5, break_min: float = 8) -> DataFrame:
    """Gap to the row before, by start: overlap, chain, gap or break."""
    w = Window.partitionBy(*keys).orderBy(lo, hi)
    gap = F.col(lo) - F.lag(hi).over(w)
    kind = F.when(F.col("gap_s").isNull(), "first").when(F.col("gap_s") < 0, "overlap").when(F.col("gap_s") <= chain_s, "chain").when(F.col("gap_s") >= break_min * 60, "break").otherwise("gap")
    return media.withColumn("gap_s", gap).withColumn("gap_class", kind)


def runs(df: DataFrame, keys: list[str], order: str, member: Column, same_as: str | None = None, min_run: int = 3) -> DataFrame:
    """Runs of at least ``min_run`` neighbours that are members (and share ``same_as``)."""
    w = Window.partitionBy(*keys).orderBy(order)
    m = df.withColumn("__tw_m", F.coalesce(member, F.lit(False)))
    new = ~(F.col("__tw_m") & F.lag("__tw_m").over(w)) if same_as is None else ~(F.col("__tw_m") & F.lag("__tw_m").over(w) & F.col(same_as).eqNullSafe(F.lag(same_as).over(w)))
    g = islands(m, keys, [order], new).where("__tw_m")
    return g.groupBy(*keys, "__tw_island").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"), F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s")).where(F.col("n") >= min_run).drop("__tw_island")


def low_rate_windows(segments: DataFrame, keys: list[str], text: str = "text", min_s: float = 30, share: float = 0.3, enough: int = 5) -> DataFrame:
    """Windows of some ``min_s`` seconds whose characters a second fall under ``share`` of the median for their script.

    A window starts at a segment of half a second or more and takes the segments
    up to the first that ends ``min_s`` after its start; it counts when it lasts
    0.8 of that. The median (upper, of segments over half a second with text) is
    that of the script most of its segments are in, or of all where ``enough``
    segments of it are missing. After a low window the search goes on behind it.
    One recording is one group, read in order once.
    """
    import numpy as np
    import pandas as pd

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start_s", "end_s"], kind="stable")
        lo, hi, n, cjk = (pdf[c].to_numpy() for c in ("start_s", "end_s", "__tw_n", "__tw_cjk"))
        timed = (hi - lo > 0.5) & (n > 0)
        rate = n[timed] / (hi - lo)[timed]
        out: list[tuple] = []
        if len(rate):
            median = lambda x: np.sort(x)[len(x) // 2]
            of = {c: median(r) if len(r := rate[cjk[timed] == c]) >= enough else median(rate) for c in (True, False)}
            chars, han, i = np.concatenate(([0], np.cumsum(n))), np.concatenate(([0], np.cumsum(cjk))), 0
            while i < len(lo):
                if hi[i] - lo[i] >= 0.5:
                    late = np.flatnonzero(hi[i:] - lo[i] >= min_s)
                    j = i + int(late[0]) if len(late) else len(lo)
                    if j > i and hi[j - 1] - lo[i] >= min_s * 0.8:
                        here = (chars[j] - chars[i]) / (hi[j - 1] - lo[i])
                        script = bool((han[j] - han[i]) * 2 >= j - i)
                        if here < of[script] * share:
                            out.append((float(lo[i]), float(hi[j - 1]), float(here), float(of[script] * share), "cjk" if script else "latin"))
                            i = j
                            continue
                i += 1
        got = pd.DataFrame(out, columns=["lo", "hi", "rate", "under", "script"])
        return pd.concat([pd.DataFrame({k: pdf[k].iloc[0] for k in keys}, index=got.index), got], axis=1)

    kinds = dict(segments.dtypes)
    ddl = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "lo double, hi double, rate double, under double, script string"])
    bare = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "^\\s+|\\s+$", ""))
    rows = segments.select(*keys, F.col("start_s").cast("double").alias("start_s"), F.col("end_s").cast("double").alias("end_s"), F.length(bare).alias("__tw_n"), (script_class(bare) == "cjk").alias("__tw_cjk"))
    return rows.groupBy(*keys).applyInPandas(find, ddl)


def merge_intervals(df: DataFrame, keys: list[str], lo: str, hi: str, tol: float = 5, reason: str | None = None) -> DataFrame:
    """Merge intervals that overlap or lie within ``tol``; their reasons are joined by `` | `` in order, repeated ones too."""
    order = [lo, hi, *([reason] if reason else [])]
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    g = islands(df.withColumn("__tw_reach", F.max(hi).over(before)), keys, order, F.col(lo) > F.col("__tw_reach") + tol)
    reasons = [F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order))), lambda x: x[reason]), " | ").alias("reasons")] if reason else []
    return g.groupBy(*keys, "__tw_island").agg(F.min(lo).alias(lo), F.max(hi).alias(hi), F.count("*").alias("n"), *reasons).drop("__tw_island")


def smooth_zscore(scores: DataFrame, row_keys: list[str], order: str, column_keys: list[str], value: str, k: int = 3) -> DataFrame:
    """Mean over k rows to either side, then z-score within the column (0 without spread)."""
    near = F.avg(value).over(Window.partitionBy(*row_keys).orderBy(order).rowsBetween(-k, k))
    s = scores.withColumn("smooth", near)
    # a column's two figures are aggregated and joined: no task holds a whole column
    stats = s.groupBy(*column_keys).agg(F.avg("smooth").alias("__tw_mean"), F.stddev_pop("smooth").alias("__tw_sd"))
    return s.join(stats, column_keys).withColumn("z", F.when(F.col("__tw_sd") > 0, (F.col("smooth") - F.col("__tw_mean")) / F.col("__tw_sd")).otherwise(F.lit(0.0))).drop("__tw_mean", "__tw_sd")


def monotone_align(scores: DataFrame, key: str, row: str, col: str, value: str, jump: float = 0.15, back: int = 12) -> DataFrame:
    """Best path of rows through never-decreasing columns, a jump of j columns costing ``jump`` * j, at most ``back`` at once.

    One recording is one group: its score matrix is that of one lecture.
    """
    import numpy as np
    import pandas as pd

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        s = pdf.pivot_table(index=row, columns=col, values=value, aggfunc="max", fill_value=0.0)
        m = s.to_numpy()
        n, p = m.shape
        total, came = m[0].copy(), np.zeros((n, p), int)
        for i in range(1, n):
            options = np.full((back + 1, p), -np.inf)
            for j in range(min(back, p - 1) + 1):
                options[j, j:] = total[: p - j] - jump * j
            step = options.argmax(axis=0)
            came[i] = np.arange(p) - step
            total = options.max(axis=0) + m[i]
        path = [int(total.argmax())]
        for i in range(n - 1, 0, -1):
            path.append(int(came[i, path[-1]]))
        return pd.DataFrame({key: pdf[key].iloc[0], row: s.index, col: s.columns.to_numpy()[path[::-1]]})

    kinds = dict(scores.dtypes)
    return scores.select(key, row, col, value).groupBy(key).applyInPandas(best, f"`{key}` {kinds[key]}, `{row}` {kinds[row]}, `{col}` {kinds[col]}")


def page_spans(path: DataFrame, pages: DataFrame, key: str, row: str, page: str, t: str) -> DataFrame:
    """Span of every page: from its first row's time to the next spoken page's; silent pages get no length at the previous end."""
    spoken = path.groupBy(key, page).agg(F.min(t).alias("span_start"))
    w = Window.partitionBy(key).orderBy(page)
    both = pages.select(key, page).join(spoken, [key, page], "left")
    after = F.first("span_start", True).over(w.rowsBetween(1, Window.unboundedFollowing))
    out = both.withColumn("next_start", after).withColumn("silent", F.col("span_start").isNull())
    start = F.coalesce("span_start", "next_start", F.last("span_start", True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return out.withColumn("span_start", start).withColumn("span_end", F.when(F.col("silent"), F.col("span_start")).otherwise(F.col("next_start"))).drop("next_start")


def context_rows(df: DataFrame, keys: list[str], order: str, match: Column, k: int = 2) -> DataFrame:
    """Matching rows with k rows around them."""
    near = F.max(match.cast("int")).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(-k, k))
    return df.withColumn("__tw_near", near).where("__tw_near = 1").withColumn("is_match", match).drop("__tw_near")


# What ends a sentence, and what ends a clause.
HARD, SOFT = "。！？!?…", "，,、；;:："


def split_untimed(segments: DataFrame, keys: list[str], text: str = "text", max_dur: float = 8) -> DataFrame:
    """Sentences of segments longer than ``max_dur``, timed by their share of the characters, to hundredths of a second.

    A sentence that would still take longer is cut into runs of as many
    characters as ``max_dur`` holds. Shorter segments stay as they are.
    """
    bare = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "^\\s+|\\s+$", "")
    dur = F.col("end_s") - F.col("start_s")
    each = dur / F.greatest(F.length(bare), F.lit(1))
    size = F.greatest(F.floor(max_dur / each), F.lit(1)).cast("int")
    sentences = F.filter(F.split(bare, f"(?<=[{HARD}])", -1), lambda p: F.trim(F.regexp_replace(p, "\\s+", "")) != "")
    runs = F.flatten(F.transform(sentences, lambda p: F.when(F.length(p) * each <= max_dur, F.array(p)).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(p), F.lit(1)), size), lambda i: F.substring(p, i, size)))))
    parts = F.when((dur <= max_dur) | (bare == ""), F.array(bare)).otherwise(runs)
    rows = segments.select(*keys, "start_s", "end_s", F.posexplode(parts).alias("pos", "part"))
    w = Window.partitionBy(*keys)
    upto, total = F.sum(F.length("part")).over(w.orderBy("pos")), F.greatest(F.sum(F.length("part")).over(w), F.lit(1))
    at = lambda n: F.round(F.col("start_s") + dur * n / total, 2)
    return rows.select(*keys, "pos", F.regexp_replace("part", "^\\s+|\\s+$", "").alias("sentence"), at(upto - F.length("part")).alias("from_s"), F.when(total == 1, F.round("end_s", 2).cast("double")).otherwise(at(upto)).alias("to_s"))


def split_sentences(segments: DataFrame, keys: list[str], words: str = "words", max_dur: float = 8, soft_dur: float = 4, gap_s: float = 3) -> DataFrame:
    """Greedy sentences of timed words: keys, sentence_no from 1, start_s, end_s, text.

    ``words`` is a segment's array of structs w, start_s, end_s in order. Cut
    after a full stop, after a clause mark once ``soft_dur`` is reached, before a
    gap, and before a word that would make it longer than ``max_dur``. Each
    segment is folded within its row: nothing is shuffled. Null and empty words
    keep their time but not their place in the text.
    """
    kind = pa.struct([("sentence_no", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("text", pa.string())])

    def fold(said: list[dict] | None) -> list[dict]:
        out: list[dict] = []
        cut = True
        for word in said or ():
            w, lo, hi = word["w"] or "", word["start_s"], word["end_s"]
            if cut or lo - out[-1]["end_s"] > gap_s or hi - out[-1]["start_s"] > max_dur:
                out.append({"sentence_no": len(out) + 1, "start_s": lo, "text": []})
            own, last = out[-1], w.strip()[-1:]
            own["end_s"] = hi
            if w:
                own["text"].append(w)
            cut = last != "" and (last in HARD or (last in SOFT and hi - own["start_s"] >= soft_dur))
        return [o | {"text": " ".join(o["text"])} for o in out]

    def run(rows: pa.Array) -> pa.Array:
        # a slice at a time: segments may be long
        parts = [pa.array([fold(s) for s in rows.slice(at, 256).to_pylist()], pa.list_(kind)) for at in range(0, len(rows), 256)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(kind))

    timed = F.transform(words, lambda x: F.struct(x["w"].cast("string").alias("w"), x["start_s"].cast("double").alias("start_s"), x["end_s"].cast("double").alias("end_s")))
    cut = F.arrow_udf(run, "array<struct<sentence_no:int,start_s:double,end_s:double,text:string>>")(timed)
    return segments.select(*keys, F.explode(cut).alias("__tw_s")).select(*keys, "__tw_s.*")


def display_rank(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("display_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def attachment_numbers(slides: DataFrame, keys: list[str], tier: str, order: str) -> DataFrame:
    """Numbers from 1: tiers 1 and 2 first, then 3, each in order."""
    return slides.withColumn("attachment_no", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(tier) > 2, order)))


def first_owner(refs: DataFrame, ref: str, owner: str, order: list) -> DataFrame:
    """Every reference belongs to its first owner by ``order``."""
    return refs.withColumn("__tw_r", F.row_number().over(Window.partitionBy(ref).orderBy(*order))).where("__tw_r = 1").select(ref, owner)


def contiguous(df: DataFrame, keys: list[str], idx: str) -> DataFrame:
    """Whether a group's distinct indexes have no hole."""
    g = df.groupBy(*keys).agg(F.min(idx).alias("lo"), F.max(idx).alias("hi"), F.count_distinct(idx).alias("n"))
    return g.withColumn("contiguous", F.col("hi") - F.col("lo") + 1 == F.col("n"))


def order_diff(df: DataFrame, keys: list[str], position: str, chronological: list) -> DataFrame:
    """Rows whose position differs from their rank in time."""
    by_pos = F.row_number().over(Window.partitionBy(*keys).orderBy(position))
    by_time = F.row_number().over(Window.partitionBy(*keys).orderBy(*chronological))
    return df.withColumn("at", by_pos).withColumn("chrono", by_time).where("at <> chrono")


def gallery_runs(lines: DataFrame, keys: list[str], order: str, image: Column, transparent: Column, min_run: int = 3) -> DataFrame:
    """Runs of images, with transparent lines between them ignored."""
    w = Window.partitionBy(*keys).orderBy(order)
    seen = lines.where(~F.coalesce(transparent, F.lit(False))).withColumn("__tw_i", F.coalesce(image, F.lit(False)))
    g = islands(seen, keys, [order], ~(F.col("__tw_i") & F.lag("__tw_i").over(w))).where("__tw_i")
    return g.groupBy(*keys, "__tw_island").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).where(F.col("n") >= min_run).drop("__tw_island")


def sections(lines: DataFrame, keys: list[str], order: str, heading: Column) -> DataFrame:
    """The heading that each line stands under, and for headings whether nothing follows before the next."""
    w = Window.partitionBy(*keys).orderBy(order)
    head = lines.withColumn("__tw_h", F.coalesce(heading, F.lit(False)))
    under = F.last(F.when(F.col("__tw_h"), F.col(order)), True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    empty = F.col("__tw_h") & F.coalesce(F.lead("__tw_h").over(w), F.lit(True))
    return head.withColumn("section", under).withColumn("empty_heading", empty).drop("__tw_h")


def running_eta(df: DataFrame, keys: list[str], order: str, seconds: str) -> DataFrame:
    """Mean time so far times what is left."""
    w = Window.partitionBy(*keys).orderBy(order)
    left = F.count("*").over(Window.partitionBy(*keys)) - F.row_number().over(w)
    return df.withColumn("eta_s", F.avg(seconds).over(w.rowsBetween(Window.unboundedPreceding, 0)) * left)


def plan_findings(plan: DataFrame, keys: list[str], lo: str, hi: str, total: str, chunk_s: int = 1800, ties: Sequence[str] = ()) -> DataFrame:
    """Plan rows that overlap the next one, leave a gap, or end the plan short of ``total``; with the chunks a recording needs.

    Rows that begin together follow each other by the columns ``ties``; without them which one is next is left open.
    """
    w = Window.partitionBy(*keys).orderBy(lo, *ties)
    nxt = F.lead(lo).over(w)
    finding = F.when(nxt < F.col(hi), "overlap").when(nxt > F.col(hi), "gap").when(nxt.isNull() & (F.col(hi) < F.col(total)), "short").otherwise("ok")
    return plan.withColumn("finding", finding).withColumn("chunks", F.ceil(F.col(total) / chunk_s))


def transcription_parts(media: DataFrame, keys: list[str], size: str, duration: str, cap_bytes: int = 24 << 20, part_s: int = 1200) -> DataFrame:
    """The parts in which a file is sent to a transcriber: keys, part from 0, offset_s, until_s.

    A file up to ``cap_bytes`` is one part, a larger one is cut every ``part_s``
    seconds. Files without a duration give one part with a null end.
    """
    n = F.when(F.coalesce(F.col(size) <= cap_bytes, F.lit(True)) | F.col(duration).isNull(), 1).otherwise(F.greatest(F.ceil(F.col(duration) / part_s), F.lit(1)))
    parts = media.select(*keys, duration, n.cast("int").alias("__tw_n"), F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("part"))
    end = F.when(F.col("part") == F.col("__tw_n") - 1, F.col(duration).cast("double")).otherwise((F.col("part") + 1) * float(part_s))
    return parts.select(*keys, "part", (F.col("part") * float(part_s)).alias("offset_s"), end.alias("until_s"))


def joined_parts(segments: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    """Segments of parts (keys, part, start_s, end_s) on their file's own time, rounded to hundredths."""
    placed = segments.join(parts.select(*keys, "part", F.col("offset_s").alias("__tw_o")), [*keys, "part"])
    on_file = {c: F.round(F.col(c) + F.col("__tw_o"), 2) for c in ("start_s", "end_s")}
    return placed.withColumns(on_file).drop("__tw_o")
