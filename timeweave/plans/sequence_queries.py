"""Order-dependent operators over the tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import sequences as W
from .proxies import HASH, SEG, SPAN, hashes, segments, spans, table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("w1_adjacent_dedup", f"""with recursive {HASH}, f as (select label, vec_id, h, row_number() over (partition by label order by vec_id) as i from hash),
r as (select label, i, vec_id, h, h as first, 1 as grp from f where i = 1 union all
  select f.label, f.i, f.vec_id, f.h, case when bit_count(xor(f.h, r.h)) >= 36 or bit_count(xor(f.h, r.first)) >= 34 then f.h else r.first end, r.grp + (bit_count(xor(f.h, r.h)) >= 36 or bit_count(xor(f.h, r.first)) >= 34)::int from r join f on f.label = r.label and f.i = r.i + 1)
select label, cast(grp as int) as grp, count(*) as group_size, min(vec_id) as first_frame, max(vec_id) as kept_frame from r group by 1, 2""")
def _w1(spark, d):
    return W.adjacent_dedup(hashes(spark, d), ["label"], "vec_id", step=36, drift=34)


@query("w1_changed_pixels", f"""with recursive {HASH}, f as (select h.label, h.vec_id, h.h, v.moved, row_number() over (partition by h.label order by h.vec_id) as i from hash h join (select vec_id, abs(embedding[1]) as moved from embeddings) v using (vec_id)),
r as (select label, i, vec_id, h, h as first, 1 as grp from f where i = 1 union all
  select f.label, f.i, f.vec_id, f.h, case when f.moved > 0.2 or bit_count(xor(f.h, r.first)) >= 40 then f.h else r.first end, r.grp + (f.moved > 0.2 or bit_count(xor(f.h, r.first)) >= 40)::int from r join f on f.label = r.label and f.i = r.i + 1)
select label, cast(grp as int) as grp, count(*) as group_size, min(vec_id) as first_frame, max(vec_id) as kept_frame from r group by 1, 2""")
def _w1c(spark, d):
    moved = table(spark, d, "embeddings").select("vec_id", F.abs(F.get("embedding", F.lit(0))).alias("moved"))
    binary = hashes(spark, d).withColumn("h", F.unhex(F.lpad(F.hex("h"), 16, "0")))
    return W.adjacent_dedup(binary.join(moved, "vec_id"), ["label"], "vec_id", step=65, drift=40, changed="moved", moved=0.2)


@query("w2_semantic_groups", f"""with {SEG}, n as (select *, case when length(text) >= 0.5 * lag(length(text)) over w and start_s - lag(start_s) over w < 60 then 0 else 1 end as new from seg window w as (partition by conv_id order by turn)),
g as (select *, sum(new) over (partition by conv_id order by turn) as grp from n)
select conv_id, turn, cast(grp as bigint) as grp, row_number() over (partition by conv_id, grp order by length(text) desc, turn desc) = 1 as is_canonical, min(start_s) over (partition by conv_id, grp) as grp_start, max(end_s) over (partition by conv_id, grp) as grp_end from g""")
def _w2(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    same = (F.length("text") >= 0.5 * F.lag(F.length("text")).over(w)) & (F.col("start_s") - F.lag("start_s").over(w) < 60)
    g = W.semantic_groups(segments(spark, d).withColumn("_same", same), ["conv_id"], "turn", F.col("_same"), "text")
    return g.select("conv_id", "turn", "grp", "is_canonical", "grp_start", "grp_end")


@query("w4_drop_repeats", "select user_id, event_id, event_type from (select *, lag(event_type) over (partition by user_id order by event_id) as p from events) where p is distinct from event_type")
def _w4(spark, d):
    return W.drop_repeats(table(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", "event_type")


@query("w5_block_end", f"with {SEG} select conv_id, role, turn, start_s, coalesce(lead(start_s) over (partition by conv_id, role order by start_s), start_s + 45) as block_end from seg")
def _w5(spark, d):
    return W.block_end(segments(spark, d).select("conv_id", "role", "turn", "start_s"), ["conv_id", "role"], "start_s")


@query("w6_cover_span", f"with {SEG} select conv_id, turn, lead(start_s) over (partition by conv_id, role order by start_s) as cover_end from seg")
def _w6(spark, d):
    return W.cover_span(segments(spark, d), ["conv_id", "role"], "start_s").select("conv_id", "turn", "cover_end")


@query("j17_inherit_time", f"""with {SEG}, t as (select conv_id, turn, case when turn % 3 = 1 then start_s end as start_s from seg)
select conv_id, turn, start_s, last_value(case when start_s is not null then turn end ignore nulls) over w as time_from, last_value(start_s ignore nulls) over w as filled_start,
case when start_s is not null then 'precise' when last_value(start_s ignore nulls) over w is not null then 'inherited' end as time_source from t window w as (partition by conv_id order by turn rows between unbounded preceding and current row)""")
def _j17(spark, d):
    t = segments(spark, d).select("conv_id", "turn", F.when(F.col("turn") % 3 == 1, F.col("start_s")).alias("start_s"))
    return W.inherit_time(t, ["conv_id"], "turn", "start_s")


@query("w7_gap_classes", f"""with {SPAN}, g as (select user_id, event_id, lo - lag(hi) over (partition by user_id order by lo, hi) as gap_s from span)
select *, case when gap_s is null then 'first' when gap_s < 0 then 'overlap' when gap_s <= 5 then 'chain' when gap_s >= 480 then 'break' else 'gap' end as gap_class from g""")
def _w7(spark, d):
    return W.gap_classes(spans(spark, d), ["user_id"], "lo", "hi").select("user_id", "event_id", "gap_s", "gap_class")


RUN = """e as (select user_id, event_id, event_type, event_id as start_s, event_id + 1 as end_s, coalesce(value < 30, false) as m from events),
n as (select *, case when m and lag(m) over w {same} then 0 else 1 end as new from e window w as (partition by user_id order by event_id)),
g as (select *, sum(new) over (partition by user_id order by event_id) as island from n)
select user_id, min(event_id) as first, max(event_id) as last, count(*) as n, min(start_s) as start_s, max(end_s) as end_s from g where m group by user_id, island having count(*) >= 3"""


def _events(spark, d):
    return table(spark, d, "events").withColumn("start_s", F.col("event_id")).withColumn("end_s", F.col("event_id") + 1)


@query("w8_equal_runs", "with " + RUN.format(same="and event_type is not distinct from lag(event_type) over w"))
def _w8(spark, d):
    return W.runs(_events(spark, d), ["user_id"], "event_id", F.col("value") < 30, "event_type")


@query("w9_fragment_runs", "with " + RUN.format(same=""))
def _w9(spark, d):
    return W.runs(_events(spark, d), ["user_id"], "event_id", F.col("value") < 30)


@query("w10_low_rate_windows", f"""with recursive {SEG}, s as (select conv_id, cast(start_s as double) as lo, cast(end_s as double) as hi, length(text) as n, row_number() over (partition by conv_id order by start_s, end_s) as i from seg),
m as (select conv_id, list_sort(list(n / (hi - lo)))[len(list(n)) // 2 + 1] * 0.95 as under from s where hi - lo > 0.5 and n > 0 group by 1),
c as (select a.conv_id, a.i, a.lo, coalesce((select min(b.i) from s b where b.conv_id = a.conv_id and b.i >= a.i and b.hi - a.lo >= 30), (select max(i) + 1 from s b where b.conv_id = a.conv_id)) as j from s a where a.hi - a.lo >= 0.5),
w as (select c.conv_id, c.i, c.j, c.lo, (select b.hi from s b where b.conv_id = c.conv_id and b.i = c.j - 1) as hi, (select sum(b.n) from s b where b.conv_id = c.conv_id and b.i >= c.i and b.i < c.j) as n from c where c.j > c.i),
low as (select w.*, n / (hi - lo) as rate, under from w join m using (conv_id) where hi - lo >= 24 and n / (hi - lo) < under),
p as (select conv_id, min(i) as i from low group by 1 union all select p.conv_id, (select min(x.i) from low x where x.conv_id = p.conv_id and x.i >= l.j) from p join low l on l.conv_id = p.conv_id and l.i = p.i where exists (select 1 from low x where x.conv_id = p.conv_id and x.i >= l.j))
select l.conv_id, l.lo, l.hi, round(l.rate, 6) as rate, round(l.under, 6) as under, 'latin' as script from low l join p on p.conv_id = l.conv_id and p.i = l.i""")
def _w10(spark, d):
    return W.low_rate_windows(segments(spark, d), ["conv_id"], share=0.95).select("conv_id", "lo", "hi", F.round("rate", 6).alias("rate"), F.round("under", 6).alias("under"), "script")


@query("w11_merge_intervals", f"""with {SPAN}, r as (select *, max(hi) over (partition by user_id order by lo, hi, event_type rows between unbounded preceding and 1 preceding) as reach from span),
g as (select *, sum(case when lo > reach + 5 or reach is null then 1 else 0 end) over (partition by user_id order by lo, hi, event_type) as island from r)
select user_id, min(lo) as lo, max(hi) as hi, count(*) as n, string_agg(event_type, ' | ' order by lo, hi, event_type) as reasons from g group by user_id, island""")
def _w11(spark, d):
    return W.merge_intervals(spans(spark, d), ["user_id"], "lo", "hi", reason="event_type")


@query("w12_smooth_zscore", """with s as (select user_id, event_type, event_id, avg(value) over (partition by user_id, event_type order by event_id rows between 3 preceding and 3 following) as smooth from events)
select user_id, event_type, event_id, smooth, case when stddev_pop(smooth) over w > 0 then (smooth - avg(smooth) over w) / stddev_pop(smooth) over w else 0.0 end as z from s window w as (partition by event_type)""")
def _w12(spark, d):
    s = W.smooth_zscore(table(spark, d, "events"), ["user_id", "event_type"], "event_id", ["event_type"], "value")
    return s.select("user_id", "event_type", "event_id", "smooth", "z")


def _scores(spark, d):
    g = segments(spark, d)
    pages = g.select("conv_id", F.col("turn").alias("page"), F.split("text", " ").alias("pw"))
    return g.select("conv_id", "turn", F.split("text", " ").alias("w")).join(pages, "conv_id").select("conv_id", "turn", "page", (F.size(F.array_intersect("w", "pw")) / (1.0 + F.size("w"))).alias("score"))


@query("w13_monotone_align")
def _w13(spark, d):
    return W.monotone_align(_scores(spark, d), "conv_id", "turn", "page", "score")


@query("w14_page_spans", f"""with {SEG}, s as (select conv_id, turn * 2 % 5 as page, min(start_s) as span_start from seg group by 1, 2), p as (select distinct conv_id, unnest(range(0, 6)) as page from seg),
b as (select p.conv_id, p.page, s.span_start, first_value(s.span_start ignore nulls) over (partition by p.conv_id order by p.page rows between 1 following and unbounded following) as nxt,
  last_value(s.span_start ignore nulls) over (partition by p.conv_id order by p.page rows between unbounded preceding and 1 preceding) as prv from p left join s using (conv_id, page))
select conv_id, page, coalesce(span_start, nxt, prv) as span_start, span_start is null as silent, case when span_start is null then coalesce(nxt, prv) else nxt end as span_end from b""")
def _w14(spark, d):
    g = segments(spark, d)
    path = g.withColumn("page", F.col("turn") * 2 % 5)
    pages = g.select("conv_id").distinct().select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))).alias("page"))
    return W.page_spans(path, pages, "conv_id", "turn", "page", "start_s")


@query("w16_context_rows", """select user_id, event_id, event_type = 'purchase' and value > 80 as is_match from (select *, max(case when event_type = 'purchase' and value > 80 then 1 else 0 end) over (partition by user_id order by event_id rows between 2 preceding and 2 following) as near from events) where near = 1""")
def _w16(spark, d):
    return W.context_rows(table(spark, d, "events"), ["user_id"], "event_id", (F.col("event_type") == "purchase") & (F.col("value") > 80)).select("user_id", "event_id", "is_match")


# the texts' full stops stand for the stops of the rule, which takes no "."
STOPPED = "replace(replace(text, '.', '!'), ';', '。')"


@query("w17_split_sentences", f"""with recursive {SEG}, w as (select conv_id, turn, generate_subscripts(string_split({STOPPED}, ' '), 1) - 1 as pos, unnest(string_split({STOPPED}, ' ')) as w, cast(start_s as double) as t from seg),
x as (select conv_id, turn, pos, w, t + pos * 0.5 + pos // 7 * 4 as s, t + pos * 0.5 + pos // 7 * 4 + 0.5 as e from w),
r as (select conv_id, turn, pos, w, s, e, s as t0, 1 as no from x where pos = 0 union all
  select conv_id, turn, pos, w, s, e, case when cut then s else t0 end, no + cut::int from (select x.*, r.t0, r.no, regexp_matches(r.w, '[。！？!?…]$') or (regexp_matches(r.w, '[，,、；;:：]$') and r.e - r.t0 >= 2) or x.s - r.e > 3 or x.e - r.t0 > 3 as cut from r join x on x.conv_id = r.conv_id and x.turn = r.turn and x.pos = r.pos + 1))
select conv_id, turn, cast(no as int) as sentence_no, min(s) as start_s, max(e) as end_s, string_agg(case when w <> '' then w end, ' ' order by pos) as text from r group by 1, 2, 3""")
def _w17(spark, d):
    start = lambda i: F.col("start_s").cast("double") + i * 0.5 + F.floor(i / 7) * 4
    words = F.transform(F.split(F.translate("text", ".;", "!。"), " "), lambda w, i: F.struct(w.alias("w"), start(i).alias("start_s"), (start(i) + 0.5).alias("end_s")))
    out = W.split_sentences(segments(spark, d).withColumn("words", words), ["conv_id", "turn"], max_dur=3, soft_dur=2)
    return out.withColumn("text", F.nullif("text", F.lit("")))


@query("w18_split_untimed", f"""with {SEG}, b as (select conv_id, turn, start_s, end_s, end_s - start_s as dur, trim({STOPPED}, ' ' || chr(10)) as x from seg),
p as (select *, greatest(cast(floor(4 / (dur / greatest(length(x), 1))) as bigint), 1) as size, list_filter(string_split(regexp_replace(x, '([。！？!?…])', '\\1' || chr(1), 'g'), chr(1)), lambda q: trim(q, ' ' || chr(10)) <> '') as q from b),
c as (select *, case when dur <= 4 or x = '' then [x] else flatten(list_transform(q, lambda y: case when length(y) * (dur / greatest(length(x), 1)) <= 4 then [y] else list_transform(range(1, length(y) + 1, size), lambda i: substring(y, i, size)) end)) end as parts from p),
r as (select conv_id, turn, start_s, end_s, dur, generate_subscripts(parts, 1) - 1 as pos, unnest(parts) as part from c),
u as (select *, sum(length(part)) over (partition by conv_id, turn order by pos) as upto, greatest(sum(length(part)) over (partition by conv_id, turn), 1) as total from r)
select conv_id, turn, cast(pos as int) as pos, trim(part, ' ' || chr(10)) as sentence, round(start_s + dur * (upto - length(part)) / total, 2) as from_s, case when total = 1 then end_s::double else round(start_s + dur * upto / total, 2) end as to_s from u""")
def _w18(spark, d):
    return W.split_untimed(segments(spark, d).withColumn("text", F.translate("text", ".;", "!。")), ["conv_id", "turn"], max_dur=4)


@query("w19_display_rank", "select p_partkey, cast(row_number() over (partition by p_brand order by p_size desc, p_partkey) as int) as display_rank from part")
def _w19(spark, d):
    return W.display_rank(table(spark, d, "part"), ["p_brand"], [F.desc("p_size"), "p_partkey"]).select("p_partkey", "display_rank")


@query("w20_attachment_numbers", "select p_partkey, cast(row_number() over (partition by p_brand order by p_size % 3 + 1 > 2, p_partkey) as int) as attachment_no from part")
def _w20(spark, d):
    return W.attachment_numbers(table(spark, d, "part").withColumn("tier", F.col("p_size") % 3 + 1), ["p_brand"], "tier", "p_partkey").select("p_partkey", "attachment_no")


@query("w21_first_owner", "select l_partkey, l_orderkey from (select *, row_number() over (partition by l_partkey order by l_shipdate, l_orderkey, l_linenumber) as k from lineitem) where k = 1")
def _w21(spark, d):
    return W.first_owner(table(spark, d, "lineitem"), "l_partkey", "l_orderkey", ["l_shipdate", "l_orderkey", "l_linenumber"])


@query("w22_contiguous", "with p as (select l_orderkey, l_linenumber + case when l_quantity > 10 then 0 else 1 end as place from lineitem) select l_orderkey, min(place) as lo, max(place) as hi, count(distinct place) as n, max(place) - min(place) + 1 = count(distinct place) as contiguous from p group by 1")
def _w22(spark, d):
    return W.contiguous(table(spark, d, "lineitem").withColumn("place", F.col("l_linenumber") + F.when(F.col("l_quantity") > 10, 0).otherwise(1)), ["l_orderkey"], "place")


@query("w23_order_diff", """select l_orderkey, l_linenumber, cast("at" as int) as "at", cast(chrono as int) as chrono from (select l_orderkey, l_linenumber, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_extendedprice) as "at", row_number() over (partition by l_orderkey order by l_shipdate, l_linenumber, l_partkey, l_extendedprice) as chrono from lineitem) where "at" <> chrono""")
def _w23(spark, d):
    li = table(spark, d, "lineitem").withColumn("pos", F.struct("l_linenumber", "l_partkey", "l_extendedprice"))
    return W.order_diff(li, ["l_orderkey"], "pos", ["l_shipdate", "l_linenumber", "l_partkey", "l_extendedprice"]).select("l_orderkey", "l_linenumber", "at", "chrono")


@query("w24_gallery_runs", """with s as (select user_id, event_id, event_type in ('click', 'view') as i from events where event_type <> 'signup'), n as (select *, case when i and lag(i) over (partition by user_id order by event_id) then 0 else 1 end as new from s),
g as (select *, sum(new) over (partition by user_id order by event_id) as k from n) select user_id, min(event_id) as first, max(event_id) as last, count(*) as n from g where i group by user_id, k having count(*) >= 3""")
def _w24(spark, d):
    return W.gallery_runs(table(spark, d, "events"), ["user_id"], "event_id", F.col("event_type").isin("click", "view"), F.col("event_type") == "signup")


@query("w25_sections", """select user_id, event_id, last_value(case when event_type = 'signup' then event_id end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and current row) as section,
event_type = 'signup' and coalesce(lead(event_type = 'signup') over (partition by user_id order by event_id), true) as empty_heading from events""")
def _w25(spark, d):
    return W.sections(table(spark, d, "events"), ["user_id"], "event_id", F.col("event_type") == "signup").select("user_id", "event_id", "section", "empty_heading")


@query("w26_running_eta", """select user_id, event_id, avg(event_id % 100) over (partition by user_id order by event_id rows between unbounded preceding and current row) * (count(*) over (partition by user_id) - row_number() over (partition by user_id order by event_id)) as eta_s from events""")
def _w26(spark, d):
    return W.running_eta(table(spark, d, "events").withColumn("s", F.col("event_id") % 100), ["user_id"], "event_id", "s").select("user_id", "event_id", "eta_s")


@query("w27_plan_findings", f"""with {SPAN}, t as (select *, max(hi) over (partition by user_id, event_type) as total from span), n as (select *, lead(lo) over (partition by user_id, event_type order by lo) as nxt from t)
select user_id, event_id, case when nxt < hi then 'overlap' when nxt > hi then 'gap' when nxt is null and hi < total then 'short' else 'ok' end as finding, cast(ceil(total / 1800.0) as bigint) as chunks from n""")
def _w27(spark, d):
    t = spans(spark, d).withColumn("total", F.max("hi").over(Window.partitionBy("user_id", "event_type")))
    return W.plan_findings(t, ["user_id", "event_type"], "lo", "hi", "total", ties=["event_id"]).select("user_id", "event_id", "finding", "chunks")


#: Events as media of ``value`` minutes in 64 kilobits a second, cut into parts.
PARTS = """media as (select event_id, value * 60 as duration, cast(floor(value * 60 * 8000) as bigint) as size from events),
part as (select event_id, unnest(range(0, case when size <= 25165824 then 1 else greatest(cast(ceil(duration / 1200) as bigint), 1) end))::int as part, duration, case when size <= 25165824 then 1 else greatest(cast(ceil(duration / 1200) as bigint), 1) end as n from media),
cut as (select event_id, part, part * 1200.0::double as offset_s, case when part = n - 1 then duration else (part + 1) * 1200.0::double end as until_s from part)"""


def _parts(spark, d):
    seconds = F.col("value") * 60
    media = table(spark, d, "events").select("event_id", seconds.alias("duration"), F.floor(seconds * 8000).alias("size"))
    return W.transcription_parts(media, ["event_id"], "size", "duration")


@query("x2_transcription_parts", f"with {PARTS} select * from cut")
def _x2(spark, d):
    return _parts(spark, d)


@query("x2_joined_parts", f"with {PARTS} select event_id, part, round(1.25 + part + offset_s, 2) as start_s, round(3.5 + part + offset_s, 2) as end_s from cut")
def _x2j(spark, d):
    """Each part heard as one segment near its start."""
    parts = _parts(spark, d)
    heard = parts.select("event_id", "part", (F.col("part") + 1.25).alias("start_s"), (F.col("part") + 3.5).alias("end_s"))
    return W.joined_parts(heard, parts, ["event_id"])
