"""Aggregates over the tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import loops as L
from ..functions import text as X
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import ranks
from .join_queries import PAIRS, TOK, _token_sets
from .proxies import HASH, SEG, SPAN, hashes, segments, spans, table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("a1_reference_density", "select l_orderkey, avg(case when l_quantity > 25 then 1 else 0 end) as density from lineitem group by 1")
def _a1(spark, d):
    return A.reference_density(table(spark, d, "lineitem").withColumn("hit", F.col("l_quantity") > 25), ["l_orderkey"], "hit")


@query("a2_boilerplate", """with t as (select distinct doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) as token from documents), n as (select count(distinct doc_id) as n_docs from t)
select token, count(*) as df, max(n_docs) as n_docs from t, n group by token having count(*) > max(n_docs) * 0.4 and max(n_docs) >= 5""")
def _a2(spark, d):
    return A.boilerplate(_token_sets(table(spark, d, "documents"), "doc_id"), "tokens")


@query("a3_supported_vocab", f"with {TOK}, b as (select source, unnest(regexp_extract_all(lower(text), '[a-z]+')) as token from documents) select token, count(distinct source) as books from b group by 1 having count(distinct source) >= 3")
def _a3(spark, d):
    return A.supported_vocab(_token_sets(table(spark, d, "documents"), "source"), "source", "tokens")


@query("a5_recording_start", f"with {SPAN} select user_id, median(lo) as measured_start, max(lo) - min(lo) as spread_s, count(*) as n_clips from span group by 1")
def _a5(spark, d):
    return A.recording_start(spans(spark, d), "user_id", "lo")


WIN = f"""{SEG}, win as (select *, least(cast(floor((start_s + end_s) / 2.0 / 60) as bigint), greatest(cast(ceil(max(end_s) over (partition by conv_id) / 60.0) as bigint) - 1, 0)) as "window" from seg)"""


@query("a6_windows", f'with {WIN} select conv_id, "window", string_agg(text, \' \' order by start_s, text) as text, count(*) as n from win group by 1, 2')
def _a6(spark, d):
    return A.assign_windows(segments(spark, d), ["conv_id"])


@query("a7_bucket_text", f"with {SEG} select conv_id, start_s // 30 * 30 as bucket, string_agg(text, ' ' order by start_s, text) as text from seg group by 1, 2")
def _a7(spark, d):
    return A.bucket_text(segments(spark, d), ["conv_id"])


FLAT = f"list_transform(string_split(text, chr(10)), lambda l: regexp_replace(lower(translate(l, '{X.WIDE}', '{X.NARROW.replace(chr(39), chr(39) * 2)}')), '{X.MARKS.replace(chr(39), chr(39) * 2)}', '', 'g'))"


@query("a8_loop_lines", f"""with s as (select doc_id, {FLAT} as lines from documents), l as (select doc_id, max(n) as top from (select doc_id, line, count(*) as n from (select doc_id, unnest(lines) as line from s) where length(line) >= 4 group by 1, 2) group by 1),
j as (select doc_id, array_to_string(lines, '') as x from s), g as (select doc_id, unnest(list_transform(range(1, length(x) - 6), lambda i: x[i:i+7])) as g from j), v as (select doc_id, round(count(distinct g) / count(*), 3) as diversity, count(*) as n from g group by 1)
select d.doc_id, cast(coalesce(top, 0) as int) as max_line_repeats, case when n >= 30 then diversity end as ngram_diversity from documents d left join l using (doc_id) left join v using (doc_id)""")
def _a8(spark, d):
    return A.loops(table(spark, d, "documents"), ["doc_id"], F.split("text", "\n"), inline=False).select("doc_id", "max_line_repeats", "ngram_diversity")


@query("a8_loop_flags")
def _a8f(spark, d):
    return A.loops(table(spark, d, "documents"), ["doc_id"], F.split("text", "\n")).select("doc_id", "inline_repeat_count", "loop")


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


#: Notes as they come from documents: front matter, embeds, links, cited times, tables and repeated lines among the texts' own lines.
NOTED = """noted as (select doc_id, case when doc_id % 3 = 0 then '---' || chr(10) || 'tags: x' || chr(10) || '---' || chr(10) else '' end || case when doc_id % 4 = 0 then repeat('- a line that says the same again (see 12:' || doc_id % 50 + 10 || ')' || chr(10) || '| a table | of cells |' || chr(10), 4) else '' end || case when doc_id % 5 = 0 then '![[' || source || '.png|400]] [[' || source || '|shown]] https://x.org/' || doc_id || chr(10) || '> [!note] head' || chr(10) else '' end || text as note from documents)"""


def _noted(spark, d):
    k = F.col("doc_id")
    again = F.concat(F.lit("- a line that says the same again (see 12:"), (k % 50 + 10).cast("string"), F.lit(")\n| a table | of cells |\n"))
    marks = F.concat(F.lit("![["), "source", F.lit(".png|400]] [["), "source", F.lit("|shown]] https://x.org/"), k.cast("string"), F.lit("\n> [!note] head\n"))
    parts = [F.when(k % 3 == 0, "---\ntags: x\n---\n").otherwise(""), F.when(k % 4 == 0, F.repeat(again, 4)).otherwise(""), F.when(k % 5 == 0, marks).otherwise(""), F.col("text")]
    return table(spark, d, "documents").select("doc_id", F.concat(*parts).alias("note"))


@query("a11_payload_repetition", f"""with {NOTED}, body as (select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(note, '{_sql(L.FRONT_MATTER)}', '', 's'), '{_sql(L.EMBED)}', '', 'g'), '{_sql(L.LINK)}', '\\1', 'g'), '{_sql(L.CITED_TIME)}', '', 'g'), '{_sql(L.ADDRESS)}', '', 'g') as t from noted),
line as (select doc_id, trim(unnest(string_split(t, chr(10)))) as l from body), bare as (select doc_id, regexp_replace(replace(regexp_replace(l, '{_sql(L.LINE_MARKS)}', ''), '`', ''), '\\s+', '', 'g') as l from line where not contains(l, '|') and not starts_with(ltrim(l, '> '), '[!')),
top as (select doc_id, max(n)::int as repeats from (select doc_id, l, count(*) as n from bare where length(l) >= 12 group by 1, 2) group by 1),
flat as (select doc_id, regexp_replace(t, '\\s+', '', 'g') as x from body), gram as (select doc_id, x, flatten([regexp_extract_all(substring(x, k), '.{{8}}') for k in range(1, 9)]) as g from flat),
shares as (select doc_id, coalesce(repeats, 0) as repeats, case when len(g) = 0 then 1.0 else len(list_distinct(g)) / len(g) end as diversity, length(x) as chars from gram left join top using (doc_id))
select doc_id, repeats, diversity, chars, repeats >= 4 or (chars >= 500 and diversity < 0.7) as degenerate from shares""")
def _a11(spark, d):
    return _noted(spark, d).select("doc_id", L.payload_repetition(F.col("note")).alias("r")).select("doc_id", "r.*")


@query("a12_coverage", f"""with {SEG}, n as (select conv_id, cast(sum(length(text)) as bigint) as note from seg where role = 'user' group by 1), t as (select conv_id, cast(sum(length(text)) as bigint) as heard from seg where role = 'assistant' group by 1)
select n.conv_id, note, heard, case when heard > 0 then note / heard end as ratio, coalesce(case when heard > 0 then note / heard end < 0.1, false) as low from n left join t using (conv_id)""")
def _a12(spark, d):
    g = segments(spark, d).withColumn("chars", F.length("text"))
    return A.coverage(g.where("role = 'user'"), g.where("role = 'assistant'"), "conv_id", "chars")


@query("a10_distribution", """select event_type, count(value) as n, count(*) filter (value < 10) as low, quantile_cont(value, 0.1) as p10, quantile_cont(value, 0.5) as p50, quantile_cont(value, 0.9) as p90 from events group by 1""")
def _a10(spark, d):
    return A.distribution(table(spark, d, "events"), ["event_type"], "value", 10)


@query("a13_collapse_share", """with e as (select user_id, event_id as start_s, case when value < 20 then 1 else 0 end as s from events), i as (select *, sum(1 - s) over (partition by user_id order by start_s) as island from e),
r as (select user_id, island, sum(s) as r, count(*) as c from i group by 1, 2)
select user_id, cast(sum(c) as bigint) as n, sum(r) / sum(c) as short_share, cast(max(r) as bigint) as longest_run, (sum(c) >= 20 and sum(r) / sum(c) >= 0.5) or max(r) >= 12 as collapsed from r group by 1""")
def _a13(spark, d):
    return A.collapse_share(table(spark, d, "events").withColumn("start_s", F.col("event_id")), ["user_id"], F.col("value") < 20)


@query("a14_vote_argmax", """select user_id, event_type, weight from (select *, row_number() over (partition by user_id order by weight desc, event_type) as k from (select user_id, event_type, cast(sum(cast(value * 100 as bigint)) as bigint) as weight from events group by 1, 2)) where k = 1""")
def _a14(spark, d):
    return A.vote_argmax(table(spark, d, "events").withColumn("w", F.round(F.col("value") * 100).cast("long")), ["user_id"], "event_type", "w")


@query("a15_chapters", f"with {SEG} select conv_id, role, min(start_s) as start_s, max(end_s) as end_s, count(*) as blocks, arg_min(turn, start_s * 1000 + turn) as first_block from seg group by 1, 2")
def _a15(spark, d):
    return A.chapters(segments(spark, d), ["conv_id", "role"], "turn")


@query("a16_segment_durations", f"with {SEG}, p as (select conv_id, role, max(end_s) - min(start_s) as s from seg group by 1, 2) select conv_id, cast(sum(s) as bigint) as duration_s, count(*) as files from p group by 1")
def _a16(spark, d):
    return A.segment_durations(segments(spark, d), "conv_id", "role")


@query("a17_engine_kpis", """with p as (select event_type, user_id, sum(case when value > 5 then 1 else 0 end) as v, count(*) as c, sum(value) as s, max(value) as m, sum(event_id) as l, stddev_pop(value) / avg(value) as cv from events group by 1, 2)
select event_type, sum(v) / sum(c) as valid_rate, sum(s) / sum(c) as mean_score, max(m) as max_score, avg(cv) as cv, sum(l) / sum(c) as latency from p group by 1""")
def _a17(spark, d):
    return A.engine_kpis(table(spark, d, "events"), "event_type", "user_id", F.col("value") > 5, "value", "event_id")


@query("a18_kpi_pivot", """select l_linestatus, avg(l_tax) filter (l_returnflag = 'A') as "A", avg(l_tax) filter (l_returnflag = 'N') as "N", avg(l_tax) filter (l_returnflag = 'R') as "R" from lineitem group by 1""")
def _a18(spark, d):
    return A.kpi_pivot(table(spark, d, "lineitem"), "l_linestatus", "l_returnflag", ["A", "N", "R"], "l_tax")


@query("a19_upper_median", """with r as (select p_brand, p_retailprice, row_number() over (partition by p_brand order by p_retailprice) as k, count(*) over (partition by p_brand) as n, row_number() over (order by p_retailprice) as gk, count(*) over () as gn from part)
select p_brand, case when n >= 5 then p_retailprice else (select p_retailprice from r where gk = gn // 2 + 1) end as median, n from r where k = n // 2 + 1""")
def _a19(spark, d):
    return A.upper_median(table(spark, d, "part"), ["p_brand"], "p_retailprice")


@query("a20_duration_stats", f"with {SEG} select role, avg(end_s - start_s) as mean_s, max(end_s - start_s) as max_s, count(*) filter (end_s - start_s > 15) as over from seg group by 1")
def _a20(spark, d):
    return A.duration_stats(segments(spark, d), ["role"], F.col("end_s") - F.col("start_s"))


@query("a21_guard_ratio", """select user_id, count(*) filter (event_type <> 'view') as attempted, count(*) filter (event_type = 'error') as failed,
count(*) filter (event_type <> 'view') > 0 and count(*) filter (event_type = 'error') <= count(*) filter (event_type <> 'view') * 0.2 as ok from events group by 1""")
def _a21(spark, d):
    return A.guard_ratio(table(spark, d, "events"), ["user_id"], F.col("event_type") == "error", F.col("event_type") != "view")


@query("a22_photos_per_recording", f"""with {SPAN}, v as (select user_id, event_id as rec, lo, hi from span where event_type = 'view')
select v.rec, count(distinct p.event_id) as photos from span p left join v on p.user_id = v.user_id and p.lo >= v.lo and p.lo <= v.hi where p.event_type = 'click' group by 1""")
def _a22(spark, d):
    from .join_queries import QUERIES as JOINS

    return A.photos_per_recording(JOINS["j2_containment"](spark, d), "event_id", "rec")


@query("a24_first_mode", """select user_id, event_type, n from (select *, row_number() over (partition by user_id order by n desc, o) as k from (select user_id, event_type, count(*) as n, min(event_id) as o from events group by 1, 2)) where k = 1""")
def _a24(spark, d):
    return A.first_mode(table(spark, d, "events"), ["user_id"], "event_type", "event_id")


@query("a25_days_covered", "select user_id, count(distinct cast(ts as date)) as days from events group by 1")
def _a25(spark, d):
    return A.days_covered(table(spark, d, "events"), ["user_id"], "ts")


@query("a26_discordant_fraction", """select a.l_orderkey, avg(case when a.l_partkey > b.l_partkey then 1 else 0 end) as discordant, count(*) as pairs from lineitem a join lineitem b using (l_orderkey) where a.l_linenumber < b.l_linenumber group by 1""")
def _a26(spark, d):
    return ranks.discordant_fraction(table(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber", "l_partkey")


@query("a27_grid_consensus", """with m as (select * from (select p_brand, p_type, row_number() over (partition by p_brand order by count(*) desc, p_type) as k from part group by 1, 2) where k = 1)
select p_brand, p_type, median(p_retailprice) as edge, stddev_samp(p_retailprice) as spread, count(*) as n from part join m using (p_brand, p_type) group by 1, 2""")
def _a27(spark, d):
    return A.grid_consensus(table(spark, d, "part"), ["p_brand"], "p_type", "p_retailprice")


@query("a28_signal_cache", f"with {HASH}, k as (select h & 255 as h, vec_id, label from hash) select h, arg_min(label, vec_id) as label from k group by 1")
def _a28(spark, d):
    h = hashes(spark, d).withColumn("h", F.col("h").bitwiseAND(F.lit(255)))
    return A.signal_cache(h, "h", "label", "vec_id")
