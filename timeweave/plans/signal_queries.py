"""Numbers, fuzzy hits, model answers, clocks and the window audit over the tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fuzzy, numbers, rewrite, signals, slides
from ..functions import values as V
from ..operators import audit, notes, rules
from .proxies import segments, table

QUERIES, SQL = {}, {}
C = F.col


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


#: Numerals of 0 to 9999 by units, written from a number's digits.
HAN_DIGITS = "零一二三四五六七八九"


def _numeral(n):
    """The numeral of a number under 10000 in Spark: 三千零五, 一百二十."""
    parts, d = [], lambda i: F.floor(n / 10**i) % 10
    name = lambda x: F.substring(F.lit(HAN_DIGITS), (x + 1).cast("int"), F.lit(1))
    for i, unit in ((3, "千"), (2, "百"), (1, "十")):
        parts.append(F.when(d(i) > 0, F.concat(name(d(i)), F.lit(unit))).otherwise(""))
    parts.append(F.when((d(0) > 0) | (n == 0), name(d(0))).otherwise(""))
    return F.concat(*parts)


@query("f34_chinese_numeral", "select o_orderkey, (o_orderkey % 10000)::varchar as units, (o_orderkey % 10000 * 10000)::varchar as myriads, (o_orderkey % 10000)::varchar || '.' || (o_orderkey % 10)::varchar as point, null::varchar as none from orders")
def _f34(spark, d):
    o = table(spark, d, "orders").withColumn("n", C("o_orderkey") % 10000)
    told, last = _numeral(C("n")), F.substring(F.lit(HAN_DIGITS), (C("o_orderkey") % 10 + 1).cast("int"), F.lit(1))
    number = numbers.chinese_numeral
    return o.select("o_orderkey", number(told).alias("units"), number(F.concat(told, F.lit("萬"))).alias("myriads"), number(F.concat(told, F.lit("點"), last)).alias("point"), number(F.concat(told, F.lit("點"))).alias("none"))


@query("f35_numbers", """select o_orderkey, concat_ws(',', (o_orderkey % 900 + 100)::varchar || '000', (o_orderkey % 90 + 10)::varchar || '%', (o_orderkey % 90 + 10)::varchar || '.5', (o_orderkey % 9 + 1)::varchar || '0000', '789', case when o_orderkey % 10000 > 9 then (o_orderkey % 10000)::varchar end) as v from orders""")
def _f35(spark, d):
    """A numeral of one character before no measure is no number."""
    o = table(spark, d, "orders")
    k = C("o_orderkey")
    text = F.concat((k % 900 + 100).cast("string"), F.lit(",000 人 "), (k % 90 + 10).cast("string"), F.lit(" % 和 "), (k % 90 + 10).cast("string"), F.lit(".50；第一 "), (k % 9 + 1).cast("string"), F.lit(" 萬 7、8、9 月 "), _numeral(k % 10000), F.lit(" 千萬不要"))
    return o.select("o_orderkey", F.array_join(numbers.numbers(text), ",").alias("v"))


@query("f19_subset_ratio")
def _f19(spark, d):
    return table(spark, d, "part").select("p_partkey", F.round(fuzzy.subset_ratio(C("p_name"), F.concat("p_brand", F.lit(" "), F.reverse("p_name"))), 6).alias("v"))


@query("f21_keyword_hit")
def _f21(spark, d):
    g = segments(spark, d)
    word = F.element_at(F.split("text", " "), -1)
    kind = F.when(C("turn") % 3 == 0, "drug").when(C("turn") % 3 == 1, "medical_term").otherwise("general")
    return g.select("conv_id", "turn", fuzzy.keyword_hit(F.concat(F.lit("so "), F.substring("text", 1, F.length("text") - 1), F.lit("x")), word, kind).alias("v"))


ANSWER = """case doc_id % 4 when 0 then '```json' || chr(10) || j || chr(10) || '```' when 1 then 'Sure: ' || j || ' Done.' when 2 then j else '{"labels": [' end"""
SIGNALS = {"labels": "list", "clinical": "bool", "density": "number", "type": "list", "chart": "bool"}


def _answers(spark, d):
    j = F.to_json(F.struct(F.array(F.col("source"), F.lit("共享 a"), F.lit("10:30"), F.lit(" ")).alias("labels"), (C("doc_id") % 3 == 0).alias("clinical"), (C("n_chars") % 100).cast("string").alias("density"), C("lang").alias("type")))
    k = C("doc_id") % 4
    raw = F.when(k == 0, F.concat(F.lit("```json\n"), j, F.lit("\n```"))).when(k == 1, F.concat(F.lit("Sure: "), j, F.lit(" Done."))).when(k == 2, j).otherwise('{"labels": [')
    return table(spark, d, "documents").select("doc_id", "text", signals.repaired_json(raw).alias("json"))


@query("f40_coerced_signals", """select doc_id, doc_id % 4 <> 3 as parsed, case when doc_id % 4 = 3 then '' else source || '|共享 a|10:30| ' end as labels, doc_id % 4 <> 3 and doc_id % 3 = 0 as clinical, case when doc_id % 4 = 3 then 0.0 else (n_chars % 100)::double end as density,
case when doc_id % 4 = 3 or lang is null then '' else lang end as type, false as chart, case when doc_id % 4 = 3 then '' else source end as clean from documents""")
def _f40(spark, d):
    s = _answers(spark, d).withColumn("s", signals.coerced(C("json"), SIGNALS))
    return s.select("doc_id", C("json").isNotNull().alias("parsed"), F.array_join("s.labels", "|").alias("labels"), "s.clinical", "s.density", F.array_join("s.type", "|").alias("type"), "s.chart", F.array_join(signals.clean_labels(C("s.labels"), ["共享"]), "|").alias("clean"))


@query("f43_paste_guard", """with d as (select doc_id, text, case when contains(text, chr(10)) then substring(text, length(split_part(text, chr(10), 1)) + 2) else text end as below from documents),
t as (select doc_id, text, below, list_distinct(list_transform(regexp_extract_all(split_part(text, chr(10), 1) || ' zebra quagga okapi', '[A-Za-z][A-Za-z0-9-]{2,}|[一-鿿]{2,}'), lambda x: lower(x))) as own, list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9-]{2,}|[一-鿿]{2,}'), lambda x: lower(x))) as seen, list_distinct(list_transform(regexp_extract_all(below, '[A-Za-z][A-Za-z0-9-]{2,}|[一-鿿]{2,}'), lambda x: lower(x))) as seen_below from d)
select doc_id, case when length(text) < 60 then true else len(list_intersect(own, seen)) / len(own) >= 0.2 end as v, case when length(below) < 60 then true else len(list_intersect(own, seen_below)) / len(own) >= 0.2 end as v_below from t""")
def _f43(spark, d):
    """A text's first line as cached labels: against the whole text, of which they are a part, and against the lines below them."""
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    labels = F.array(first, F.lit("zebra quagga okapi"))
    below = F.when(F.contains(C("text"), F.lit("\n")), F.substring(C("text"), F.length(first) + 2, F.length("text"))).otherwise(C("text"))
    return table(spark, d, "documents").select("doc_id", signals.paste_guard(labels, C("text")).alias("v"), signals.paste_guard(labels, below).alias("v_below"))


@query("f44_local_time", """select event_id, case event_id % 5 when 0 then (date_trunc('second', ts) + interval 8 hour)::timestamptz when 4 then null else date_trunc('second', ts)::timestamptz end as at,
case event_id % 5 when 0 then 'utc+8' when 1 then 'tz-tagged' when 2 then 'exif' when 3 then 'iso' end as source from events""")
def _f44(spark, d):
    e, k = table(spark, d, "events"), C("event_id") % 5
    iso, space = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    raw = F.when(k == 0, F.concat(iso, F.lit(".000Z"))).when(k == 1, F.concat(iso, F.lit("+09:00"))).when(k == 2, F.date_format("ts", "yyyy:MM:dd HH:mm:ss")).when(k == 3, space).otherwise("no time")
    return e.select("event_id", V.local_time(raw, 8).alias("t")).select("event_id", "t.at", "t.source")


@query("f46_clock_offset", """select event_id, case when event_type = 'click' then -4350.0 when event_type like 'v%' or event_id::varchar like '%7' then 330.0 when event_id::varchar like '1_2' then 5.0 end as v from events""")
def _f46(spark, d):
    return table(spark, d, "events").select("event_id", V.clock_offset(C("event_type"), F.lit(None).cast("string"), C("event_id").cast("string"), [("clic[jk]", -4350), ("v*", 330), ("*7", 330), ("1?2", 5)]).alias("v"))


def _sides(spark, d):
    """One transcript as it is, and the other with numbers changed, pieces lost and a line repeated."""
    g = segments(spark, d).select("conv_id", "start_s", "end_s", F.concat("text", F.lit(" 共 "), (C("turn") * 7 + 11).cast("string"), F.lit("%")).alias("text"), "turn")
    other = F.when(C("turn") % 5 == 0, F.replace("text", F.lit("%"), F.lit(""))).when(C("turn") % 5 == 1, F.repeat(F.lit("again and again. "), 9)).otherwise(C("text"))
    return g.drop("turn"), g.where("turn % 7 <> 3").withColumn("text", other).drop("turn")


@query("a9_window_audit")
def _a9(spark, d):
    out = audit.compare_windows(*_sides(spark, d), ["conv_id"])
    return out.withColumns({c: F.array_join(c, ",") for c in ("only_primary", "only_other", "excused", "flags", "suppressed")})


# ---------------------------------------------------------------- slides, captions, engines' answers

@query("f8_title_guess", """with b as (select l_orderkey, list({'h': -l_quantity, 'i': l_linenumber, 't': trim(l_shipmode || ' ' || l_comment_, ' '), 'top': l_linenumber * 100} order by l_linenumber) as b from (select *, case when l_linenumber % 3 = 0 then '' else l_shipinstruct_ end as l_comment_ from (select *, repeat(l_returnflag, cast(l_quantity as int) * 2) as l_shipinstruct_, l_linestatus as l_shipmode from lineitem)) group by 1)
select l_orderkey, coalesce(list_sort(list_filter(b, lambda x: x.t <> '' and length(x.t) <= 60 and x.top <= 350))[1].t, '') as v from b""")
def _f8(spark, d):
    li = table(spark, d, "lineitem")
    words = F.when(C("l_linenumber") % 3 == 0, "").otherwise(F.repeat("l_returnflag", (C("l_quantity").cast("int") * 2)))
    text = F.trim(F.concat("l_linestatus", F.lit(" "), words))
    blocks = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity", text.alias("text")))), lambda b: F.struct((b["l_linenumber"] * 100).alias("top"), b["l_quantity"].alias("height"), b["text"].alias("text")))
    return li.groupBy("l_orderkey").agg(blocks.alias("b")).select("l_orderkey", slides.title_guess(C("b"), F.lit(1000)).alias("v"))


WORDY = "(coalesce(list_sum(list_transform(regexp_extract_all(x, '[A-Za-z]{3,}'), lambda w: length(w))), 0))"


@query("f51_slide_text", rf"""with s as (select doc_id, case when doc_id % 4 = 0 then ' ' else text end as clean, split_part(text, ' ', 1) as quick, source || ' ' || chr(10) || ' sum ' as summary, case doc_id % 5 when 0 then ['decorative'] when 1 then ['table'] when 2 then ['text', 'ultrasound', 'chart'] else [] end as types from documents),
x as (select *, case when trim(clean, ' ' || chr(10)) <> '' then trim(clean, ' ' || chr(10)) else quick end as x from s)
select doc_id, substring(trim(regexp_replace(case when {WORDY} >= 14 and not list_has_any(types, ['ultrasound', 'decorative']) then x when list_has_any(types, ['table', 'flowchart', 'diagram', 'algorithm', 'chart']) then trim(summary, ' ') else '' end, '\s+', ' ', 'g'), ' '), 1, 240) as v from x""")
def _f51(spark, d):
    k = C("doc_id")
    arr = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    types = F.when(k % 5 == 0, arr("decorative")).when(k % 5 == 1, arr("table")).when(k % 5 == 2, arr("text", "ultrasound", "chart")).otherwise(arr())
    return table(spark, d, "documents").select("doc_id", slides.slide_text(F.when(k % 4 == 0, " ").otherwise(C("text")), F.split_part("text", F.lit(" "), F.lit(1)), F.concat("source", F.lit(" \n sum ")), types).alias("v"))


@query("f58_course_name", """with s as (select *, case c_custkey % 5 when 0 then '20250914_L1_' || c_name || '_' || c_mktsegment || '_x' when 1 then c_name || '_' || c_mktsegment when 2 then '20250914' when 3 then 'L2_' || c_mktsegment else '2025091_L1' end as slug from customer)
select c_custkey, case when c_custkey % 5 in (0, 2) then '20250914' else '' end as date, case c_custkey % 5 when 0 then split_part(c_name, '_', 1) when 1 then split_part(c_name, '_', 1) when 2 then 'unknown' when 3 then c_mktsegment else '2025091' end as speaker,
case c_custkey % 5 when 0 then array_to_string(string_split(c_name || '_' || c_mktsegment || '_x', '_')[2:], '_') when 1 then array_to_string(string_split(c_name || '_' || c_mktsegment, '_')[2:], '_') else 'lecture' end as topic from s""")
def _f58(spark, d):
    k = C("c_custkey") % 5
    slug = F.when(k == 0, F.concat(F.lit("20250914_L1_"), "c_name", F.lit("_"), "c_mktsegment", F.lit("_x"))).when(k == 1, F.concat("c_name", F.lit("_"), "c_mktsegment")).when(k == 2, "20250914").when(k == 3, F.concat(F.lit("L2_"), "c_mktsegment")).otherwise("2025091_L1")
    return table(spark, d, "customer").select("c_custkey", slides.course_name(slug).alias("n")).select("c_custkey", "n.*")


@query("f60_answer_fault", """select p_partkey, case p_partkey % 7 when 0 then null when 1 then 'missing labels' when 2 then 'page_confidence of a wrong kind' when 3 then 'malformed block' when 4 then 'reading order not of integers' when 5 then 'not an object' else 'missing fixture' end as fault,
case when p_partkey % 7 in (0, 1, 2) then p_name || chr(10) || p_brand when p_partkey % 7 in (3, 4) then p_brand else '' end as text from part""")
def _f60(spark, d):
    k = C("p_partkey") % 7
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    blocks = F.concat(F.lit('"blocks": [{"text": '), q(C("p_brand")), F.lit('}, {"text": ""}, '), F.when(k == 3, '{"other": 1}').otherwise(F.concat(F.lit('{"text": '), q(C("p_name")), F.lit("}"))), F.lit("]"))
    rest = F.concat(F.lit(', "engine": "e", "latency_s": 2'), F.when(k == 2, ', "page_confidence": "high"').otherwise(', "page_confidence": 0.5'), F.when(k == 1, "").otherwise(', "labels": []'), F.when(k == 4, ', "reading_order": [0.5, "b"]').otherwise(', "reading_order": [2, 1, 0, 9]'))
    json = F.when(k == 5, "[1]").when(k == 6, '{"engine": "e"}').otherwise(F.concat(F.lit('{"fixture": "f", '), blocks, rest, F.lit("}")))
    return table(spark, d, "part").select("p_partkey", slides.answer_fault(json).alias("fault"), slides.answer_text(json).alias("text"))


@query("f64_crop_boxes", """select p_partkey, case when p_partkey between 1 and 10 then 0 when p_partkey between 11 and 50 then 5 when p_partkey between 60 and 99 then 7 end as x from part""")
def _f64(spark, d):
    made = spark.createDataFrame([("1-10", 0, 0, 640, 360), ("11-50", 5, 5, 640, 360), ("60-99", 7, 5, 200, 200)], "slides string, x int, y int, w int, h int")
    return rules.crop_boxes(table(spark, d, "part").select("p_partkey"), "p_partkey", made).select("p_partkey", "x")


# ---------------------------------------------------------------- notes

NOTE = """note as (select doc_id, case when doc_id % 3 = 0 then '---' || chr(10) || 'tags: [x]' || chr(10) || '  - y' || chr(10) || '---' || chr(10) else '' end || '# Title `' || source || '`' || chr(10) || '# Empty' || chr(10) || '## Deeper' || chr(10) || case when doc_id % 4 = 0 then '> [!summary] s' || chr(10) else '' end
|| '![[a.png|400]] ![[b.jpg]]' || chr(10) || case when doc_id % 5 = 0 then '[!todo] x ```a```' || chr(10) || '![[c.png]]' || chr(10) else '' end || replace(text, chr(10), chr(10) || '  - ') || chr(10) || case when doc_id % 2 = 0 then '# Resource' else '' end as t from documents)"""


def _notes(spark, d):
    k = C("doc_id")
    t = F.concat(
        F.when(k % 3 == 0, "---\ntags: [x]\n  - y\n---\n").otherwise(""), F.lit("# Title `"), "source", F.lit("`\n# Empty\n## Deeper\n"), F.when(k % 4 == 0, "> [!summary] s\n").otherwise(""),
        F.lit("![[a.png|400]] ![[b.jpg]]\n"), F.when(k % 5 == 0, "[!todo] x ```a```\n![[c.png]]\n").otherwise(""), F.replace("text", F.lit("\n"), F.lit("\n  - ")), F.lit("\n"), F.when(k % 2 == 0, "# Resource").otherwise(""),
    )
    return table(spark, d, "documents").select("doc_id", t.alias("t"))


@query("v1_note_audit", rf"""with {NOTE}, c as (select doc_id, t, (doc_id % 2 <> 0)::int as sources, (doc_id % 4 <> 0)::int as summary, (doc_id % 3 <> 0)::int as tags, 1 + (doc_id % 5 = 0)::int as width, (doc_id % 5 = 0)::int as todo, (doc_id % 5 = 0)::int as code,
  len(list_filter(string_split(regexp_replace(t, '^---\n(tags[^\n]*\n[^\n]*\n)---\n', ''), chr(10)), lambda l: regexp_matches(l, '^ +[-*] '))) as indent, 1 + (doc_id % 2 = 0)::int as empty, (not contains(t, '🗣️'))::int as speaker from note),
u as (unpivot c on sources, summary, tags, width, todo, code, indent, empty, speaker into name x value n)
select doc_id, case x when 'sources' then 'STRUCT sources' when 'summary' then 'STRUCT summary' when 'tags' then 'STRUCT tags' when 'width' then 'FIG width' when 'todo' then 'FIG todo' when 'code' then 'FMT code block' when 'indent' then 'FMT blank indent' when 'empty' then 'FMT empty heading' else 'LEC speaker' end as "check",
case when n = 0 then 'PASS' when x in ('code', 'indent', 'empty', 'speaker') then 'WARN' else 'FAIL' end as level, cast(n as int) as n from u""")
def _v1n(spark, d):
    found = notes.audit_notes(_notes(spark, d), "doc_id", "t")
    return found.where(C("check").isin("STRUCT sources", "STRUCT summary", "STRUCT tags", "FIG width", "FIG todo", "FMT code block", "FMT blank indent", "FMT empty heading", "LEC speaker"))


@query("v7_note_format")
def _v7(spark, d):
    lecture, book = (notes.audit_notes(_notes(spark, d), "doc_id", "t", mode) for mode in ("lecture", "textbook"))
    return lecture.where(C("check").startswith("FMT") | C("check").startswith("LEC") | C("check").startswith("REP")).unionByName(book.where(C("check").startswith("TXT")))


@query("f53_declared_labels", """with f as (select n_nationkey, 'V1' as label, n_name || '.MTS' as file from nation union all select n_nationkey, 'A2', '<s>-' || n_name || ' 1.mp3' from nation) select * from f""")
def _f53(spark, d):
    t = F.concat(F.lit("# x\n## 影片代號 表\n| 代號 | 原始檔案 |\n|---|---|\n| V1 | old.mp4 |\n| V1 | "), "n_name", F.lit(".MTS（04:39 起） |\n| A2 | `<s>-"), "n_name", F.lit(" 1.mp3` 註 |\n| B3 | no file |\n# y\n| C4 | z.mp4 |"))
    return notes.declared_labels(table(spark, d, "nation").select("n_nationkey", t.alias("t")), "n_nationkey", "t")


@query("f52_time_citations", """select n_nationkey, * from nation, (values (0, 1, 'a.MTS', 262, 271), (0, 2, 'a.MTS', 373, null), (1, 1, 'b c.mp3', 3723, null), (2, 1, 'a.MTS', 1710, 1722)) v("at", nth, file, start_s, "until")""".replace("select n_nationkey, *", 'select n_nationkey, "at", nth, file, start_s, "until"'))
def _f52(spark, d):
    t = F.concat(F.lit("see (V1 04:22–04:31, 06:13) and (b c.mp3 1:02:03) then `(練習段 V1 28:30-42)`, not (V9 01:00) nor (BP 120:80) nor (see V1 07:30 of it)"), "n_name")
    nation = table(spark, d, "nation")
    labels = nation.select("n_nationkey", F.explode(F.array(F.struct(F.lit("V1").alias("label"), F.lit("a.MTS").alias("file")), F.struct(F.lit("A2").alias("label"), F.lit("b c.mp3").alias("file")))).alias("l")).select("n_nationkey", "l.*")
    return notes.time_citations(nation.select("n_nationkey", t.alias("t")), "n_nationkey", "t", labels).drop("clock")


@query("f56_split_caption")
def _f56(spark, d):
    c = F.regexp_replace(F.replace(F.replace("text", F.lit(", "), F.lit("，")), F.lit(". "), F.lit("（")), "\\n", "）")
    return table(spark, d, "documents").select("doc_id", slides.split_caption(c).alias("c")).select("doc_id", "c.*")


# ---------------------------------------------------------------- segmentation audit

@query("v2_segmentation_audit", """with e as (select user_id, event_id, cast(floor(epoch_us(ts) / 1000000.0) as bigint) as lo, cast(floor(epoch_us(ts) / 1000000.0) as bigint) + cast(value * 60 as bigint) as hi, event_id % 7 as seg from events),
r as (select *, row_number() over (partition by user_id order by lo, event_id) - 1 as pos from e), s as (select user_id, seg, min(pos) as a, max(pos) as b, count(*) as n from r where seg > 0 group by 1, 2),
q as (select user_id, count(*) filter (b - a + 1 <> n) as holes from s group by 1), c as (select user_id, count(*) filter (seg = 0) as uncovered from r group by 1),
o as (select user_id, count(*) filter (play <> first) as moved from (select user_id, row_number() over (partition by user_id order by seg) as play, row_number() over (partition by user_id order by a) as first from s) group by 1),
g as (select user_id, count(*) filter (gap >= 0 and gap <= 3600) as chains, count(*) filter (gap >= 86400) as breaks from (select user_id, lead(lo) over (partition by user_id order by lo, event_id) - hi as gap from r) group by 1),
p as (select a.user_id, count(*) as n from r a join r b on a.user_id = b.user_id and a.event_id < b.event_id and least(a.hi, b.hi) - greatest(a.lo, b.lo) > 60 and not (a.seg = b.seg and a.seg > 0) group by 1),
t as (select user_id, 'segments-noncontiguous' as code, 'REGENERATE' as level, holes as n from q union all select user_id, 'segments-uncovered', 'REVIEW', uncovered from c union all select user_id, 'segments-display-order', 'REVIEW', moved from o
  union all select user_id, 'split-recordings', 'INFO', chains from g union all select user_id, 'natural-breaks', 'INFO', breaks from g union all select user_id, 'parallel-tracks', 'REVIEW', n from p)
select user_id, code, level, n from t where n > 0""")
def _v2s(spark, d):
    e = table(spark, d, "events")
    lo = F.floor(F.unix_micros(C("ts").cast("timestamp")) / 1000000)
    sources = e.select("user_id", "event_id", lo.alias("lo"), (lo + F.round(C("value") * 60).cast("long")).alias("hi"))
    placed = e.where("event_id % 7 > 0").select("user_id", "event_id", (C("event_id") % 7).alias("seg"), (C("event_id") % 7).alias("display_order"))
    return audit.segmentation_findings(sources, placed, "user_id", "event_id", chain_s=3600, break_s=86400)


# ---------------------------------------------------------------- rewriting by a table

@query("f61_rewritten", """with t as (select c_custkey, c_name || ' of NATION_' || c_nationkey || c_custkey % 10 || ' (NATION_1) ' || c_mktsegment as x from customer), n as (select list(n_name order by length(n_name) desc) as names from nation)
select c_custkey, list_reduce(list_prepend(x, names), lambda a, w: replace(a, w, '<' || substring(w, 8) || '>')) as v from t, n""")
def _f61(spark, d):
    table_ = rewrite.table_of(table(spark, d, "nation").select("n_name", F.concat(F.lit("<"), F.substring(C("n_name"), F.lit(8), F.length("n_name")), F.lit(">")).alias("to")), "n_name", "to")
    text = F.concat("c_name", F.lit(" of NATION_"), C("c_nationkey").cast("string"), (C("c_custkey") % 10).cast("string"), F.lit(" (NATION_1) "), "c_mktsegment")
    return table(spark, d, "customer").select("c_custkey", rewrite.rewrite(text, table_).alias("v"))
