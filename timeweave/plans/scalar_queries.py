"""Scalar functions over the tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import loops as L
from ..functions import text as X
from ..functions import values as V
from .proxies import HASH, SEG, hashes, segments, table

QUERIES, SQL = {}, {}


def column(name: str, source: str, key: str, build, sql: str, with_sql: bool = True):
    """A query of one computed column ``v`` next to the key of a table."""

    def run(spark, d):
        df = segments(spark, d).withColumn("sid", F.col("conv_id") * 100 + F.col("turn")) if source == "seg" else hashes(spark, d) if source == "hash" else table(spark, d, source)
        return df.select(key, build().alias("v"))

    QUERIES[name] = run
    if with_sql:
        with_ = {"seg": f"with {SEG} ", "hash": f"with {HASH} "}.get(source, "")
        k = "conv_id * 100 + turn as sid" if source == "seg" else key
        SQL[name] = f"{with_}select {k}, {sql} as v from {source}"


C = F.col
column("f1_skip_gate", "part", "p_partkey", lambda: V.skip_gate(C("p_size") / 100, F.length("p_name"), C("p_retailprice") / 20, F.nullif(C("p_partkey") % 130, F.lit(5).cast("long"))), "coalesce(p_size / 100 < 0.05 and length(p_name) < 20 and p_retailprice / 20 < 80 and nullif(p_partkey % 130, 5) < 100, false)")
column("f1_skip_reasons", "part", "p_partkey", lambda: F.array_join(V.skip_reasons(C("p_size") / 100, F.length("p_name"), C("p_retailprice") / 20, C("p_partkey") % 130), ","), "concat_ws(',', case when p_size / 100 < 0.05 then 'low_density' end, case when length(p_name) < 20 then 'little_text' end, case when p_retailprice / 20 < 80 then 'small_file' end, case when p_partkey % 130 < 100 then 'flat_image' end)")
column("f2_ocr_route", "part", "p_partkey", lambda: V.ocr_route(C("p_type") == "PROMO", F.length("p_name"), F.nullif(C("p_size"), F.lit(7)) / 500, C("p_partkey") % 9 != 0), "case when p_type = 'PROMO' then 'pdf' when p_partkey % 9 = 0 then 'image-missing' when nullif(p_size, 7) is not null and length(p_name) < 12 and nullif(p_size, 7) / 500 < 0.03 then 'skip' else 'engine' end")
column("f3_ocr_fallback", "part", "p_partkey", lambda: V.ocr_fallback(F.nullif(C("p_size"), F.lit(7)), F.nullif(C("p_type"), F.lit("ECONOMY")).isNull().cast("int") + F.lit(None), C("p_size") / 50), "case when nullif(p_size, 7) is null then 'no_result' when p_size / 50 < 0.60 then 'low_confidence' end")
column("f4_drop_lines", "documents", "doc_id", lambda: X.drop_lines(C("text"), ["License", "token"]), "array_to_string(list_filter(string_split(text, chr(10)), lambda l: not (contains(l, 'License') or contains(l, 'token'))), chr(10))")
column("f5_drop_short_chrome", "documents", "doc_id", lambda: X.drop_lines(C("text"), ["of", "de"], 8), "array_to_string(list_filter(string_split(text, chr(10)), lambda l: not ((contains(l, 'of') or contains(l, 'de')) and length(trim(l, ' ')) <= 8)), chr(10))")
column("f5_drop_chrome_lines", "documents", "doc_id", lambda: X.drop_pattern_lines(C("text"), "[A-Z]{3,}!!"), "array_to_string(list_filter(string_split(text, chr(10)), lambda l: not regexp_matches(l, '[A-Z]{3,}!!')), chr(10))")
column("f12_mean_confidence", "embeddings", "vec_id", lambda: F.round(V.mean_confidence(F.transform("embedding", lambda x: x.cast("double"))), 6), "round(list_avg(embedding), 6)")
column("f15_hamming", "hash", "vec_id", lambda: V.hamming(C("h"), C("vec_id") * 1234567), "cast(bit_count(xor(h, vec_id * 1234567)) as int)")
column("f16_changed_fraction", "embeddings", "vec_id", lambda: V.changed_fraction(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32), 0.1), "len(list_filter(range(1, 33), lambda i: abs(embedding[i] - embedding[i + 32]) > cast(0.1 as double))) / 32")
column("f17_bhattacharyya", "embeddings", "vec_id", lambda: F.round(V.bhattacharyya(F.transform(F.slice("embedding", 1, 32), lambda x: F.abs(x).cast("double")), F.transform(F.slice("embedding", 33, 32), lambda x: F.abs(x).cast("double"))), 6), "round(sqrt(greatest(0, 1 - list_sum(list_transform(range(1, 33), lambda i: sqrt(abs(cast(embedding[i] as double)) * abs(cast(embedding[i + 32] as double))))) / sqrt(list_sum(list_transform(embedding[1:32], lambda x: abs(cast(x as double)))) * list_sum(list_transform(embedding[33:64], lambda x: abs(cast(x as double))))))), 6)")
column("f18_layout_similarity", "part", "p_partkey", lambda: V.layout_similarity(F.nullif(C("p_size"), F.lit(7)) / 50, C("p_partkey") % 100 / 100), "0.6::double * (nullif(p_size, 7) / 50) + 0.4::double * (1 - p_partkey % 100 / 100)")
column("f25_skip_score", "seg", "sid", lambda: V.skip_score(C("end_s") - C("start_s"), F.regexp_count("text", F.lit(" ")), C("turn") / 5), "case when end_s - start_s < 10 and length(text) - length(replace(text, ' ', '')) < 30 then 0.9::double else least(greatest(1 - turn / 5, 0), 1) end")
column("f30_parse_tier", "orders", "o_orderkey", lambda: V.parse_tier(F.when(C("o_orderkey") % 7 == 0, F.lit(None)).when(C("o_orderkey") % 7 == 1, "core").otherwise(C("o_orderpriority"))), "case when o_orderkey % 7 = 0 then 3 when o_orderkey % 7 = 1 then 1 else cast(regexp_extract(o_orderpriority, '[1-9]') as int) end")
column("f31_fmt_hms", "orders", "o_orderkey", lambda: V.fmt_hms(C("o_orderkey")), "case when o_orderkey >= 3600 then (o_orderkey // 3600) || ':' || lpad((o_orderkey % 3600 // 60)::varchar, 2, '0') else lpad((o_orderkey // 60)::varchar, 2, '0') end || ':' || lpad((o_orderkey % 60)::varchar, 2, '0')")
column("f31_parse_time", "orders", "o_orderkey", lambda: V.parse_time(V.fmt_hms(C("o_orderkey"))), "o_orderkey::double")
column("f33_bigram_jaccard", "part", "p_partkey", lambda: X.bigram_jaccard(F.concat("p_name", "p_type"), F.concat("p_name", "p_brand"), 15), "case when length(p_name || p_type) >= 15 and length(p_name || p_brand) >= 15 then len(list_intersect(list_distinct(list_transform(range(1, length(p_name || p_type)), lambda i: (p_name || p_type)[i:i+1])), list_distinct(list_transform(range(1, length(p_name || p_brand)), lambda i: (p_name || p_brand)[i:i+1])))) / len(list_distinct(list_transform(range(1, length(p_name || p_type)), lambda i: (p_name || p_type)[i:i+1]) || list_transform(range(1, length(p_name || p_brand)), lambda i: (p_name || p_brand)[i:i+1]))) end")
column("f48_salient_tokens", "documents", "doc_id", lambda: F.size(X.salient_tokens(C("text"), ["the", "and"])), "cast(len(list_filter(list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}')), lambda x: x not in ('the', 'and'))) as int)")
column("f49_note_payload", "documents", "doc_id", lambda: X.note_payload(C("text")), "regexp_replace(regexp_replace(regexp_replace(text, 'https?://[^ \\n]+', '', 'g'), '[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?', '', 'g'), '[ \\t\\n\\r]+', '', 'g')")
column("f50_wordy_chars", "documents", "doc_id", lambda: X.wordy_chars(C("text")), "cast(coalesce(list_sum(list_transform(regexp_extract_all(text, '[A-Za-z]{3,}'), lambda x: length(x))), 0) as int)")
column("f54_strip_tags", "pages", "page_id", lambda: F.length(X.strip_tags(C("html"))), "cast(length(trim(regexp_replace(replace(replace(replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&quot;', '\"'), '&amp;', '&'), '[ \\t\\n\\r]+', ' ', 'g'), ' ')) as int)")
column("f55_slug", "customer", "c_custkey", lambda: X.slug(F.concat("c_name", F.lit(" / "), "c_mktsegment")), "regexp_replace(regexp_replace(lower(c_name || ' / ' || c_mktsegment), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')")
column("f57_natural_key", "part", "p_partkey", lambda: X.natural_key(F.concat("p_brand", F.lit("x"), C("p_size").cast("string"))), "regexp_extract(p_brand, '^[^0-9]+') || lpad(regexp_extract(p_brand, '[0-9]+'), 8, '0') || 'x' || lpad(p_size::varchar, 8, '0')")
column("f62_truncate_words", "documents", "doc_id", lambda: X.truncate_words(C("text"), 100), "case when length(text) <= 100 then text when contains(left(text, 100), ' ') and 100 - instr(reverse(left(text, 100)), ' ') >= 80 then left(text, 100 - instr(reverse(left(text, 100)), ' ')) else left(text, 100) end")
column("f47_reliable", "events", "event_id", lambda: V.reliable(F.when(C("event_id") % 3 == 0, "mtime:x").when(C("event_id") % 3 == 1, F.lit(None)).otherwise(C("event_type"))), "event_id % 3 = 2")
column("s9_filename_time", "events", "event_id", lambda: V.filename_time(F.concat(F.lit("VID_"), F.date_format("ts", "yyMMdd_HHmm"))), "date_trunc('minute', ts)::timestamptz")
column("f45_refine_seconds", "events", "event_id", lambda: V.refine_seconds(F.date_trunc("minute", "ts"), C("ts") + F.make_interval(secs=C("event_id") % 60)), "case when date_trunc('minute', ts) = date_trunc('minute', ts + to_seconds(event_id % 60)) then ts + to_seconds(event_id % 60) else date_trunc('minute', ts) end")
column("o6_snippet", "documents", "doc_id", lambda: X.snippet(C("text"), ["license", "token"]), "substring(text, greatest(coalesce(least(nullif(instr(lower(text), 'license'), 0), nullif(instr(lower(text), 'token'), 0)), 1) - 24, 1), 90)")


# ---------------------------------------------------------------- rules with several branches

def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


#: Han instead of some letters, so that the rules on scripts meet all their branches.
LETTERS, NUMERALS = "abcdefghij", "一二三四五六七八九十"
HAN_DOC = f"case doc_id % 3 when 0 then text when 1 then translate(text, 'aeiou', '{NUMERALS[:5]}') else translate(text, 'aeiounrstlhd', '{NUMERALS}天地') end"


def _han_doc():
    return F.when(C("doc_id") % 3 == 0, C("text")).when(C("doc_id") % 3 == 1, F.translate("text", "aeiou", NUMERALS[:5])).otherwise(F.translate("text", "aeiounrstlhd", NUMERALS + "天地"))


@query("f6_classify_keyword", r"""with w as (select distinct unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9-]+')) as word from documents
union select case n_nationkey % 5 when 0 then '頸椎病變' when 1 then 'MRI' when 2 then 'covid19' when 3 then 'averyveryverylonggluedword' else 'well-known-hyphenated-word' end from nation)
select word, case when regexp_matches(word, '^\p{Han}{2,}$') then 'cjk' when length(word) >= 19 and not contains(word, '-') then null when regexp_matches(word, '^[A-Z]{1,4}$') or upper(word) = 'COVID19' then 'abbreviation'
when ends_with(lower(word), 'tion') and length(word) > 6 then 'drug' when ends_with(lower(word), 'ing') and length(word) > 5 then 'medical_term' when length(word) >= 5 then 'general' end as v from w""")
def _f6(spark, d):
    own = F.when(C("n_nationkey") % 5 == 0, "頸椎病變").when(C("n_nationkey") % 5 == 1, "MRI").when(C("n_nationkey") % 5 == 2, "covid19").when(C("n_nationkey") % 5 == 3, "averyveryverylonggluedword").otherwise("well-known-hyphenated-word")
    words = table(spark, d, "documents").select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[A-Za-z][A-Za-z0-9-]+"), 0))).alias("word")).union(table(spark, d, "nation").select(own)).distinct()
    return words.select("word", X.classify_keyword(C("word"), ["tion"], ["ing"], ["covid19"]).alias("v"))


@query("f7_keywords", r"""with t as (select doc_id, regexp_extract_all(text, '[A-Za-z][A-Za-z0-9-]+|\p{Han}{2,}') as l from documents) select doc_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') as v from t""")
def _f7(spark, d):
    return table(spark, d, "documents").select("doc_id", F.array_join(X.keywords(C("text")), ",").alias("v"))

FIRST = "lower(substr(split_part(text, ' ', 1), 2, 3))"
column("f20_word_start_hit", "documents", "doc_id", lambda: X.word_start_hit(C("text"), F.substring(F.split_part("text", F.lit(" "), F.lit(1)), 2, 3)), f"case when regexp_matches({FIRST}, '^[a-z0-9][a-z0-9-]*$') then regexp_matches(lower(text), '(^|[^a-z0-9])' || regexp_escape({FIRST})) else contains(lower(text), {FIRST}) end")
column("f23_abbreviation_hit", "documents", "doc_id", lambda: X.abbreviation_hit(C("text"), F.regexp_extract("text", "[A-Z][a-z]{1,3}", 0)), "regexp_matches(text, '(^|[^A-Za-z0-9])' || regexp_escape(regexp_extract(text, '[A-Z][a-z]{1,3}')) || '([^A-Za-z0-9]|$)')")


@query("f22_gram_hit", rf"""with t as (select doc_id, {HAN_DOC} as text from documents),
r as (select doc_id, reverse(regexp_extract(text, '\p{{Han}}{{3,6}}')) as word, flatten(list_transform(string_split(text, chr(10)), lambda l: regexp_extract_all(regexp_replace(regexp_replace(l, '(\p{{Han}})\s+(\p{{Han}})', '\1\2', 'g'), '(\p{{Han}})\s+(\p{{Han}})', '\1\2', 'g'), '\p{{Han}}{{2,}}'))) as runs from t),
g as (select *, list_distinct(list_transform(range(1, length(word)), lambda i: word[i:i+1])) as want, list_distinct(flatten(list_transform(runs, lambda x: list_transform(range(1, length(x)), lambda i: x[i:i+1])))) as held from r)
select doc_id, word, case when length(word) < 4 then len(list_filter(runs, lambda x: contains(x, word))) > 0 else len(list_intersect(want, held)) / len(want) >= 0.4 end as v from g where word <> ''""")
def _f22(spark, d):
    t = table(spark, d, "documents").select("doc_id", _han_doc().alias("text"))
    t = t.withColumn("word", F.reverse(F.regexp_extract("text", X.HAN + "{3,6}", 0))).where("word <> ''")
    return t.select("doc_id", "word", X.gram_hit(F.split("text", "\n"), C("word")).alias("v"))


CUES = "(contains(lower(l), 'license') or contains(lower(l), 'token') or contains(lower(l), 'shou'))"
column("f24_cue_density", "documents", "doc_id", lambda: X.cue_density(F.split("text", "\n"), ["License", "token", "shou"]), f"len(list_filter(string_split(text, chr(10)), lambda l: {CUES})) / len(string_split(text, chr(10)))")
column("f26_domains", "documents", "doc_id", lambda: F.array_join(X.domains(C("text"), {"legal": ["License", "copyright"], "access": "token", "none": [], "sport": ["shou", "ball"]}), ","), "concat_ws(',', case when contains(lower(text), 'license') or contains(lower(text), 'copyright') then 'legal' end, case when contains(lower(text), 'token') then 'access' end, case when contains(lower(text), 'shou') or contains(lower(text), 'ball') then 'sport' end)")
GUESS = "case when doc_id % 3 = 0 then 'Zoom' when doc_id % 3 = 1 then '12 / 30' end"
PROGRAMS = "(?i)^\\W*(zoom|slides?)\\W*$"
GOOD = rf"""(len(regexp_extract_all(trim(x, ' '), '[A-Za-z一-鿿]')) >= 2 and not regexp_matches(trim(x, ' '), '{X.PURE_NUMBER.replace("'", "''")}') and not regexp_matches(trim(x, ' '), '{PROGRAMS}') and not contains(x, 'The'))"""
column("f29_clean_title", "documents", "doc_id", lambda: X.clean_title(F.when(C("doc_id") % 3 == 0, "Zoom").when(C("doc_id") % 3 == 1, "12 / 30"), C("text"), F.lit(None).cast("array<string>"), ["The"], [PROGRAMS]), f"coalesce(regexp_replace(trim(list_filter([coalesce({GUESS}, '')] || string_split(text, chr(10)), lambda x: {GOOD})[1], ' '), '\\s+', ' ', 'g'), '')")
TYPES = "case when p_type = 'PROMO' then ['title', 'decorative'] when p_type = 'ECONOMY' then ['ultrasound', 'title'] when p_type = 'STANDARD' then ['chart'] when p_partkey % 4 = 0 then ['table', 'title'] when p_partkey % 4 = 1 then ['text'] when p_partkey % 4 = 2 then ['text', 'anatomy'] else [] end"
SLIDE = f"""slide as (select *, {TYPES} as types, case when p_partkey % 17 = 0 then ['summary'] else ['other'] end as fns, p_partkey % 13 / 13 as red, p_partkey % 19 = 0 as imaging, p_partkey % 23 = 0 as algorithm, p_partkey % 2 = 0 as canonical from part),
scored as (select *, least(greatest(0.25::double * (p_size / 50) + 0.2::double * (p_partkey % 10 / 10) + 0.3::double * coalesce(nullif(p_partkey % 7, 3) / 7, 0) + 0.15::double * (p_partkey % 3 / 3) + 0.1::double * least(p_retailprice / 10 / 120, 1)
  + case when list_contains(types, 'chart') then 0.15 else 0 end + case when list_contains(types, 'ultrasound') then 0.1 else 0 end - 0.2::double * (p_partkey % 5 / 5) - 0.05::double * (p_partkey % 11 / 11) - case when red > 0.8 then 0.15 else 0 end, 0), 1) as score from slide)"""
FLOORED = "(imaging or list_has_any(types, ['ultrasound', 'xray', 'mri', 'anatomy', 'flowchart', 'chart', 'kaplan_meier', 'scatter_plot']))"


def _slides(spark, d):
    arr = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    k = C("p_partkey")
    types = F.when(C("p_type") == "PROMO", arr("title", "decorative")).when(C("p_type") == "ECONOMY", arr("ultrasound", "title")).when(C("p_type") == "STANDARD", arr("chart")).when(k % 4 == 0, arr("table", "title")).when(k % 4 == 1, arr("text")).when(k % 4 == 2, arr("text", "anatomy")).otherwise(arr())
    p = table(spark, d, "part").withColumns({"types": types, "fns": F.when(k % 17 == 0, arr("summary")).otherwise(arr("other")), "red": k % 13 / 13, "imaging": k % 19 == 0, "algorithm": k % 23 == 0, "canonical": k % 2 == 0})
    signals = {"visual_complexity": C("p_size") / 50, "information_density": k % 10 / 10, "reference_density": F.nullif(k % 7, F.lit(3).cast("long")) / 7, "emphasis": k % 3 / 3, "time_s": C("p_retailprice") / 10, "skip": k % 5 / 5, "confusion": k % 11 / 11, "redundancy": C("red"), "types": C("types")}
    weights = {"visual_complexity": 0.25, "information_density": 0.2, "reference_density": 0.3, "emphasis": 0.15, "time": 0.1}
    return p.withColumn("score", V.tier_score(signals, weights, {"chart": 0.15, "ultrasound": 0.1}, {"skip": -0.2, "confusion": -0.05, "redundancy": -0.15}, 0.8))


@query("f27_tier_score", f"with {SLIDE} select p_partkey, round(score, 6) as v from scored")
def _f27s(spark, d):
    return _slides(spark, d).select("p_partkey", F.round("score", 6).alias("v"))


@query("f27_tier", f"""with {SLIDE}, t as (select *, case when score >= 0.6 then 1 when score >= 0.35 then 2 else 3 end as base from scored)
select p_partkey, case when list_contains(fns, 'summary') then 1 when types = ['title', 'decorative'] or (red >= 0.7 and len(list_filter(types, lambda x: x not in ('text', 'title', 'decorative'))) = 0 and not imaging and not algorithm) then 3
when base = 3 and canonical and {FLOORED} then 2 else base end as v from t""")
def _f27(spark, d):
    return _slides(spark, d).select("p_partkey", V.tier(C("score"), C("types"), C("fns"), C("red"), C("imaging"), C("algorithm"), C("canonical"), (0.6, 0.35), ["summary"], [["title"], ["title", "decorative"]]).alias("v"))


@query("f28_embed_width", f"""with {SLIDE} select p_partkey, case when list_has_any(types, ['ultrasound', 'xray', 'mri']) or imaging then 800 when list_has_any(types, ['anatomy', 'flowchart']) or algorithm or list_contains(fns, 'summary') then 700
when list_has_any(types, ['chart', 'kaplan_meier', 'scatter_plot']) then 640 when list_contains(types, 'table') and len(list_filter(types, lambda x: x not in ('table', 'title'))) = 0 then 600 else 500 end as v from slide""")
def _f28(spark, d):
    return _slides(spark, d).select("p_partkey", V.embed_width(C("types"), C("fns"), C("imaging"), C("algorithm"), ["summary"], {"chart": 640, "default": 500}).alias("v"))


MARKS_SQL = X.MARKS.replace("'", "''")
WIDE_NAME = "p_name || '，Ｂ' || p_brand || ' 5％-（X）' || p_type"
column("f32_squash", "part", "p_partkey", lambda: L.squash(F.concat("p_name", F.lit("，Ｂ"), "p_brand", F.lit(" 5％-（X）"), "p_type")), f"regexp_replace(lower(translate({WIDE_NAME}, '{X.WIDE}', '{X.NARROW.replace(chr(39), chr(39) * 2)}')), '{MARKS_SQL}', '', 'g')")


@query("f37_script_class", rf"""with t as (select doc_id, regexp_replace({HAN_DOC}, '\s+', '', 'g') as x from documents) select doc_id, case when len(regexp_extract_all(x, '\p{{Han}}')) >= 0.3 * greatest(length(x), 1) then 'cjk' else 'latin' end as v from t""")
def _f37(spark, d):
    return table(spark, d, "documents").select("doc_id", X.script_class(_han_doc()).alias("v"))


@query("f39_language_verdict", rf"""with t as (select doc_id, {HAN_DOC} as x from documents), n as (select doc_id, len(regexp_extract_all(x, '\p{{Han}}')) as h, len(regexp_extract_all(x, '[A-Za-z]')) as l from t)
select doc_id, case when h + l = 0 then 'unknown' when h / (h + l) >= 0.6 then 'zh' when h / (h + l) <= 0.1 then 'en' else 'bilingual' end as v from n""")
def _f39(spark, d):
    return table(spark, d, "documents").select("doc_id", X.language_verdict(_han_doc()).alias("v"))


column("f38_wordless", "documents", "doc_id", lambda: X.wordless(F.regexp_extract("text", "[^A-Za-z]*$", 0)), "not regexp_matches(regexp_extract(text, '[^A-Za-z]*$'), '[\\p{L}\\p{N}]')")
column("f63_capital_terms", "documents", "doc_id", lambda: F.array_join(X.capital_terms(C("text")), ","), "array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[A-Z][a-z]{3,}')))[1:50], ',')")


@query("f59_repetition_score", r"""with w as (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w from documents), g as (select doc_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as g from w where len(w) >= 6),
c as (select doc_id, g, count(*) as n from g group by 1, 2), s as (select doc_id, round(max(n) / count(*), 3) as v from c group by 1) select d.doc_id, coalesce(v, 0.0) as v from documents d left join s using (doc_id)""")
def _f59(spark, d):
    return table(spark, d, "documents").select("doc_id", X.repetition_score(C("text")).alias("v"))


column("f66_gpu_verdict", "part", "p_partkey", lambda: V.gpu_verdict(C("p_size") * 1000, C("p_partkey") % 100, F.array(F.lit(None).cast("double"), C("p_retailprice").cast("double"), (C("p_size") * 25).cast("double")), 20000, 80), "case when p_size * 1000 < 20000 or ((p_retailprice >= 1024 or p_size * 25 >= 1024) and p_partkey % 100 > 80) then 'blocked' when p_retailprice >= 1024 or p_size * 25 >= 1024 then 'warning' else 'ok' end")
STATUS = [400, 404, 429, 500, 502, 503, 504, 522, 524]
column("f67_transient_error", "orders", "o_orderkey", lambda: X.transient_error(F.when(C("o_orderkey") % 5 == 0, "timeout").when(C("o_orderkey") % 5 == 1, "value").when(C("o_orderkey") % 5 != 2, "http"), F.element_at(F.array(*map(F.lit, STATUS)), (C("o_orderkey") % 9 + 1).cast("int"))), f"case when o_orderkey % 5 = 0 then true when o_orderkey % 5 in (1, 2) then false else {STATUS}[o_orderkey % 9 + 1] in (500, 502, 503, 504, 522, 524) end")
column("f68_fingerprint", "documents", "doc_id", lambda: V.fingerprint(F.encode("text", "utf-8"), F.octet_length("text"), C("n_chars")), "", with_sql=False)
column("f36_inline_repeat", "documents", "doc_id", lambda: F.array_max(F.transform(L.squash_lines(F.split("text", "\n")), X.inline_repeat)), "", with_sql=False)
