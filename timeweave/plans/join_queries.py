"""Join operators over the tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import offsets
from .proxies import HASH, SEG, SPAN, hashes, segments, spans, table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("j1_interval_join", f"""with {SEG}, s as (select conv_id, turn as slide, greatest(0, start_s - 20) as lo, end_s + 20 as hi from seg where role = 'user')
select s.conv_id, s.slide, g.turn as seg from s join seg g on s.conv_id = g.conv_id and not (g.end_s < s.lo or g.start_s > s.hi)""")
def _j1(spark, d):
    g = segments(spark, d)
    s = g.where("role = 'user'").select("conv_id", F.col("turn").alias("slide"), F.col("start_s").alias("slide_start"), F.col("end_s").alias("slide_end"))
    return J.window_segments(s, g.select("conv_id", F.col("turn").alias("seg"), "start_s", "end_s"), ["conv_id"]).select("conv_id", "slide", "seg")


@query("j2_containment", f"""with {SPAN}, v as (select user_id, event_id as rec, lo, hi from span where event_type = 'view')
select p.event_id, v.rec from span p left join v on p.user_id = v.user_id and p.lo >= v.lo and p.lo <= v.hi where p.event_type = 'click'""")
def _j2(spark, d):
    s = spans(spark, d)
    rec = s.where("event_type = 'view'").select("user_id", F.col("event_id").alias("rec"), F.col("lo").alias("r_lo"), F.col("hi").alias("r_hi"))
    p = s.where("event_type = 'click'").select("user_id", "event_id", F.col("lo").alias("t"))
    return J.containing(p, rec, "t", "r_lo", "r_hi", ["user_id"], "event_id", 3600).select("event_id", "rec")


@query("j3_slice_by_plan", f"""with {SEG}, plan as (select distinct conv_id, start_s // 40 as part from seg where turn % 2 = 0)
select p.conv_id, p.part, g.turn from plan p join seg g on p.conv_id = g.conv_id and g.start_s >= p.part * 40 and g.start_s < (p.part + 1) * 40""")
def _j3(spark, d):
    g = segments(spark, d)
    plan = g.where("turn % 2 = 0").select("conv_id", F.floor(F.col("start_s") / 40).alias("part")).distinct()
    plan = plan.withColumn("plan_lo", F.col("part") * 40).withColumn("plan_hi", (F.col("part") + 1) * 40)
    return J.slice_by_plan(g, plan, ["conv_id"]).select("conv_id", "part", "turn")


PAIRS = f"""{SPAN}, pair as (select a.user_id, a.event_id as id_a, b.event_id as id_b, least(a.hi, b.hi) - greatest(a.lo, b.lo) as overlap_s
from span a join span b on a.user_id = b.user_id and a.event_id < b.event_id and a.lo < b.hi and b.lo < a.hi)"""


def _pairs(spark, d):
    return J.overlap_pairs(spans(spark, d), "event_id", "lo", "hi", ["user_id"], 3600)


@query("j4_overlap_pairs", f"with {PAIRS} select * from pair")
def _j4(spark, d):
    return _pairs(spark, d)


@query("j5_parallel_tracks", f"""with {PAIRS} select p.id_a, p.id_b, p.overlap_s from pair p join events a on a.event_id = p.id_a join events b on b.event_id = p.id_b
where p.overlap_s > 60 and a.event_type <> b.event_type""")
def _j5(spark, d):
    return J.parallel_tracks(_pairs(spark, d), table(spark, d, "events"), "event_id", "event_type").select("id_a", "id_b", "overlap_s")


@query("j6_replace_overlapping", f"""with {SEG}, r as (select conv_id, start_s + 2 as start_s, end_s + 2 as end_s, case when turn % 6 = 4 then '' else 'again ' || turn end as text from seg where turn % 3 = 1)
select conv_id, start_s, end_s, text from seg m where not exists (select 1 from r where r.conv_id = m.conv_id and r.text <> '' and r.start_s < m.end_s and m.start_s < r.end_s
  and (least(m.end_s, r.end_s) - greatest(m.start_s, r.start_s)) / (m.end_s - m.start_s) >= 0.5)
union all select * from r where text <> ''""")
def _j6(spark, d):
    g = segments(spark, d)
    text = F.when(F.col("turn") % 6 == 4, "").otherwise(F.concat(F.lit("again "), F.col("turn").cast("string")))
    r = g.where("turn % 3 = 1").select("conv_id", (F.col("start_s") + 2).alias("start_s"), (F.col("end_s") + 2).alias("end_s"), text.alias("text"))
    return J.replace_overlapping(g, r, ["conv_id"])


GRAMS = f"""{SEG}, x as (select conv_id, start_s, regexp_replace(text, '\\s+', '', 'g') as x from seg), g as (select conv_id, start_s, unnest(list_transform(range(1, length(x) - 4), lambda i: x[i:i+5])) as gram from x),
c as (select conv_id as clip, start_s as t, gram from g where conv_id % 2 = 0), rr as (select conv_id as rec, start_s as t, gram from g where conv_id % 2 = 1),
rare as (select * from (select *, count(*) over (partition by rec, gram) as n from rr) where n <= 4),
vote as (select clip, rec, cast(round_even((rare.t - c.t) / 5.0, 0) as bigint) * 5 as offset_s, count(*) as votes from c join rare using (gram) group by all)"""


def _clips(spark, d):
    """Even conversations as clips, odd ones as recordings."""
    g = segments(spark, d).select("conv_id", F.col("start_s").alias("t"), "text")
    return g.where("conv_id % 2 = 0").withColumnRenamed("conv_id", "clip"), g.where("conv_id % 2 = 1").withColumnRenamed("conv_id", "rec")


@query("j7_offset_votes", f"with {GRAMS} select * from vote")
def _j7(spark, d):
    return offsets.offset_votes(*_clips(spark, d))


@query("a4_best_offset", f"""with {GRAMS}, s as (select *, cast(sum(votes) over (partition by clip, rec order by offset_s range between 5 preceding and 5 following) as bigint) as smooth from vote)
select clip, rec, offset_s, smooth as votes, smooth < 40 as low_confidence from (select *, row_number() over (partition by clip order by smooth desc, rec, offset_s) as k from s) where k = 1""")
def _a4(spark, d):
    return offsets.best_offset(*_clips(spark, d))


TOK = f"""{SEG}, tok as (select conv_id * 100 + turn as seg, unnest(regexp_extract_all(lower(text), '[a-z]+')) as token from seg),
vocab as (select distinct unnest(regexp_extract_all(lower(text), '[a-z]+')) as token from documents)"""


def _tokens(df, ident, text="text"):
    return df.select(ident, F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), 0)).alias("token"))


def _token_sets(df, *keep, text="text"):
    """Each row's distinct tokens as an array."""
    return df.select(*keep, F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), 0)).alias("tokens"))


def _suspects(spark, d):
    g = segments(spark, d).withColumn("seg", F.col("conv_id") * 100 + F.col("turn"))
    vocab = _token_sets(table(spark, d, "documents"), "doc_id").select(F.explode("tokens").alias("token")).distinct()
    terms = spark.createDataFrame([("licensed",), ("version",)], "token string")
    return J.suspect_tokens(_tokens(g, "seg"), [vocab, terms])


SUS = f"""{TOK}, sus as (select token, min(seg) as first_seg, count(*) as n from tok where length(token) >= 4
and token not in (select token from vocab) and token not in ('licensed', 'version') group by token)"""


@query("j8_suspect_tokens", f"with {SUS} select * from sus")
def _j8(spark, d):
    return _suspects(spark, d)


@query("j9_closest_terms", f"""with {SUS}, t as (select distinct n_name as term from nation union select distinct unnest(string_split(p_name, ' ')) from part union select token from vocab),
p as (select token, term, levenshtein(token, term) as distance from sus, t where abs(length(token) - length(term)) <= 2 and token <> term and term <> '')
select token, term, cast(distance as int) as distance, cast(k as int) as rank from (select *, row_number() over (partition by token order by distance, distance / greatest(length(token), length(term)), term) as k from p where distance <= 2) where k <= 3""")
def _j9(spark, d):
    vocab = _token_sets(table(spark, d, "documents"), "doc_id").select(F.explode("tokens").alias("term"))
    terms = table(spark, d, "nation").select(F.col("n_name").alias("term")).union(table(spark, d, "part").select(F.explode(F.split("p_name", " ")))).union(vocab)
    return J.closest_terms(_suspects(spark, d), terms)


@query("j10_hamming_nn", f"""with {HASH}, p as (select a.vec_id as id, a.label as ll, b.vec_id as rid, b.label as rl, bit_count(xor(xor(a.h, 37), b.h)) as dist from hash a, hash b where a.vec_id % 5 = 0)
select id, case when ll = rl then rid end as rid, cast(dist as int) as dist from (select *, row_number() over (partition by id order by dist, rid) as k from p where dist <= 6) where k = 1""")
def _j10(spark, d):
    h = hashes(spark, d)
    left = h.where("vec_id % 5 = 0").select(F.col("vec_id").alias("id"), F.col("h").bitwiseXOR(F.lit(37)).alias("h"), F.col("label").alias("ll"))
    return J.hamming_nn(left, h.select(F.col("vec_id").alias("rid"), F.col("h").alias("rh"), F.col("label").alias("rl")), guard=F.col("ll") == F.col("rl"))


@query("j11_resolve_unique", """with l as (select distinct 'NATION_' || (n_nationkey % 13) as sub from nation), n as (select distinct n_name from nation),
c as (select sub, count(*) as k, min(n_name) as m from l join n on contains(n_name, sub) group by sub)
select l.sub, coalesce(n.n_name, case when c.k = 1 then c.m end) as n_name from l left join n on l.sub = n.n_name left join c on c.sub = l.sub""")
def _j11(spark, d):
    n = table(spark, d, "nation")
    return J.resolve_unique(n.select(F.concat(F.lit("NATION_"), (F.col("n_nationkey") % 13).cast("string")).alias("sub")), n, "sub", "n_name")


@query("j12_explode_members", """select n_regionkey as region, string_agg(n_name, ',' order by n_nationkey desc) as names from nation group by 1""")
def _j12(spark, d):
    n = table(spark, d, "nation")
    groups = n.groupBy(F.col("n_regionkey").alias("region")).agg(F.reverse(F.array_sort(F.collect_list("n_nationkey"))).alias("keys"))
    return J.explode_members(groups, n, "region", "keys", "n_nationkey", "n_name").select("region", F.concat_ws(",", "values").alias("names"))


@query("j13_names_in_text", """with n as (select distinct unnest(string_split(p_name, ' ')) as name from part union select distinct p_name from part),
h as (select p_partkey as id, name, instr(p_name, name) as pos from part join n on contains(p_name, name)),
b as (select * from (select *, row_number() over (partition by id, pos order by length(name) desc, name) as k from h) where k = 1)
select id, name, cast(pos as int) as pos, cast(row_number() over (partition by id order by pos) as int) as nth from b""")
def _j13(spark, d):
    p = table(spark, d, "part")
    names = p.select(F.explode(F.split("p_name", " ")).alias("name")).union(p.select("p_name")).distinct()
    return J.names_in_text(p.select(F.col("p_partkey").alias("id"), "p_name"), names, "id", "p_name")


@query("j14_claim_conflicts", """select o.o_orderkey as id, o.o_totalprice as claimed, m.measured, o.o_totalprice - m.measured as delta_s, abs(o.o_totalprice - m.measured) > 150000 as conflict
from orders o join (select l_orderkey, max(l_extendedprice) * 4 as measured from lineitem group by 1) m on m.l_orderkey = o.o_orderkey""")
def _j14(spark, d):
    m = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg((F.max("l_extendedprice") * 4).alias("measured"))
    return J.claim_conflicts(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("claimed")), m, "id", "claimed", "measured", 150000)


@query("j15_caption_overlap", """with f as (select doc_id, list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}')) as t from documents)
select doc_id, cast(shared as int) as shared, case when n < 3 then 'skip' when shared = 0 then 'fail' when shared = 1 then 'weak' else 'ok' end as status
from (select a.doc_id, len(list_intersect(b.t, a.t)) as shared, len(a.t) as n from f a join f b on b.doc_id = a.doc_id + 1)""")
def _j15(spark, d):
    toks = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), 0))
    docs = table(spark, d, "documents")
    return J.caption_overlap(docs.select((F.col("doc_id") - 1).alias("doc_id"), toks.alias("tokens")), docs.select("doc_id", toks.alias("tokens")), "doc_id")


@query("j16_ref_integrity", """with a as (select n_name as name, count(distinct n_regionkey) as n from (select n_name, n_regionkey from nation union all select p_name, p_size from part) group by 1)
select r.ref, case when n is null then 'missing' when n > 1 then 'ambiguous' else 'ok' end as status from (select distinct p_name as ref from part union select distinct c_mktsegment from customer union select n_name from nation) r left join a on a.name = r.ref""")
def _j16(spark, d):
    p, n = table(spark, d, "part"), table(spark, d, "nation")
    assets = n.select(F.col("n_name").alias("name"), F.col("n_regionkey").cast("long").alias("digest")).union(p.select("p_name", F.col("p_size").cast("long")))
    refs = p.select(F.col("p_name").alias("ref")).union(table(spark, d, "customer").select("c_mktsegment")).union(n.select("n_name"))
    return J.ref_integrity(refs, assets, "ref", "name", "digest")


@query("j18_seek", f"""with {SEG} select conv_id, turn, start_s, end_s from (select *, row_number() over (partition by conv_id order by (role = 'assistant') desc, start_s desc, turn) as k from seg
where start_s - 0.15 <= 30.0 and 30.0 < end_s + 0.15) where k = 1""")
def _j18(spark, d):
    g = segments(spark, d)
    return J.seek(g, ["conv_id"], F.lit(30.0), "start_s", "end_s", [F.desc(F.col("role") == "assistant"), F.desc("start_s"), F.col("turn")]).select("conv_id", "turn", "start_s", "end_s")


@query("j19_deep_links", """with l as (select n_nationkey, case when n_nationkey % 2 = 0 then lower(n_name) when n_nationkey % 3 = 0 then n_name || 'x' else n_name end as link from nation)
select l.n_nationkey, l.link, coalesce(e.n_name, g.m) as resolved from l left join (select distinct n_name from nation) e on e.n_name = l.link
left join (select lower(n_name) as k, min(n_name) as m from nation group by 1) g on g.k = lower(l.link)""")
def _j19(spark, d):
    n = table(spark, d, "nation")
    link = F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).when(F.col("n_nationkey") % 3 == 0, F.concat("n_name", F.lit("x"))).otherwise(F.col("n_name"))
    return J.deep_links(n.select("n_nationkey", link.alias("link")), n, "link", "n_name")


@query("j20_unmentioned", """with n as (select distinct unnest(string_split(p_name, ' ')) as name from part union select n_name from nation union select distinct split_part(text, ' ', 1) from benchmark)
select name from n where name <> '' and not exists (select 1 from conversations where contains(text, name))""")
def _j20(spark, d):
    names = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("name")).union(table(spark, d, "nation").select("n_name")).union(table(spark, d, "benchmark").select(F.split_part("text", F.lit(" "), F.lit(1)))).distinct().where("name <> ''")
    return J.unmentioned(names, table(spark, d, "conversations"), "name", "text")


@query("j21_ingested", """select c_custkey, c_mktsegment from customer where c_mktsegment in (select o_orderpriority from orders union select c_mktsegment from customer where c_acctbal < 0)""")
def _j21(spark, d):
    c = table(spark, d, "customer")
    slides = table(spark, d, "orders").select(F.col("o_orderpriority").alias("c_mktsegment")).union(c.where("c_acctbal < 0").select("c_mktsegment"))
    return J.ingested(c.select("c_custkey", "c_mktsegment"), slides, "c_mktsegment")


@query("u8_cache_split", f"""with {HASH}, c as (select h & 255 as k, min(label) as label from hash where vec_id % 3 = 0 group by 1)
select h.vec_id, c.label, case when c.label is null then 'pending' else 'hit' end as status from hash h left join c on (h.h & 255) = c.k""")
def _u8(spark, d):
    h = hashes(spark, d).withColumn("k", F.col("h").bitwiseAND(F.lit(255)))
    return J.cache_split(h.select("vec_id", "k"), h.where("vec_id % 3 = 0").select("k", "label"), "k", "label").select("vec_id", "label", "status")
