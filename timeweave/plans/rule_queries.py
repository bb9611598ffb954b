"""Search, sets, audits, monitors, readers and writers over the tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules as R
from ..sources import readers, sinks
from ..streaming import emit
from ..streaming import monitor as M
from .proxies import SEG, segments, table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("o1_chronological", "select event_id, case when event_type <> 'view' then ts::timestamptz end as ts from events")
def _o1(spark, d):
    return R.chronological(table(spark, d, "events").select("event_id", F.when(F.col("event_type") != "view", F.col("ts").cast("timestamp")).alias("ts")), "ts", "event_id")


@query("o2_top_keywords", """with o as (select user_id, event_type, max(case when value > 95 then 1 else 0 end) as hit, min(event_id) as pos from events group by 1, 2)
select * from (select *, cast(row_number() over (partition by user_id order by hit desc, pos) as int) as rank from o) where rank <= 3""")
def _o2(spark, d):
    return R.top_keywords(table(spark, d, "events").withColumn("h", F.col("value") > 95), ["user_id"], "event_type", "h", "event_id", 3)


@query("o5_search", "select doc_id from documents where contains(lower(text), 'license') and contains(lower(text), 'version') order by doc_id limit 80")
def _o5(spark, d):
    return R.search(table(spark, d, "documents"), "text", ["License", "version"], ["doc_id"]).select("doc_id")


@query("o7_even_sample", """with r as (select user_id, event_id, row_number() over (partition by user_id order by event_id) - 1 as i, count(*) over (partition by user_id) as n from events)
select user_id, event_id from r where i in (0, cast(floor(1 * (n - 1) / 4) as bigint), cast(floor(2 * (n - 1) / 4) as bigint), cast(floor(3 * (n - 1) / 4) as bigint), n - 1)""")
def _o7(spark, d):
    return R.even_sample(table(spark, d, "events"), ["user_id"], "event_id", 5).select("user_id", "event_id")


@query("o9_capped_list", "select p_brand, array_to_string(list(p_partkey order by p_partkey)[1:4], ',') as examples, count(*) as n from part group by 1")
def _o9(spark, d):
    return R.capped_list(table(spark, d, "part"), ["p_brand"], "p_partkey", "p_partkey", 4)


@query("u1_multiset_difference", """with a as (select o_custkey, o_orderpriority, count(*) filter (o_orderkey % 2 = 0) as na, count(*) filter (o_orderkey % 2 = 1) as nb from orders group by 1, 2)
select o_custkey, o_orderpriority, greatest(na - nb, 0) as only_a, greatest(nb - na, 0) as only_b from a where na <> nb""")
def _u1(spark, d):
    o = table(spark, d, "orders")
    return R.multiset_difference(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 2 = 1"), ["o_custkey"], "o_orderpriority")


@query("u2_interleave", f"""with {SEG}, u as (select conv_id, start_s as t, turn as id, 'slide' as kind from seg where role = 'user' union all select conv_id, start_s, turn, 'speech' from seg)
select *, cast(row_number() over (partition by conv_id order by t, kind = 'speech', id) as int) as n from u""")
def _u2(spark, d):
    g = segments(spark, d).select("conv_id", F.col("start_s").alias("t"), F.col("turn").alias("id"), "role")
    return R.interleave(g.where("role = 'user'").drop("role"), g.drop("role"), ["conv_id"], "t")


@query("u5_token_sets", """select l_orderkey from lineitem where l_returnflag = 'A' intersect select o_orderkey from orders where o_orderstatus = 'P' except select l_orderkey from lineitem where l_tax > 0.06""")
def _u5(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    return li.where("l_returnflag = 'A'").select("l_orderkey").intersect(o.where("o_orderstatus = 'P'").select("o_orderkey")).subtract(li.where("l_tax > 0.06").select("l_orderkey"))


@query("u6_ordered_distinct", "select user_id, event_type, min(event_id) as event_id from events group by 1, 2")
def _u6(spark, d):
    return R.ordered_distinct(table(spark, d, "events"), ["user_id"], "event_type", "event_id")


@query("u7_pending", "select doc_id from documents where doc_id not in (select doc_id from labels)")
def _u7(spark, d):
    return R.pending(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("u10_append_untimed", f"with {SEG} select conv_id, turn, start_s from seg union all select conv_id, turn + 1000, null from seg where role = 'system'")
def _u10(spark, d):
    g = segments(spark, d).select("conv_id", "turn", "start_s", "role")
    return R.append_untimed(g.drop("role"), g.where("role = 'system'").withColumn("turn", F.col("turn") + 1000), "start_s")


LOG = """log as (select ts, user_id as run_id, case event_type when 'signup' then 'start' when 'purchase' then 'stage_done' when 'click' then 'heartbeat' else 'slide_done' end as event,
case when event_type = 'error' then 'error' when value > 90 then 'retry' else 'running' end as status, event_id from events)"""


def log(spark, d):
    e = table(spark, d, "events")
    event = F.when(F.col("event_type") == "signup", "start").when(F.col("event_type") == "purchase", "stage_done").when(F.col("event_type") == "click", "heartbeat").otherwise("slide_done")
    status = F.when(F.col("event_type") == "error", "error").when(F.col("value") > 90, "retry").otherwise("running")
    return e.select(F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("run_id"), event.alias("event"), status.alias("status"), "event_id")


@query("t1_event_lines", f"""with {LOG}, g as (select *, epoch_us(ts) - min(epoch_us(ts)) over (partition by run_id) as us from log) select event_id, run_id::varchar as run_id, event, status, round(us / 1000000.0, 3)::double as elapsed, event_id as extra, substring(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 1, 23) as at from g""")
def _t1(spark, d):
    """The emitted lines, read back."""
    lines = emit.event_lines(log(spark, d), "ts", "run_id", F.lit("ocr"), "event", "status", ["event_id"])
    e = F.from_json("line", "ts string, run_id string, stage string, event string, status string, elapsed_monotonic_s double, event_id long")
    return lines.select("event_id", e.alias("e")).select("event_id", "e.run_id", "e.event", "e.status", F.col("e.elapsed_monotonic_s").alias("elapsed"), F.col("e.event_id").alias("extra"), F.substring("e.ts", 1, 23).alias("at"))


@query("t2_run_ordinals", f"with {LOG} select event_id, cast(sum(case when event = 'start' then 1 else 0 end) over (partition by run_id order by event_id) as bigint) as run_no from log")
def _t2(spark, d):
    return M.run_ordinals(log(spark, d), ["run_id"], "event_id").select("event_id", "run_no")


@query("t3_stale_heartbeats", f"with {LOG}, g as (select event_id, (epoch_us(lead(ts) over (partition by run_id order by ts)) - epoch_us(ts)) / 1000000.0 as gap_s from log) select event_id, gap_s::double as gap_s from g where gap_s > 40000")
def _t3(spark, d):
    return M.stale_heartbeats(log(spark, d), ["run_id"], max_age_s=40000).select("event_id", "gap_s")


@query("t4_latest_stage", f"with {LOG} select run_id, arg_max(status, event_id) as status, max(event_id) as event_id from log group by 1")
def _t4(spark, d):
    return M.latest_stage(log(spark, d), ["run_id"], "event_id", "status")


@query("t5_aborted", f"with {LOG} select distinct run_id, cast(ts as date) as day from log where event = 'start' except select run_id, cast(ts as date) from log where event = 'stage_done'")
def _t5(spark, d):
    return M.aborted(log(spark, d).withColumn("day", F.to_date("ts")), ["run_id", "day"])


@query("t6_retry_loops", f"with {LOG} select run_id, count(*) filter (status = 'retry') as retries from log group by 1 having count(*) filter (status = 'retry') >= 5")
def _t6(spark, d):
    return M.retry_loops(log(spark, d), ["run_id"], 5)


@query("t7_errors", f"with {LOG} select event_id, run_id from log where status = 'error'")
def _t7(spark, d):
    return M.errors(log(spark, d)).select("event_id", "run_id")


@query("t8_stalls", f"with {LOG} select event_id % 10 as node, count(*) filter (event = 'heartbeat') as alive, count(*) filter (event = 'slide_done') as progress, (time_bucket(interval '1 hour', ts))::timestamptz as win from log group by 1, 4 having alive > 0 and progress = 0")
def _t8(spark, d):
    return M.stalls(log(spark, d).withColumn("node", F.col("event_id") % 10), ["node"], width="1 hour")


@query("t9_run_trends", f"with {LOG} select cast(ts as date) as day, count(*) as n, avg((status = 'error')::int) as error_rate, avg((status = 'retry')::int) as retry_rate from log group by 1")
def _t9(spark, d):
    return M.run_trends(log(spark, d))


@query("t10_sessions", f"""with {LOG}, n as (select *, case when ts < lag(ts) over w + interval '6 hours' then 0 else 1 end as new from log window w as (partition by run_id order by ts)), g as (select *, sum(new) over (partition by run_id order by ts) as k from n)
select run_id, min(ts)::timestamptz as session_start, (max(ts) + interval '6 hours')::timestamptz as session_end, count(*) as n from g group by run_id, k""")
def _t10(spark, d):
    return M.sessions(log(spark, d), ["run_id"], gap="6 hours")


@query("v1_findings", """select 'WARN' as level, 'short' as "check", doc_id::varchar as detail from documents where length(text) < 100 union all select 'FAIL', 'licence', doc_id::varchar from documents where contains(text, 'License') union all select 'INFO', 'long', doc_id::varchar from documents where length(text) > 20000""")
def _v1(spark, d):
    key = F.col("doc_id")
    return R.findings(table(spark, d, "documents"), [("WARN", "short", F.length("text") < 100, key), ("FAIL", "licence", F.contains("text", F.lit("License")), key), ("INFO", "long", F.length("text") > 20000, key)])


@query("v2_verdict", """with f as (select source, case when length(text) < 100 then 'REVIEW' end as a, case when contains(text, 'License') then 'REGENERATE' end as b from documents), x as (select source, a as level from f where a is not null union all select source, b from f where b is not null)
select source, count(*) as findings, case when bool_or(level = 'REGENERATE') then 'REGENERATE' else 'REVIEW' end as verdict from x group by 1""")
def _v2(spark, d):
    f = R.findings(table(spark, d, "documents"), [("REVIEW", "short", F.length("text") < 100, F.col("source")), ("REGENERATE", "licence", F.contains("text", F.lit("License")), F.col("source"))])
    return R.verdict(f.withColumnRenamed("detail", "source"), ["source"], ["INFO", "REVIEW", "REGENERATE"])


@query("v3_embed_findings", """with r as (select distinct l_partkey as k from lineitem where l_quantity > 49), s as (select p_partkey as k, p_size % 3 + 1 as tier from part where p_partkey % 50 <> 0)
select coalesce(r.k, s.k) as k, case when s.k is null then 'unknown' when r.k is not null and tier > 2 then 'removed' else 'missing' end as status from r full join s on r.k = s.k where s.k is null or (r.k is not null and tier > 2) or (r.k is null and tier <= 2)""")
def _v3(spark, d):
    r = table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("k"))
    return R.embed_findings(r, table(spark, d, "part").where("p_partkey % 50 <> 0").select(F.col("p_partkey").alias("k"), (F.col("p_size") % 3 + 1).alias("tier")), "k", "tier")


@query("v5_snapshot_diff", """with e as (select c_custkey as k, c_acctbal as bal from customer where c_custkey % 11 <> 0), g as (select c_custkey as k, case when c_custkey % 5 = 0 then c_acctbal + 0.01 when c_custkey % 7 = 0 then null else c_acctbal end as bal from customer where c_custkey % 13 <> 0)
select * from (select coalesce(e.k, g.k) as k, e.bal as bal_want, g.bal as bal_got, case when g.k is null then 'gone' when e.k is null then 'new' when g.bal is null or abs(e.bal - g.bal) > 0.001 then 'changed' end as diff from e full join g on e.k = g.k) where diff is not null""")
def _v5(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"))
    got = c.where("k % 13 <> 0").withColumn("bal", F.when(F.col("k") % 5 == 0, F.col("bal") + 0.01).when(F.col("k") % 7 != 0, F.col("bal")))
    return R.snapshot_diff(c.where("k % 11 <> 0"), got, "k", ["bal"])


@query("v6_plan_steps", """select * from (values (1, 'PROMO', 'transcribe'), (2, 'ECONOMY', 'read slides'), (3, 'PROMO', 'align')) t(step_no, kind, step) join (select p_type as kind, count(*) as n from part group by 1) using (kind) where n >= 3""")
def _v6(spark, d):
    counts = table(spark, d, "part").groupBy(F.col("p_type").alias("kind")).agg(F.count("*").alias("n"))
    return R.plan_steps(counts, [("PROMO", 1, "transcribe"), ("ECONOMY", 1, "read slides"), ("PROMO", 3, "align")])


@query("v8_rename_refs", "select p_partkey, p_name as ref, coalesce(n_name, p_name) as renamed from part left join nation on p_name = lower(n_name)")
def _v8(spark, d):
    n = table(spark, d, "nation").select(F.lower("n_name").alias("old"), F.col("n_name").alias("new"))
    return R.rename_refs(table(spark, d, "part").select("p_partkey", F.col("p_name").alias("ref")), n, "ref", "old", "new").select("p_partkey", "ref", "renamed")


@query("v9_backfill", "select p_partkey, coalesce(nullif(p_type, 'PROMO'), 'talk') as p_type, 'hall' as region from part")
def _v9(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    return R.backfill(p, {"p_type": F.lit("talk"), "region": F.lit("hall")})


@query("s10_corpus", "select source, doc_id, left(text, 200000) as text from (select *, row_number() over (partition by source order by doc_id) as k from documents) where k <= 15")
def _s10(spark, d):
    return readers.corpus(table(spark, d, "documents").select("source", "doc_id", "text"), "source", "doc_id", "text")


@query("s12_json_strings", """select doc_id, text as value from documents union all select doc_id, source || '"\\é' from documents""")
def _s12(spark, d):
    j = F.to_json(F.struct(F.col("text").alias("a"), F.struct(F.col("doc_id").alias("n"), F.array(F.concat("source", F.lit('"\\é'))).alias("list")).alias("b")))
    return readers.json_strings(table(spark, d, "documents").select("doc_id", F.replace(j, F.lit("é"), F.lit("\\u00e9")).alias("j")), "doc_id", "j")


@query("s13_classify_paths", "select p_partkey, case p_type when 'PROMO' then 'video' when 'ECONOMY' then 'image' else 'other' end as kind from part")
def _s13(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat(F.lit("/a.b/"), "p_name", F.lit("."), F.when(F.col("p_type") == "PROMO", "MP4").when(F.col("p_type") == "ECONOMY", "jpg").otherwise("xyz")).alias("path"))
    return readers.classify_paths(p, "path", {"video": ["mp4", "mov"], "image": ["jpg", "png"]}).select("p_partkey", "kind")


@query("s13_image_decks", """select '/a.b/' || p_brand as folder, count(*) as images from part where p_type = 'ECONOMY' group by p_brand having count(*) >= 3""")
def _s13d(spark, d):
    p = table(spark, d, "part").select(F.concat(F.lit("/a.b/"), "p_brand", F.lit("/"), "p_name", F.when(F.col("p_type") == "ECONOMY", ".JPG").otherwise(".mp4")).alias("path"))
    return readers.image_decks(readers.classify_paths(p, "path", {"video": ["mp4", "mov"], "image": ["jpg", "png"]}), "path")


@query("s7_frame_times", "select p_partkey, (p_size - 1) * 2.5::double as t from part")
def _s7(spark, d):
    return readers.frame_times(table(spark, d, "part"), "p_size", 2.5).select("p_partkey", "t")


@query("k2_transcript_lines", f"with {SEG} select conv_id, turn, '[' || lpad((start_s // 60)::varchar, 2, '0') || ':' || lpad((start_s % 60)::varchar, 2, '0') || '] ' || text as line from seg")
def _k2(spark, d):
    return sinks.transcript_lines(segments(spark, d), "start_s", "text").select("conv_id", "turn", "line")


@query("k10_render_markdown", "select n_regionkey, '# ' || n_regionkey || chr(10) || string_agg('- ' || n_name, chr(10) order by n_nationkey) as text from nation group by 1")
def _k10(spark, d):
    n = table(spark, d, "nation").withColumn("title", F.col("n_regionkey"))
    return sinks.render_markdown(n, ["n_regionkey"], "title", "n_nationkey", "n_name")


@query("k6_unresolved_refs", "select distinct p_name as name from part where p_name not in (select n_name from nation union select c_mktsegment from customer union select split_part(p_name, ' ', 1) from part)")
def _k6(spark, d):
    p = table(spark, d, "part").withColumnRenamed("p_name", "name")
    assets = table(spark, d, "nation").select(F.col("n_name").alias("name")).union(table(spark, d, "customer").select("c_mktsegment")).union(p.select(F.split_part("name", F.lit(" "), F.lit(1))))
    return sinks.unresolved_refs(p, assets, "name")


@query("k7_timeline_json", f"with {SEG} select conv_id, cast(to_json(list({{'start_s': start_s, 'end_s': end_s, 'turn': turn, 'role': role}} order by start_s, end_s, turn)) as varchar) as timeline from seg group by 1")
def _k7(spark, d):
    return sinks.timeline_json(segments(spark, d), ["conv_id"], "start_s", ["start_s", "end_s", "turn", "role"])
