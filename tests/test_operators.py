"""Literal cases of operators that SQL can't check, and of readers, writers and monitors."""

import json
import re

import pytest
from pyspark.sql import functions as F

from timeweave.functions import text as X
from timeweave.functions import values as V
from timeweave.operators import joins, rules, sequences
from timeweave.plans import scalar_queries
from timeweave.sources import readers, sinks
from timeweave.streaming import monitor


def test_segments_reader(spark, tmp_path):
    rows = [{"start": 0, "end": 1.5, "text": "a"}, {"start": 2, "end": 3, "text": "b"}]
    (tmp_path / "list").mkdir()
    (tmp_path / "list" / "a.json").write_text(json.dumps(rows))
    (tmp_path / "list" / "b.json").write_text(json.dumps({"segments": rows[:1]}))
    got = readers.segments_json(spark, str(tmp_path / "list")).collect()
    assert sorted((r["lecture_id"][-6:], r["seg_id"], r["text"]) for r in got) == [("a.json", 0, "a"), ("a.json", 1, "b"), ("b.json", 0, "a")]
    (tmp_path / "bad.json").write_text('{"other": 1}')
    with pytest.raises(Exception, match="no segments"):
        readers.segments_json(spark, str(tmp_path / "bad.json")).collect()


def test_vtt(spark):
    vtt = "WEBVTT\n\n00:01.000 --> 00:02.500\n<b>one</b> &amp; two\n\n00:02.500 --> 00:04.000\none & two\nthree\n\n00:04.000 --> 0:00:05.000\nthree\n\n1\n00:06.000 --> 00:07.000 align:start\nfour\n\n00:07.000 --> 00:08.000\nfive\n"
    got = readers.parse_vtt(spark.createDataFrame([("f", vtt)], "k string, v string"), "k", "v").orderBy("seg_id").collect()
    assert [(r["start_s"], r["end_s"], r["text"]) for r in got] == [(1.0, 2.5, "one & two"), (2.5, 4.0, "three"), (6.0, 7.0, "four"), (7.0, 8.0, "five")]


def test_monotone_alignment(spark):
    best = [0, 0, 1, 1, 3]
    rows = [("x", r, c, 1.0 if best[r] == c else 0.1) for r in range(5) for c in range(4)]
    got = sequences.monotone_align(spark.createDataFrame(rows, "k string, r int, c int, s double"), "k", "r", "c", "s").orderBy("r").collect()
    assert [r["c"] for r in got] == best


def test_drift_opens_a_group(spark):
    # each step moves 10 bits; the third frame is 20 bits from the first
    h = [0, (1 << 10) - 1, (1 << 20) - 1, (1 << 30) - 1]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(h)], "k string, o long, h long")
    got = sequences.adjacent_dedup(df, ["k"], "o", step=15, drift=20).orderBy("grp").collect()
    assert [(r["first_frame"], r["kept_frame"], r["group_size"]) for r in got] == [(0, 1, 2), (2, 3, 2)]


def test_unknown_is_not_zero(spark):
    df = spark.createDataFrame([(None, 5, 10.0, 10.0), (0.01, 5, 10.0, 10.0), (0.01, 5, None, 10.0)], "d double, n int, kb double, lap double")
    assert [r[0] for r in df.select(V.skip_gate(F.col("d"), F.col("n"), F.col("kb"), F.col("lap"))).collect()] == [False, True, False]
    tiers = spark.createDataFrame([(None,), ("core",), ("T2 x",)], "t string").select(V.parse_tier(F.col("t"))).collect()
    assert [r[0] for r in tiers] == [3, 1, 2]


def test_han_text(spark):
    df = spark.createDataFrame([("心電圖 ECG 與 beta-blocker 心電圖",)], "t string")
    row = df.select(X.keywords(F.col("t")).alias("k"), X.language_verdict(F.col("t")).alias("l"), X.script_class(F.col("t")).alias("s"), X.wordy_chars(F.col("t")).alias("w"), X.wordless(F.lit("…!")).alias("n")).first()
    assert row["k"] == ["心電圖", "ECG", "beta-blocker"] and row["l"] == "bilingual" and row["s"] == "cjk" and row["w"] == 3 + 3 + 4 + 7 + 3 and row["n"]


def test_keywords_of_whole_texts(spark, tmp_path):
    texts = ["short text", "pad " * 100 + "late beta-blocker late 心電圖", "... " * 80 + "Last1 x", ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["v"] for r in scalar_queries.QUERIES["f7_keywords"](spark, str(tmp_path)).collect()}
    assert got == {i: ",".join(dict.fromkeys(re.findall("[A-Za-z][A-Za-z0-9-]+|[\u4e00-\u9fff]{2,}", t))) for i, t in enumerate(texts)}


def test_shapes(spark):
    df = spark.sql("select array(struct(0d as x, 0d as y), struct(4d as x, 0d as y), struct(4d as x, 3d as y), struct(0d as x, 3d as y)) as p, array(struct(2 as top, 0 as left, 'c' as text), struct(1 as top, 5 as left, 'b' as text), struct(1 as top, 0 as left, 'a' as text)) as b")
    row = df.select(V.polygon_density(F.col("p"), F.lit(24.0)).alias("d"), V.reading_order(F.col("b")).alias("o")).first()
    assert row["d"] == 0.5 and row["o"] == "a b c"


def test_empty_does_not_look_clean(spark):
    with pytest.raises(rules.EmptyInput):
        rules.require_rows(spark.range(0), "slides")


def test_interval_join_plan_has_no_nested_loop(spark):
    a = spark.range(10).select(F.lit(1).alias("k"), F.col("id").alias("lo"), (F.col("id") + 5).alias("hi"))
    b = a.select("k", F.col("lo").alias("l2"), F.col("hi").alias("h2"))
    plan = joins.interval_join(a, b, ("lo", "hi"), ("l2", "h2"), ["k"], 4)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert joins.interval_join(a, b, ("lo", "hi"), ("l2", "h2"), ["k"], 4).count() == sum(abs(i - j) <= 5 for i in range(10) for j in range(10))


def test_stream_monitor_and_sinks(spark, tmp_path):
    rows = [("2024-01-01 00:00:01", "r", "ocr", "start", "running", 0.0), ("2024-01-01 00:01:00", "r", "ocr", "x", "error", 1.0), ("2024-01-01 01:00:00", "r", "ocr", "x", "retry", 2.0)]
    ev = spark.createDataFrame(rows, "ts string, run_id string, stage string, event string, status string, elapsed_monotonic_s double").withColumn("ts", F.col("ts").cast("timestamp"))
    sinks.append_events(ev, str(tmp_path / "log"))
    stream = monitor.monitor_stream(readers.event_log(spark, str(tmp_path / "log"), stream=True), ["stage"])
    q = stream.writeStream.format("memory").queryName("watched").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["n"], r["errors"], r["retries"]) for r in spark.table("watched").collect()) == [(1, 0, 1), (2, 1, 0)]
    sinks.write_table(ev, str(tmp_path / "t"))
    sinks.write_table(ev.limit(0), str(tmp_path / "t"), mode="ignore")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
