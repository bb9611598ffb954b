"""The stateful monitor against the batch operator, by the watermark and by the cluster's clock, and emitted events."""

import json
import os
import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from timeweave.sources import readers
from timeweave.streaming import alerts, emit, monitor

BEGIN = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, run_id string, stage string, event string, status string, elapsed_monotonic_s double"


def rows_of(steps):
    return [(BEGIN + timedelta(seconds=s), run, "ocr", event, "running", 0.0) for s, run, event in steps]


@pytest.fixture()
def stateful(spark):
    held = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.shuffle.partitions": "2"}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def started(stream, name, path, **trigger):
    q = stream.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{path}/checkpoint-{name}")
    return (q.trigger(**trigger) if trigger else q).start()


def feed(spark, path, steps, no):
    spark.createDataFrame(rows_of(steps), SCHEMA).coalesce(1).write.json(f"{path}/step-{no}")


def test_replayed_log_gives_the_batch_rows(stateful, tmp_path):
    """Several runs in many small files, in order: silences equal the batch's, and open ones are told once."""
    spark, rng = stateful, random.Random(7)
    now, steps = 0.0, []
    for _ in range(160):
        now += rng.choice([1, 20, 45, 60])
        steps.append((round(now, 1), rng.choice("abc"), "heartbeat"))
    steps.append((now + 1, "a", "stage_done"))
    steps.append((now + 4000, "z", "heartbeat"))  # carries the watermark over all others
    stream = spark.readStream.schema(SCHEMA).json(f"{tmp_path}/step-*")
    feed(spark, tmp_path, steps[:1], "000")
    q = started(alerts.silences(stream, ["run_id"], max_age_s=90, clock="event"), "replayed", tmp_path)
    try:
        for no, at in enumerate(range(1, len(steps), 27), 1):
            feed(spark, tmp_path, steps[at : at + 27], f"{no:03}")
            q.processAllAvailable()
    finally:
        q.stop()
    batch = monitor.stale_heartbeats(spark.createDataFrame(rows_of(steps), SCHEMA), ["run_id"], max_age_s=90)
    want = {(r["run_id"], r["ts"]) for r in batch.collect()}
    got = [(r["run_id"], r["ts"], r["kind"]) for r in spark.table("replayed").collect()]
    last = {run: max(s for s, r, _ in steps if r == run) for run in "bc"}
    still = {(run, BEGIN + timedelta(seconds=s)) for run, s in last.items()}
    assert len(got) == len(set(got)) and {g[2] for g in got} == {"silence"}
    assert {g[:2] for g in got} == want | still and want


def test_clock_and_late_events(stateful, tmp_path):
    """By the cluster's clock: one alert while a run is silent, none after its end, late events apart."""
    spark = stateful
    stream = spark.readStream.schema(SCHEMA).json(f"{tmp_path}/step-*")
    feed(spark, tmp_path, [(100, "a", "start"), (100, "b", "start"), (101, "b", "stage_done")], "0")
    q = started(alerts.silences(stream, ["run_id"], max_age_s=4, late_s=10), "clocked", tmp_path, processingTime="500 milliseconds")
    try:
        until(lambda: rows(spark, "clocked") == [("a", "silence", 100, None)])
        feed(spark, tmp_path, [(50, "a", "heartbeat"), (95, "a", "heartbeat"), (102, "a", "heartbeat"), (120, "a", "stage_done")], "1")
        until(lambda: ("a", "late", 50, None) in rows(spark, "clocked"))
        time.sleep(6)
        assert rows(spark, "clocked") == [("a", "late", 50, None), ("a", "silence", 100, None), ("a", "silence", 102, 18.0)]
    finally:
        q.stop()


def rows(spark, name):
    return sorted((r["run_id"], r["kind"], int((r["ts"] - BEGIN).total_seconds()), r["gap_s"]) for r in spark.table(name).collect())


def until(holds, seconds=90):
    end = time.time() + seconds
    while not holds():
        assert time.time() < end
        time.sleep(0.5)


def test_event_lines(spark):
    df = spark.createDataFrame(rows_of([(0, "r", "start"), (2.5, "r", "x"), (1, "s", None)]), SCHEMA)
    got = [json.loads(r["line"]) for r in emit.event_lines(df, "ts", "run_id", F.lit("ocr"), "event", "status", ["stage"]).orderBy("run_id", "ts").collect()]
    assert [(g["ts"][:19], g["run_id"], g.get("event"), g["elapsed_monotonic_s"]) for g in got] == [("2024-01-01T00:00:00", "r", "start", 0.0), ("2024-01-01T00:00:02", "r", "x", 2.5), ("2024-01-01T00:00:01", "s", None, 0.0)]


def test_event_log_of_a_job(spark, tmp_path):
    path = str(tmp_path / "log")
    with emit.EventLog(spark, path, "r1", "ocr", every=3) as log:
        for i in range(4):
            log.emit("slide_done", slide=i)
        with log.heartbeat(0.2):
            with pytest.raises(RuntimeError), log.heartbeat():
                pass
            until(lambda: log.last_beat and readers.event_log(spark, path).where("event = 'heartbeat'").count() >= 2)
        assert not log.stale() and log.stale(0)
        log.stage_done(slides=4)
    with pytest.raises(ZeroDivisionError), emit.EventLog(spark, path, "r2", "ocr"):
        1 / 0  # noqa: B018
    with emit.EventLog(spark, path, "r3", "ocr"):
        pass
    got = readers.event_log(spark, path).groupBy("run_id").agg(F.count_if(F.col("event") == "start").alias("s"), F.max_by("status", F.col("event") == "stage_done").alias("end"), F.count_if(F.col("event") == "slide_done").alias("n")).orderBy("run_id").collect()
    assert [(r["run_id"], r["s"], r["end"], r["n"]) for r in got] == [("r1", 1, "success", 4), ("r2", 1, "error", 0), ("r3", 1, "error", 0)]
    assert {r["run_id"] for r in monitor.aborted(readers.event_log(spark, path), ["run_id"]).collect()} == set()


def test_streaming_queries_emit_their_life(spark, tmp_path):
    log = emit.EventLog(spark, str(tmp_path / "log"), "r", "stream")
    listener = emit.QueryEvents(log)
    spark.streams.addListener(listener)
    try:
        spark.createDataFrame([(1,)], "x int").write.json(f"{tmp_path}/in")
        q = started(spark.readStream.schema("x int").json(f"{tmp_path}/in"), "lived", tmp_path)
        q.processAllAvailable()
        q.stop()
        until(lambda: os.path.exists(f"{log.path}/_SUCCESS") and spark.read.text(log.path).where("value like '%stage_done%'").count(), 60)
    finally:
        spark.streams.removeListener(listener)
    log.flush()
    got = [json.loads(r["value"]) for r in spark.read.text(log.path).collect()]
    assert {"start", "heartbeat", "stage_done"} <= {g["event"] for g in got} and sum(g.get("rows", 0) for g in got) == 1
