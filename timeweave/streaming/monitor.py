"""Monitors of an append-only event log (ts, run_id, stage, event, status), for batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_ordinals(events: DataFrame, keys: list[str], order: str, start: str = "start") -> DataFrame:
    """The how-manieth run of its stage an event belongs to; reruns append."""
    w = Window.partitionBy(*keys).orderBy(order)
    return events.withColumn("run_no", F.sum((F.col("event") == start).cast("long")).over(w))


def stale_heartbeats(events: DataFrame, keys: list[str], ts: str = "ts", max_age_s: float = 90) -> DataFrame:
    """Events after which nothing came for longer than ``max_age_s``; the last one is open."""
    gap = (F.unix_micros(F.lead(ts).over(Window.partitionBy(*keys).orderBy(ts))) - F.unix_micros(ts)) / 1e6
    return events.withColumn("gap_s", gap).where(F.col("gap_s") > max_age_s)


def latest_stage(events: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    return events.groupBy(*keys).agg(F.max_by(value, order).alias(value), F.max(order).alias(order))


def aborted(events: DataFrame, keys: list[str], start: str = "start", done: str = "stage_done") -> DataFrame:
    """Runs that started and never ended."""
    began = events.where(F.col("event") == start).select(*keys).distinct()
    return began.join(events.where(F.col("event") == done).select(*keys).distinct(), keys, "left_anti")


def retry_loops(events: DataFrame, keys: list[str], n: int = 3) -> DataFrame:
    return events.groupBy(*keys).agg(F.count_if(F.col("status") == "retry").alias("retries")).where(F.col("retries") >= n)


def errors(events: DataFrame) -> DataFrame:
    return events.where(F.col("status") == "error")


def stalls(events: DataFrame, keys: list[str], ts: str = "ts", alive: str = "heartbeat", progress: str = "slide_done", width: str = "10 minutes") -> DataFrame:
    """Windows with heartbeats and no progress."""
    c = events.groupBy(*keys, F.window(ts, width)["start"].alias("win")).agg(F.count_if(F.col("event") == alive).alias("alive"), F.count_if(F.col("event") == progress).alias("progress"))
    return c.where("alive > 0 and progress = 0")


def run_trends(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Error and retry rates by day."""
    return events.groupBy(F.to_date(ts).alias("day")).agg(F.count("*").alias("n"), F.avg((F.col("status") == "error").cast("int")).alias("error_rate"), F.avg((F.col("status") == "retry").cast("int")).alias("retry_rate"))


def sessions(events: DataFrame, keys: list[str], ts: str = "ts", gap: str = "30 minutes") -> DataFrame:
    """Sessions of events no further apart than ``gap``; on a stream, with a watermark."""
    g = events.groupBy(*keys, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"))
    return g.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def monitor_stream(stream: DataFrame, keys: list[str], ts: str = "ts", late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts by status in tumbling windows of a stream, with late events dropped after the watermark."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "error").alias("errors"), F.count_if(F.col("status") == "retry").alias("retries"))


def rejects(events: DataFrame, reliable: str) -> tuple[DataFrame, DataFrame]:
    """Events with a trusted time, and the others apart: they aren't ordered, but not lost."""
    ok = F.coalesce(F.col(reliable), F.lit(False))
    return events.where(ok), events.where(~ok)
