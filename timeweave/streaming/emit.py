"""Emitting events: lines of an append-only log, from tables, from a running job and from streaming queries."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


def event_lines(events: DataFrame, ts: str, run: str, stage: Column, event: str, status: str, extras: list[str] = ()) -> DataFrame:
    """``line``: each event as JSON with its time, run, stage, seconds since its run began, and extra fields."""
    began = F.min(ts).over(Window.partitionBy(run))
    elapsed = F.round((F.unix_micros(ts) - F.unix_micros(began)) / 1e6, 3)
    at = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    fields = [at.alias("ts"), F.col(run).cast("string").alias("run_id"), stage.alias("stage"), F.col(event).alias("event"), F.col(status).alias("status"), elapsed.alias("elapsed_monotonic_s")]
    return events.withColumn("line", F.to_json(F.struct(*fields, *extras)))


class EventLog:
    """The events of one stage of a run, appended to a folder that event_log reads; reruns append.

    Events are gathered and written as one file at every flush: at an end, an
    error, and each ``every`` events. Used as a block it brackets the stage: an
    exception is an error's ``stage_done``, a block left without one as well.
    """

    def __init__(self, spark: SparkSession, path: str, run_id: str, stage: str, every: int = 100, **extras):
        self.spark, self.path, self.every = spark, path, every
        self.base, self.extras, self.began = (run_id, stage), extras, time.monotonic()
        self.held: list[str] = []
        self.lock, self.writing, self.done, self.beat, self.last_beat = threading.Lock(), threading.Lock(), False, None, None

    def emit(self, event: str, status: str = "running", **fields) -> None:
        run_id, stage = self.base
        row = {"ts": datetime.now(UTC).isoformat(timespec="milliseconds"), "run_id": run_id, "stage": stage, "event": event, "status": status, "elapsed_monotonic_s": round(time.monotonic() - self.began, 3)} | self.extras | fields
        with self.lock:
            self.held.append(json.dumps(row, ensure_ascii=False, default=str))
            full = len(self.held) >= self.every
        if full or status in ("error", "success"):
            self.flush()

    def flush(self) -> None:
        with self.writing:
            with self.lock:
                lines, self.held = self.held, []
            if lines:
                self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(self.path)

    def stage_done(self, success: bool = True, **fields) -> None:
        self.done = True
        self.emit("stage_done", "success" if success else "error", success=success, **fields)

    @contextmanager
    def heartbeat(self, interval_s: float = 30) -> Iterator[EventLog]:
        """A heartbeat every ``interval_s`` while the block runs; blocks of one log can't be nested."""
        if self.beat is not None:
            raise RuntimeError("a heartbeat of this stage runs already")
        stop = threading.Event()

        def run() -> None:
            while not stop.wait(interval_s):
                self.emit("heartbeat")
                self.last_beat = time.monotonic()
                self.flush()

        self.beat, self.last_beat = threading.Thread(target=run, daemon=True), time.monotonic()
        self.beat.start()
        try:
            yield self
        finally:
            stop.set()
            self.beat.join(timeout=60)
            self.beat = None

    def stale(self, max_age_s: float = 90) -> bool:
        """Whether heartbeats began and stopped coming."""
        return self.last_beat is not None and time.monotonic() - self.last_beat > max_age_s

    def __enter__(self) -> EventLog:
        self.emit("start")
        return self

    def __exit__(self, kind, error, _) -> None:
        if not self.done:
            self.stage_done(False, **({"error": f"{kind.__name__}: {error}"[:300]} if kind else {"error": "left without stage_done"}))
        self.flush()


class QueryEvents(StreamingQueryListener):
    """Streaming queries' own life as events: start, a heartbeat for every batch or idle trigger, stage_done."""

    def __init__(self, log: EventLog):
        self.log = log

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.log.emit("start", query=str(event.id), name=event.name)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.log.emit("heartbeat", query=str(p.id), batch=p.batchId, rows=p.numInputRows)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self.log.emit("heartbeat", query=str(event.id))

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.log.emit("stage_done", "error" if event.exception else "success", query=str(event.id), error=event.exception)
