"""Keyed state with timers: one alert for every silence of a run, and events that come out of order apart.

The state of a run is its latest event, whether a silence after it was told, and
whether the run has ended. A timer runs from the latest event on; when it
expires before another event comes, the silence is told once, as it happens. An
event that ends a longer silence which no timer told (both events came together)
tells it then. So a replayed log gives the rows of the batch operator
``stale_heartbeats``, and one more for each run that is silent now.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE = "last_us long, told boolean, ended boolean"


class Silences(StatefulProcessor):
    """Rows: the key, kind (silence, late), ts (of the event), gap_s (null while the silence lasts)."""

    def __init__(self, keys: list[str], max_age_s: float, late_s: float, done: str, arrival: bool):
        self.keys, self.max_age, self.late, self.done, self.arrival = keys, round(max_age_s * 1e6), round(late_s * 1e6), done, arrival

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", STATE)

    def close(self) -> None:
        pass

    def _rows(self, key: tuple, rows: list[tuple[str, int, float | None]]) -> pd.DataFrame:
        out = pd.DataFrame({k: [v] * len(rows) for k, v in zip(self.keys, key, strict=True)})
        return out.assign(kind=[r[0] for r in rows], ts=pd.to_datetime([r[1] for r in rows], unit="us"), gap_s=pd.Series([r[2] for r in rows], dtype="float64"))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        came = sorted((int(us), event) for pdf in rows for us, event in zip(pdf["us"], pdf["event"], strict=True))
        last, told, ended = self.state.get() if self.state.exists() else (None, False, False)
        known, found = last, []
        for us, event in came:
            if known is not None and us < known - self.late:
                found.append(("late", us, None))  # behind what an earlier batch has seen of this run
                continue
            if last is None or us >= last:
                if last is not None and not told and not ended and us - last > self.max_age:
                    found.append(("silence", last, (us - last) / 1e6))
                last, told, ended = us, False, event == self.done
        if last is not None and last != known:
            self.state.update((last, told, ended))
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            if not ended:
                start = timerValues.getCurrentProcessingTimeInMs() if self.arrival else last // 1000
                # never in the past: such a timer would expire unseen
                self.handle.registerTimer(max(start + self.max_age // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1 if not self.arrival else 0))
        if found:
            yield self._rows(key, found)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, told, ended = self.state.get()
        if not told and not ended:
            self.state.update((last, True, ended))
            yield self._rows(key, [("silence", last, None)])


def silences(events: DataFrame, keys: list[str], ts: str = "ts", event: str = "event", max_age_s: float = 90, late_s: float = 0, done: str = "stage_done", clock: str = "arrival", watermark: str = "0 seconds") -> DataFrame:
    """Alerts of a stream: the keys, kind, ts, gap_s.

    kind ``silence``: nothing came after the event at ``ts`` for longer than
    ``max_age_s``, told once, with the gap if its end came along. After ``done``
    a run may be silent. kind ``late``: an event more than ``late_s`` behind the
    latest that earlier batches had of its run; it changes nothing and isn't
    lost. ``clock='arrival'`` measures silences since the latest event came, by
    the cluster's clock; ``'event'`` by the stream's watermark, for replays:
    events behind the watermark never get here, so route them by ``'arrival'``.
    """
    arrival = clock == "arrival"
    source = events if arrival else events.withWatermark(ts, watermark)
    rows = source.select(*keys, ts, F.unix_micros(F.col(ts)).alias("us"), F.col(event).alias("event")).where(F.col("us").isNotNull())
    kinds = dict(events.dtypes)
    ddl = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "kind string, ts timestamp, gap_s double"])
    return rows.groupBy(*keys).transformWithStateInPandas(Silences(keys, max_age_s, late_s, done, arrival), ddl, "Append", "ProcessingTime" if arrival else "EventTime")
