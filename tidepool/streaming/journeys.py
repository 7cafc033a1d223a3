"""Stateful processing of the user's own (X13): from a first event to its answer.

For each key the first ``start`` event opens a journey; the next ``goal`` event
within ``horizon`` closes it as reached, otherwise it ends, unanswered, ``horizon``
after it began, and a later start opens the next one. The open journey is the
only state of a key; a timer in event time flushes the one that no later event of
the key comes to close, and the state goes with it, so the state store holds open
journeys only, never a key's history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "key long, started timestamp, ended timestamp, reached boolean"
EPOCH = dt.datetime(1970, 1, 1)


def _micros(t) -> int:
    t = pd.Timestamp(t)
    return (t.tz_convert("UTC").tz_localize(None) if t.tzinfo else t).value // 1000


def step(opened: int | None, at: int, start: bool, goal: bool, horizon: int) -> tuple[list[tuple[int, int, bool]], int | None]:
    """(journeys that this event ends, the open one after it); times in microseconds."""
    out = []
    if opened is not None and at > opened + horizon:
        out.append((opened, opened + horizon, False))
        opened = None
    if opened is not None and goal:
        out.append((opened, at, True))
        opened = None
    elif opened is None and start:
        opened = at
    return out, opened


class Journeys(StatefulProcessor):
    def __init__(self, start: str, goal: str, horizon: int):
        self.start, self.goal, self.horizon = start, goal, horizon

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "at long")

    def _frame(self, key, ended: list[tuple[int, int, bool]]) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]] * len(ended),
                             "started": pd.to_datetime([e[0] for e in ended], unit="us"),
                             "ended": pd.to_datetime([e[1] for e in ended], unit="us"),
                             "reached": [e[2] for e in ended]})

    def _timer(self, opened: int) -> int:
        # the first whole millisecond after the last moment a goal still counts
        return (opened + self.horizon) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.state.get()[0] if self.state.exists() else None
        opened, ended = before, []
        events = pd.concat(list(rows)).sort_values(["ts", "event_id"], kind="stable")  # one key's rows of one micro-batch
        for at, kind in zip(events["ts"], events["kind"]):
            out, opened = step(opened, _micros(at), kind == self.start, kind == self.goal, self.horizon)
            ended += out
        if before is not None and before != opened:
            self.handle.deleteTimer(self._timer(before))
        if opened is None:
            self.state.clear()
        elif opened != before:
            self.state.update((opened,))
            self.handle.registerTimer(self._timer(opened))
        if ended:
            yield self._frame(key, ended)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            opened = self.state.get()[0]
            if self._timer(opened) <= expiredTimerInfo.getExpiryTimeInMs():
                self.state.clear()
                yield self._frame(key, [(opened, opened + self.horizon, False)])

    def close(self) -> None:
        pass


def journeys(events: DataFrame, key: str, ts_col: str, kind_col: str, id_col: str, start: str, goal: str,
             horizon: dt.timedelta, watermark: str = "10 minutes") -> DataFrame:
    """key, started, ended, reached of every journey that has ended. Events that
    share a time are taken in the order of ``id_col``; null keys and times are left
    out. A micro-batch's events of one key are ordered in one task, so size the
    trigger (``maxFilesPerTrigger``) to the hottest key."""
    named = (events.where(F.col(key).isNotNull() & F.col(ts_col).isNotNull())
             .select(F.col(key).cast("long").alias("key"), F.col(ts_col).cast("timestamp").alias("ts"),
                     F.col(kind_col).alias("kind"), F.col(id_col).cast("long").alias("event_id"))
             .withWatermark("ts", watermark))
    return named.groupBy("key").transformWithStateInPandas(
        Journeys(start, goal, int(horizon.total_seconds() * 1_000_000)), OUTPUT, "Append", "EventTime")
