"""Velocity and change features on a stream, exact up to the watermark.

Rows of a user wait in state until the watermark has passed them. A timer at the end of the earliest row's bucket
of time lets all rows before the watermark leave at once, in order of time; so late rows within the delay change nothing
in the result, a batch only appends, and a user costs a few calls to the state per bucket of a stream that runs, or in all where the
source is read at once. The trailing window is a running count with a head that moves on: every row enters and leaves it once.
Of the window stays what rows after the watermark may need; a second timer clears it for a user who stays away. What stays of
such a user is one row (last time, location and device), which later features need; ``forget`` puts an end to that too.

State lies on disk (RocksDB), which this operator sets for the session. Equal times share an entry.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

OUTPUT = (
    "user_id string, tx_id long, timestamp timestamp, tx_velocity_24h long, time_since_last_tx double, "
    "location_changed int, device_changed int"
)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HOUR = 3_600_000_000
#: Rows in a value of the state.
_PART = 10_000


def _known(v):
    return None if v is None or v != v else v


def _columns(rows: list[tuple]) -> tuple:
    return tuple(map(list, zip(*rows)))


def _differs(before, now) -> int:
    return int(before is None or now is None or before != now)


class SequenceProcessor(StatefulProcessor):
    """``width`` of the window and of a bucket, and after how long without rows a user is forgotten, in microseconds."""

    def __init__(self, width: int, forget: int | None):
        self.width, self.forget = width, forget

    def init(self, handle) -> None:
        self.handle = handle
        #: A value for each part of a batch.
        self.waiting = handle.getListState("waiting", "t array<long>, id array<long>, location array<string>, device array<string>")
        #: Last row; times of the window and their numbers of rows.
        self.last = handle.getValueState("last", "t long, location string, device string, at array<long>, n array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark, first = timerValues.getCurrentWatermarkInMs() * 1000, None
        for part in rows:
            if not len(part):  # comes without columns
                continue
            ids, places, devices = ([_known(v) for v in part[c].tolist()] for c in ("tx_id", "location", "device"))
            new = [
                (t, None if i is None else int(i), where, what)
                for t, i, where, what in zip(part["micros"].tolist(), ids, places, devices) if t >= mark]
            if new:
                self.waiting.appendValue(_columns(new))
                first = min(r[0] for r in new) if first is None else min(first, *(r[0] for r in new))
        if first is not None:
            self._wake(first)
        yield from ()

    def _wake(self, t: int) -> None:
        """A timer at the end of the bucket of time ``t``."""
        self.handle.registerTimer((t // self.width + 1) * self.width // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        rows = [r for part in self.waiting.get() for r in zip(*part)]
        due, later = [r for r in rows if r[0] < mark], [r for r in rows if r[0] >= mark]
        if not due and not self.last.exists():
            return
        last, where, what, at, n = self.last.get() if self.last.exists() else (None, None, None, [], [])
        held = len(at)
        if due:
            due.sort(key=lambda r: (r[0], r[1] is not None, r[1]))
            out, last, where, what, at, n = self._released(due, last, where, what, list(at), list(n))
            yield out.assign(user_id=key[0])[_NAMES]
            if later:
                self.waiting.put([_columns(later[a:a + _PART]) for a in range(0, len(later), _PART)])
                self._wake(min(r[0] for r in later))
            else:
                self.waiting.clear()
        kept = bisect_left(at, mark - self.width)  # rows to come are not before the watermark
        at, n = list(at[kept:]), list(n[kept:])
        if not at and self.forget is not None and mark - last >= self.forget:
            self.last.clear()
        elif due or len(at) != held:
            self.last.update((last, where, what, at, n))
            if due and at:
                self.handle.registerTimer((last + self.width) // 1000 + 1)
            if due and self.forget is not None:
                self.handle.registerTimer((last + max(self.forget, self.width)) // 1000 + 1)

    def _released(self, rows, last, where, what, at, n):
        """Features of sorted rows, and what the next ones need."""
        out, head, inside, k = [], 0, sum(n), 0
        while k < len(rows):
            t = rows[k][0]
            same = k
            while same < len(rows) and rows[same][0] == t:
                same += 1
            while head < len(at) and at[head] < t - self.width:  # the head moves to the first time inside the window
                inside, head = inside - n[head], head + 1
            if self.forget is not None and last is not None and t - last >= self.forget:
                last = where = what = None
            for _, i, location, device in rows[k:same]:
                out.append((i, t, inside, 0.0 if last is None else (t - last) / _HOUR, _differs(where, location), _differs(what, device)))
                last, where, what = t, location, device
            at.append(t)
            n.append(same - k)
            inside, k = inside + same - k, same
        out = pd.DataFrame(out, columns=_NAMES[1:]).astype({"tx_id": "Int64"})
        out["timestamp"] = pd.Series(out["timestamp"].to_numpy(np.int64).view("datetime64[us]")).dt.tz_localize("UTC")
        return out, last, where, what, at[head:], n[head:]

    def close(self) -> None:
        pass


_NAMES = [c.split()[0] for c in OUTPUT.split(", ")]


def stream_sequence(rows: DataFrame, hours: int = 24, delay: str = "1 day", forget_hours: int | None = None) -> DataFrame:
    """Needs ``user_id``, ``tx_id``, ``timestamp``, ``location`` and ``device``; rows later than ``delay`` are dropped."""
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = rows.filter(F.col("user_id").isNotNull() & F.col("timestamp").isNotNull()).withWatermark(
        "timestamp", delay)
    keyed = timed.select(
        "user_id", F.col("tx_id").cast("long").cast("string").alias("tx_id"), "timestamp", "location", "device",
        F.unix_micros("timestamp").alias("micros"))
    forget = None if forget_hours is None else forget_hours * _HOUR
    return keyed.groupBy("user_id").transformWithStateInPandas(
        SequenceProcessor(hours * _HOUR, forget), OUTPUT, "append", "EventTime")
