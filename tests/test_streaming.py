import random
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators.parse import parse_logs, valid_rows
from tidewatch.operators.sequence import sequence_features
from tidewatch.streaming import run, score, sequence, windows


def folder(tmp_path, df, parts=3):
    """The rows as files that a stream picks up one by one, oldest first."""
    path = str(tmp_path / "in")
    for i in range(parts):
        df.filter(F.col("tx_id") % parts == i).coalesce(1).write.mode("append").parquet(path)
    return path


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    start = datetime(2024, 3, 1)
    lines = [(i, f"{start + timedelta(minutes=37 * i)}::user{i % 4}::{'refund' if i % 3 else 'debit'}::{i * 10}.0::London::Pixel 6")
             for i in range(60)]
    raw = spark.createDataFrame([*lines, (99, "MALFORMED_LOG"), (98, None), (97, "no time::user1::debit::5.0::London::Pixel 6")], "tx_id long, raw_log string")
    path = str(tmp_path / "profile")
    score.save_profile(valid_rows(parse_logs(raw)), path)
    profile = score.load_profile(spark, path)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(folder(tmp_path, raw))
    cols = ["tx_id", "user_id", "amount", "rule_score"]
    got = run.run_available(score.score_lines(stream, profile, delay="5 days").select(*cols), str(tmp_path / "out"))
    want = score.score_lines(raw, profile).select(*cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 61


def test_stream_sequence_equals_batch_up_to_the_watermark(spark, tmp_path):
    start = datetime(2024, 3, 1)
    rows = [(i, f"u{i % 2}", start + timedelta(minutes=20 * (i // 2)), "LM"[i // 5 % 2] if i % 7 else None, "xy"[i % 3 // 2])
            for i in range(300)]
    df = spark.createDataFrame(rows, "tx_id long, user_id string, timestamp timestamp, location string, device string")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder(tmp_path, df))
    got = {r["tx_id"]: r for r in run.run_available(
        sequence.stream_sequence(stream, 24, delay="60 hours"), str(tmp_path / "out")).collect()}
    last = max(r[2] for r in rows)
    assert set(got) >= {r[0] for r in rows if r[2] < last - timedelta(hours=60)}
    want = {r["tx_id"]: r for r in sequence_features(df).collect()}
    for i, r in got.items():
        for c in ("tx_velocity_24h", "location_changed", "device_changed"):
            assert r[c] == want[i][c], (i, c)
        assert r["time_since_last_tx"] == pytest.approx(want[i]["time_since_last_tx"])


def _random_rows(n, seed, users=3, hours=200):
    """Busy and idle users, equal times, nulls; in order of time up to a few hours."""
    draw = random.Random(seed)
    start = datetime(2024, 3, 1)
    rows = []
    for i in range(n):
        at = start + timedelta(minutes=10 * int(i * hours * 6 / n) + draw.choice([-150, -10, 0, 0, 10]))
        user = "idle" if draw.random() < 0.02 else f"u{draw.randrange(users)}"
        rows.append((i, user, at, draw.choice(["L", "M", None]), draw.choice(["x", "y"]), float(i)))
    return rows


ROWS = "tx_id long, user_id string, timestamp timestamp, location string, device string, amount double"


def _ordered(tmp_path, spark, rows, parts=6):
    """Files in order of arrival, as a stream of one file per batch."""
    path = str(tmp_path / "ordered")
    for i in range(parts):
        part = rows[len(rows) * i // parts:len(rows) * (i + 1) // parts]
        spark.createDataFrame(part, ROWS).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # the source takes files by their time
    return spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(path)


def test_finite_stream_gives_all_rows_without_a_batch(spark, tmp_path):
    rows = _random_rows(600, 1)
    stream = _ordered(tmp_path, spark, rows)
    got = {r["tx_id"]: r for r in run.run_finite(lambda t: sequence.stream_sequence(t, 24, delay="6 hours"), stream).collect()}
    assert set(got) == {r[0] for r in rows}
    for r in sequence_features(spark.createDataFrame(rows, ROWS)).collect():
        for c in ("tx_velocity_24h", "location_changed", "device_changed"):
            assert got[r["tx_id"]][c] == r[c], (r["tx_id"], c)
        assert got[r["tx_id"]]["time_since_last_tx"] == pytest.approx(r["time_since_last_tx"])


def test_forgotten_users_begin_anew(spark, tmp_path):
    start = datetime(2024, 3, 1)
    times = [0, 5, 30, 31, 400, 401]
    rows = [(i, "u", start + timedelta(hours=h), "L", "x", 1.0) for i, h in enumerate(times)]
    stream = _ordered(tmp_path, spark, rows, parts=3)
    out = run.run_finite(lambda t: sequence.stream_sequence(t, 24, delay="1 hour", forget_hours=200), stream).collect()
    since = {r["tx_id"]: (r["time_since_last_tx"], r["tx_velocity_24h"], r["location_changed"]) for r in out}
    assert since == {0: (0.0, 0, 1), 1: (5.0, 1, 0), 2: (25.0, 0, 0), 3: (1.0, 1, 0), 4: (0.0, 0, 1), 5: (1.0, 1, 0)}


def test_stream_sessions_merge_and_late_rows_go(spark, tmp_path):
    start = datetime(2024, 3, 1)
    at = lambda i, user, h, amount: (i, user, start + timedelta(hours=h), None, None, amount)
    rows = [at(0, "a", 0, 1.0), at(1, "a", 20, 2.0), at(2, "b", 30, 5.0),  # two sessions of a
            at(3, "a", 10, 4.0), at(4, None, 31, 7.0), at(5, "c", 100, 1.0),  # row 3 is late within the delay and joins them
            at(8, "c", 101, 1.0), at(9, "c", 102, 1.0),
            at(6, "a", 5, 100.0), at(7, "c", 104, 2.0)]  # row 6 comes after the watermark
    stream = _ordered(tmp_path, spark, rows, parts=5)  # late: the session it would open ended by the watermark of the batch before
    out = run.run_finite(lambda t: windows.session_counts(t, "12 hours", delay="1 day"), stream).collect()
    got = sorted((r["user_id"], (r["session_start"] - start) / timedelta(hours=1), r["n"], r["amount"]) for r in out)
    assert got == [("a", 0.0, 3, 7.0), ("b", 30.0, 1, 5.0), ("c", 100.0, 4, 5.0)]
    batch = windows.session_counts(spark.createDataFrame([r for r in rows if r[0] != 6], ROWS), "12 hours").collect()
    assert sorted((r["user_id"], r["n"], r["amount"]) for r in batch) == [(u, n, a) for u, _, n, a in got]


class _Held:
    """State of one user in memory: a value, a list or a map; every call counts."""

    def __init__(self, handle):
        self.handle, self.items = handle, {}

    def __getattr__(self, name):
        items = self.items

        def call(*args):
            self.handle.calls += 1
            return {
                "exists": lambda: bool(items), "clear": items.clear, "keys": lambda: list(items), "removeKey": lambda k: items.pop(k),
                "get": lambda: list(items.values()) if self.handle.lists is self else items[0], "update": lambda v: items.update({0: v}),
                "appendValue": lambda v: items.update({len(items): v}), "put": lambda vs: (items.clear(), items.update(enumerate(vs))),
                "containsKey": lambda k: k in items, "getValue": lambda k: items[k], "updateValue": lambda k, v: items.update({k: v}),
            }[name](*args)
        return call


class _Handle:
    def __init__(self):
        self.calls, self.lists, self.timers = 0, None, set()

    def getListState(self, *_):
        self.lists = _Held(self)
        return self.lists

    def getValueState(self, *_):
        return _Held(self)

    getMapState = getValueState

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)


class _At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_a_source_read_at_once_costs_a_user_a_few_state_calls():
    day, hour = 24 * sequence._HOUR, sequence._HOUR
    times = [d * day + h * hour for d in range(19_000, 19_200) for h in (1, 5, 23)]
    part = pd.DataFrame({"tx_id": [str(i) for i in range(len(times))], "micros": times, "location": "L", "device": None})
    user, handle = sequence.SequenceProcessor(day, None), _Handle()
    user.init(handle)
    out = list(user.handleInputRows(("u",), iter([part.sample(frac=1, random_state=1)]), _At(0)))
    end = 20_000 * day // 1000
    while handle.timers:
        ms = min(handle.timers)
        handle.timers.remove(ms)
        out += user.handleExpiredTimer(("u",), _At(end), _At(ms))
    assert handle.calls <= 12  # 4598, when every day had its own entry and timer
    got = pd.concat(out, ignore_index=True)
    assert got["tx_id"].tolist() == list(range(600)) and got["tx_velocity_24h"].tolist() == [0, 1, 2] + [3] * 597
    assert got["timestamp"].dt.tz is not None and got["timestamp"].iloc[0] == pd.Timestamp(times[0], unit="us", tz="UTC")
