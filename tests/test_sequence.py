import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.config import ScaleLimits
from tidewatch.operators import sequence, skew

SCHEMA = "tx_id long, user_id string, timestamp timestamp, amount double, location string, device string"


def sample(n=400, seed=1):
    """Half of the rows belong to one user, many with equal times; some values are missing."""
    rnd = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        user = "hot" if i % 2 else rnd.choice(["a", "b", "c", None])
        when = None if rnd.random() < 0.05 else start + timedelta(minutes=rnd.choice([0, 0, 0, 60]) + 30 * rnd.randrange(300))
        if user == "hot" and rnd.random() < 0.3:
            when = start + timedelta(days=2)
        rows.append((i, user, when, None if rnd.random() < 0.05 else round(rnd.uniform(1, 99), 2),
                     rnd.choice(["L", "M", None]), rnd.choice(["x", "y", None])))
    rows.append((n, "single", start, 5.0, "L", "x"))
    return rows


def expected(rows, hours=24):
    df = pd.DataFrame(rows, columns=["tx_id", "user_id", "timestamp", "amount", "location", "device"])
    out = {}
    for user, g in df[df["user_id"].notna()].groupby("user_id"):
        g = g.sort_values(["timestamp", "tx_id"], na_position="last")
        mean, std = g["amount"].mean(), g["amount"].std()
        prev = None
        items = list(g.itertuples())
        for i, r in enumerate(items):
            nxt = items[i + 1] if i + 1 < len(items) else None
            gap = lambda a, b: 0.0 if a is None or b is None or pd.isna(a.timestamp) or pd.isna(b.timestamp) else (
                b.timestamp - a.timestamp).total_seconds() / 3600
            v = 0 if pd.isna(r.timestamp) else int(((g["timestamp"] >= r.timestamp - timedelta(hours=hours)) & (
                g["timestamp"] < r.timestamp)).sum())
            diff = lambda x: int(prev is None or getattr(prev, x) is None or getattr(r, x) is None
                                 or getattr(prev, x) != getattr(r, x))
            z = None if pd.isna(r.amount) or pd.isna(std) else round((r.amount - mean) / max(std, 1e-8), 3)
            out[r.tx_id] = (round(gap(prev, r), 6), round(gap(r, nxt), 6), v, diff("location"), diff("device"), z)
            prev = r
    for r in df[df["user_id"].isna()].itertuples():
        out[r.tx_id] = (0.0, 0.0, None, 1, 1, None)
    return out


def actual(df):
    return {r["tx_id"]: (
        round(r["time_since_last_tx"], 6), round(r["time_until_next_tx"], 6), r["tx_velocity_24h"],
        r["location_changed"], r["device_changed"],
        None if r["amount_zscore_user"] is None else round(r["amount_zscore_user"], 3)) for r in df.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][:5] == b[k][:5], (k, a[k], b[k])
        assert (a[k][5] is None) == (b[k][5] is None) and (a[k][5] is None or abs(a[k][5] - b[k][5]) <= 0.0011)


@pytest.mark.parametrize("limits", [ScaleLimits(), ScaleLimits(rows_per_task=40)], ids=["ordinary", "split"])
def test_against_brute_force(spark, limits):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = sequence.sequence_features(df, 24, limits)
    assert out.count() == len(rows)
    close(actual(out), expected(rows))


def test_split_user_whose_times_are_all_equal(spark):
    rows = [(i, "u", datetime(2024, 1, 1), 1.0, "L", "x") for i in range(200)]
    rows += [(1000 + i, "u", datetime(2024, 1, 1, 12), 1.0, "M", "x") for i in range(100)]
    out = sequence.sequence_features(spark.createDataFrame(rows, SCHEMA), 24, ScaleLimits(rows_per_task=20))
    close(actual(out), expected(rows))


@pytest.mark.parametrize("limits", [ScaleLimits(), ScaleLimits(rows_per_task=40)], ids=["ordinary", "split"])
def test_recent_locations(spark, limits):
    rows = [r for r in sample(300, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["tx_id"]: r["recent_locations"] for r in sequence.distinct_locations_within(df, 24, limits=limits).collect()}
    for i, user, when, _, _, _ in rows:
        if user is None or when is None:
            assert got[i] == 0
        else:
            near = {r[4] for r in rows if r[1] == user and r[2] is not None and r[4] is not None
                    and when - timedelta(hours=24) <= r[2] <= when}
            assert got[i] == len(near)


def test_one_user_in_one_place(spark):
    """All rows under one key: no block above the ceiling, whatever the fair share, and the counts stay right."""
    rows = [(i, "u", datetime(2024, 1, 1) + timedelta(minutes=7 * i), 1.0, "L" if i % 50 else "M", "x") for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    limits = ScaleLimits(rows_per_task=10_000, most_rows=100)
    assert skew.fair_share(spark, 10**9, limits) == 100
    visits = df.select("user_id", "location", F.col("timestamp").alias("_t")).distinct()
    nxt = {(r[1], r[2]): r[3] for r in skew.next_in_order(visits, ["user_id", "location"], "_t", "n", limits).select(
        "user_id", "location", "_t", "n").collect()}
    for place in "LM":
        times = sorted(r[2] for r in rows if r[4] == place)
        assert [nxt[place, a] for a in times] == times[1:] + [None]
    pairs = visits.withColumn("_pair", F.xxhash64("user_id", "location"))
    hot, share = skew.hot_keys(pairs, "_pair", limits)
    assert len(hot) == 1
    points = skew.cut_points(pairs, "_pair", ["_t"], hot, share)
    blocks = skew.with_blocks(pairs, {k: skew.evenly(v, 2 * hot[k] // share + 1) for k, v in points.items()}, "_pair", ["_t"])
    assert max(r["count"] for r in blocks.groupBy("_block").count().collect()) <= 100
    got = {r["tx_id"]: r["recent_locations"] for r in sequence.distinct_locations_within(df, 3, limits=limits).collect()}
    for i, _, when, *_ in rows:
        assert got[i] == len({r[4] for r in rows if when - timedelta(hours=3) <= r[2] <= when})


def test_no_order_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "tx_id long, amount double")
    assert sequence.sequence_features(df).columns == ["tx_id", "amount"]


def test_plan_has_one_shuffle(spark):
    rows = spark.createDataFrame(sample(50), SCHEMA)
    plan = sequence.sequence_features(rows).select("tx_id", *sequence.SEQUENCE_COLUMNS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_unusual_hours(spark):
    rows = [(h, "u", datetime(2024, 1, 1, h), 1.0, "L", "x") for h in (0, 5, 6, 12, 22, 23)]
    out = {r["tx_id"]: (r["is_unusual_hour"], r["is_night_transaction"])
           for r in sequence.sequence_features(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {0: (1, 1), 5: (1, 1), 6: (0, 0), 12: (0, 0), 22: (0, 0), 23: (1, 0)}


def test_ordinary_users_are_sorted_once(spark):
    df = spark.createDataFrame(
        [(1, "u", "2024-01-01 00:00:00", 1.0)], "tx_id long, user_id string, timestamp string, amount double")
    plan = sequence.sequence_features(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") >= 3 and plan.count("Sort [") == 1
