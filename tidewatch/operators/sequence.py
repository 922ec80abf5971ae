"""Features that depend on the order of a user's transactions.

Ordinary users: one shuffle by user; every feature comes from windows over it.
The trailing-window count is a sweep: each transaction adds one when it happens
and takes one away when it leaves the window, and a running sum gives the count.
Its cost does not grow with the number of transactions inside the window.

A user (or the missing user) holding more rows than one task should take is cut
into blocks of consecutive transactions. Blocks are computed apart; the few rows
at their edges and one total per block carry state from block to block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import DEFAULTS, ScaleLimits
from ..functions.numbers import flag_int, micros, rounded
from .skew import cut_points, evenly, hot_keys, next_in_order, running_total, with_blocks

_HOUR = 3600 * 1_000_000
_LAST = 2**63 - 1
SEQUENCE_COLUMNS = [
    "time_since_last_tx", "time_until_next_tx", "tx_velocity_24h", "location_changed",
    "device_changed", "amount_zscore_user", "is_unusual_hour", "is_night_transaction",
]


def _hours(later: Column, earlier: Column) -> Column:
    return F.coalesce((later - earlier) / F.lit(float(_HOUR)), F.lit(0.0))


def _zscore(amount: Column, avg: Column, std: Column) -> Column:
    """Null when the user's spread is unknown (fewer than two amounts)."""
    return F.when(std.isNotNull(), rounded((amount - avg) / F.greatest(std, F.lit(1e-8)), 4))


def _changed(previous: Column, current: Column) -> Column:
    """A null on either side counts as a change, also null after null."""
    return F.coalesce(previous != current, F.lit(True)).cast("int")


def _ensure_columns(df: DataFrame) -> DataFrame:
    for name, kind in (("location", "string"), ("device", "string"), ("amount", "double")):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def _ordinary(df: DataFrame, hours: int) -> DataFrame:
    t = F.col("_t")
    sweep = F.when(F.col("user_id").isNotNull() & t.isNotNull(), F.array(F.lit(1), F.lit(-1))).otherwise(
        F.array(F.lit(1)))
    own = F.col("_step") == 1
    keep = [c for c in df.columns if c not in ("user_id", "_t", "tx_id")]
    # The row that leaves is a few numbers; what the transaction carries goes with the row that enters.
    marks = df.select("user_id", "_t", "tx_id", F.struct(*keep).alias("_row"), F.explode(sweep).alias("_step")).select(
        "user_id",
        F.when(own, t).otherwise(t + F.lit(hours * _HOUR)).alias("_t"),
        "_step",
        *[F.when(own, F.col(c)).alias(c) for c in ("tx_id", "_row")],
    )
    # Sorted once in the order that all windows below need; each would sort the rows again for itself.
    marks = marks.repartition("user_id").sortWithinPartitions("user_id", t.asc_nulls_last(), "tx_id")
    running = Window.partitionBy("user_id").orderBy(t.asc_nulls_last()).rangeBetween(Window.unboundedPreceding, -1)
    counted = marks.withColumn("_inside", F.sum("_step").over(running)).filter(own).select(
        "user_id", "_t", "tx_id", "_row.*", "_step", "_inside")
    user = Window.partitionBy("user_id")
    seq = user.orderBy(t.asc_nulls_last(), "tx_id")
    known = F.col("user_id").isNotNull()
    prev = lambda c: F.when(known, F.lag(c).over(seq))
    return counted.withColumns({
        "time_since_last_tx": _hours(t, prev("_t")),
        "time_until_next_tx": _hours(F.when(known, F.lead("_t").over(seq)), t),
        "tx_velocity_24h": F.when(
            known, F.when(t.isNull(), F.lit(0)).otherwise(F.coalesce(F.col("_inside"), F.lit(0)))).cast("long"),
        "location_changed": _changed(prev("location"), F.col("location")),
        "device_changed": _changed(prev("device"), F.col("device")),
        "amount_zscore_user": F.when(known, _zscore(
            F.col("amount"), F.avg("amount").over(user), F.stddev_samp("amount").over(user))),
    }).drop("_step", "_inside")


def _unknown_user(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "time_since_last_tx": F.lit(0.0),
        "time_until_next_tx": F.lit(0.0),
        "tx_velocity_24h": F.lit(None).cast("long"),
        "location_changed": F.lit(1),
        "device_changed": F.lit(1),
        "amount_zscore_user": F.lit(None).cast("double"),
    })


def _hot(df: DataFrame, hot: dict, share: int, hours: int, limits: ScaleLimits) -> DataFrame:
    """The same features for users that are too big for one task."""
    df = df.withColumn("_o", F.coalesce(F.col("_t"), F.lit(_LAST)))
    sample = cut_points(df, "user_id", ["_o", "tx_id"], hot, share)
    pieces = {k: math.ceil(2 * n / share) for k, n in hot.items()}
    rows = with_blocks(
        df, {k: evenly(v, pieces[k]) for k, v in sample.items()}, "user_id", ["_o", "tx_id"])
    block = Window.partitionBy("user_id", "_block").orderBy("_o", "tx_id")
    order = F.struct("_o", "tx_id")
    state = F.struct("_t", "location", "device")
    edges = rows.groupBy("user_id", "_block").agg(
        F.max_by(state, order).alias("_final"), F.min_by(F.struct("_t"), order).alias("_initial"))
    blocks = Window.partitionBy("user_id").orderBy("_block")
    edges = edges.select(
        "user_id", "_block",
        F.lag("_final").over(blocks).alias("_before"), F.lead("_initial").over(blocks).alias("_after"))
    prev = F.coalesce(F.lag(state).over(block), F.col("_before"))
    nxt = F.coalesce(F.lead(F.struct("_t")).over(block), F.col("_after"))
    spread = df.groupBy("user_id").agg(F.avg("amount").alias("_avg"), F.stddev_samp("amount").alias("_std"))
    return (
        rows.join(F.broadcast(edges), ["user_id", "_block"])
        .join(F.broadcast(spread), "user_id")
        .withColumn("_prev", prev).withColumn("_next", nxt)
        .join(_hot_velocity(df, hours, limits), ["user_id", "_t"], "left")
        .withColumns({
            "time_since_last_tx": _hours(F.col("_t"), F.col("_prev._t")),
            "time_until_next_tx": _hours(F.col("_next._t"), F.col("_t")),
            "tx_velocity_24h": F.coalesce(F.col("_velocity"), F.lit(0)).cast("long"),
            "location_changed": _changed(F.col("_prev.location"), F.col("location")),
            "device_changed": _changed(F.col("_prev.device"), F.col("device")),
            "amount_zscore_user": _zscore(F.col("amount"), F.col("_avg"), F.col("_std")),
        })
        .drop("_o", "_block", "_before", "_after", "_avg", "_std", "_prev", "_next", "_velocity")
    )


def _hot_velocity(df: DataFrame, hours: int, limits: ScaleLimits) -> DataFrame:
    """Trailing count per (user, time): steps are summed per distinct time before any block forms."""
    t = F.col("_t")
    steps = df.filter(t.isNotNull()).select("user_id", F.inline(F.array(
        F.struct(t.alias("_t"), F.lit(1).alias("_step")),
        F.struct((t + F.lit(hours * _HOUR)).alias("_t"), F.lit(-1).alias("_step")),
    ))).groupBy("user_id", "_t").agg(F.sum("_step").alias("_step"), F.max("_step").alias("_kind"))
    counted = running_total(steps, "user_id", "_t", "_step", limits, inclusive=False)
    return counted.filter(F.col("_kind") == 1).select("user_id", "_t", F.col("_sum").alias("_velocity"))


def sequence_features(
    df: DataFrame, hours: int = DEFAULTS.velocity_window_hours, limits: ScaleLimits = DEFAULTS.limits
) -> DataFrame:
    """Gaps, changes, velocity and deviation relative to the user's own history.

    Needs ``tx_id`` (ties in time are ordered by it), ``user_id``, ``timestamp``.
    """
    if "timestamp" not in df.columns or "user_id" not in df.columns:
        return df
    given = df.columns
    base = _ensure_columns(df).withColumn("_t", micros(F.col("timestamp")))
    hot, share = hot_keys(df, "user_id", limits)
    if not hot:
        out = _ordinary(base, hours)
    else:
        user = F.col("user_id")
        big = {k: n for k, n in hot.items() if k is not None}
        is_big = F.coalesce(user.isin(*big), F.lit(False)) if big else F.lit(False)
        rest = base.filter(~is_big & user.isNotNull())
        out = _ordinary(rest, hours).unionByName(_unknown_user(base.filter(user.isNull())))
        if big:
            out = out.unionByName(_hot(base.filter(is_big), big, share, hours, limits))
    out = out.drop("_t")
    hour = F.col("hour") if "hour" in given else F.hour(F.col("timestamp").cast("timestamp"))
    extra = [] if "hour" in given else ["hour"]
    out = out.withColumns({
        "hour": hour,
        "is_unusual_hour": flag_int((hour < 6) | (hour > 22)),
        "is_night_transaction": flag_int((hour >= 0) & (hour < 6)),
    })
    return out.select(*given, *extra, *SEQUENCE_COLUMNS)


def trailing_count(df: DataFrame, hours: int, name: str, limits: ScaleLimits = DEFAULTS.limits) -> DataFrame:
    """Only the velocity, over a window of another length."""
    slim = df.select("tx_id", "user_id", "timestamp")
    return sequence_features(slim, hours, limits).select(
        "tx_id", "user_id", "timestamp", F.col("tx_velocity_24h").alias(name))


def distinct_locations_within(
    df: DataFrame, hours: int, name: str = "recent_locations", limits: ScaleLimits = DEFAULTS.limits
) -> DataFrame:
    """Distinct locations of the user in the trailing ``hours``, the transaction included.

    Each visit keeps its location open until the next visit to it or until it leaves
    the window, so a running sum of openings and closings counts the open locations.
    Both the visits of a hot user to one place and a hot user's sum are cut into blocks.
    """
    width = hours * _HOUR
    t = F.col("_t")
    rows = df.withColumn("_t", micros(F.col("timestamp")))
    timed = rows.filter(F.col("user_id").isNotNull() & t.isNotNull())
    visits = timed.filter(F.col("location").isNotNull()).select("user_id", "location", "_t").distinct()
    followed = next_in_order(visits, ["user_id", "location"], "_t", "_next", limits)
    close = F.least(F.coalesce("_next", t + width + 1), t + width + 1)
    steps = followed.withColumn("_close", close).select("user_id", F.inline(F.array(
        F.struct(t.alias("_t"), F.lit(1).alias("_step")),
        F.struct(F.col("_close").alias("_t"), F.lit(-1).alias("_step")))))
    points = timed.select("user_id", "_t", F.lit(0).alias("_step")).unionByName(steps).groupBy("user_id", "_t").agg(
        F.sum("_step").alias("_step"))
    counted = running_total(points, "user_id", "_t", "_step", limits, inclusive=True).select("user_id", "_t", "_sum")
    return rows.join(counted, ["user_id", "_t"], "left").withColumn(
        name, F.coalesce(F.col("_sum"), F.lit(0)).cast("long")).drop("_t", "_sum")
