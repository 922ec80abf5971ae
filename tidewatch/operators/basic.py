"""Per-row features of a parsed transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULTS, DEVICE_BRANDS, TRANSACTION_GROUPS, ScaleLimits
from ..functions.numbers import ratio, rounded
from .skew import distinct_estimate, quantiles, value_counts

AMOUNT_PROBS = [0.25, 0.5, 0.75, 0.8, 0.95]


def amount_statistics(
    df: DataFrame, limits: ScaleLimits = DEFAULTS.limits, probs=None, distinct: int | None = None
) -> DataFrame:
    """One row: quantiles ``q``, ``mean`` and ``std`` (n - 1) of the amounts.

    Everything comes from the counts per distinct amount, so the table is
    aggregated once and only distinct amounts are moved.
    """
    probs = AMOUNT_PROBS if probs is None else probs
    v, n = F.col("amount"), F.col("n")
    counts = value_counts(df, "amount")
    rows = F.sum("n")
    mean = ratio(F.sum(v * n), rows)
    # Squares of distances from the mean: sums of squares would cancel for large, close amounts.
    off = v - counts.agg(mean).scalar()
    spread = [mean.alias("mean"), F.sqrt(ratio(F.sum(off * off * n), rows - 1)).alias("std")]
    distinct = distinct_estimate(df, v) if distinct is None else distinct
    if distinct <= limits.quantile_values:
        return counts.agg(F.percentile("amount", F.array(*map(F.lit, probs)), n).alias("q"), *spread)
    one = F.lit(1).alias("one")
    q = quantiles(df, "amount", probs, limits, distinct).select(one, "q")
    return q.join(counts.agg(*spread).select(one, "mean", "std"), "one").drop("one")


def statistics_column(stats: DataFrame) -> Column:
    """The one row as a struct-valued scalar subquery: no join, no collected value."""
    return stats.select(F.struct(*stats.columns)).scalar()


def hour_category(hour: Column) -> Column:
    return (
        F.when(hour <= 6, "night").when(hour <= 12, "morning").when(hour <= 18, "afternoon")
        .when(hour <= 24, "evening")
    )


def amount_category(amount: Column, q: Column) -> Column:
    """Quarter of the distribution; equal edges merge their classes, negatives have none."""
    return (
        F.when(amount < 0, F.lit(None).cast("string"))
        .when(amount <= q[0], "low").when(amount <= q[1], "medium")
        .when(amount <= q[2], "high").when(amount.isNotNull(), "very_high")
    )


def transaction_group(kind: Column) -> Column:
    out = None
    for name, kinds in TRANSACTION_GROUPS.items():
        cond = kind.isin(*kinds)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise("other")


def time_features(df: DataFrame) -> DataFrame:
    ts = F.col("timestamp").cast("timestamp")
    day = F.weekday(ts)
    return df.withColumns({
        "hour": F.hour(ts),
        "day_of_week": day,
        "is_weekend": F.coalesce(day.isin(5, 6), F.lit(False)),
        "month": F.month(ts),
        "day_of_month": F.dayofmonth(ts),
        "hour_category": hour_category(F.hour(ts)),
    })


def basic_features(
    df: DataFrame, stats: DataFrame | None = None, limits: ScaleLimits = DEFAULTS.limits
) -> DataFrame:
    """Calendar, amount, presence, filled and grouped columns, as far as their inputs exist.

    ``stats`` (see :func:`amount_statistics`) may come from a saved profile; by
    default the quantiles are those of ``df`` itself.
    """
    have = set(df.columns)
    out = time_features(df) if "timestamp" in have else df
    new: dict[str, Column] = {}
    if "amount" in have:
        stats = amount_statistics(df, limits) if stats is None else stats
        amount = F.col("amount")
        new |= {
            "amount_log": F.log1p(amount),
            "amount_rounded": rounded(amount, -1),
            "amount_category": amount_category(amount, stats.select("q").scalar()),
        }
    for col in ("currency", "location", "device"):
        if col in have:
            new[f"has_{col}"] = F.col(col).isNotNull()
            new[f"{col}_filled"] = F.coalesce(F.col(col), F.lit("unknown"))
    if "device" in have:
        brands = F.create_map(*[F.lit(x) for kv in DEVICE_BRANDS.items() for x in kv])
        new["device_brand"] = F.try_element_at(brands, new["device_filled"])
    if "transaction_type" in have:
        kind = F.coalesce(F.col("transaction_type"), F.lit("unknown"))
        new |= {"transaction_type_filled": kind, "transaction_group": transaction_group(kind)}
    return out.withColumns(new)
