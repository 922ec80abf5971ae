"""Behaviour profile of each user, and its join back to the transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import mean, micros, ratio, rounded, total

PROFILE_COLUMNS = [
    "user_tx_count", "user_avg_amount", "user_std_amount", "user_min_amount", "user_max_amount",
    "user_total_amount", "user_first_tx_time", "user_last_tx_time", "user_unique_locations",
    "user_unique_devices", "user_unique_types", "user_unique_currencies", "user_activity_days",
    "user_tx_per_day", "user_amount_cv", "user_location_diversity", "user_device_diversity",
]
_DAY = 24 * 3600 * 1_000_000


def user_profile(df: DataFrame) -> DataFrame:
    """One row per known user, from one aggregation. Missing inputs give constant columns."""
    have = set(df.columns)
    amount = F.col("amount")
    r4 = lambda c: rounded(c, 4)
    if "amount" in have:
        aggs = [
            F.count("amount").alias("user_tx_count"),
            r4(mean(amount)).alias("user_avg_amount"),
            r4(F.stddev_samp("amount")).alias("user_std_amount"),
            r4(F.min("amount")).alias("user_min_amount"),
            r4(F.max("amount")).alias("user_max_amount"),
            r4(total(amount)).alias("user_total_amount"),
        ]
    else:
        aggs = [F.count(F.lit(1)).alias("user_tx_count")] + [
            F.max(F.lit(0.0)).alias(f"user_{s}_amount") for s in ("avg", "std", "min", "max", "total")]
    ts = F.col("timestamp").cast("timestamp") if "timestamp" in have else F.current_timestamp()
    aggs += [F.min(ts).alias("user_first_tx_time"), F.max(ts).alias("user_last_tx_time")]
    for col, name in (
        ("location", "locations"), ("device", "devices"), ("transaction_type", "types"), ("currency", "currencies"),
    ):
        aggs.append(
            (F.count_distinct(col) if col in have else F.max(F.lit(0)).cast("long")).alias(f"user_unique_{name}"))
    stats = df.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(*aggs)
    span = (micros(F.col("user_last_tx_time")) - micros(F.col("user_first_tx_time"))) / F.lit(float(_DAY))
    count = F.col("user_tx_count")
    stats = stats.withColumn("user_activity_days", span).withColumns({
        "user_tx_per_day": r4(ratio(count, F.col("user_activity_days") + 1)),
        "user_amount_cv": r4(F.coalesce(ratio(F.col("user_std_amount"), F.col("user_avg_amount")), F.lit(0.0))),
        "user_location_diversity": r4(ratio(F.col("user_unique_locations"), count)),
        "user_device_diversity": r4(ratio(F.col("user_unique_devices"), count)),
    })
    numeric = [c for c in PROFILE_COLUMNS if not c.endswith("_time")]
    return stats.fillna(0, subset=numeric).select("user_id", *PROFILE_COLUMNS)


def user_features(df: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Add the profile of each row's user; rows without a user (or profile) get nulls."""
    if "user_id" not in df.columns:
        return df
    return df.join(user_profile(df) if profile is None else profile, "user_id", "left")


def user_statistics(df: DataFrame) -> DataFrame:
    """Per-user activity table, rounded to pennies."""
    r2 = lambda c: rounded(c, 2)
    amount = F.col("amount")
    return df.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        F.count("amount").alias("tx_count"),
        r2(mean(amount)).alias("avg_amount"),
        r2(F.stddev_samp("amount")).alias("std_amount"),
        r2(F.min("amount")).alias("min_amount"),
        r2(F.max("amount")).alias("max_amount"),
        r2(total(amount)).alias("total_amount"),
        F.count_distinct("location").alias("unique_locations"),
        F.count_distinct("device").alias("unique_devices"),
        F.count_distinct("transaction_type").alias("unique_types"),
    )


def most_active_users(df: DataFrame, n: int = 10) -> DataFrame:
    return user_statistics(df).orderBy(F.col("tx_count").desc(), "user_id").limit(n)
