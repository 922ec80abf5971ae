"""Operators over score columns, one column per detection method."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import DEFAULTS, ScaleLimits
from ..functions.bands import risk_band_user
from ..functions.numbers import clip01, mean, ratio, rounded
from .skew import quantiles

METHODS = ["isolation_forest", "one_class_svm", "lof", "dbscan", "hdbscan"]


def score_column(method: str) -> str:
    return f"{method}_score"


def present_methods(df: DataFrame) -> list[str]:
    return [m for m in METHODS if score_column(m) in df.columns]


def minmax(df: DataFrame, columns: dict[str, str], source: DataFrame | None = None) -> DataFrame:
    """Scale ``{input: output}`` columns to [0, 1]; a column of equal values becomes 0.

    Missing values become 0. One aggregation gives all ranges.
    """
    source = df if source is None else source
    ranges = source.agg(*[
        F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in columns])
    return apply_ranges(df, columns, ranges)


def apply_ranges(df: DataFrame, columns: dict[str, str], ranges: DataFrame) -> DataFrame:
    """Scale with given ranges: one row with a struct ``(lo, hi)`` per input column."""
    row = ranges.select(F.struct(*ranges.columns)).scalar()
    r = lambda c, side: F.col(f"_ranges.{c}.{side}")
    return df.withColumn("_ranges", row).withColumns({
        out: F.coalesce(clip01(ratio(F.col(c) - r(c, "lo"), r(c, "hi") - r(c, "lo"))), F.lit(0.0))
        for c, out in columns.items()
    }).drop("_ranges")


def statistical_ensemble(
    df: DataFrame, weights: dict[str, float] | None = None, output: str = "statistical_score"
) -> DataFrame:
    """Weighted mean of the method scores; equal weights by default, absent methods count 0."""
    methods = present_methods(df)
    weights = dict.fromkeys(methods, 1.0) if weights is None else weights
    total = sum(weights.values())
    return df.withColumn(output, sum(
        (F.col(score_column(m)) * F.lit(weights.get(m, 0.0) / total) for m in methods), F.lit(0.0)))


def long_scores(df: DataFrame, methods: list[str], *keep: str) -> DataFrame:
    """One row per transaction and method."""
    return df.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(m).alias("method"), F.col(score_column(m)).alias("score")) for m in methods])))


def model_statistics(
    df: DataFrame, methods: list[str] | None = None, limits: ScaleLimits = DEFAULTS.limits
) -> DataFrame:
    """Per method: mean, population std, range, and counts above its own 90/95/99 % quantiles."""
    methods = present_methods(df) if methods is None else methods
    cut = {m: quantiles(df, score_column(m), [0.9, 0.95, 0.99], limits).select("q").scalar() for m in methods}
    marked = df.select(*[score_column(m) for m in methods], *[cut[m].alias(f"_q_{m}") for m in methods])
    above = lambda m, i: F.count_if(F.col(score_column(m)) > F.col(f"_q_{m}")[i])
    stats = marked.agg(*[
        F.struct(
            F.lit(m).alias("method"),
            F.avg(score_column(m)).alias("mean_score"),
            F.stddev_pop(score_column(m)).alias("std_score"),
            F.min(score_column(m)).alias("min_score"),
            F.max(score_column(m)).alias("max_score"),
            above(m, 0).alias("anomaly_count_10pct"),
            above(m, 1).alias("anomaly_count_5pct"),
            above(m, 2).alias("anomaly_count_1pct"),
        ).alias(m) for m in methods])
    return stats.select(F.inline(F.array(*methods)))


def method_comparison(df: DataFrame, methods: list[str] | None = None, threshold: float = 0.6) -> DataFrame:
    """Per method: mean, population std, maximum and count above the threshold."""
    methods = present_methods(df) if methods is None else methods
    stats = df.agg(*[
        F.struct(
            F.lit(m).alias("method"),
            F.avg(score_column(m)).alias("mean_score"),
            F.stddev_pop(score_column(m)).alias("std_score"),
            F.max(score_column(m)).alias("max_score"),
            F.count_if(F.col(score_column(m)) > threshold).alias("high_risk_count"),
        ).alias(m) for m in methods])
    return stats.select(F.inline(F.array(*methods)))


def modal_value(df: DataFrame, keys: list[str], column: str, name: str) -> DataFrame:
    """Most frequent value per key (the smallest of equally frequent ones), else ``Unknown``.

    Counts per (key, value) are formed first, so no task holds all values of a key.
    """
    counts = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min_by(column, F.when(F.col(column).isNotNull(), F.struct(-F.col("_n"), F.col(column))))
    return counts.groupBy(*keys).agg(F.coalesce(best, F.lit("Unknown")).alias(name))


def with_modes(stats: DataFrame, rows: DataFrame, keys: list[str], modes: dict[str, str]) -> DataFrame:
    for column, name in modes.items():
        stats = stats.join(modal_value(rows, keys, column, name), keys)
    return stats


def users_by_method(df: DataFrame, methods: list[str] | None = None) -> DataFrame:
    """Per method and user: mean, maximum and number of scores, with the user's main values."""
    methods = present_methods(df) if methods is None else methods
    r4 = lambda c: rounded(c, 4)
    known = df.filter(F.col("user_id").isNotNull())
    stats = known.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("tx_count"),
        r4(mean(F.col("amount"))).alias("avg_amount"),
        *[F.struct(
            F.lit(m).alias("method"),
            # Decimals add up the same in any order, so a mean halfway between two roundings does not depend on it.
            r4(F.avg(F.col(score_column(m)).cast("decimal(20,15)")).cast("double")).alias("mean_score"),
            r4(F.max(score_column(m))).alias("max_score"),
        ).alias(m) for m in methods])
    stats = with_modes(stats, known, ["user_id"], {"location": "main_location", "transaction_type": "main_type"})
    return stats.select(
        "user_id", "tx_count", "avg_amount", "main_location", "main_type", F.inline(F.array(*methods)))


def top_users_by_method(df: DataFrame, methods: list[str] | None = None, n: int = 5) -> DataFrame:
    """The ``n`` users with the highest mean score of each method, with their risk band."""
    w = Window.partitionBy("method").orderBy(F.col("mean_score").desc(), "user_id")
    ranked = users_by_method(df, methods).withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") <= n).withColumn("risk_level", risk_band_user(F.col("mean_score")))


def method_user_summary(df: DataFrame, methods: list[str] | None = None) -> DataFrame:
    """Per method: users analysed, users above 0.6 and 0.8, mean of means, highest score."""
    s = F.col("mean_score")
    return users_by_method(df, methods).groupBy("method").agg(
        F.count(F.lit(1)).alias("users"),
        F.count_if(s > 0.6).alias("high_risk_users"),
        F.count_if(s > 0.8).alias("critical_users"),
        mean(s).alias("avg_score"),
        F.max("max_score").alias("highest_score"),
    )


def cross_method_users(df: DataFrame, n: int = 5, methods: list[str] | None = None) -> DataFrame:
    """Top users by the plain mean over all methods."""
    methods = present_methods(df) if methods is None else methods
    combined = sum((F.col(score_column(m)) for m in methods), F.lit(0.0)) / len(methods)
    stats = df.filter(F.col("user_id").isNotNull()).withColumn("_s", combined).groupBy("user_id").agg(
        rounded(F.avg("_s"), 4).alias("mean_score"),
        rounded(F.max("_s"), 4).alias("max_score"),
        F.count("_s").alias("tx_count"),
    )
    top = stats.orderBy(F.col("mean_score").desc(), "user_id").limit(n)
    return top.withColumn("risk_level", risk_band_user(F.col("mean_score")))


def score_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of score columns, from one aggregation."""
    pairs = [(a, b) for a in columns for b in columns]
    row = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"`{i}`").alias("correlation"))
        for i, (a, b) in enumerate(pairs)])))
