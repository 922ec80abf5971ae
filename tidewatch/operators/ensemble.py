"""The weighted ensemble of rule and detector scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULTS, EnsembleWeights, ScaleLimits
from ..functions.bands import risk_band_top
from ..functions.numbers import clip01, ratio
from .rules import RuleSet
from .scoring import present_methods, score_column
from .skew import quantiles

# Features each rule reads, for the estimated importance.
RULE_FEATURES = {
    "large_amount": ["amount", "amount_log", "amount_category"],
    "unusual_hours": ["hour", "is_unusual_hour", "is_night_transaction"],
    "high_velocity": ["tx_velocity_24h", "user_tx_count"],
    "unusual_location": ["location_rarity", "location_risk_score"],
    "device_change": ["device_changed", "user_device_diversity"],
    "amount_deviation": ["amount_zscore_user", "user_amount_cv"],
    "weekend_activity": ["is_weekend", "amount"],
    "rare_transaction_type": ["type_rarity", "transaction_type"],
    "multiple_locations": ["user_unique_locations", "location_diversity"],
    "round_amounts": ["amount", "amount_rounded"],
}


def method_weight(method: str, w: EnsembleWeights) -> float:
    """Weight of a method in explanations (the last two do not enter the score)."""
    return {
        "isolation_forest": w.isolation_weight,
        "lof": w.autoencoder_weight,
        "dbscan": w.clustering_weight,
        "hdbscan": w.clustering_weight * 0.5,
        "one_class_svm": w.isolation_weight * 0.5,
    }.get(method, 0.1)


def combine_scores(df: DataFrame, weights: EnsembleWeights = EnsembleWeights()) -> DataFrame:
    """Add ``ensemble_score``; a missing component counts 0."""
    def part(column: str, weight: float) -> Column:
        value = F.coalesce(F.col(column), F.lit(0.0)) if column in df.columns else F.lit(0.0)
        return value * F.lit(weight)

    return df.withColumn("ensemble_score", clip01(
        part("rule_score", weights.rule_weight)
        + part("isolation_forest_score", weights.isolation_weight)
        + part("lof_score", weights.autoencoder_weight)
        + part("dbscan_score", weights.clustering_weight)))


def detection_summary(scored: DataFrame) -> DataFrame:
    s = F.col("ensemble_score")
    return scored.agg(
        F.count(F.lit(1)).alias("transactions"),
        F.avg(s).alias("mean_score"),
        F.stddev_pop(s).alias("std_score"),
        F.count_if(s > 0.7).alias("anomaly_count_threshold_70"),
        F.count_if(s > 0.8).alias("anomaly_count_threshold_80"),
        F.count_if(s > 0.9).alias("anomaly_count_threshold_90"),
    )


def explain_top(
    scored: DataFrame, rules: RuleSet = RuleSet(), weights: EnsembleWeights = EnsembleWeights(), n: int = 10
) -> DataFrame:
    """The ``n`` highest ensemble scores with the share of every component and rule."""
    parts = [("rule_based", "rule_score", weights.rule_weight)] + [
        (f"statistical_{m}", score_column(m), method_weight(m, weights)) for m in present_methods(scored)]
    shares = F.array(*[
        F.struct(
            F.lit(name).alias("component"),
            F.col(col).alias("score"),
            F.lit(float(w)).alias("weight"),
            (F.col(col) * F.lit(w)).alias("contribution"),
        ) for name, col, w in parts])
    top = scored.orderBy(F.col("ensemble_score").desc(), "tx_id").limit(n)
    return rules.explain(top).withColumn("component_contributions", shares)


def top_anomalies(scored: DataFrame, n: int = DEFAULTS.top_n) -> DataFrame:
    """The ``n`` highest ensemble scores with every component score and a risk level."""
    top = scored.orderBy(F.col("ensemble_score").desc(), "tx_id").limit(n)
    return top.withColumn("risk_level", risk_band_top(F.col("ensemble_score")))


def rule_feature_importance(spark, rules: RuleSet = RuleSet()) -> DataFrame:
    """The weight of each rule, shared evenly among the features it reads."""
    pairs = [
        (feature, rule.weight / len(RULE_FEATURES[rule.name]))
        for rule in rules.rules for feature in RULE_FEATURES.get(rule.name, [])]
    return spark.createDataFrame(pairs, "feature string, importance double").groupBy("feature").agg(
        F.sum("importance").alias("importance"))


def combined_importance(
    statistical: DataFrame, rules: RuleSet = RuleSet(), weights: EnsembleWeights = EnsembleWeights()
) -> DataFrame:
    """Measured and rule-derived importance, weighted, normalised and sorted."""
    scaled = lambda df, w: df.select("feature", (F.col("importance") * F.lit(w)).alias("importance"))
    both = scaled(statistical, weights.isolation_weight).unionByName(
        scaled(rule_feature_importance(statistical.sparkSession, rules), weights.rule_weight))
    summed = both.groupBy("feature").agg(F.sum("importance").alias("importance"))
    total = summed.agg(F.sum("importance")).scalar()
    return rank_importance(summed.withColumn(
        "importance", F.coalesce(ratio(F.col("importance"), total), F.col("importance"))))


def rank_importance(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("importance").desc(), "feature")


def ensemble_statistics(scored: DataFrame, limits: ScaleLimits = DEFAULTS.limits) -> DataFrame:
    s = F.col("ensemble_score")
    q = quantiles(scored, "ensemble_score", [0.5, 0.75, 0.9, 0.95, 0.99], limits).select("q").scalar()
    rule = F.col("rule_score")
    row = scored.agg(
        F.avg(s).alias("mean_score"), F.stddev_pop(s).alias("std_score"),
        F.min(s).alias("min_score"), F.max(s).alias("max_score"),
        F.avg(rule).alias("rule_mean_score"),
        F.count_if(rule > 0).alias("rule_triggered_transactions"),
        ratio(F.count_if(rule > 0), F.count(F.lit(1))).alias("rule_trigger_rate"),
    ).withColumn("_q", q)
    return row.withColumns({
        f"p{p}": F.col("_q")[i] for i, p in enumerate([50, 75, 90, 95, 99])}).drop("_q")
