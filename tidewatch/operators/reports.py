"""Report tables over scored transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..config import EnsembleWeights
from ..functions.bands import REPORT_LEVELS, risk_band_export, risk_band_report
from ..functions.numbers import mean, ratio, rounded, total
from .scoring import present_methods, score_column, with_modes

TOP_PER_BAND = {"CRITICAL": 10, "HIGH": 10, "MEDIUM": 5}


def risk_breakdown(scored: DataFrame) -> DataFrame:
    """Count and share of each report band, empty bands included."""
    band = risk_band_report(F.col("ensemble_score"))
    row = scored.agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(band == level).alias(level) for level in REPORT_LEVELS])
    return row.select(F.inline(F.array(*[
        F.struct(
            F.lit(level).alias("risk_level"),
            F.col(level).alias("transactions"),
            F.coalesce(ratio(F.col(level), F.col("n")) * 100, F.lit(0.0)).alias("percentage"),
        ) for level in REPORT_LEVELS])))


def _user_risk(rows: DataFrame, keys: list[str]) -> DataFrame:
    r4 = lambda c: rounded(c, 4)
    stats = rows.groupBy(*keys).agg(
        r4(F.avg("ensemble_score")).alias("mean_score"),
        r4(F.max("ensemble_score")).alias("max_score"),
        F.count("ensemble_score").alias("tx_count"),
        r4(mean(F.col("amount"))).alias("avg_amount"),
        r4(total(F.col("amount"))).alias("total_amount"),
    )
    return with_modes(stats, rows, keys, {"location": "main_location"})


def _banded(scored: DataFrame) -> DataFrame:
    known = scored.filter(F.col("user_id").isNotNull())
    return known.withColumn("risk_level", risk_band_report(F.col("ensemble_score"))).filter(
        F.col("risk_level").isin(*TOP_PER_BAND))


def _top_per_band(users: DataFrame) -> DataFrame:
    w = Window.partitionBy("risk_level").orderBy(F.col("mean_score").desc(), "user_id")
    ranked = users.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= max(TOP_PER_BAND.values()))
    keep = None
    for level, n in TOP_PER_BAND.items():
        cond = (F.col("risk_level") == level) & (F.col("rank") <= n)
        keep = cond if keep is None else keep | cond
    return ranked.filter(keep)


def users_by_band(scored: DataFrame) -> DataFrame:
    """Users of the three upper bands, measured on their rows inside the band."""
    return _top_per_band(_user_risk(_banded(scored), ["risk_level", "user_id"]))


def users_by_band_all_rows(scored: DataFrame) -> DataFrame:
    """As :func:`users_by_band`, but critical and high users are measured on all their rows."""
    banded = _banded(scored)
    parts = []
    for level in ("CRITICAL", "HIGH"):
        members = banded.filter(F.col("risk_level") == level).select("user_id").distinct()
        rows = scored.join(members, "user_id", "left_semi").withColumn("risk_level", F.lit(level))
        parts.append(rows.select("risk_level", "user_id", "ensemble_score", "amount", "location"))
    medium = banded.filter(F.col("risk_level") == "MEDIUM").select(
        "risk_level", "user_id", "ensemble_score", "amount", "location")
    rows = parts[0].unionByName(parts[1]).unionByName(medium)
    return _top_per_band(_user_risk(rows, ["risk_level", "user_id"]))


def top_users(scored: DataFrame, by: str = "max", n: int = 10) -> DataFrame:
    """Most anomalous users, by their highest (``max``) or their ``mean`` ensemble score."""
    r4 = lambda c: rounded(c, 4)
    known = scored.filter(F.col("user_id").isNotNull())
    stats = known.groupBy("user_id").agg(
        r4(F.avg("ensemble_score")).alias("mean_ensemble"),
        r4(F.max("ensemble_score")).alias("max_ensemble"),
        F.count("ensemble_score").alias("tx_count"),
        r4(F.avg("rule_score")).alias("mean_rule"),
        r4(mean(F.col("amount"))).alias("avg_amount"),
        r4(total(F.col("amount"))).alias("total_amount"),
    )
    order = F.col(f"{by}_ensemble")
    top = stats.orderBy(order.desc(), "user_id").limit(n)
    # Main values are only worked out for the users in the report.
    rows = known.join(F.broadcast(top.select("user_id")), "user_id", "left_semi")
    top = with_modes(top, rows, ["user_id"], {"location": "main_location", "transaction_type": "main_type"})
    return top.withColumn("risk_level", risk_band_report(order))


def component_analysis(scored: DataFrame, weights: EnsembleWeights = EnsembleWeights()) -> DataFrame:
    """Per component: mean score, weight in the ensemble (if any) and rows above 0.7."""
    weight = {
        "rule_based": weights.rule_weight, "isolation_forest": weights.isolation_weight,
        "lof": weights.autoencoder_weight, "dbscan": weights.clustering_weight,
    }
    parts = [("rule_based", "rule_score")] + [(m, score_column(m)) for m in present_methods(scored)]
    row = scored.agg(*[
        F.struct(
            F.lit(name).alias("component"), F.avg(col).alias("mean_score"),
            F.lit(weight.get(name)).cast("double").alias("weight"),
            F.count_if(F.col(col) > 0.7).alias("high_risk"),
        ).alias(name) for name, col in parts])
    return row.select(F.inline(F.array(*[name for name, _ in parts])))


def suspicious_users(scored: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Users with transactions above the threshold, most such transactions first."""
    return (
        scored.filter((F.col("ensemble_score") > threshold) & F.col("user_id").isNotNull())
        .groupBy("user_id").agg(F.count(F.lit(1)).alias("high_risk_transactions"))
        .orderBy(F.col("high_risk_transactions").desc(), "user_id")
    )


def detection_rate(scored: DataFrame) -> DataFrame:
    """Share of rows above 0.7, and confidence by spread and by mean."""
    s = F.col("ensemble_score")
    row = scored.agg(
        F.count(F.lit(1)).alias("transactions"), F.count_if(s > 0.7).alias("flagged"),
        F.avg(s).alias("_mean"), F.stddev_pop(s).alias("_std"))
    grade = lambda c, a, b: F.when(c > a, "HIGH").when(c > b, "MEDIUM").otherwise("LOW")
    return row.select(
        "transactions", "flagged",
        F.coalesce(ratio(F.col("flagged"), F.col("transactions")) * 100, F.lit(0.0)).alias("detection_rate"),
        grade(F.col("_std"), 0.1, 0.05).alias("confidence_by_spread"),
        grade(F.col("_mean"), 0.5, 0.3).alias("confidence_by_mean"))


def high_risk_counters(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Scores above the threshold by rules, by all statistical methods together, by the ensemble."""
    over = lambda c: F.count_if(F.col(c) > threshold)
    methods = present_methods(scored)
    return scored.agg(
        over("rule_score").alias("rule_anomalies"),
        sum((over(score_column(m)) for m in methods), F.lit(0).cast("long")).alias("statistical_anomalies"),
        over("ensemble_score").alias("ensemble_anomalies"))


def detailed_report(scored: DataFrame) -> DataFrame:
    """One row per transaction for export."""
    return scored.select(
        "user_id", "ensemble_score", "rule_score", "amount", "location", "transaction_type",
        risk_band_export(F.col("ensemble_score")).alias("risk_level"))


def fraud_report_lines(scored: DataFrame) -> DataFrame:
    """The text report as ordered lines, put together from the report tables."""
    overall = scored.agg(
        F.count(F.lit(1)).alias("n"), F.avg("ensemble_score").alias("mean"),
        F.stddev_pop("ensemble_score").alias("std"), F.max("ensemble_score").alias("hi"),
        F.min("ensemble_score").alias("lo"))
    # This pattern rounds the binary value half to even, as printf does; format_string would round its decimal text up.
    fixed = lambda c, digits: F.call_function("format_number", F.col(c), F.lit("0." + "0" * digits))
    num = lambda c: fixed(c, 4)
    lines = lambda df, section, text, order: df.select(
        F.lit(section).alias("section"), order.cast("int").alias("position"), text.alias("line"))
    entry = lambda i, text: F.struct(F.lit(0).alias("section"), F.lit(i).alias("position"), text.alias("line"))
    head = overall.select(F.inline(F.array(
        entry(0, F.concat(F.lit("Total transactions: "), F.col("n"))),
        entry(1, F.concat(F.lit("Mean ensemble score: "), num("mean"))),
        entry(2, F.concat(F.lit("Standard deviation: "), num("std"))),
        entry(3, F.concat(F.lit("Highest score: "), num("hi"))),
        entry(4, F.concat(F.lit("Lowest score: "), num("lo"))))))
    bands = lines(
        risk_breakdown(scored), 1,
        F.format_string("%s: %d transactions (%s%%)", "risk_level", "transactions", fixed("percentage", 1)),
        F.array_position(F.array(*map(F.lit, REPORT_LEVELS)), F.col("risk_level")))
    parts = lines(
        component_analysis(scored).withColumn("mean_score", rounded(F.col("mean_score"), 6)), 2,
        F.format_string("%s: mean %s, above 0.7: %d", "component", num("mean_score"), "high_risk"), F.lit(0))
    w = Window.orderBy(F.col("mean_ensemble").desc(), "user_id")
    users = lines(
        top_users(scored, by="mean").withColumn("_i", F.row_number().over(w)), 3,
        F.format_string("%s: mean %s, rule %s, %d transactions, total %s, %s, %s, %s", "user_id", num("mean_ensemble"),
                        num("mean_rule"), "tx_count", fixed("total_amount", 1), "main_location", "main_type", "risk_level"),
        F.col("_i"))
    return head.unionByName(bands).unionByName(parts).unionByName(users).orderBy("section", "position", "line")
