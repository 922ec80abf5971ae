"""Counts per time window and risk band, on streams and on batches alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bands import risk_band_report
from ..functions.numbers import total


def windowed_risk_counts(
    scored: DataFrame, length: str = "1 day", slide: str | None = None, score: str = "rule_score",
    delay: str = "1 day", band: Column | None = None,
) -> DataFrame:
    """Transactions per tumbling (or, with ``slide``, sliding) window and band."""
    timed = scored.withWatermark("timestamp", delay) if scored.isStreaming else scored
    window = F.window("timestamp", length, slide) if slide else F.window("timestamp", length)
    band = risk_band_report(F.col(score)) if band is None else band
    counts = timed.filter(F.col("timestamp").isNotNull()).groupBy(window, band.alias("risk_level")).agg(
        F.count(F.lit(1)).alias("n"))
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "risk_level", "n")


def session_counts(rows: DataFrame, gap: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Transactions and amount per user session: a session ends after ``gap`` without one."""
    timed = rows.withWatermark("timestamp", delay) if rows.isStreaming else rows
    known = timed.filter(F.col("timestamp").isNotNull() & F.col("user_id").isNotNull())
    out = known.groupBy(F.session_window("timestamp", gap), "user_id").agg(
        F.count(F.lit(1)).alias("n"), total(F.col("amount")).alias("amount"))
    return out.select(
        F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"),
        "user_id", "n", "amount")
