"""The four risk bandings in use. They differ on purpose, so each keeps its own name."""

from pyspark.sql import Column, functions as F

REPORT_LEVELS = ["CRITICAL", "HIGH", "MEDIUM", "LOW", "NORMAL"]


def risk_band_report(score: Column) -> Column:
    return (
        F.when(score > 0.8, "CRITICAL").when(score > 0.7, "HIGH").when(score > 0.5, "MEDIUM")
        .when(score > 0.3, "LOW").when(score.isNotNull(), "NORMAL")
    )


def risk_band_export(score: Column) -> Column:
    """Half-open bands from zero: a score of exactly 0 (or above 1) has no band."""
    return (
        F.when((score <= 0) | (score > 1), F.lit(None).cast("string"))
        .when(score > 0.9, "CRITICAL").when(score > 0.7, "HIGH").when(score > 0.5, "MEDIUM")
        .when(score > 0.3, "LOW").when(score.isNotNull(), "NORMAL")
    )


def risk_band_top(score: Column) -> Column:
    return (
        F.when((score < 0) | (score > 1), F.lit(None).cast("string"))
        .when(score > 0.8, "Critical").when(score > 0.6, "High").when(score > 0.3, "Medium")
        .when(score.isNotNull(), "Low")
    )


def risk_band_user(score: Column) -> Column:
    return (
        F.when(score > 0.8, "CRITICAL").when(score > 0.6, "HIGH").when(score > 0.4, "MEDIUM")
        .when(score > 0.2, "LOW").when(score.isNotNull(), "NORMAL")
    )
