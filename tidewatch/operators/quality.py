"""Parse counters, quality grades, recommendations and layout analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numbers import ratio, rounded
from .parse import FORMAT_NAMES, log_class, parse_lines

# Texts of the recommendations, with the condition each depends on.
RECOMMENDATIONS = [
    (lambda: F.col("success_rate") < 70, [
        "Consider adding more format parsers to improve success rate",
        "Review failed logs to identify new patterns"]),
    (lambda: F.col("failure_rate") > 20, [
        "High failure rate detected - investigate parsing logic",
        "Consider implementing additional regex patterns"]),
    (lambda: F.col("empty_rate") > 15, [
        "High number of empty logs - check data source quality",
        "Consider filtering empty entries at source"]),
    (lambda: F.col("malformed_rate") > 15, [
        "High malformed log rate - investigate data generation process",
        "Consider implementing data validation at source"]),
    (lambda: F.col("success_rate") >= 85, [
        "Excellent parsing performance - system is production ready"]),
]
RECOMMENDATIONS_DEFAULT = [
    "Parsing performance is within acceptable ranges",
    "Monitor trends over time for any degradation",
]


def parsing_counters(raw: DataFrame, column: str = "raw_log", compat: bool = True) -> DataFrame:
    """One row of counts over all raw lines, in one pass."""
    lines = parse_lines(raw.select(F.col(column).alias("raw_log")), compat=compat)
    is_log = F.col("log_class") == "log"
    counts = lines.agg(
        F.count(F.lit(1)).alias("total_logs"),
        F.count_if(is_log & F.col("is_parsed")).alias("parsed_successfully"),
        F.count_if(is_log & ~F.col("is_parsed")).alias("parsing_failed"),
        F.count_if(F.col("log_class") == "empty").alias("empty_logs"),
        F.count_if(F.col("log_class") == "malformed").alias("malformed_logs"),
    )
    return counts.withColumns({
        "success": F.col("parsed_successfully"),
        "failed": F.col("parsing_failed") + F.col("empty_logs") + F.col("malformed_logs"),
    })


def parsing_errors(raw: DataFrame, column: str = "raw_log", n: int = 10) -> DataFrame:
    """The ``n`` most common errors of lines that could not be parsed."""
    lines = parse_lines(raw.select(F.col(column).alias("raw_log")))
    return (
        lines.filter((F.col("log_class") == "log") & ~F.col("is_parsed") & F.col("parse_errors").isNotNull())
        .select(F.explode(F.split("parse_errors", "; ")).alias("error"))
        .groupBy("error").agg(F.count(F.lit(1)).alias("occurrences"))
        .orderBy(F.col("occurrences").desc(), "error").limit(n)
    )


def _rates(counters: DataFrame) -> DataFrame:
    pct = lambda c: F.coalesce(ratio(F.col(c), F.col("total_logs")) * 100, F.lit(0.0))
    return counters.withColumns({
        "success_rate": pct("parsed_successfully"),
        "failure_rate": pct("parsing_failed"),
        "empty_rate": pct("empty_logs"),
        "malformed_rate": pct("malformed_logs"),
    })


def quality_report(counters: DataFrame) -> DataFrame:
    """Rates, grades and error categories of one counter row."""
    r = _rates(counters)
    bad = F.col("empty_rate") + F.col("malformed_rate")
    grade = lambda c, a, b, x, y, z: F.when(c >= a, x).when(c >= b, y).otherwise(z)
    usable = ratio(F.col("parsed_successfully"), F.col("total_logs"))
    return r.select(
        "total_logs", "parsed_successfully", "parsing_failed", "empty_logs", "malformed_logs",
        rounded(F.col("success_rate"), 2).alias("success_rate_percent"),
        rounded(F.col("failure_rate"), 2).alias("failure_rate_percent"),
        rounded(F.col("empty_rate"), 2).alias("empty_rate_percent"),
        rounded(F.col("malformed_rate"), 2).alias("malformed_rate_percent"),
        grade(F.col("success_rate"), 80, 60, "High", "Medium", "Low").alias("parsing_efficiency"),
        F.when(bad <= 20, "Good").when(bad <= 40, "Fair").otherwise("Poor").alias("data_quality"),
        rounded(F.col("success_rate"), 2).alias("usable_data_ratio"),
        grade(usable, 0.8, 0.6, "Good", "Fair", "Poor").alias("usable_data_grade"),
        F.col("failed").alias("total_errors"),
    )


def recommendations(counters: DataFrame) -> DataFrame:
    """One row per piece of advice, in order."""
    picks = [F.when(cond(), F.array(*map(F.lit, texts))) for cond, texts in RECOMMENDATIONS]
    advice = F.flatten(F.array_compact(F.array(*picks)))
    listed = _rates(counters).select(advice.alias("advice")).select(
        F.when(F.size("advice") > 0, F.col("advice"))
        .otherwise(F.array(*map(F.lit, RECOMMENDATIONS_DEFAULT))).alias("advice"))
    return listed.select(F.posexplode("advice").alias("position", "recommendation"))


def summary_table(counters: DataFrame) -> DataFrame:
    """Five rows of category, count and percentage text."""
    r = _rates(counters)
    text = lambda c: F.concat(rounded(F.col(c), 2).cast("string"), F.lit("%"))
    row = lambda name, count, pct: F.struct(
        F.lit(name).alias("category"), F.col(count).alias("count"), pct.alias("percentage"))
    return r.select(F.inline(F.array(
        row("Total Logs", "total_logs", F.lit("100.0%")),
        row("Successfully Parsed", "parsed_successfully", text("success_rate")),
        row("Parsing Failures", "parsing_failed", text("failure_rate")),
        row("Empty Logs", "empty_logs", text("empty_rate")),
        row("Malformed Logs", "malformed_logs", text("malformed_rate")),
    )))


def separator_counts(raw: DataFrame, column: str = "raw_log") -> DataFrame:
    """How many raw lines show each separator, and how many are empty or malformed."""
    c = F.col(column)
    return raw.agg(
        F.count_if(c.contains("|")).alias("pipe"),
        F.count_if(c.contains("::")).alias("double_colon"),
        F.count_if(c.contains(">>")).alias("arrow"),
        F.count_if(c.contains(":::")).alias("triple_colon"),
        F.count_if(c.contains("usr:")).alias("usr_prefix"),
        F.count_if(c.startswith("user")).alias("user_start"),
        F.count_if(c.isNull()).alias("null_lines"),
        F.count_if(log_class(c) == "empty").alias("empty_lines"),
        F.count_if(log_class(c) == "malformed").alias("malformed_lines"),
    )


def format_report(raw: DataFrame, column: str = "raw_log") -> DataFrame:
    """Per detected layout: lines, parsed lines and success rate."""
    names = F.create_map(*[F.lit(x) for kv in FORMAT_NAMES.items() for x in kv])
    lines = parse_lines(raw.select(F.col(column).alias("raw_log"))).filter(F.col("log_class") == "log")
    return (
        lines.groupBy("format_id")
        .agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("is_parsed")).alias("parsed"))
        .select(
            "format_id", F.try_element_at(names, F.col("format_id")).alias("format"), "lines", "parsed",
            rounded(ratio(F.col("parsed"), F.col("lines")) * 100, 2).alias("success_rate_percent"))
    )
