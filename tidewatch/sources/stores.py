"""Tables and files between the stages. File names avoid characters that Hadoop paths reject."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.quality import quality_report, recommendations
from ..operators.reports import detailed_report, fraud_report_lines


def write_parsed(parsed: DataFrame, path: str, files_per_day: int = 4) -> None:
    """The parsed table, partitioned by day so that later reads can skip days.

    Rows are dealt by day and a salt first, so a day is written by at most ``files_per_day`` tasks
    and a busy day by that many.
    """
    salt = F.pmod(F.xxhash64(*parsed.columns), F.lit(files_per_day))
    parsed.withColumn("day", F.to_date("timestamp")).repartition("day", salt).write.mode("overwrite").partitionBy("day").parquet(path)


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("day")


def write_parsed_csv(parsed: DataFrame, path: str) -> None:
    parsed.write.mode("overwrite").option("header", True).csv(path)


def read_parsed_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


write_features = write_parsed
read_features = read_parsed


def report_name(prefix: str, when: datetime) -> str:
    return f"{prefix}_{when:%d-%m-%y-%H-%M}"


def statistics_document(counters: DataFrame, errors: DataFrame | None = None, formats: DataFrame | None = None) -> DataFrame:
    """One JSON line: metadata, statistics and the raw counts.

    ``errors`` (of ``parsing_errors``) and ``formats`` (of ``format_report``) add the common errors and the
    layouts; both have a few rows whatever the number of lines.
    """
    def listed(df: DataFrame, first: Column, columns: list[str]) -> Column:
        rows = F.array_sort(F.collect_list(F.struct(first.alias("at"), F.struct(*columns).alias("row"))))
        return df.agg(F.transform(rows, lambda x: x["row"]).alias("a")).select("a").scalar()

    more = []
    if errors is not None:
        order = F.struct(-F.col("occurrences"), F.col("error"))
        more.append(listed(errors, order, ["error", "occurrences"]).alias("common_errors"))
    if formats is not None:
        more.append(listed(formats, F.col("format_id"), ["format", "lines", "parsed", "success_rate_percent"]).alias("format_analysis"))
    quality = quality_report(counters)
    advice = recommendations(counters).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("position", "recommendation"))), lambda x: x["recommendation"]
    ).alias("a"))
    doc = counters.select(F.struct(
        F.struct(F.current_timestamp().alias("generated_at"), F.lit("1.0.0").alias("parser_version"),
                 F.lit("Transaction Log Parsing Statistics").alias("report_type")).alias("report_metadata"),
        quality.select(F.struct(*quality.columns)).scalar().alias("statistics"),
        advice.select("a").scalar().alias("recommendations"),
        *more,
        F.struct(*counters.columns).alias("raw_parsing_data"),
    ).alias("d"))
    return doc.select(F.to_json("d").alias("value"))


def write_statistics(
    counters: DataFrame, path: str, errors: DataFrame | None = None, formats: DataFrame | None = None
) -> None:
    statistics_document(counters, errors, formats).coalesce(1).write.mode("overwrite").text(path)


def write_detailed_report(scored: DataFrame, path: str) -> None:
    detailed_report(scored).write.mode("overwrite").option("header", True).csv(path)


def write_text_report(scored: DataFrame, path: str) -> None:
    """A report of a few dozen lines, so one file."""
    fraud_report_lines(scored).select("line").coalesce(1).write.mode("overwrite").text(path)
