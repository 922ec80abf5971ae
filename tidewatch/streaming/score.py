"""Parse and score a stream of log lines against a saved profile.

Everything per line is stateless; what a line is compared with (user profiles,
frequencies, amount thresholds) comes from tables that a batch job saved. A line
therefore scores as in batch against the same profile, for the rules that do not
depend on the order of a user's transactions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DEFAULTS, Options
from ..operators.basic import time_features
from ..operators.context import apply_context, context_tables, frequency_cube
from ..operators.parse import parse_logs, valid_rows
from ..operators.rules import RuleSet
from ..operators.skew import lookup
from ..operators.users import user_profile


@dataclass(frozen=True)
class StreamProfile:
    users: DataFrame
    cube: DataFrame
    thresholds: DataFrame
    user_rows: int
    cube_rows: int


def save_profile(parsed: DataFrame, path: str, rules: RuleSet = RuleSet(), options: Options = DEFAULTS) -> None:
    """Profile a parsed batch table for later streams."""
    user_profile(parsed).write.mode("overwrite").parquet(f"{path}/users")
    frequency_cube(time_features(parsed)).write.mode("overwrite").parquet(f"{path}/cube")
    rules.thresholds(parsed, options.limits).write.mode("overwrite").parquet(f"{path}/thresholds")


def load_profile(spark: SparkSession, path: str) -> StreamProfile:
    users, cube = spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/cube")
    return StreamProfile(
        users, cube, spark.read.parquet(f"{path}/thresholds"), users.count(), cube.count())


def score_lines(
    lines: DataFrame, profile: StreamProfile, rules: RuleSet = RuleSet(), options: Options = DEFAULTS,
    delay: str = "1 day",
) -> DataFrame:
    """Parsed and rule-scored transactions; repeated ids within the delay are dropped on streams.

    Works on a stream and, for comparison, on a batch of the same lines.
    """
    parsed = valid_rows(parse_logs(lines))
    if lines.isStreaming:
        parsed = parsed.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["tx_id"])
    rows = lookup(time_features(parsed), profile.users, ["user_id"], profile.user_rows, options.limits)
    tables = context_tables(profile.cube)
    rows = apply_context(rows, tables, dict.fromkeys(tables, profile.cube_rows), options)
    return rules.score(rows, profile.thresholds, limits=options.limits)
