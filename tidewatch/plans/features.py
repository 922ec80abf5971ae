"""The whole feature pipeline and its catalogue."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULTS, Options
from ..operators.basic import amount_statistics, basic_features
from ..operators.context import amount_percentile, contextual_features
from ..operators.sequence import sequence_features
from ..operators.skew import checkpointed, distinct_estimate
from ..operators.users import user_features, user_profile

REQUIRED = ["timestamp", "user_id", "amount", "transaction_type"]
# Columns of the parsed table, and the words that sort features into categories.
SOURCE_COLUMNS = [
    "tx_id", "line_num", "raw_log", "timestamp", "user_id", "transaction_type", "amount",
    "amount_raw", "currency", "location", "device", "is_parsed", "parse_errors", "format_id",
]
CATEGORY_WORDS = {
    "temporal": ["hour", "day", "weekend", "month", "time", "night"],
    "amount": ["amount"],
    "location": ["location"],
    "device": ["device"],
    "transaction": ["transaction", "type", "tx"],
    "contextual": ["frequency", "rarity", "risk", "deviation", "percentile"],
    "interaction": ["location_device", "hour_type"],
    "derived": ["category", "group", "brand", "filled", "changed", "zscore"],
}


def extract_features(df: DataFrame, options: Options = DEFAULTS) -> DataFrame:
    """Parsed transactions to the full feature table.

    The sequence windows shuffle by user once and the user profile joins on that
    same partitioning; the remaining features are projections and lookups. Where the ranks
    of the amounts are too many to broadcast, they join the parsed rows, before the feature
    columns exist, and are stored with them; so the wide rows never move by amount.
    """
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        warnings.warn(f"missing recommended columns: {', '.join(missing)}", stacklevel=2)
    stats = amounts = None
    source, ranked = df, False
    if "amount" in df.columns:
        amounts = distinct_estimate(df, F.col("amount"))
        stats = amount_statistics(df, options.limits, distinct=amounts)
        ranked = amounts > options.limits.broadcast_rows and "amount_percentile" not in df.columns
        if ranked:
            df = checkpointed(amount_percentile(df, options.limits, amounts))
    out = sequence_features(df, options.velocity_window_hours, options.limits)
    if "user_id" in df.columns:
        out = user_features(out, user_profile(source))
    out = basic_features(out, stats, options.limits)
    out = contextual_features(out, options, source=source, amounts=amounts, ranked=ranked)
    return out.withColumn("feature_extraction_timestamp", F.current_timestamp())


def feature_catalogue(df: DataFrame) -> DataFrame:
    """(category, feature) pairs from the column names; a feature may have several categories."""
    names = [c for c in df.columns if c not in SOURCE_COLUMNS]
    pairs = [("user", n) for n in names if n.startswith("user_")]
    pairs += [(cat, n) for cat, words in CATEGORY_WORDS.items() for n in names if any(w in n for w in words)]
    sorted_names = {n for _, n in pairs}
    pairs += [("other", n) for n in names if n not in sorted_names]
    return df.sparkSession.createDataFrame(sorted(pairs), "category string, feature string")
