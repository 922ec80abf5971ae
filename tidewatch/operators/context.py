"""Features that compare a transaction with the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULTS, Options, ScaleLimits
from ..functions.numbers import ratio
from .skew import checkpointed, distinct_estimate, lookup, ranked_values

CONTEXT_COLUMNS = [
    "location_frequency", "location_rarity", "location_risk_score", "device_frequency", "device_rarity",
    "type_frequency", "type_rarity", "location_device", "location_device_frequency",
    "location_device_rarity", "hour_type", "hour_type_frequency", "hour_type_rarity",
    "amount_percentile", "amount_deviation_location", "amount_deviation_type",
]


def pair_label(left: Column, right: Column) -> Column:
    """Two values in one text; a missing value reads ``None``."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    return F.concat(text(left), F.lit("_"), text(right))


def frequency_cube(df: DataFrame) -> DataFrame:
    """Counts and amount sums per combination of the compared columns.

    One pass over the table; every frequency below is a roll-up of this result.
    """
    cube = df.groupBy("location", "device", "transaction_type", "hour").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount").alias("amount_sum"),
        F.count("amount").alias("amount_n"),
    )
    return cube.withColumns({
        "location_device": pair_label(F.col("location"), F.col("device")),
        "hour_type": pair_label(F.col("hour"), F.col("transaction_type")),
    })


def frequency_table(cube: DataFrame, key: str, name: str, with_mean: bool = False) -> DataFrame:
    """``<name>_frequency`` per non-null key, with the mean amount where asked."""
    aggs = [F.sum("n").alias(f"{name}_frequency")]
    if with_mean:
        aggs.append(ratio(F.sum("amount_sum"), F.sum("amount_n")).alias(f"_{name}_mean"))
    return cube.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def context_tables(cube: DataFrame) -> dict[str, tuple[str, DataFrame]]:
    return {
        "location": ("location", frequency_table(cube, "location", "location", with_mean=True)),
        "device": ("device", frequency_table(cube, "device", "device")),
        "type": ("transaction_type", frequency_table(cube, "transaction_type", "type", with_mean=True)),
        "location_device": ("location_device", frequency_table(cube, "location_device", "location_device")),
        "hour_type": ("hour_type", frequency_table(cube, "hour_type", "hour_type")),
    }


def percentile_table(
    df: DataFrame, limits: ScaleLimits = DEFAULTS.limits, distinct: int | None = None
) -> tuple[DataFrame, int]:
    """Share of rows at or below each amount (ties get their average), and its size."""
    distinct = distinct_estimate(df, F.col("amount")) if distinct is None else distinct
    ranked = ranked_values(df, "amount", distinct, limits)
    return ranked.select(
        "amount", ratio(F.col("below") + (F.col("n") + 1) / 2, F.col("size")).alias("amount_percentile")), distinct


def amount_percentile(
    df: DataFrame, limits: ScaleLimits = DEFAULTS.limits, distinct: int | None = None
) -> DataFrame:
    table, distinct = percentile_table(df, limits, distinct)
    return lookup(df, table, ["amount"], distinct, limits)


def apply_context(
    df: DataFrame, tables: dict[str, tuple[str, DataFrame]], sizes: dict[str, int], options: Options
) -> DataFrame:
    """Frequencies, rarities and deviations from lookup tables of known size."""
    out = df.withColumns({
        "location_device": pair_label(F.col("location"), F.col("device")),
        "hour_type": pair_label(F.col("hour"), F.col("transaction_type")),
    })
    for name, (key, table) in tables.items():
        out = lookup(out, table, [key], sizes[name], options.limits)
        out = out.withColumn(f"{name}_rarity", F.lit(1.0) / (F.col(f"{name}_frequency") + 1))
    amount = F.col("amount")
    return out.withColumns({
        "location_risk_score": F.coalesce(
            F.col("location_rarity") > options.location_risk_threshold, F.lit(False)).cast("int"),
        "amount_deviation_location": F.abs(amount - F.col("_location_mean")),
        "amount_deviation_type": F.abs(amount - F.col("_type_mean")),
    }).drop("_location_mean", "_type_mean")


def contextual_features(
    df: DataFrame, options: Options = DEFAULTS, source: DataFrame | None = None, amounts: int | None = None,
    ranked: bool = False,
) -> DataFrame:
    """All contextual features of ``df``, which must already have its ``hour``.

    ``source`` is a cheaper plan with the same rows (such as the parsed table that
    ``df`` was built from); the lookup tables are then made from it. ``amounts`` is the
    number of distinct amounts, where it is already measured. With ``ranked``, ``df`` carries
    its ``amount_percentile`` already.
    """
    source = df if source is None else source
    given = [c for c in df.columns if not (ranked and c == "amount_percentile")]
    for col, kind in (("location", "string"), ("device", "string"), ("transaction_type", "string"),
                      ("hour", "int"), ("amount", "double")):
        if col not in df.columns:
            df = df.withColumn(col, F.lit(None).cast(kind))
        if col not in source.columns:
            hour = F.hour(F.col("timestamp").cast("timestamp")) if "timestamp" in source.columns else F.lit(None)
            source = source.withColumn(col, (hour if col == "hour" else F.lit(None)).cast(kind))
    cube = checkpointed(frequency_cube(source))
    tables = context_tables(cube)
    rows = cube.count()
    if rows <= options.limits.broadcast_rows:
        sizes = dict.fromkeys(tables, rows)
    else:
        sizes = {name: table.count() for name, (_, table) in tables.items()}
    out = apply_context(df, tables, sizes, options)
    if not ranked:
        table, distinct = percentile_table(source, options.limits, amounts)
        out = lookup(out, table, ["amount"], distinct, options.limits)
    return out.select(*given, *CONTEXT_COLUMNS)
