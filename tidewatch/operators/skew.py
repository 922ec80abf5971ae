"""Ways to stay distributed when a table or a key is too big for one task.

Sizes are measured with small jobs while the plan is built; the plan that is
returned fits the measured sizes. Only bounded results reach the driver: counts,
and at most a few cut points per shuffle partition.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..config import DEFAULTS, ScaleLimits

SAMPLES_PER_BLOCK = 64


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a folder of our own only where it is unset, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="tidewatch-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the table to the shared folder once and go on from there.

    Written as parquet, so later readers still read only the columns they need,
    and a lost executor costs a re-read instead of a recomputation.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def distinct_estimate(df: DataFrame, col: Column) -> int:
    return df.agg(F.approx_count_distinct(col)).first()[0]


def lookup(df: DataFrame, table: DataFrame, on: list[str], rows: int, limits: ScaleLimits) -> DataFrame:
    """Left join with a lookup table of measured size.

    Up to the limit the table is broadcast, so the big side is not moved at all.
    Beyond it both sides are shuffled, and adaptive execution splits hot keys.
    """
    return df.join(F.broadcast(table) if rows <= limits.broadcast_rows else table, on, "left")


# --- order statistics -------------------------------------------------------

def value_counts(df: DataFrame, column: str, keys: tuple[str, ...] = ()) -> DataFrame:
    c = F.col(column)
    return df.filter(c.isNotNull() & ~F.isnan(c)).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))


def ranked_values(
    df: DataFrame, column: str, distinct: int, limits: ScaleLimits = DEFAULTS.limits, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Distinct values (per key) with ``n`` copies, ``below`` smaller rows and ``size`` rows in all.

    Many values are cut into value ranges at approximate quantiles: counts run
    inside each range, and the totals of the ranges (one row each) give the rest.
    """
    counts = value_counts(df, column, keys)
    upto = (Window.unboundedPreceding, Window.currentRow)
    everything = (Window.unboundedPreceding, Window.unboundedFollowing)
    if distinct <= limits.quantile_values:
        w = Window.partitionBy(*keys).orderBy(column)
        return counts.withColumns({
            "below": F.sum("n").over(w.rowsBetween(*upto)) - F.col("n"),
            "size": F.sum("n").over(w.rowsBetween(*everything)),
        })
    pieces = max(2, math.ceil(2 * distinct / limits.quantile_values))
    cuts = sorted(set(counts.approxQuantile(column, [i / pieces for i in range(1, pieces)], 0.2 / pieces)))
    cut = Bucketizer(
        splits=[-math.inf, *cuts, math.inf], inputCol=column, outputCol="_block"
    ).transform(counts)
    totals = cut.groupBy(*keys, "_block").agg(F.sum("n").alias("_total"))
    blocks = Window.partitionBy(*keys).orderBy("_block")
    offsets = totals.select(
        *keys, "_block",
        F.coalesce(F.sum("_total").over(blocks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_total").over(blocks.rowsBetween(*everything)).alias("size"))
    inside = Window.partitionBy(*keys, "_block").orderBy(column).rowsBetween(*upto)
    run = cut.withColumn("_run", F.sum("n").over(inside) - F.col("n"))
    # A missing key is a key like any other, so the join compares null-safe.
    renamed = offsets.withColumnsRenamed({"_block": "_at", **{k: f"_{k}" for k in keys}})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_block") == F.col("_at")]
    joined = run.join(renamed if keys else F.broadcast(renamed), same)
    return joined.select(*keys, column, "n", (F.col("_run") + F.col("_offset")).alias("below"), "size")


def quantiles(
    df: DataFrame, column: str, probs: list[float], limits: ScaleLimits = DEFAULTS.limits,
    distinct: int | None = None, keys: tuple[str, ...] = (),
) -> DataFrame:
    """Exact quantiles with linear interpolation, in one array column ``q`` (per key)."""
    if distinct is None:
        distinct = distinct_estimate(df, F.col(column))
    if distinct <= limits.quantile_values:
        return value_counts(df, column, keys).groupBy(*keys).agg(
            F.percentile(column, F.array(*map(F.lit, probs)), F.col("n")).alias("q"))
    ranked = ranked_values(df, column, distinct, limits, keys)
    v, lo, hi = F.col(column), F.col("below"), F.col("below") + F.col("n")
    at = lambda i: F.max(F.when((lo <= i) & (i < hi), v))
    pos = [F.lit(p) * (F.col("size") - 1) for p in probs]
    ends = ranked.groupBy(*keys).agg(
        *[at(F.floor(x)).alias(f"a{i}") for i, x in enumerate(pos)],
        *[at(F.ceil(x)).alias(f"b{i}") for i, x in enumerate(pos)],
        F.max("size").alias("size"))
    return ends.select(*keys, F.array(*[
        F.col(f"a{i}") + (F.col(f"b{i}") - F.col(f"a{i}")) * (x - F.floor(x)) for i, x in enumerate(pos)
    ]).alias("q"))


# --- hot keys ---------------------------------------------------------------

def fair_share(spark: SparkSession, rows: int, limits: ScaleLimits) -> int:
    """Rows of one key that one task may take: grows with the table up to a ceiling."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(max(limits.rows_per_task, 2 * rows // partitions), limits.most_rows)


def hot_keys(df: DataFrame, key: str, limits: ScaleLimits) -> tuple[dict, int]:
    """Keys (null included) with more rows than their fair share, and that share.

    There are at most as many such keys as shares in the table: fewer than shuffle
    partitions below the ceiling, one per ``limits.most_rows`` rows beyond it.
    """
    rows = df.select(key).count()
    share = fair_share(df.sparkSession, rows, limits)
    if rows <= share:
        return {}, share
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return {r[0]: r[1] for r in counts.filter(F.col("n") > share).collect()}, share


def cut_points(
    df: DataFrame, key: str, order: list[str], hot: dict, share: int
) -> dict[object, list[tuple]]:
    """Per hot key, a small sorted sample of its rows in the given order.

    The sample only decides where blocks begin, never what is computed.
    """
    pieces = {k: math.ceil(2 * n / share) for k, n in hot.items()}
    rates = F.create_map(*[
        F.lit(x) for k, n in hot.items()
        for x in (k, min(1.0, SAMPLES_PER_BLOCK * pieces[k] / n))])
    draw = F.pmod(F.xxhash64(key, *order), F.lit(1_000_003)) / F.lit(1_000_003.0)
    picked = df.filter(draw < F.try_element_at(rates, F.col(key))).select(key, *order).collect()
    out: dict[object, list[tuple]] = {k: [] for k in hot}
    for row in picked:
        out[row[0]].append(tuple(row[1:]))
    return {k: sorted(v) for k, v in out.items()}


def evenly(points: list, pieces: int) -> list:
    """``pieces - 1`` cut points out of a sorted list, without repeats."""
    if not points:
        return []
    step = len(points) / pieces
    return sorted({points[int(i * step)] for i in range(1, pieces)})


def with_blocks(df: DataFrame, cuts: dict, key: str, order: list[str], how: str = "inner") -> DataFrame:
    """Add ``_block``: how many of its key's sorted cut points a row reaches.

    ``cuts`` covers the hot keys only, so the table that is broadcast is bounded.
    """
    point = T.StructType([T.StructField(c, df.schema[c].dataType) for c in order])
    schema = T.StructType([
        T.StructField(key, df.schema[key].dataType), T.StructField("_cuts", T.ArrayType(point))])
    table = df.sparkSession.createDataFrame(list(cuts.items()), schema)
    here = F.struct(*order)
    return (
        df.join(F.broadcast(table), key, how)
        .withColumn("_block", F.when(F.col("_cuts").isNotNull(), F.size(F.filter("_cuts", lambda c: c <= here))))
        .drop("_cuts")
    )


def running_total(
    df: DataFrame, key: str, order: str, value: str, limits: ScaleLimits, inclusive: bool = True
) -> DataFrame:
    """Add ``_sum``, the running sum of ``value`` per key over distinct ``order`` values.

    Keys with too many rows are cut into blocks; the totals of the earlier blocks
    (one row per block) are added to the sums inside each block.
    """
    end = Window.currentRow if inclusive else -1
    hot, share = hot_keys(df, key, limits)
    if not hot:
        w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, end)
        return df.withColumn("_sum", F.coalesce(F.sum(value).over(w), F.lit(0)))
    sample = cut_points(df, key, [order], hot, share)
    rows = with_blocks(
        df, {k: evenly(v, math.ceil(2 * hot[k] / share)) for k, v in sample.items()}, key, [order], how="left")
    inside = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, end)
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.filter(F.col("_block").isNotNull()).groupBy(key, "_block").agg(F.sum(value).alias("_total"))
    offsets = totals.select(key, "_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    return (
        rows.withColumn("_run", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), [key, "_block"], "left")
        .withColumn("_sum", F.col("_run") + F.coalesce(F.col("_offset"), F.lit(0)))
        .drop("_block", "_run", "_offset")
    )


def next_in_order(df: DataFrame, keys: list[str], order: str, name: str, limits: ScaleLimits) -> DataFrame:
    """Add ``name``: the next ``order`` value of the same keys (null for the last); keys and order are distinct and not null.

    Keys with too many rows are cut into blocks at sampled points; the last row of a
    block continues with the first of the next one (one row per block).
    """
    # Keys are cut by their hash; windows and joins use the keys themselves, so equal hashes do no harm.
    rows = df.withColumn("_pair", F.xxhash64(*keys))
    hot, share = hot_keys(rows, "_pair", limits)
    if not hot:
        return df.withColumn(name, F.lead(order).over(Window.partitionBy(*keys).orderBy(order)))
    sample = cut_points(rows, "_pair", [order], hot, share)
    cut = with_blocks(
        rows, {k: evenly(v, math.ceil(2 * hot[k] / share)) for k, v in sample.items()}, "_pair", [order], how="left")
    first = cut.filter(F.col("_block").isNotNull()).groupBy(*keys, "_block").agg(F.min(order).alias("_first"))
    after = first.select(*keys, "_block", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_block")).alias("_after"))
    inside = F.lead(order).over(Window.partitionBy(*keys, "_block").orderBy(order))
    return cut.withColumn("_lead", inside).join(F.broadcast(after), [*keys, "_block"], "left").withColumn(
        name, F.coalesce("_lead", "_after")).drop("_pair", "_block", "_lead", "_after")
