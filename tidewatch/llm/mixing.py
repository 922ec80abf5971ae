"""Operator 1: mixing sources to target weights by Pareto order sampling.

Each document has an expected number of copies. The whole part is certain; for the
fraction p the document draws u (a hash of its id and text) and is ranked by
``(u / (1 - u)) / (p / (1 - p))``. The documents lowest in this order are taken until
their sizes reach what the whole copies leave of the source's target, so a sample has
a fixed size in words and a document's inclusion probability is p, near enough.

The order is never sorted in one task: ranks are cut into equal slices of u, sizes
are summed per slice, and only the slice that holds the cut is sorted.

Defined results: a null or empty text has size 0 and is never taken; null sources
are one source, last in order; repeated rows are rows of their own; ties in rank are
broken by id and text hash; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import ScaleLimits
from .common import BLANK, stored, table

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
ROWS_PER_SLICE = 50_000
#: Rows of the table of sources that may be broadcast; one row is a name and six numbers.
SOURCES_BROADCAST = ScaleLimits().broadcast_rows


def text_size(text: Column) -> Column:
    """Number of runs of characters that aren't ASCII white space (null: 0)."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK, -1), "")).cast("long")


def draw(doc_id: Column) -> Column:
    """A number above 0 and below 1 from 52 bits of md5, which any engine can repeat."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))


def targets(sources: DataFrame, weights=WEIGHTS, most: float = MOST_REPEATS) -> DataFrame:
    """Add ``target`` to (source, source_size, ...): shares by weight, none above ``most`` times its size.

    Capping and resharing end where target = min(most * size, level * weight) adds up to the whole; the
    level follows from the sources sorted by most * size / weight. The table has one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ordered = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    upto, later = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.partitionBy(F.lit(0))
    return (
        sources.withColumn("weight", weight).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumns({
            "whole": F.sum("source_size").over(all_rows).cast("double"),
            "full": F.coalesce(F.sum("cap").over(upto), F.lit(0.0)),
            "open": F.sum("weight").over(later),
        })
        # The level if this source is the first below its cap; it is where this first holds.
        .withColumn("level", (F.col("whole") - F.col("full")) / F.col("open"))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(all_rows)["level"])
        .withColumn("target", F.when(F.col("level").isNull(), F.col("cap")).otherwise(
            F.least("cap", F.col("level") * F.col("weight"))))
        .drop("cap", "ratio", "whole", "full", "open", "level", "weight")
    )


def mix(docs: DataFrame, weights=WEIGHTS, most: float = MOST_REPEATS, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, tie) of every document; ``tie`` is the hash of its text."""
    facts = stored(docs.select(
        "doc_id", "source", text_size(F.col("text")).alias("size"),
        draw(F.col("doc_id")).alias("u"), F.xxhash64("text").alias("tie")), "sizes")
    sources = facts.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    plan = stored(targets(sources, weights, most).select(
        F.col("source").alias("name"), "source_size", "target",
        F.greatest(F.lit(1), F.ceil(F.col("n") / rows_per_slice)).alias("slices"),
        F.floor(F.try_divide(F.col("target"), F.col("source_size"))).cast("long").alias("certain"),
    ).withColumns({
        "certain": F.coalesce("certain", F.lit(0)),
        "p": F.coalesce(F.try_divide(F.col("target"), F.col("source_size")) - F.col("certain"), F.lit(0.0)),
        "rest": F.col("target") - F.coalesce("certain", F.lit(0)) * F.col("source_size"),
    }), "targets")
    small = plan.count() <= SOURCES_BROADCAST
    ranked = facts.join(F.broadcast(plan) if small else plan, F.col("source").eqNullSafe(F.col("name")), "left").drop("name")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    # The rank of a source's documents grows with u alone, so slices of u are slices of the order.
    ranked = ranked.withColumns({
        "rank": F.when(F.col("p") > 0, odds), "slice": F.floor(F.col("u") * F.col("slices")).cast("long")})
    sums = ranked.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    run = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        sums.withColumn("upto", F.sum("words").over(run)).filter(F.col("upto") >= F.col("rest"))
        .groupBy(F.col("source").alias("name")).agg(F.min(F.struct("slice", (F.col("upto") - F.col("words")).alias("before"))).alias("cut"))
        .select("name", F.col("cut.slice").alias("last"), F.col("cut.before").alias("before"))
    )
    placed = ranked.join(F.broadcast(cut) if small else cut, F.col("source").eqNullSafe(F.col("name")), "left").drop("name")
    edge = F.col("slice") == F.col("last")
    # Only the slices that hold a cut are sorted; the other rows need no window and aren't shuffled.
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sorted_edge = (
        placed.filter(edge).withColumn("_upto", F.col("before") + F.sum("size").over(order))
        .withColumn("_taken", F.col("_upto") - F.col("size") / 2 <= F.col("rest")).drop("_upto"))
    others = placed.filter(~F.coalesce(edge, F.lit(False))).withColumn(
        "_taken", F.coalesce(F.col("slice") < F.col("last"), F.lit(True)))
    picked = (F.col("p") > 0) & (F.col("size") > 0) & F.col("_taken")
    copies = F.when(F.col("size") > 0, F.col("certain") + F.when(picked, 1).otherwise(0)).otherwise(0).cast("long")
    return sorted_edge.unionByName(others).withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "tie")


def mixed_texts(docs: DataFrame, **how) -> DataFrame:
    """The documents that the mix takes, one row each with ``copies``, ``taken`` and the whole text.

    The mix is worked out without texts, which join at the end by id, source and text hash. Rows that agree in all
    three have one text, which is joined to each of them that is taken. Empty tables give empty results.
    """
    keys = ["doc_id", "source", "tie"]
    texts = docs.select("doc_id", "source", F.xxhash64("text").alias("tie"), "text").groupBy(*keys).agg(F.any_value("text").alias("text"))
    renamed = texts.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return mix(docs, **how).filter("copies > 0").join(renamed, same).select(
        "doc_id", "source", "text", "size", "source_size", "target", "copies", "taken")


def op1_pareto_mix(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


_SQL = r"""
WITH facts AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
         (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM facts GROUP BY source),
weighted AS (
  SELECT *, list_extract([5.0, 2.0, 1.0], (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
         3.0::DOUBLE * source_size AS cap FROM sources),
levels AS (
  SELECT *, cap / weight AS ratio,
         (sum(source_size) OVER ()::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
plan AS (
  SELECT source, source_size,
         least(cap, (SELECT min(struct_pack(r := ratio, l := level)) FROM levels WHERE level <= ratio).l * weight) AS target FROM levels),
parts AS (
  SELECT f.doc_id, f.size, f.u, p.source, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size)::BIGINT ELSE 0 END AS certain
  FROM facts f JOIN plan p ON f.source IS NOT DISTINCT FROM p.source),
ranked AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size - certain ELSE 0 END AS p, target - certain * source_size AS rest,
         sum(size) OVER (PARTITION BY source ORDER BY u, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM parts),
copied AS (
  SELECT *, CASE WHEN size > 0 THEN certain + CASE WHEN p > 0 AND upto - size / 2 <= rest THEN 1 ELSE 0 END ELSE 0 END::BIGINT AS copies FROM ranked)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies FROM copied
"""

QUERIES = {"op1_pareto_mix": op1_pareto_mix}
ORACLES = {"op1_pareto_mix": _SQL}
