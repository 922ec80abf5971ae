"""Operator 13: hard negatives by an inverted multi-index.

Vectors are cut into two halves. Each half has a codebook of k centres, fitted on a bounded sample
(``SAMPLE_ROWS`` rows on average, twice that at most), and the pair of nearest centres is a vector's cell. All rows are indexed. For an anchor
q and centre c of a half, q . c + |q| * radius(c) bounds the half's part of the inner product with every row
under that centre, so the sum of two such half-scores bounds a cell. The bounds of a half are sorted, and a
heap walks the grid of pairs from the highest sum down (multi-sequence). It needs no score of a row.

An anchor visits its next cells in rounds, ``GROWTH`` times as many in each. After a round, an anchor whose result
is certified leaves: five positives above the bound of the next cell, or per score window three negatives
above that bound, or a bound below the window. So the result is exact, whatever the codebooks are; they
only decide how many cells are visited. Positives are found first, since the windows hang on their scores.

In a round, cells are joined by their number: the rows of a cell are cut into chunks of ``CHUNK_ROWS``, its visitors into
batches of ``QUERY_ROWS``, and one task compares one batch with one chunk, so a cell that holds (or draws)
a third of all rows is many tasks. What a task returns is at most the wanted rows per visitor.

Defined results: rows with a null label, null vector, or null or non-finite component take no part; components
count as 0 beyond a vector's end; an empty vector scores 0 with everything; rows that repeat an id are rows of
their own, and anchors of their own; null ids are no anchors and come last among equal scores; anchors
without others of their label have no rows; an empty table gives an empty result. Scores are exact
while they stay below 2 ** 53. Columns other than vec_id, label and embedding are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored, table

SAMPLE_ROWS = 10_000
CELL_ROWS = 1_000
MOST_CODES = 256
CHUNK_ROWS = 2_048
QUERY_ROWS = 1_024
FIRST_VISITS, GROWTH = 8, 4
POSITIVES, NEGATIVES = 5, 3
#: Stands for a null id inside tasks: it comes last.
NO_ID = (1 << 63) - 1


def _stack(column: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(column), dims))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def taking_part(rows: DataFrame) -> DataFrame:
    """(key, label, vec): whole-number vectors of the rows that count, with every seventh label moved on."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.filter(F.col("label").isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("key"), moved.cast("long").alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * 256).cast("double")).alias("vec"))


def centres(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's centres of a bounded sample; an empty centre keeps its place."""
    distinct = np.unique(points, axis=0)
    at = distinct[np.linspace(0, len(distinct) - 1, min(k, len(distinct))).astype(int)]
    for _ in range(rounds):
        near = _nearest(points, at)[0]
        n = np.bincount(near, minlength=len(at))
        total = np.zeros_like(at)
        np.add.at(total, near, points)
        at = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], at)
    return at


def _nearest(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = (points**2).sum(1)[:, None] - 2 * points @ at.T + (at**2).sum(1)[None, :]
    near = d.argmin(1)
    return near, np.sqrt(((points - at[near]) ** 2).sum(1))


@dataclass
class MultiIndex:
    """All rows with their cell, and what a walk needs: codebooks, radii, rows per cell (bounded by ``MOST_CODES`` squared)."""

    rows: DataFrame
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    sizes: dict[int, int]

    @property
    def split(self) -> int:
        return self.books[0].shape[1]

    @property
    def dims(self) -> int:
        return self.split + self.books[1].shape[1]


def build(points: DataFrame, cell_rows: int = CELL_ROWS, sample_rows: int = SAMPLE_ROWS) -> MultiIndex | None:
    """Fit the codebooks on a sample by hash, place every row, measure the radii over all rows."""
    points = stored(points.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    n, dims = points.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    if not n:
        return None
    dims = max(2, dims)
    draw = F.pmod(F.xxhash64("key", "rid"), F.lit(1 << 30)) < math.ceil((1 << 30) * min(1.0, sample_rows / n))
    sample = points.filter(draw).select("vec").limit(2 * sample_rows).toPandas()["vec"]
    if not len(sample):  # a draw of few rows may be empty
        sample = points.select("vec").limit(1).toPandas()["vec"]
    x, half = _stack(sample, dims), dims // 2
    k = min(MOST_CODES, max(2, math.ceil(math.sqrt(n / cell_rows))))
    books = centres(x[:, :half], k), centres(x[:, half:], k)
    shared = points.sparkSession.sparkContext.broadcast(books)

    @F.pandas_udf("struct<cell int, far0 double, far1 double>")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vecs in batches:
            v, (one, two) = _stack(vecs, dims), shared.value
            (a, far0), (b, far1) = _nearest(v[:, :half], one), _nearest(v[:, half:], two)
            yield pd.DataFrame({"cell": (a * len(two) + b).astype(np.int32), "far0": far0, "far1": far1})

    placed = stored(points.withColumn("_p", place("vec")).select("key", "label", "vec", "rid", "_p.*"), "cells")
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far0").alias("r0"), F.max("far1").alias("r1")).collect()
    radii = np.zeros(len(books[0])), np.zeros(len(books[1]))
    for c in cells:
        for side, code in enumerate(divmod(c["cell"], len(books[1]))):
            radii[side][code] = max(radii[side][code], c[f"r{side}"])
    return MultiIndex(placed.drop("far0", "far1"), books, radii, {c["cell"]: c["n"] for c in cells})


def walk(half0: np.ndarray, half1: np.ndarray, sizes: dict[int, int]) -> Iterator[tuple[int, float]]:
    """Cells that hold rows by falling sum of half-scores; a heap holds the border of the visited part of the grid."""
    one, two = np.argsort(-half0, kind="stable"), np.argsort(-half1, kind="stable")
    heap, left = [(-(half0[one[0]] + half1[two[0]]), 0, 0)], len(sizes)
    while heap and left:
        bound, i, j = heapq.heappop(heap)
        cell = int(one[i]) * len(two) + int(two[j])
        if cell in sizes:
            left -= 1
            yield cell, -bound
        if j + 1 < len(two):
            heapq.heappush(heap, (-(half0[one[i]] + half1[two[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(one):  # each pair is reached one way only
            heapq.heappush(heap, (-(half0[one[i + 1]] + half1[two[0]]), i + 1, 0))


def next_cells(index: MultiIndex, anchors: DataFrame, done: int, upto: int) -> DataFrame:
    """Add ``cells`` (visits ``done`` to ``upto`` of each anchor) and ``bound``, that of the cell after them (null: none)."""
    shared = anchors.sparkSession.sparkContext.broadcast((index.books, index.radii, index.sizes))
    split, dims = index.split, index.dims

    @F.pandas_udf("struct<cells array<int>, bound double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        books, radii, sizes = shared.value
        for vecs in batches:
            q, out = _stack(vecs, dims), []
            halves = [
                h @ b.T + np.sqrt((h**2).sum(1))[:, None] * r[None, :]
                for h, b, r in zip((q[:, :split], q[:, split:]), books, radii)]
            slack = 1e-9 * (1 + (q**2).sum(1)) + 1e-6  # rounding must not lower a bound
            for i in range(len(q)):
                way, cells, bound = walk(halves[0][i], halves[1][i], sizes), [], None
                for k, (cell, b) in enumerate(way):
                    if k == upto:
                        bound = b + slack[i] + 1e-9 * abs(b)
                        break
                    if k >= done:
                        cells.append(cell)
                out.append((cells, bound))
            yield pd.DataFrame(out, columns=["cells", "bound"])

    return anchors.withColumn("_w", run("vec")).select("*", "_w.*").drop("_w")


def best_of(value: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` highest finite values of each row; of equal ones, the first columns."""
    k = min(k, value.shape[1])
    edge = -np.partition(-value, k - 1, axis=1)[:, k - 1]
    row, col = np.nonzero((value >= edge[:, None]) & np.isfinite(value))
    order = np.lexsort((col, -value[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, row)
    keep = np.arange(len(row)) - first < k
    return row[keep], col[keep]


FOUND = "anchor long, slot int, score long, key long, rid long"


def _compare(wanted: int, windows: bool, dims: int):
    """Scores of one batch of visitors with one chunk of a cell: the best in each of the visitors' slots."""

    def run(qs: pd.DataFrame, ps: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"anchor": [], "slot": [], "score": [], "key": [], "rid": []}, dtype="int64")]
        if len(qs) and len(ps):
            ps = ps.sort_values(["key", "rid"])
            y, label, key, rid = _stack(ps["vec"], dims), ps["label"].to_numpy(), ps["key"].to_numpy(), ps["rid"].to_numpy()
            for a in range(0, len(qs), QUERY_ROWS):
                q = qs.iloc[a:a + QUERY_ROWS]
                score, own = _stack(q["vec"], dims) @ y.T, q["rid"].to_numpy()
                same = q["label"].to_numpy()[:, None] == label[None, :]
                if windows:
                    score[same] = -np.inf
                    low, high = _stack(q["low"], POSITIVES), _stack(q["high"], POSITIVES)
                    high[np.arange(POSITIVES)[None, :] >= q["low"].map(len).to_numpy()[:, None]] = -np.inf
                    masks = [(s, np.where((score >= low[:, s:s + 1]) & (score <= high[:, s:s + 1]), score, -np.inf)) for s in range(POSITIVES)]
                else:
                    masks = [(0, np.where(same & (own[:, None] != rid[None, :]), score, -np.inf))]
                for slot, value in masks:
                    r, c = best_of(value, wanted)
                    out.append(pd.DataFrame({
                        "anchor": own[r], "slot": slot, "score": value[r, c].astype(np.int64), "key": key[c], "rid": rid[c]}))
        return pd.concat(out, ignore_index=True)

    return run


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows per anchor and slot with their ``place``."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "key", "rid")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def visit(index: MultiIndex, visitors: DataFrame, wanted: int, windows: bool) -> DataFrame:
    """Compare every visitor with all rows of its ``cells``."""
    carried = ["rid", "vec", "label"] + (["low", "high"] if windows else [])
    visits = visitors.select(*carried, F.explode("cells").alias("cell"))
    sizes = index.rows.sparkSession.createDataFrame(list(index.sizes.items()), "cell int, n long")
    load = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    plan = stored(load.join(F.broadcast(sizes), "cell").select(
        "cell", F.ceil(F.col("n") / CHUNK_ROWS).alias("chunks"), F.ceil(F.col("m") / QUERY_ROWS).alias("batches")), "plan")
    plan = F.broadcast(plan)  # a row per cell, at most MOST_CODES squared
    part = lambda n: F.pmod(F.xxhash64("rid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    q = visits.join(plan, "cell").withColumn("batch", part("batches")).withColumn("chunk", every("chunks")).drop("chunks", "batches")
    p = index.rows.join(plan, "cell").withColumn("chunk", part("chunks")).withColumn("batch", every("batches")).drop("chunks", "batches")
    keys = ("cell", "chunk", "batch")
    return q.groupBy(*keys).cogroup(p.groupBy(*keys)).applyInPandas(_compare(wanted, windows, index.dims), FOUND)


def search(index: MultiIndex, anchors: DataFrame, wanted: int, windows: bool) -> DataFrame:
    """Rounds of visits until every anchor is certified: (anchor, slot, score, key, rid, place)."""
    spark = index.rows.sparkSession
    found, visiting, done, step = spark.createDataFrame([], FOUND + ", place int"), anchors, 0, FIRST_VISITS
    while True:
        visitors = stored(next_cells(index, visiting, done, done + step), "visitors")
        new = visit(index, visitors, wanted, windows)
        found = stored(best(found.drop("place").unionByName(new), wanted), "found")
        last = found.filter(F.col("place") == wanted).groupBy(F.col("anchor").alias("rid")).agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("_last"))  # at most five slots
        open_ = visitors.filter(F.col("bound").isNotNull()).join(last, "rid", "left")
        sure = lambda slot: F.coalesce(F.try_element_at("_last", slot) > F.col("bound"), F.lit(False))
        if windows:
            certified = F.forall(F.sequence(F.lit(0), F.size("low") - 1), lambda s: sure(s) | (F.col("bound") < F.get("low", s)))
        else:
            certified = sure(F.lit(0))
        visiting = stored(open_.filter(~certified).select(*anchors.columns), "open")
        done, step = done + step, step * GROWTH
        if not visiting.limit(1).count():
            return found


def hard_negatives(rows: DataFrame, is_anchor: Column, cell_rows: int = CELL_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (key, label, vec) rows.

    ``is_anchor`` is a condition on key, label and vec.
    """
    spark, index = rows.sparkSession, build(rows, cell_rows, sample_rows)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if index is None:
        return spark.createDataFrame([], schema)
    anchors = index.rows.filter(is_anchor).select("rid", "key", "label", "vec")
    positives = search(index, anchors, POSITIVES, windows=False)
    # Whole scores s with 50 * positive <= 100 * s <= 95 * positive; a window of a negative positive is empty.
    s = F.col("score")
    windows = positives.filter("score >= 0").groupBy(F.col("anchor").alias("rid")).agg(
        F.array_sort(F.collect_list(F.struct("place", s.alias("score")))).alias("w"))  # at most five
    asked = stored(anchors.join(windows, "rid").select(
        "rid", "key", "label", "vec", F.transform("w", lambda p: F.ceil(p["score"] / 2).cast("double")).alias("low"),
        F.transform("w", lambda p: F.floor(p["score"] * 95 / 100).cast("double")).alias("high")), "windows")
    negatives = search(index, asked, NEGATIVES, windows=True)
    names = index.rows.select(F.col("rid").alias("anchor"), F.col("key").alias("anchor_id"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    pairs = positives.select(
        "anchor", (F.col("place") - 1).alias("slot"), F.col("key").alias("positive_id"), s.alias("positive_score"))
    return negatives.select("anchor", "slot", F.col("place").alias("rank"), F.col("key").alias("negative_id"), s.alias("negative_score")).join(
        pairs, ["anchor", "slot"]).join(names, "anchor").select(
        "anchor_id", real("positive_id"), "rank", real("negative_id"), "positive_score", "negative_score")


def op13_multi_index(spark, sf_dir):
    return hard_negatives(taking_part(table(spark, sf_dir, "embeddings")), (F.col("key") != NO_ID) & (F.col("key") % 50 == 0))


_SQL = r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_dot_product(a.vec, b.vec)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, s.other_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 3
"""

QUERIES = {"op13_multi_index": op13_multi_index}
ORACLES = {"op13_multi_index": _SQL}
