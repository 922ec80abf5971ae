"""Exact neighbour search over vectors, in cells that are stored once.

Rows with equal vectors become one weighted point. Points are assigned to the
nearest of a bounded set of pivots (a Voronoi cell) and stored by cell in the shared
folder. A query only visits the cells that the triangle inequality cannot rule out
(cf. Lu et al., "Efficient processing of k nearest neighbor joins using MapReduce",
2012). A task holds a block of queries and reads the files of one group of cells after
the other, nearest first; what it finds narrows the search of the rest. So points and
queries are moved once, however many cells a query visits, memory is bounded by the
blocks, and what a task returns is per query, never per pair or visited cell.
"""

from __future__ import annotations

import math
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, functions as F

from .skew import checkpointed, shared_folder

MAX_PIVOTS = 2048
CHUNK_ROWS = 2000
#: Rows compared at a time, rows of queries in a task, pairs measured at a time, and bytes of cells that a worker keeps.
BLOCK_QUERIES, BLOCK_POINTS, TASK_QUERIES, PAIRS, KEPT_BYTES = 1024, 4096, 1024, 1 << 18, 64 << 20
#: Queries that go through the cells together where a search compares ``SLICE`` of them at a time.
PASS_QUERIES, SLICE = 4096, 512
MOST_TASKS = 4096
_SLACK = 1e-9
_LAST = np.iinfo(np.int64).max


def weighted_points(matrix: DataFrame) -> DataFrame:
    """(gid, weight, features): one point per distinct vector; ``gid`` is its smallest row id."""
    return matrix.groupBy("features").agg(
        F.min("tx_id").cast("long").alias("gid"), F.count(F.lit(1)).alias("weight"))


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T, 0.0)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(squares(a, b))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(-1))


def _stack(col: pd.Series) -> np.ndarray:
    return np.stack(col.to_numpy()).astype(float)


@dataclass
class CellIndex:
    """Points stored by cell, and the bounded description of the cells."""

    points: DataFrame
    pivots: np.ndarray
    radius: np.ndarray
    counts: dict[int, int]
    chunk_rows: int


def write_by_cell(df: DataFrame, path: str) -> None:
    """A folder per cell. Ranges of cells and ids keep tasks even, also where one cell holds most rows."""
    df.repartitionByRange("cell", "gid").sortWithinPartitions("cell").write.mode("overwrite").partitionBy("cell").parquet(path)


def by_cell(df: DataFrame) -> DataFrame:
    """The table written by cell to the shared folder, as :func:`scan` reads it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
    write_by_cell(df, path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def build_index(points: DataFrame, chunk_rows: int = CHUNK_ROWS) -> CellIndex:
    n = points.count()
    # Pivots are random points, so dense regions get more (and smaller) cells. Far more cells than rows in a cell would
    # cost more in opened files than they rule out.
    wanted = min(MAX_PIVOTS, max(1, min(math.ceil(n / chunk_rows), math.isqrt(n))))
    rows = points.orderBy(F.xxhash64("gid"), "gid").limit(wanted).select("features").collect()
    pivots = np.array([r[0] for r in rows], dtype=float)
    shared = points.sparkSession.sparkContext.broadcast(pivots)

    @F.pandas_udf("struct<cell int, own double>")
    def nearest(features: pd.Series) -> pd.DataFrame:
        x = _stack(features)
        d = distances(x, shared.value)
        cell = d.argmin(1)
        return pd.DataFrame({"cell": cell.astype(np.int32), "own": _exact(x, shared.value[cell])})

    placed = checkpointed(points.withColumn("_at", nearest("features")).select(
        "gid", "weight", "features", "_at.cell", "_at.own"))
    stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("r")).collect()
    radius = np.zeros(len(pivots))
    for s in stats:
        radius[s["cell"]] = s["r"]
    return CellIndex(by_cell(placed), pivots, radius, {s["cell"]: s["n"] for s in stats}, chunk_rows)


def _arrays(table: pa.Table | pa.RecordBatch) -> dict[str, np.ndarray]:
    """Columns as arrays; lists of equal length as one matrix."""
    out = {}
    for name in table.schema.names:
        col = table.column(name)
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        if pa.types.is_list(col.type):
            flat = col.flatten().to_numpy(zero_copy_only=False)
            out[name] = flat.reshape(len(col), len(flat) // max(1, len(col))).astype(float, copy=False)
        else:
            out[name] = col.to_numpy(zero_copy_only=False)
    return out


class StoredCells:
    """Cells as a task sees them: bounds from the pivots, rows from the files."""

    def __init__(self, pivots: np.ndarray, radius: np.ndarray, counts: dict[int, int], files: dict[int, list[str]], columns: list[str]):
        self.used = np.array(sorted(files), dtype=np.int64)
        self.pivots, self.radius, self.files, self.columns = pivots, radius[self.used], files, columns
        self.rows = np.array([counts[c] for c in self.used])
        self.kept: OrderedDict = OrderedDict()
        self.bytes = 0

    def bounds(self, x: np.ndarray, home: np.ndarray) -> np.ndarray:
        """No point of a used cell is nearer to the query than this."""
        sq = squares(x, self.pivots)
        noise = 1e-12 * max(1.0, float((x * x).sum(1).max()) + float((self.pivots * self.pivots).sum(1).max()))
        own, there = sq[np.arange(len(x)), home][:, None], sq[:, self.used]
        centres, at = np.unique(home, return_inverse=True)
        gap = distances(self.pivots[centres], self.pivots[self.used])[at]
        # Distance to the plane between the own pivot and the other one.
        plane = np.where(gap > 0, (there - own - noise) / np.where(gap > 0, 2 * gap, 1.0), 0.0)
        bound = np.maximum(plane, np.sqrt(np.maximum(there - noise, 0.0)) - self.radius)
        bound[self.used[None, :] == home[:, None]] = 0.0
        return bound

    def read(self, cell: int) -> Iterator[dict[str, np.ndarray]]:
        """Rows of a cell in pieces of bounded size; small cells are kept for the next block of queries."""
        if cell in self.kept:
            self.kept.move_to_end(cell)
            yield from self.kept[cell]
            return
        pieces, size = [], 0
        for uri in self.files[cell]:
            source, path = pa.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
            with source.open_input_file(path) as file:
                for batch in pa.parquet.ParquetFile(file).iter_batches(BLOCK_POINTS, columns=self.columns):
                    piece = _arrays(batch)
                    size += sum(a.nbytes for a in piece.values())
                    if size <= KEPT_BYTES // 4:
                        pieces.append(piece)
                    yield piece
        if size <= KEPT_BYTES // 4:
            self.kept[cell] = pieces
            self.bytes += size
            while self.bytes > KEPT_BYTES:
                self.bytes -= sum(a.nbytes for p in self.kept.popitem(last=False)[1] for a in p.values())

    def visit(self, q: dict[str, np.ndarray], search) -> None:
        """Show ``search`` the rows of every cell that is not ruled out, the nearest cells first."""
        bound = search.ruled_out(self.bounds(q["features"], q["cell"]), self.used)
        group, active, rows = [], np.zeros(len(bound), bool), 0
        order = np.argsort(bound.min(0), kind="stable")
        for n, c in enumerate(order):
            asks = bound[:, c] <= search.limit() * (1 + _SLACK) + _SLACK
            if asks.any():
                group.append(int(self.used[c]))
                active, rows = active | asks, rows + self.rows[c]
            if group and (rows >= BLOCK_POINTS or n == len(order) - 1):
                self.show(group, np.flatnonzero(active), search)
                group, active, rows = [], np.zeros(len(bound), bool), 0

    def show(self, group: list[int], active: np.ndarray, search) -> None:
        held, rows = [], 0
        for cell in group:
            for piece in self.read(cell):
                held.append(piece)
                rows += len(piece["gid"])
                if rows >= BLOCK_POINTS:
                    search.meet(active, {k: np.concatenate([h[k] for h in held]) for k in held[0]})
                    held, rows = [], 0
        if held:
            search.meet(active, {k: np.concatenate([h[k] for h in held]) for k in held[0]})


class Search:
    """What a scan looks for on behalf of one block of queries ``q`` (arrays by column)."""

    def __init__(self, q: dict[str, np.ndarray]):
        self.q, self.n = q, len(q["gid"])

    def limit(self) -> np.ndarray:
        """Per query the distance beyond which no point matters."""
        raise NotImplementedError

    def ruled_out(self, bound: np.ndarray, cells: np.ndarray) -> np.ndarray:
        return bound

    def meet(self, active: np.ndarray, p: dict[str, np.ndarray]) -> None:
        """Compare the ``active`` queries with some points."""
        raise NotImplementedError

    def result(self) -> pa.RecordBatch:
        raise NotImplementedError


def scan(
    index: CellIndex, queries: DataFrame, points: DataFrame, columns: list[str], make, schema: str, block: int = BLOCK_QUERIES,
) -> DataFrame:
    """Run ``make(q)``, a :class:`Search`, for every ``block`` of queries over the ``points`` that are stored by cell.

    ``queries`` have ``gid``, ``features`` and ``cell``; they move once, to tasks of neighbouring cells.
    """
    files: dict[int, list[str]] = {}
    for uri in points.inputFiles():  # as many as cells, and one more for each task that wrote them
        if "/cell=" in uri:
            files.setdefault(int(uri.rsplit("/cell=", 1)[1].split("/")[0]), []).append(uri)
    facts = (index.pivots, index.radius, index.counts, {c: sorted(f) for c, f in files.items()}, ["gid", "features", *columns])
    shared = queries.sparkSession.sparkContext.broadcast(facts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = StoredCells(*shared.value)
        for batch in batches:
            for a in range(0, batch.num_rows, block):
                q = _arrays(batch.slice(a, block))
                search = make(q)
                cells.visit(q, search)
                yield search.result()

    # A task reads the cells once for its queries, so in large tables it holds more of them, while every core still has tasks.
    rows = queries.count()
    share = min(block, max(TASK_QUERIES, rows // (4 * queries.sparkSession.sparkContext.defaultParallelism)))
    tasks = min(MOST_TASKS, math.ceil(rows / share))
    if tasks > 1:
        queries = queries.repartitionByRange(tasks, "cell", "gid")
    return queries.sortWithinPartitions("cell", "gid").mapInArrow(run, schema)


def some_rows(counts: np.ndarray) -> Iterator[slice]:
    """Slices of rows whose counts add up to at most ``PAIRS`` (a single row may have more)."""
    at, total = 0, np.cumsum(counts)
    while at < len(counts):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + PAIRS, side="right")))
        yield slice(at, end)
        at = end


def positions(hits: np.ndarray) -> np.ndarray:
    """Flat positions where ``hits`` is true, in order. Few are, so eight at a time are looked at first."""
    flat = hits.ravel()
    whole = len(flat) // 8 * 8
    at = (8 * np.flatnonzero(flat[:whole].view(np.uint64))[:, None] + np.arange(8)).ravel()
    return np.concatenate([at[flat[at]], whole + np.flatnonzero(flat[whole:])])


def near_pairs(x: np.ndarray, y: np.ndarray, limit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, float]]:
    """(i, j, squares, noise): pairs whose squared distance may be within ``limit`` (one per row of ``x``), with that square.

    No pair inside the limit is missing, and no square is off by more than ``noise``. One product a slice decides, in single
    precision where its rounding is small against the limits; ``i`` ascends.
    """
    xs, ys = (x * x).sum(1), (y * y).sum(1)
    scale = max(float(xs.max()), float(ys.max()))
    # Beyond four times the scale no limit excludes anything.
    limit = np.minimum(limit, 4.0 * scale + 1.0)
    kind, noise = np.float64, 1e-9 * max(1.0, scale)
    single = 4 * (x.shape[1] + 8) * 2.0**-24 * scale
    if 1e-20 < scale < 1e30 and single <= 0.01 * float(np.median(limit)):
        kind, noise = np.float32, single
    right = np.concatenate([y, -ys[:, None]], axis=1).astype(kind).T
    for a in range(0, len(x), SLICE):
        part = slice(a, a + SLICE)
        left = np.concatenate([2.0 * x[part], np.ones((len(x[part]), 1))], axis=1).astype(kind)
        near = left @ right
        least = xs[part] - limit[part] - noise
        at = positions(near >= least.astype(kind)[:, None])
        if len(at):
            i, j = np.divmod(at, len(y))
            yield i + a, j, xs[part][i] - near.ravel()[at], 2 * noise


class _Nearest(Search):
    def __init__(self, q, k):
        super().__init__(q)
        self.k = k
        self.dist, self.nid = np.full((self.n, k), np.inf), np.full((self.n, k), _LAST)
        self.weight = np.zeros((self.n, k), np.int64)

    def limit(self):
        return self.dist[:, -1]

    def meet(self, active, p):
        x, y = self.q["features"][active], p["features"]
        far = self.dist[active, -1] ** 2
        unset = np.flatnonzero(np.isinf(far))
        if len(unset) and len(y) >= self.k:
            for some in np.array_split(unset, math.ceil(len(unset) / SLICE)):
                far[some] = np.partition(squares(x[some], y), self.k - 1, axis=1)[:, self.k - 1]
            far[unset] += 1e-9 * max(1.0, float((x * x).sum(1).max()), float((y * y).sum(1).max()))
        # Products round; what may lie inside the limit is measured again without shortcuts.
        for i, j, _, _ in near_pairs(x, y, far):
            counts = np.bincount(i - i[0])
            ends = np.concatenate([[0], np.cumsum(counts)])
            for rows in some_rows(counts):
                part = slice(ends[rows.start], ends[rows.stop])
                self._meet(active, x, y, p, i[part], j[part])

    def _meet(self, active, x, y, p, i, j):
        dist = _exact(x[i], y[j])
        closer = dist <= self.dist[active[i], -1]
        if closer.any():
            i, j = i[closer], j[closer]
            found, at = np.unique(i, return_inverse=True)
            self._merge(active[found], at, dist[closer], p["gid"][j], p["weight"][j])

    def _merge(self, rows, i, dist, nid, weight):
        """The ``k`` nearest of old and new, by (distance, id); ``i`` numbers the ``rows``."""
        k = self.k
        i = np.concatenate([i, np.repeat(np.arange(len(rows)), k)])
        dist, nid, weight = (np.concatenate([a, b[rows].ravel()]) for a, b in (
            (dist, self.dist), (nid, self.nid), (weight, self.weight)))
        order = np.lexsort((nid, dist, i))
        i = i[order]
        rank = np.arange(len(i)) - np.searchsorted(i, np.arange(len(rows)))[i]
        order, at = order[rank < k], (rows[i[rank < k]], rank[rank < k])
        self.dist[at], self.nid[at], self.weight[at] = dist[order], nid[order], weight[order]

    def result(self):
        real = np.isfinite(self.dist)
        items = pa.StructArray.from_arrays(
            [pa.array(self.dist[real]), pa.array(self.nid[real]), pa.array(self.weight[real])], ["dist", "nid", "nweight"])
        ends = np.concatenate([[0], np.cumsum(real.sum(1))]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.q["gid"]), pa.ListArray.from_arrays(pa.array(ends), items)], ["gid", "neighbours"])


def _nearest_kernel(k: int):
    def kernel(qs: pd.DataFrame, ps: pd.DataFrame) -> pd.DataFrame:
        if len(qs) == 0:
            return pd.DataFrame({"gid": [], "nid": [], "dist": [], "nweight": []})
        x, y = _stack(qs["features"]), _stack(ps["features"])
        m = min(k + 8, len(y))
        d = distances(x, y)
        near = np.argpartition(d, m - 1, axis=1)[:, :m] if m < len(y) else np.tile(np.arange(len(y)), (len(x), 1))
        exact = _exact(x[:, None, :], y[near])
        nid = ps["gid"].to_numpy()[near]
        order = np.lexsort((nid, exact), axis=1)[:, :k]
        take = lambda a: np.take_along_axis(a, order, axis=1)
        w = ps["weight"].to_numpy()[near]
        return pd.DataFrame({
            "gid": qs["gid"].to_numpy(), "nid": list(take(nid)), "dist": list(take(exact)), "nweight": list(take(w))})
    return kernel


_LISTS = "gid long, nid array<long>, dist array<double>, nweight array<long>"


_NEIGHBOURS = "gid long, neighbours array<struct<dist double, nid long, nweight long>>"


def nearest_points(index: CellIndex, k: int) -> DataFrame:
    """(gid, neighbours): the ``k`` nearest weighted points of every point, itself included, by (distance, id)."""
    return _search(index, index.points, k)


def nearest_to(index: CellIndex, queries: DataFrame, k: int) -> DataFrame:
    """(gid, neighbours): the ``k`` nearest weighted points of every row of (gid, features), indexed or not."""
    used = np.array(sorted(index.counts))
    shared = queries.sparkSession.sparkContext.broadcast((used, index.pivots[used]))

    @F.pandas_udf("int")
    def cell(features: pd.Series) -> pd.Series:
        numbers, pivots = shared.value
        return pd.Series(numbers[distances(_stack(features), pivots).argmin(1)] if len(features) else [], dtype="int32")

    return _search(index, checkpointed(queries.select("gid", "features", cell("features").alias("cell"))), k)


def _search(index: CellIndex, placed: DataFrame, k: int) -> DataFrame:
    return scan(index, placed.select("gid", "features", "cell"), index.points, ["weight"], lambda q: _Nearest(q, k), _NEIGHBOURS, PASS_QUERIES)


def within(d: np.ndarray, x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """Which pairs are within ``eps``; pairs at the edge are measured again without shortcuts."""
    hit = d <= eps
    scale = max(1.0, float((x * x).sum(1).max()), float((y * y).sum(1).max()))
    i, j = np.nonzero(np.abs(d * d - eps * eps) <= 1e-9 * scale)
    hit[i, j] = _exact(x[i], y[j]) <= eps
    return hit
