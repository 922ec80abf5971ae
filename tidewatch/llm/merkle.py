"""Operator 12: a Merkle manifest of a dataset whose nodes keep SHA-256 midstates.

Every row is a leaf; leaves form one tree per source, the subroots form the tree above them. A digest
as hex text is 64 bytes, one block of SHA-256, so the state of a parent's hash before a child slot
is eight words. A parent keeps that state for each slot. Folding a replaced leaf resumes the parent's
state at the leaf's slot with the new digest and the siblings to the right of it; what lies to the left
is never hashed again.

Trees are built and folded in passes of ``LEVELS`` levels. In a pass, the nodes of one tree are cut into blocks
of 3 ** LEVELS neighbours; a block is a bounded group that holds the whole subtree above its nodes. So the number of
shuffles is the depth divided by ``LEVELS``, a hot source is many blocks, and no task holds a tree. Leaves are
put in order by a range partitioning and numbered inside their partition; one row per source and partition adds
what lies before. From the top down, a block hands the path above a node to the block below, one row
per block, and the lowest pass folds all leaves of a block at once.

Defined results: null fields are written as ``-``; null sources are one source, first in order; a null id comes first
in its source and is never tampered with; rows with the same id and source are ordered by their leaf;
equal rows are leaves of their own; an empty table has no rows and no root; texts of any length
are hashed whole; columns other than the five are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored, table

FAN = 3
LEVELS = 6
_WIDE = FAN**LEVELS
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

# --- SHA-256 over many rows at once: states are (8, n), blocks (16, n) words ------------


def _cube_root(x: int) -> int:
    r = round(x ** (1 / 3))
    while r**3 > x:
        r -= 1
    while (r + 1) ** 3 <= x:
        r += 1
    return r


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, isqrt(p) + 1))]
#: The standard's constants: first 32 bits after the point of roots of primes.
_ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _PRIMES], np.uint32)
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _PRIMES[:8]], np.uint32)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states after one more block each."""
    w = [block[i] for i in range(16)]
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        if i >= 16:
            x, y = w[(i - 15) % 16], w[(i - 2) % 16]
            w[i % 16] = (
                w[i % 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3)))
                + w[(i - 7) % 16] + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[i] + w[i % 16]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n, 32) of hashes that have taken in so many whole blocks."""
    last = np.zeros((16, state.shape[1]), np.uint32)
    last[0], last[15] = 0x80000000, blocks.astype(np.uint32) * np.uint32(512)
    return raw(absorb(state, last))


def raw(state: np.ndarray) -> np.ndarray:
    """(8, n) words as (n, 32) bytes."""
    return np.ascontiguousarray(state.T).astype(">u4").view(np.uint8).reshape(-1, 32)


def unraw(data: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.ascontiguousarray(data).view(">u4").astype(np.uint32).reshape(-1, 8).T)


_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """(n, 32) digests as blocks (16, n) of their hex text."""
    text = np.empty((len(digests), 64), np.uint8)
    text[:, 0::2], text[:, 1::2] = _HEX[digests >> 4], _HEX[digests & 15]
    return np.ascontiguousarray(text.view(">u4").astype(np.uint32).T)


def _digests(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32)


# --- blocks ------------------------------------------------------------------------------

def whole_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows in portions that don't cut a block; adds ``g``, the block's number in the portion."""
    rest = None
    for part in batches:
        rows = part if rest is None else pd.concat([rest, part], ignore_index=True)
        edge = _edges(rows)
        rest = rows.iloc[edge[-1]:] if len(edge) else rows if len(rows) else None
        if len(edge):
            yield _numbered(rows.iloc[:edge[-1]])
    if rest is not None:
        yield _numbered(rest)


def _edges(rows: pd.DataFrame) -> np.ndarray:
    t, b = rows["tree"].to_numpy(object), rows["block"].to_numpy()
    return np.flatnonzero((t[1:] != t[:-1]) | (b[1:] != b[:-1])) + 1


def _numbered(rows: pd.DataFrame) -> pd.DataFrame:
    g = np.zeros(len(rows), np.int64)
    g[_edges(rows)] = 1
    return rows.assign(g=np.cumsum(g)).reset_index(drop=True)


NODE = "tree string, block long, level int, index long, digest binary, states binary"


def grow(base: int):
    """Build the levels above the nodes of a pass: one row per parent, with the state before each child slot."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_blocks(batches):
            tree, block, g = rows["tree"].to_numpy(object), rows["block"].to_numpy(), rows["g"].to_numpy()
            index, depth, digest = rows["index"].to_numpy(), rows["depth"].to_numpy(), _digests(rows["digest"])
            for level in range(base, base + LEVELS):
                up = depth > level
                tree, block, g, index, depth, digest = (x[up] for x in (tree, block, g, index, depth, digest))
                if not len(g):
                    break
                parent = index // FAN
                first = np.flatnonzero(np.concatenate(([True], (g[1:] != g[:-1]) | (parent[1:] != parent[:-1]))))
                width = np.diff(np.append(first, len(g)))
                blocks, state = hex_blocks(digest), np.repeat(START[:, None], len(first), 1)
                kept = np.empty((len(first), FAN, 32), np.uint8)
                for slot in range(FAN):
                    kept[:, slot] = raw(state)
                    has = width > slot
                    state[:, has] = absorb(state[:, has], blocks[:, first[has] + slot])
                tree, block, g, index, depth, digest = tree[first], block[first], g[first], parent[first], depth[first], finish(state, width)
                yield pd.DataFrame({
                    "tree": tree, "block": block, "level": np.int32(level + 1), "index": index,
                    "digest": [x.tobytes() for x in digest], "states": [k[:w].tobytes() for k, w in zip(kept, width)]})

    return run


class Climb:
    """The way from the lowest nodes of whole blocks to the top of their blocks, all at once."""

    def __init__(self, rows: pd.DataFrame, base: int):
        self.rows, self.base = rows, base
        level = rows["level"].to_numpy()
        self.level = {l: rows[level == l] for l in range(base, base + LEVELS + 1)}
        path = rows[level < 0]
        self.path = path.set_index("g")
        self.leaves = self.level[base]
        self.g = self.leaves["g"].to_numpy()

    def _places(self, rows: pd.DataFrame, up: int) -> np.ndarray:
        """Where nodes stand in their block, above the places of the blocks before."""
        return rows["g"].to_numpy() * _WIDE + rows["index"].to_numpy() - rows["block"].to_numpy() * FAN ** (LEVELS - up)

    def steps(self):
        """Per level: who climbs, slot, width, state before the slot, place of the first child, digests of all children."""
        who, place = np.arange(len(self.leaves)), self._places(self.leaves, 0)
        below = self.leaves
        for up in range(1, LEVELS + 1):
            parents = self.level[self.base + up]
            if not len(parents):
                return
            g, local = self.g[who], place - self.g[who] * _WIDE
            here, wanted = self._places(parents, up), g * _WIDE + local // FAN
            at = np.searchsorted(here, wanted)
            on = here[np.minimum(at, len(here) - 1)] == wanted
            who, place, at, slot = who[on], wanted[on], at[on], (local % FAN)[on]
            child = np.searchsorted(self._places(below, up - 1), g[on] * _WIDE + local[on] // FAN * FAN)
            states = parents["states"].to_numpy(object)
            width = np.array([len(s) // 32 for s in states], np.int64)[at]
            padded = np.frombuffer(b"".join(s.ljust(32 * FAN, b"\0") for s in states), np.uint8).reshape(-1, FAN, 32)
            yield who, slot, width, unraw(padded[at, slot]), child, _digests(below["digest"])
            below = parents


#: One step of a path: state before the slot, siblings to the right, width, those siblings' digests.
_STEP = 32 + 1 + 1 + 32 * (FAN - 1)
PATH = "tree string, index long, steps binary, siblings string"


def hand_down(base: int):
    """The path above each node of a pass, from its block's parents and the path above its block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_blocks(batches):
            climb = Climb(rows, base)
            steps, names = [[] for _ in climb.g], [[] for _ in climb.g]
            for who, slot, width, state, child, digests in climb.steps():
                state = raw(state)
                for k, (i, s, w, c) in enumerate(zip(who, slot, width, child)):
                    right = digests[c + s + 1:c + w].tobytes()
                    steps[i].append(state[k].tobytes() + bytes([w - s - 1, w]) + right.ljust(32 * (FAN - 1), b"\0"))
                    names[i].append(digests[c:c + s].tobytes().hex() + right.hex())
            over, said = (climb.path[c].loc[climb.g].to_numpy(object) for c in ("states", "siblings"))
            yield pd.DataFrame({
                "tree": climb.leaves["tree"].to_numpy(object), "index": climb.leaves["index"].to_numpy(),
                "steps": [b"".join(s) + o for s, o in zip(steps, over)], "siblings": ["".join(n) + o for n, o in zip(names, said)]})

    return run


FOLDED = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Fold every leaf of whole blocks to the root, with its replacement where it has one."""
    for rows in whole_blocks(batches):
        climb = Climb(rows, 0)
        own = climb.leaves["digest"].to_numpy(object)
        now = _digests([r if r is not None else d for r, d in zip(climb.leaves["replaced"].to_numpy(object), own)]).copy()
        proofs = [[] for _ in own]
        for who, slot, width, state, child, digests in climb.steps():
            blocks, names = hex_blocks(digests), [d.tobytes().hex() for d in digests]
            state = absorb(state, hex_blocks(now[who]))
            for s in range(1, FAN):
                right = (s > slot) & (s < width)
                state[:, right] = absorb(state[:, right], blocks[:, child[right] + s])
            now[who] = finish(state, width)
            for i, s, w, c in zip(who.tolist(), slot.tolist(), width.tolist(), child.tolist()):
                proofs[i] += [names[c + k] for k in range(w) if k != s]
        path = climb.path.sort_index()
        steps = path["states"].to_numpy(object)
        n, most = np.array([len(s) // _STEP for s in steps]), max(map(len, steps)) // _STEP
        above = np.frombuffer(b"".join(s.ljust(most * _STEP, b"\0") for s in steps), np.uint8).reshape(len(steps), most, _STEP)
        for t in range(most):
            who = np.flatnonzero(n[climb.g] > t)
            step = above[climb.g[who], t]
            state = absorb(unraw(step[:, :32]), hex_blocks(now[who]))
            for s in range(FAN - 1):
                right = step[:, 32] > s
                state[:, right] = absorb(state[:, right], hex_blocks(step[right, 34 + 32 * s:66 + 32 * s]))
            now[who] = finish(state, step[:, 33])
        said, subroot, root = (path[c].to_numpy(object)[climb.g] for c in ("siblings", "digest", "replaced"))
        folded = [x.tobytes() for x in now]
        yield pd.DataFrame({
            "id": climb.leaves["id"].to_numpy(object), "leaf": [d.hex() for d in own], "subroot": [s.hex() for s in subroot],
            "root": [r.hex() for r in root],
            "proof_sha256": [hashlib.sha256(("".join(p) + s).encode()).hexdigest() for p, s in zip(proofs, said)],
            "folded_root": [f.hex() for f in folded], "verified": [f == r for f, r in zip(folded, root)]})


# --- tables ---------------------------------------------------------------------------------

def in_blocks(nodes: DataFrame) -> DataFrame:
    """Blocks in one task each, in order."""
    return nodes.repartition("tree", "block").sortWithinPartitions("tree", "block", "level", "index")


def depth_of(n: Column) -> Column:
    """Levels above ``n`` leaves: the least d with 3 ** d >= n."""
    return sum((F.when(n > FAN**i, 1).otherwise(0) for i in range(1, 39)), F.when(n > 1, 1).otherwise(0)).cast("int")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``index`` (place in its tree, from 0) and ``depth`` of the tree, without a tree in one task."""
    placed = stored(rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order).withColumn(
        "_row", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id()), "leaves")
    parts = placed.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("tree").orderBy("_part")
    offsets = stored(parts.select(
        "tree", "_part", (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_shift"),
        depth_of(F.sum("_n").over(Window.partitionBy("tree"))).alias("depth")), "offsets")
    return placed.join(offsets, ["tree", "_part"]).withColumn("index", F.col("_row") + F.col("_shift")).drop("_row", "_part", "_shift")


@dataclass
class Forest:
    """Numbered leaves, and per pass the table of parents with their states."""

    leaves: DataFrame
    parents: list[DataFrame]

    def roots(self) -> DataFrame:
        """(tree, digest, depth) of every tree."""
        found = self.leaves.filter("depth = 0").select("tree", "digest", "depth")
        for p in self.parents:
            found = found.unionByName(p.filter("level = depth").select("tree", "digest", "depth"))
        return found

    def nodes(self, k: int) -> DataFrame:
        """The lowest nodes of pass ``k``: leaves, or the tops of the blocks below."""
        rows = self.leaves.withColumn("level", F.lit(0)) if k == 0 else self.parents[k - 1].filter(
            (F.col("level") == k * LEVELS) & (F.col("depth") > k * LEVELS))
        return rows.withColumn("block", F.floor(F.col("index") / _WIDE).cast("long"))

    def paths(self, k: int, tops: DataFrame) -> DataFrame:
        """(tree, block, steps, siblings) above every block of pass ``k``; ``tops`` has the path above every tree."""
        last = F.greatest(F.floor((F.col("depth") - 1) / LEVELS), F.lit(0))
        own = tops.join(self.roots().select("tree", "depth"), "tree").filter(last == k).select(
            "tree", F.lit(0).cast("long").alias("block"), "steps", "siblings")
        if k + 1 >= len(self.parents):
            return own
        rows = self._stream(k + 1, self.nodes(k + 1), self.paths(k + 1, tops))
        down = in_blocks(rows).mapInPandas(hand_down((k + 1) * LEVELS), PATH)
        return stored(own.unionByName(down.withColumnRenamed("index", "block")), "paths")

    def _stream(self, k: int, nodes: DataFrame, paths: DataFrame, *more: str) -> DataFrame:
        """Nodes, parents and path rows (level -1) of a pass in one shape."""
        empty = F.unhex(F.lit(""))
        low = nodes.select("tree", "block", "level", "index", "digest", empty.alias("states"), F.lit("").alias("siblings"), *more)
        high = paths.select(
            "tree", "block", F.lit(-1).alias("level"), F.lit(-1).cast("long").alias("index"),
            (F.col("digest") if "digest" in paths.columns else empty).alias("digest"), F.col("steps").alias("states"), "siblings",
            *[F.col(c) if c in paths.columns else F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in more])
        out = low.unionByName(high)
        if k < len(self.parents):
            out = out.unionByName(self.parents[k].select(
                "tree", "block", "level", "index", "digest", "states", F.lit("").alias("siblings"),
                *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in more]))
        return out


def forest(leaves: DataFrame, order: list[str]) -> Forest:
    """Build all trees of (tree, digest, ...) rows in the given order; one written table per pass."""
    out = Forest(numbered(leaves, order), [])
    deepest = out.leaves.agg(F.max("depth")).first()[0] or 0
    for k in range(-(-deepest // LEVELS)):
        nodes = out.nodes(k)
        made = in_blocks(nodes.select("tree", "block", "level", "index", "depth", "digest")).mapInPandas(grow(k * LEVELS), NODE)
        depths = out.leaves.select("tree", "depth").distinct()
        out.parents.append(stored(made.join(depths, "tree"), "parents"))
    return out


@dataclass
class Manifest:
    """Trees of the sources, the tree above them, and the root's digest (None without rows)."""

    sources: Forest
    top: Forest
    root: bytes | None


def manifest(leaves: DataFrame) -> Manifest:
    """From (tree, id, digest, replaced): tree names sort as the sources do."""
    sources = forest(leaves, ["id_order", "digest"])
    tops = sources.roots().select(F.lit("").alias("tree"), "digest", F.col("tree").alias("name"))
    top = forest(tops, ["name"])
    found = top.roots().select("digest").first()  # one digest
    return Manifest(sources, top, bytes(found[0]) if found else None)


def folded(book: Manifest) -> DataFrame:
    """Every leaf folded to the root: with ``replaced`` where it has a value, with its own digest elsewhere."""
    spark = book.sources.leaves.sparkSession
    if book.root is None:
        return spark.createDataFrame([], FOLDED)
    nothing = spark.range(1).select(F.lit("").alias("tree"), F.unhex(F.lit("")).alias("steps"), F.lit("").alias("siblings"))
    rows = book.top._stream(0, book.top.nodes(0), book.top.paths(0, nothing))
    names = book.top.leaves.select("index", F.col("name"), F.col("digest").alias("subroot"))
    tops = stored(in_blocks(rows).mapInPandas(hand_down(0), PATH).drop("tree").join(names, "index").select(
        F.col("name").alias("tree"), "steps", "siblings", "subroot"), "tops")
    paths = book.sources.paths(0, tops).join(tops.select("tree", F.col("subroot").alias("digest")), "tree").withColumn(
        "replaced", F.unhex(F.lit(book.root.hex())))
    stream = book.sources._stream(0, book.sources.nodes(0), paths, "replaced", "id")
    return in_blocks(stream).mapInPandas(fold, FOLDED)


# --- documents as leaves ------------------------------------------------------------------------

def leaf_digest(*fields: Column) -> Column:
    """sha256 of the fields, each as its size in bytes, a colon and its value, ``-`` for null."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def document_leaves(docs: DataFrame) -> DataFrame:
    """(tree, id, id_order, digest, replaced): the leaf of every row, and that of its text without line feeds where it is tampered with."""
    fields = [F.col(c) for c in FIELDS]
    chosen = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.col("text").contains("\n")
    other = leaf_digest(*fields[:-1], F.replace(fields[-1], F.lit("\n"), F.lit("")))
    return docs.select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("tree"), F.col("doc_id").cast("string").alias("id"),
        F.col("doc_id").alias("id_order"), leaf_digest(*fields).alias("digest"), F.when(chosen, other).alias("replaced"))


def op12_midstate_tree(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = folded(manifest(document_leaves(docs)))
    return out.withColumn("id", F.col("id").cast(docs.schema["doc_id"].dataType)).withColumnRenamed("id", "doc_id")


_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, *, doc_id IS NOT NULL AND 1 & xor(4294967295::UBIGINT, list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::UBIGINT)),
           lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda k: 0::UBIGINT)),
             lambda a, z: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)))) = 0 AS chosen
  FROM documents),
fields AS (
  SELECT rid, doc_id, source, chosen, text, concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
           coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS start FROM docs),
hashed AS (
  SELECT rid, doc_id, source, sha256(start || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN chosen AND text IS NOT NULL THEN sha256(start || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), '')) END AS changed
  FROM fields),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS size FROM hashed),
tree AS (
  SELECT source, 0 AS level, place AS idx, leaf AS digest, size AS n FROM leaves
  UNION ALL
  SELECT source, level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM tree WHERE n > 1 GROUP BY source, level, idx // 3, n),
subs AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS size FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS level, place AS idx, subroot AS digest, size AS n FROM subs
  UNION ALL
  SELECT level + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY level, idx // 3, n),
steps AS (
  SELECT l.rid, t.level, string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx < l.place // pow(3, t.level)::BIGINT) AS lefts,
         string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx > l.place // pow(3, t.level)::BIGINT) AS rights
  FROM leaves l JOIN tree t ON l.source IS NOT DISTINCT FROM t.source AND t.n > 1 AND t.idx // 3 = l.place // pow(3, t.level + 1)::BIGINT
  GROUP BY l.rid, t.level
  UNION ALL
  SELECT l.rid, 100 + t.level, string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx < s.place // pow(3, t.level)::BIGINT),
         string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx > s.place // pow(3, t.level)::BIGINT)
  FROM leaves l JOIN subs s ON l.source IS NOT DISTINCT FROM s.source
  JOIN top t ON t.n > 1 AND t.idx // 3 = s.place // pow(3, t.level + 1)::BIGINT
  GROUP BY l.rid, t.level),
ways AS (
  SELECT rid, list(struct_pack(a := coalesce(lefts, ''), b := coalesce(rights, '')) ORDER BY level) AS way FROM steps GROUP BY rid),
climb AS (
  SELECT l.rid, coalesce(l.changed, l.leaf) AS digest, coalesce(w.way, []) AS way, 1 AS i FROM leaves l LEFT JOIN ways w USING (rid)
  UNION ALL
  SELECT rid, sha256(way[i].a || digest || way[i].b), way, i + 1 FROM climb WHERE i <= len(way)),
done AS (
  SELECT rid, digest AS folded_root, sha256(array_to_string(list_transform(way, lambda s: s.a || s.b), '')) AS proof_sha256 FROM climb WHERE i > len(way))
SELECT l.doc_id, l.leaf, s.subroot, r.digest AS root, d.proof_sha256, d.folded_root, d.folded_root = r.digest AS verified
FROM leaves l JOIN subs s ON l.source IS NOT DISTINCT FROM s.source JOIN done d USING (rid) CROSS JOIN (SELECT digest FROM top WHERE n = 1) r
"""

QUERIES = {"op12_midstate_tree": op12_midstate_tree}
ORACLES = {"op12_midstate_tree": _SQL}
