"""Operator 10: near-duplicate detection with ProbMinHash.

A text is a bag of five-word shingles weighted by how often they occur. Each shingle
sends points at the times of a Poisson process whose rate is its weight; a point falls on
a random register, and a register keeps the shingle that arrives first. A shingle stops as
soon as its next arrival is later than every register's (early termination). Two texts
agree on a register with the probability Jaccard similarity of their bags.

Registers are grouped into bands. Texts that share a band are candidates; candidates are
verified exactly on their bags. Copies of one bag are folded before, so each bag is compared
once. Members of a bucket first meet its first member. Those that are near it are of its class and
need no comparison with each other; the rest of its companions is compared with all of them,
block by block inside tasks, which return classes and never pairs. So no link between classes
is missed.

Defined results: every row gives one row; texts without words (null, empty) are alone in their class; texts of
fewer than five words are one shingle; equal bags are one class; repeated rows, rows that repeat an id with another text and rows
without an id are members like any other, since bags are named by numbers of their own and texts by id and hash; the class id is the
smallest doc_id of its members, null if none has an id; of a class the row with the smallest id stays (null last, then by hash of
the text, then one of the equal rows); ids of any type that sorts are allowed; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.components import connected_components
from .common import BROADCAST_BYTES, mix, shingles, stored, table

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 6
#: Members that meet one leader in one task.
CHUNK = 32
#: Members of a block, of which two are compared in one task, and columns of their matrix at a time.
BLOCK = 256
COLUMNS = 1 << 14
#: Cells of a 0/1 matrix of texts and shingles; many texts are compared over fewer shingles at a time.
CELLS = 1 << 20
#: An upper bound for a row of six numbers in a broadcast table.
ROW_BYTES = 128
#: Words of texts that are hashed at a time; about 400 bytes of working memory each.
BATCH_WORDS = 50_000
_U = np.float64(2.0 ** -53)


def bags(column, size: int = SHINGLE):
    """(row, shingle, weight) of an Arrow string column, sorted by row and shingle."""
    hashes, rows = shingles(column, size)
    if not len(hashes):
        return rows, hashes, np.empty(0)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])))
    at = np.flatnonzero(new)
    return rows[at], hashes[at], np.diff(np.concatenate((at, [len(hashes)]))).astype(float)


def steps(column) -> list[int]:
    """Ends of runs of texts that are long enough together: memory follows the longest text, not the number of texts."""
    import pyarrow as pa
    chars = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0))
    return [*(np.flatnonzero(np.diff(np.cumsum(chars) // (6 * BATCH_WORDS))) + 1).tolist(), len(column)]


def bags_by_steps(column, size: int = SHINGLE):
    """As :func:`bags`, with the working memory of a step."""
    at, parts = 0, []
    for end in steps(column):
        if end > at:
            rows, items, weights = bags(column.slice(at, end - at), size)
            parts.append((rows + at, items, weights))
        at = end
    return tuple(map(np.concatenate, zip(*parts))) if parts else bags(column, size)


def signatures(rows: np.ndarray, items: np.ndarray, weights: np.ndarray, n_rows: int, registers: int) -> np.ndarray:
    """ProbMinHash registers of all rows at once: for each row and register the item that arrived first.

    Every round draws the next arrivals of the items that may still be early enough.
    """
    best = np.full(n_rows * registers, np.inf)
    owner = np.zeros(n_rows * registers, np.uint64)
    time = np.zeros(len(items))
    seeds = mix(items ^ np.uint64(0xD1B54A32D192ED03))
    live = np.arange(len(items))
    round_ = 0
    while len(live):
        ahead = max(1, min(64, 20_000 // len(live)))  # arrivals drawn at a time; drawing too many changes nothing
        step = np.arange(round_ + 1, round_ + ahead + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        round_ += ahead
        draw = mix(seeds[live, None] + step)
        wait = -np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * _U) / weights[live, None]
        arrived = time[live, None] + np.cumsum(wait, axis=1)
        time[live] = arrived[:, -1]
        register = (mix(draw ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(registers)).astype(np.int64)
        at = (rows[live, None] * registers + register).ravel()
        early = np.flatnonzero(arrived.ravel() < best[at])
        at, when, item = at[early], arrived.ravel()[early], np.repeat(items[live], ahead)[early]
        np.minimum.at(best, at, when)
        first = when == best[at]
        owner[at[first]] = item[first]
        table_ = best.reshape(n_rows, registers)
        latest = table_.max(axis=1)[rows[live]] if len(live) > n_rows else table_[rows[live]].max(axis=1)
        live = live[time[live] < latest]
    return owner.reshape(n_rows, registers)


def probability_jaccard(a, wa, b, wb) -> float:
    """Exact: sum over common items of 1 / sum of max(x_i / x_d, y_i / y_d), by one sort of the ratios."""
    items = np.union1d(a, b)
    x, y = np.zeros(len(items)), np.zeros(len(items))
    x[np.searchsorted(items, a)], y[np.searchsorted(items, b)] = wa, wb
    both = (x > 0) & (y > 0)
    if not both.any():
        return 0.0
    if x.max() == 1 and y.max() == 1:
        return float(np.count_nonzero(both) / len(items))
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio, kind="stable")
    x, y, both = x[order], y[order], both[order]
    # At d, items of smaller ratio weigh by y, the others by x.
    below, above = np.cumsum(y) - y, np.cumsum(x[::-1])[::-1]
    return float(np.sum(1 / (above[both] / x[both] + below[both] / y[both])))


def sketches(docs: DataFrame, size: int, bands: int, rows_per_band: int) -> DataFrame:
    """(doc_id, text_hash, bag, bands): ``bag`` names the bag of shingles (two 64-bit sums); both are null without words."""
    registers = bands * rows_per_band

    def sketched(batches):
        import pyarrow as pa
        for batch in batches:
            text, at = batch.column(1), 0
            for end in steps(text):
                if end > at:
                    part, n = text.slice(at, end - at), end - at
                    rows, items, weights = bags(part, size)
                    filled = np.bincount(rows, minlength=n) > 0
                    signed = signatures(rows, items, weights, n, registers).reshape(n * bands, rows_per_band)
                    band = np.tile(np.arange(bands, dtype=np.uint64), n)
                    for k in range(rows_per_band):
                        band = mix(band * np.uint64(0x2545F4914F6CDD1D) + signed[:, k])
                    w = weights.astype(np.uint64)
                    sums = np.zeros((2, n), np.uint64)
                    if len(rows):
                        heads = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1])))
                        for s, salt in zip(sums, (0x632BE59BD9B4E019, 0xE220A8397B1DCDAF)):
                            s[rows[heads]] = np.add.reduceat(mix(items ^ np.uint64(salt)) * (w * np.uint64(2) + np.uint64(1)), heads)
                    name = [f"{a:016x}{b:016x}" if f else None for a, b, f in zip(*sums, filled)]
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(band.view(np.int64)),
                        mask=pa.array(~filled))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(at, n), batch.column(2).slice(at, n), pa.array(name, pa.string()), lists],
                        names=["doc_id", "text_hash", "bag", "bands"])
                at = end

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", text_hash(docs).alias("text_hash")).mapInArrow(
        sketched, f"doc_id {kind}, text_hash long, bag string, bands array<long>")


def text_hash(docs: DataFrame) -> Column:
    """With the id, the name of a text."""
    return F.xxhash64(docs["text"])


def _with_texts(wanted: DataFrame, texts: DataFrame, heads: DataFrame) -> DataFrame:
    """Join the texts to the rows that ask for them by ``id``, the number of a bag.

    ``texts`` are (doc_id, text_hash, text) and hold the row of every head. Rows are few numbers each. Their count is
    measured: up to ``BROADCAST_BYTES`` they are broadcast and the texts that nobody asks for aren't moved; beyond it
    both sides are shuffled.
    """
    small = wanted.count() * ROW_BYTES <= BROADCAST_BYTES
    asked = wanted.join(heads.select("id", "head"), "id").select(*wanted.columns, F.col("head.doc_id").alias("_of"), F.col("head.text_hash").alias("_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("text_hash") == F.col("_hash"))
    return texts.join(F.broadcast(asked) if small else asked, same)


def verified(texts: DataFrame, heads: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """(src, dst, similarity) of all (leader, member) pairs of bags, with their exact similarity.

    Every text is sent once per chunk of members of its leader, so a leader of very many pairs is
    spread over tasks and a task holds one leader and ``CHUNK`` members at a time.
    """
    chunks = pairs.groupBy("leader").agg(F.count(F.lit(1)).alias("n")).withColumn("chunks", F.ceil(F.col("n") / CHUNK))
    salted = pairs.join(chunks, "leader").withColumn("chunk", F.pmod(F.xxhash64("member"), F.col("chunks")))
    wanted = stored(salted.select(F.col("member").alias("id"), "leader", "chunk").unionByName(
        chunks.select(F.col("leader").alias("id"), "leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    ), "near-wanted")
    sent = _with_texts(wanted, texts, heads).select("leader", "chunk", "id", "text")

    def compared(key, group):
        import pyarrow as pa
        leader = key[0].as_py()
        ids = np.asarray(group.column("id"))
        at = int(np.flatnonzero(ids == leader)[0])
        out = []
        text = group.column("text").combine_chunks()
        text = text if isinstance(text, pa.Array) else text.chunk(0)
        rows, items, weights = bags_by_steps(text, size)
        edge = np.searchsorted(rows, np.arange(len(ids) + 1))
        a, wa = items[edge[at]:edge[at + 1]], weights[edge[at]:edge[at + 1]]
        for i, other in enumerate(ids):
            if other != leader:
                part = slice(edge[i], edge[i + 1])
                out.append((leader, int(other), probability_jaccard(a, wa, items[part], weights[part])))
        src, dst, j = zip(*out) if out else ((), (), ())
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64()), "similarity": pa.array(j, pa.float64())})

    found = sent.groupBy("leader", "chunk").applyInArrow(compared, "src long, dst long, similarity double")
    return stored(found, "near-verified")


def similar(bags_: list, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Matrix of which texts of ``left`` and ``right`` (numbers of bags) are at least ``threshold`` similar.

    Common shingles are counted by products of 0/1 matrices, a slice of the shingles at a time. Without
    repeated shingles the similarity follows from the counts; other pairs are measured one by one, if
    the weight they have in common allows it.
    """
    n = len(bags_)
    rows = np.repeat(np.arange(n), [len(i) for i, _ in bags_])
    items, weights = np.concatenate([i for i, _ in bags_]), np.concatenate([w for _, w in bags_])
    size = np.bincount(rows, minlength=n).astype(float)
    share = weights / np.maximum(np.bincount(rows, weights, minlength=n), 1)[rows]
    plain = np.array([len(w) == 0 or w.max() == 1 for _, w in bags_])
    _, code, count = np.unique(items, return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1  # shingles of one text only can't be common
    common = count[code] > 1
    rows, share, column = rows[common], share[common], column[code][common]
    order = np.argsort(column, kind="stable")
    rows, share, column = rows[order], share[order], column[order]
    both = np.zeros((len(left), len(right)))
    of_left, of_right = np.zeros_like(both), np.zeros_like(both)
    width = max(1, min(COLUMNS, CELLS // max(1, n)))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, (first, first + width)))
        has = np.zeros((n, min(width, int(column[-1]) + 1 - first)), np.float32)
        has[rows[part], column[part] - first] = 1
        both += has[left] @ has[right].T
        if not plain.all():
            weigh = np.zeros_like(has)
            weigh[rows[part], column[part] - first] = share[part]
            of_left += weigh[left] @ has[right].T
            of_right += has[left] @ weigh[right].T
    near = both >= threshold * (size[left][:, None] + size[right][None, :] - both) - 1e-9
    near &= both > 0
    if not plain.all():
        odd = ~(plain[left][:, None] & plain[right][None, :])
        near &= ~odd
        for i, j in np.argwhere(odd & (np.minimum(of_left, of_right) >= threshold - 1e-4)):
            near[i, j] = probability_jaccard(*bags_[left[i]], *bags_[right[j]]) >= threshold
    return near


def compared_blocks(texts: DataFrame, heads: DataFrame, company: DataFrame, size: int, threshold: float) -> DataFrame:
    """(src, dst): links that join all companions of a leader that are near one of its ``rest``.

    Each side is cut into blocks by hash; a task holds two blocks and returns at most one row per text.
    """
    counts = company.groupBy("first").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"), F.ceil(F.count_if("rest") / BLOCK).alias("rests")).filter("rests > 0")
    dealt = company.join(counts, "first")
    block = lambda n: F.pmod(F.xxhash64("id", F.lit(10)), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    wanted = stored(
        dealt.select("first", "id", F.lit(False).alias("rest"), block("blocks").alias("a"), each("rests").alias("b")).unionByName(
            dealt.filter("rest").select("first", "id", "rest", each("blocks").alias("a"), block("rests").alias("b"))), "near-blocks")
    sent = _with_texts(wanted, texts, heads).select("first", "a", "b", "id", "rest", "text")

    def compared(key, group):
        import pyarrow as pa
        ids, rest = np.asarray(group.column("id")), np.asarray(group.column("rest"))
        own, at = np.unique(ids, return_index=True)
        text = group.column("text").combine_chunks()
        text = (text if isinstance(text, pa.Array) else text.chunk(0)).take(pa.array(at))
        rows, items, weights = bags_by_steps(text, size)
        edge = np.searchsorted(rows, np.arange(len(own) + 1))
        parts = [(items[a:b], weights[a:b]) for a, b in zip(edge[:-1], edge[1:])]
        left, right = np.searchsorted(own, ids[rest]), np.searchsorted(own, ids[~rest])
        near = similar(parts, left, right, threshold)
        label = np.arange(len(own))
        i, j = np.nonzero(near)
        i, j = left[i], right[j]
        while True:  # spread the smallest number along the links
            low = np.minimum(label[i], label[j])
            new = label.copy()
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
            if (new == label).all():
                break
            label = new
        moved = np.flatnonzero(label != np.arange(len(own)))
        return pa.table({"src": pa.array(own[label[moved]], pa.int64()), "dst": pa.array(own[moved], pa.int64())})

    return stored(sent.groupBy("first", "a", "b").applyInArrow(compared, "src long, dst long"), "near-links")


def near_groups(
    docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, bands: int = BANDS, rows_per_band: int = ROWS,
) -> DataFrame:
    """(doc_id, class_id, class_size, bag_id, kept) of every document; ``bag_id`` is the smallest id with the same bag."""
    return _members(docs, size, threshold, bands, rows_per_band).drop("text_hash")


def _members(docs: DataFrame, size: int, threshold: float, bands: int, rows_per_band: int) -> DataFrame:
    """The rows of ``near_groups`` with the hash of their text."""
    # Written out, so the numbers of rows and bags stay what they are.
    sketch = stored(sketches(docs, size, bands, rows_per_band).withColumn("row", F.monotonically_increasing_id()), "near-sketches")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    heads = sketch.filter(F.col("bag").isNotNull()).groupBy("bag").agg(
        F.min(place).alias("head"), F.first("bands").alias("bands"))
    heads = stored(heads.withColumn("id", F.monotonically_increasing_id()), "near-heads")
    members = heads.select("id", F.explode("bands").alias("hash"))
    hot = members.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").drop("last")
    hot = stored(hot, "near-buckets")
    # Only members of buckets of two or more go on.
    shared = stored(members.join(hot, "hash"), "near-members")
    texts = docs.select("doc_id", text_hash(docs).alias("text_hash"), "text")
    if _rows_repeat(sketch):
        texts = texts.groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"))
    nodes = heads.select("id")

    first = stored(shared.filter("id > first").select(F.col("first").alias("leader"), F.col("id").alias("member")).distinct(), "near-pairs")
    tested = verified(texts, heads, first, size)
    links = tested.filter(F.col("similarity") >= threshold).select("src", "dst")
    labels = stored(_components(nodes, links), "near-labels")
    # Companions of a leader outside its class may still be near others, whatever bucket they share.
    company = shared.select("first", "id").distinct().join(labels, "id").join(
        labels.select(F.col("id").alias("first"), F.col("label").alias("of")), "first")
    company = stored(company.select("first", "id", (F.col("label") != F.col("of")).alias("rest")), "near-company")
    if company.filter("rest").limit(1).count():
        links = links.unionByName(compared_blocks(texts, heads, company, size, threshold))
        labels = stored(_components(nodes, links), "near-labels")
    facts = heads.select("bag", "id", F.col("head.doc_id").alias("bag_id")).join(labels, "id").drop("id")
    named = stored(sketch.select("doc_id", "text_hash", "row", "bag").join(facts, "bag", "left"), "near-named")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "row")
    sizes = named.filter("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("class_size"), F.min(place).alias("stays"))
    out = named.join(sizes, "label", "left")
    alone = F.col("label").isNull()
    return out.select(
        "doc_id", "text_hash", F.when(alone, F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("bag_id")).alias("bag_id"),
        (alone | (F.col("row") == F.col("stays.row"))).alias("kept"))


def _rows_repeat(sketch: DataFrame) -> bool:
    """Whether a row with words is there twice, by id and text."""
    return sketch.filter("bag is not null").groupBy("doc_id", "text_hash").count().filter("count > 1").limit(1).count() > 0


def _components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, label) of every node. Only nodes with a link take part in the rounds."""
    touched = links.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    found = connected_components(touched, links).select("id", F.col("component").alias("label"))
    return nodes.join(found, "id", "left").select("id", F.coalesce("label", "id").alias("label"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents of which each class keeps one, with all their columns; documents without words stay."""
    rows = _members(docs, SHINGLE, THRESHOLD, BANDS, ROWS).groupBy("doc_id", "text_hash").agg(
        F.count_if("kept").alias("stay"), F.count_if(~F.col("kept")).alias("go"))
    # Equal rows have one name: where one of them stays and others go, they are named here and put back once.
    going = stored(rows.filter("go > 0").select(F.col("doc_id").alias("_of"), F.col("text_hash").alias("_hash"), (F.col("stay") > 0).alias("_one")), "near-gone")
    named = lambda rows, of: rows["doc_id"].eqNullSafe(of["_of"]) & (text_hash(rows) == of["_hash"])
    out = docs.join(going, named(docs, going), "left_anti")
    again = going.filter("_one")
    if again.limit(1).count():
        hashed = "_h" + "_".join(docs.columns)  # a name that no column has
        whole = docs.join(again, named(docs, again), "left_semi")
        out = out.unionByName(whole.withColumn(hashed, text_hash(whole)).dropDuplicates(["doc_id", hashed]).drop(hashed))
    return out


def op10_probminhash(spark, sf_dir):
    return near_groups(table(spark, sf_dir, "documents"))


QUERIES = {"op10_probminhash": op10_probminhash}
ORACLES = {}
