"""Operator 8: benchmark decontamination by a prefix-filtered set join, in SQL functions only.

An item window (13 words in a row, or a whole shorter item) must occur in a document in
full. Its tokens are ordered by rarity in all documents; for full containment the necessary
prefix is one token, the rarest. Documents are joined on that token alone; the window's place
around the token gives length and positional bounds, and the words at that place are compared
one by one.

The windows of a block of items, checked to be below ``broadcast_bytes``, are broadcast, and the
documents are never shuffled; a larger benchmark is taken in blocks, each against all documents.

Defined results: a null or empty text, and one without words, has no words, no hits and is
not contaminated; an item without words has no windows; items with a null id have windows and count
as one item that is left out of the list; repeated items count once by id; repeated documents are rows of
their own; an empty benchmark hits nothing; columns beyond id and text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from .common import BROADCAST_BYTES, stored, table, words

WINDOW = 13
#: A document is contaminated from this share of its words on.
SHARE = 20


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item_id, window): distinct arrays of words of every item."""
    parts = items.select("item_id", words(F.col("text")).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - size + 1))
    return parts.select("item_id", "words", F.explode(starts).alias("at")).select(
        "item_id", F.slice("words", F.col("at"), F.least(F.lit(size), F.size("words"))).alias("window")).distinct()


def rarities(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(token, n): how often each token of the vocabulary occurs in all documents."""
    found = docs.select(F.explode(words(F.col("text"))).alias("token")).join(F.broadcast(vocabulary), "token")
    counts = found.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return vocabulary.join(counts, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))


def prefixes(windows: DataFrame, rarity: DataFrame) -> DataFrame:
    """Add the necessary prefix of each window: its rarest token and that token's place (from 0)."""
    placed = windows.select("item_id", "window", F.posexplode("window").alias("place", "token"))
    best = placed.join(rarity, "token").groupBy("item_id", "window").agg(F.min(F.struct("n", "token", "place")).alias("rarest"))
    return best.select("item_id", "window", F.col("rarest.token").alias("token"), F.col("rarest.place").alias("place"))


def decontaminate(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, share: int = SHARE, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(rid, doc_id, n_words, n_hit, n_items, items_sha256, contaminated), one row per document."""
    return _judged(_hits(docs.select("doc_id", "text"), items, size, broadcast_bytes), share)


def _blocks(windows: DataFrame, broadcast_bytes: int) -> list[DataFrame]:
    # 16 bytes for a word in a row of an array, and its characters.
    measured = windows.agg(F.sum(F.lit(64) + F.aggregate("window", F.lit(0).cast("long"), lambda n, w: n + 16 + F.octet_length(w)))).first()[0] or 0
    blocks = max(1, math.ceil(2 * measured / broadcast_bytes))
    return [windows] if blocks == 1 else [
        windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b) for b in range(blocks)]


def _hits(docs: DataFrame, items: DataFrame, size: int, broadcast_bytes: int, keep: tuple = ()) -> DataFrame:
    """One row (rid, doc_id, n_words, null) per document, and one per occurrence of a window (start, end, item_id)."""
    windows = stored(item_windows(items, size), "bench-windows")
    tokens = docs.withColumn("rid", F.monotonically_increasing_id()).withColumn("words", words(F.col("text")))
    out = None
    for b, block in enumerate(_blocks(windows, broadcast_bytes)):
        vocabulary = block.select(F.explode("window").alias("token")).distinct()
        table_ = stored(prefixes(block, rarities(docs, vocabulary)).withColumn("length", F.size("window")), "bench-prefixes")
        placed = tokens.select("rid", "doc_id", "words", F.posexplode_outer("words").alias("pos", "token"))
        joined = placed.join(F.broadcast(table_), "token", "left")
        start = F.col("pos") - F.col("place")
        inside = (start >= 0) & (start + F.col("length") <= F.size("words"))
        same = F.when(inside, F.slice("words", F.when(inside, start + 1).otherwise(1), F.col("length")) == F.col("window")).otherwise(False)
        hit = joined.withColumn("hit", F.col("window").isNotNull() & same)
        first = F.coalesce(F.col("pos") == 0, F.lit(True)) if b == 0 else F.lit(False)
        rows = hit.filter(F.col("hit") | first).select(
            "rid", "doc_id", F.when(first, F.size("words")).alias("n_words"),
            F.when(F.col("hit"), start).alias("start"), F.when(F.col("hit"), start + F.col("length")).alias("end"),
            F.when(F.col("hit"), F.col("item_id")).alias("item_id"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _judged(hits: DataFrame, share: int) -> DataFrame:
    """Fold a document's occurrences: positions covered by their union, and the items they belong to."""
    spans = hits.groupBy("rid", "doc_id", "start", "end").agg(
        F.max("n_words").alias("n_words"), F.collect_set("item_id").alias("items"))
    before = Window.partitionBy("rid").orderBy(F.col("start").asc_nulls_first(), "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    ids = F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_list("items"))), lambda i: i.cast("string")))
    return spans.withColumn("covered", covered).groupBy("rid", "doc_id").agg(
        F.coalesce(F.max("n_words"), F.lit(0)).cast("long").alias("n_words"),
        F.coalesce(F.sum("covered"), F.lit(0)).cast("long").alias("n_hit"), ids.alias("ids"),
    ).select(
        "rid", "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that aren't contaminated, with all their columns. A document is named by id and text."""
    marked = docs.select("doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    name = F.struct("doc_id", F.xxhash64("text").alias("key"))
    bad = decontaminate(marked.select(name.alias("doc_id"), "text"), items).filter("contaminated").select("doc_id.*").distinct()
    bad = stored(bad.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")), "bench-bad")
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_key")), "left_anti")


def op8_prefix_join(spark, sf_dir):
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("rid")


_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
doc_windows AS (
  SELECT rid, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT rid, s, n, item_id FROM doc_windows JOIN windows USING (n, win)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hits) GROUP BY rid),
named AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM (SELECT DISTINCT rid, item_id FROM hits) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (rid) LEFT JOIN named USING (rid)
"""

QUERIES = {"op8_prefix_join": op8_prefix_join}
ORACLES = {"op8_prefix_join": _SQL}
