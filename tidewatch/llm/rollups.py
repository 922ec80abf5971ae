"""Operator 6: token counts as delta-maintained rollups.

A change feed of signed rows (insert +, delete -, revision - old and + new) is folded per batch to one
row per (source, lang, tokenizer) and written under the batch's number; then a commit record
is written. Totals add up the deltas of committed batches. A batch that is delivered again is
not applied again; a batch that failed before its commit overwrites what it left. No change reads or
rewrites earlier totals.

Tokens are counted by a public byte-level vocabulary whose file is a parameter; every Python worker loads
it once. Sums are folded before the shuffle, so a hot source is one row per task.

Defined results: a null or empty text has 0 tokens and counts as a document; null sources and
languages are groups of their own; repeated rows count each time; groups whose documents and tokens add up
to zero are left out of the totals; a store without commits has no rows; columns beyond id, text,
source and lang are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import new_folder, stored, table
from .mixing import text_size

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
BPE, BLANKS = "byte_bpe_50k", "blank_separated"
#: How a byte-level vocabulary cuts a text before merging (fixed value).
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEYS = ["source", "lang", "tokenizer"]
_ENCODERS: dict = {}


def encoder(path: str):
    """The tokenizer of a vocabulary file, once per process."""
    if path not in _ENCODERS:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_counter(path: str = VOCABULARY):
    """Column function: number of tokens of a text."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(path).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return counted


class Rollup:
    """A store of signed deltas and commits in a folder that all executors reach."""

    DELTA = "source string, lang string, tokenizer string, docs long, tokens long"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.deltas, self.commits = spark, f"{path}/deltas", f"{path}/commits"
        # So that reading an empty store works.
        spark.createDataFrame([], "id long").write.mode("append").parquet(self.commits)

    def committed(self) -> DataFrame:
        return self.spark.read.schema("id long").parquet(self.commits)

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Apply signed changes (source, lang, tokenizer, sign, tokens) once; False if the batch is known."""
        if self.committed().filter(F.col("id") == batch).limit(1).count():
            return False
        delta = changes.groupBy(*KEYS).agg(
            F.sum("sign").cast("long").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).cast("long").alias("tokens"))
        delta.write.mode("overwrite").parquet(f"{self.deltas}/batch={batch}")
        self.spark.range(batch, batch + 1, 1, 1).select("id").write.mode("append").parquet(self.commits)
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all committed batches."""
        ids = [r["id"] for r in self.committed().distinct().orderBy("id").collect()]  # one number per commit since the last compaction
        if not ids:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, n_docs long, n_tokens long")
        rows = self.spark.read.schema(self.DELTA).parquet(*[f"{self.deltas}/batch={i}" for i in ids])
        return rows.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens")).filter("n_docs <> 0 or n_tokens <> 0")


def inserts(rows: DataFrame, tokenizer: str, tokens: str, sign: int = 1) -> DataFrame:
    return rows.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).alias("sign"), F.col(tokens).alias("tokens"))


def revisions(rows: DataFrame, before: tuple[str, str], after: tuple[str, str]) -> DataFrame:
    """A revised count takes the old one back: two signed rows per document."""
    return inserts(rows, *before, sign=-1).unionByName(inserts(rows, *after))


def copies(counts: DataFrame) -> DataFrame:
    """All rows of each text but one, by (sha256, id): their counts and how many they are."""
    same = counts.groupBy("sha", "source", "lang", "bpe").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("id"))
    best = F.struct(F.col("id").isNull(), F.col("id"), F.col("source"), F.col("lang"))
    kept = same.groupBy("sha").agg(F.min(best).alias("kept"))
    return same.join(kept, "sha").withColumn("gone", F.col("n") - F.when(best.eqNullSafe(F.col("kept")), 1).otherwise(0)).filter("gone > 0")


def op6_token_rollups(spark, sf_dir, vocabulary: str = VOCABULARY):
    """Load all documents under a rough count, revise every count to the vocabulary's, delete repeated texts.

    The second batch is delivered twice. What remains are the tokens of distinct texts.
    """
    docs = table(spark, sf_dir, "documents")
    counts = stored(docs.select(
        "doc_id", "source", "lang", text_size(F.col("text")).alias("blanks"), token_counter(vocabulary)("text").alias("bpe"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha")), "token-counts")
    rollup = Rollup(spark, new_folder(spark, "rollup"))
    rollup.commit(1, inserts(counts, BLANKS, "blanks"))
    for _ in range(2):
        rollup.commit(2, revisions(counts, (BLANKS, "blanks"), (BPE, "bpe")))
    rollup.commit(3, copies(counts).select(
        "source", "lang", F.lit(BPE).alias("tokenizer"), (-F.col("gone")).alias("sign"), F.col("bpe").alias("tokens")))
    return rollup.totals()


QUERIES = {"op6_token_rollups": op6_token_rollups}
ORACLES = {}
