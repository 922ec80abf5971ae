"""Shared parts of the corpus operators: intermediate tables, keys, words, spans."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.skew import shared_folder

#: Words of a text, and what lies between them, after A-Z became a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: ASCII white space.
BLANK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tables up to this many bytes (as Arrow or row data) may be broadcast.
BROADCAST_BYTES = 32 << 20
#: Rows that a task hands to Python at a time in the pipeline.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a table to the shared folder and go on from there: a lost executor costs a re-read."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Tasks hand whole texts to Python ``BATCH_ROWS`` at a time from here on, unless the session asks for fewer.

    A batch is held by the JVM, in buffers of powers of two, and by Python; with Spark's 10,000 rows it is as large as a task's input.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    spark.conf.set(name, str(min(now, BATCH_ROWS) if now > 0 else BATCH_ROWS))


def column(df: DataFrame, name: str, default: str) -> Column:
    """A column by name, or a typed null where the table lacks it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(default).alias(name)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of words of a text (null: empty array). Split once; separators at the ends leave empty strings."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NO_WORD, -1), "")


# --- spans of patterns, in SQL ------------------------------------------------

def pieces(text: Column, pattern: str, kind: int, when: Column) -> Column:
    """Array of (kind, before, found): the matches in order, each with the text between it and the one before.

    The last entry has the rest of the text and no match. Both functions walk the text with the same
    leftmost, non-overlapping search, so they agree on every match.
    """
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    typed = F.transform(zipped, lambda z: F.struct(
        F.lit(kind).alias("kind"), z["before"].alias("before"), z["found"].alias("found")))
    return F.when(when, typed).otherwise(F.array().cast("array<struct<kind:int,before:string,found:string>>"))


def positions(rows: DataFrame, row: str = "rid") -> DataFrame:
    """Add start and end (code points, end exclusive) to exploded pieces ``(row, kind, pos, before, found)``."""
    upto = Window.partitionBy(row, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.coalesce(F.char_length("found"), F.lit(0))
    end = F.sum(F.char_length("before").cast("long") + size).over(upto)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - size)


def joined(spans: Column, names: list[str], by_kind: bool) -> Column:
    """``kind:start:end`` of an array of (kind, start, end), comma-joined in the contract's order."""
    order = ["kind", "start", "end"] if by_kind else ["start", "kind", "end"]
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in order])))
    named = F.array(*map(F.lit, names))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.element_at(named, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


# --- words and shingles of many texts at once, in numpy ---------------------------

_IS_WORD = np.ones(256, bool)
_IS_WORD[:0x30] = _IS_WORD[0x3A:0x41] = _IS_WORD[0x5B:0x61] = _IS_WORD[0x7B:0x80] = False
_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: near numbers end far apart."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(column) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of an Arrow string column, and the row it stands in.

    The texts are one byte buffer. A word's hash is a difference of running sums of byte times power,
    shifted to the word's start, so no loop over words or rows is needed.
    """
    import pyarrow as pa

    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    first, last = int(offsets[0]) if len(offsets) else 0, int(offsets[-1]) if len(offsets) else 0
    if last == first:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[first:last]
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IS_WORD[data]
    cut = np.zeros(len(data) + 1, bool)  # a row's first byte starts a word of its own
    cut[offsets[:-1] - first] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | cut))
    ends = np.flatnonzero(before & (~inside | cut))
    power = np.full(len(data) + 1, _BASE)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_FOLD[data] + np.uint64(1)) * power[:-1], out=running[1:])
    back = np.full(int(starts[-1]) + 1 if len(starts) else 1, _BASE_INVERSE)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    hashes = mix((running[ends] - running[starts]) * back[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(offsets - first, starts, side="right") - 1


def shingles(column, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words (of all words, in texts of fewer), and their rows, row by row."""
    hashes, rows = word_hashes(column)
    if not len(hashes):
        return hashes, rows
    n = np.bincount(rows, minlength=len(column))
    first = np.concatenate(([0], np.cumsum(n)[:-1]))
    left = (first + n)[rows] - np.arange(len(rows))  # words from here to the end of the text
    out = np.zeros(len(hashes), np.uint64)
    for k in range(size):
        part = np.zeros(len(hashes), np.uint64)
        part[: max(0, len(hashes) - k)] = hashes[k:]
        out = np.where(left > k, mix(out * np.uint64(0x2545F4914F6CDD1D) + part + np.uint64(k + 1)), out)
    whole = (left >= size) | ((n[rows] < size) & (left == n[rows]))
    return out[whole], rows[whole]
