"""Operator 9: language identification with language-bitmask n-gram filters.

Every language owns one bit of a mask. A filter is a bit-sliced Bloom filter: an array of
masks, where inserting an n-gram of a language sets the language's bit at its k positions,
and the AND of the k masks names all languages that contain an n-gram. A text's n-grams
are looked up, counted per language, corrected for the filter's measured rate of false
positives, and the language with the largest corrected count wins.

Fitting: Spark counts n-grams by language in all labelled texts (``rows_per_lang`` bounds them, lowest
id hashes first, where a caller asks for it). n-grams enter the filter of each language in which they are frequent enough. The model is one byte
array per filter, bounded by ``slots``.

Defined results: a null text or one without a letter is ``und`` with score 0; ties go
to the language first in code point order; documents with null labels or null ids are
not learned from (a null id counts as held out) but predicted; with nothing to learn from, every text is ``und``;
repeated rows are predicted alike; other columns are ignored; a language beyond 64
raises.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import mix, table

SIZE = 4
SLOTS = 1 << 20
PROBES = 3
#: A cut lies below the score that this share of labelled texts miss.
ERROR = 0.001
#: Texts that taught score higher than new ones, so a cut is this part of their quantile.
MARGIN = 0.5
LEAST_COUNT = 3
#: An n-gram belongs to a language if it is at least this fraction as frequent as where it is most frequent.
LEAST_SHARE = 0.1
#: Characters that are looked up at a time; a longer text is taken in parts that overlap.
PART = 1 << 20

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_SEEDS = [np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)]


def grams(text: str, size: int = SIZE) -> np.ndarray:
    """Codes of all character n-grams of the letters, words set apart by one space."""
    flat = " " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " "
    points = np.frombuffer(flat.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    n = len(points) - size + 1
    if n <= 0:
        points = np.concatenate((points, np.full(size - len(points), 32, np.uint64)))
        n = 1
    code = np.zeros(n, np.uint64)
    for k in range(size):
        code = code * np.uint64(0x100000001B3) + points[k:n + k]
    return mix(code)


def has_letter(text: str | None) -> bool:
    return text is not None and re.search(r"[^\W\d_]", text) is not None


def slots_of(codes: np.ndarray, probe: int, slots: int) -> np.ndarray:
    return (mix(codes ^ _SEEDS[probe]) & np.uint64(slots - 1)).astype(np.int64)


class LanguageFilters:
    """languages, masks (one integer per slot, bit i for language i) and each language's false-positive rate."""

    def __init__(self, languages: list[str], masks: np.ndarray, size: int, probes: int):
        self.languages, self.masks, self.size, self.probes = languages, masks, size, probes
        self.slots = len(masks)
        self.bits = [masks.dtype.type(1 << i) for i in range(len(languages))]
        self.false_rate = (np.array([np.count_nonzero(masks & b) for b in self.bits]) / len(masks)) ** probes

    def languages_of(self, codes: np.ndarray) -> np.ndarray:
        """Mask of all languages whose filter holds each n-gram."""
        found = self.masks[slots_of(codes, 0, self.slots)]
        for p in range(1, self.probes):
            found = found & self.masks[slots_of(codes, p, self.slots)]
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return "und", 0.0
        hits, n = np.zeros(len(self.languages)), 0
        for at in range(0, len(text), PART):
            codes = grams(text[at:at + PART + self.size - 1], self.size)
            found = self.languages_of(codes)
            n += len(codes)
            hits += [np.count_nonzero(found & b) for b in self.bits]
        true = np.clip((hits - n * self.false_rate) / (1 - self.false_rate), 0, n)
        best = int(np.argmax(true))
        return self.languages[best], float(true[best] / n)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def _added(held: tuple[np.ndarray, np.ndarray] | None, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Codes with their counts, ``parts`` counted in."""
    code, n = np.unique(np.concatenate(parts), return_counts=True)
    if held is None:
        return code, n
    both, at = np.unique(np.concatenate((held[0], code)), return_inverse=True)
    sums = np.zeros(len(both), np.int64)
    np.add.at(sums, at, np.concatenate((held[1], n)))
    return both, sums


def gram_counts(pairs: Iterable[tuple[str, str]], size: int = SIZE) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, codes, counts) of the n-grams in (lang, text); a code may come more than once.

    Holds ``PART`` n-grams and the texts' latest part, and ``PART`` / 4 counts, however many texts or rows of a batch there are.
    """
    waiting: dict[str, list[np.ndarray]] = {}
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    rows = 0
    for lang, text in pairs:
        if not has_letter(text):
            continue
        for i in range(0, len(text), PART):
            codes = grams(text[i:i + PART], size)
            waiting.setdefault(lang, []).append(codes)
            rows += len(codes)
            if rows >= PART:
                held |= {k: _added(held.get(k), parts) for k, parts in waiting.items()}
                waiting, rows = {}, 0
                if sum(len(code) for code, _ in held.values()) >= PART // 4:
                    yield from ((k, *counts) for k, counts in held.items())
                    held = {}
    held |= {k: _added(held.get(k), parts) for k, parts in waiting.items()}
    yield from ((k, *counts) for k, counts in held.items())


def pairs_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, str]]:
    """(lang, text) of Arrow batches; of a batch's texts, one is a Python string at a time."""
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            yield lang.as_py(), text.as_py()


def fit(
    labelled: DataFrame, size: int = SIZE, slots: int = SLOTS, probes: int = PROBES,
    rows_per_lang: int | None = None, least_count: int = LEAST_COUNT, least_share: float = LEAST_SHARE,
) -> LanguageFilters:
    """Filters from (doc_id, text, lang); rows with a null text or label are left out.

    n-grams are counted in Spark; the driver receives the masks of the slots, ``slots`` rows at most.
    """
    usable = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(65).collect()}
    languages = sorted(sizes, key=lambda x: x.encode())
    if len(languages) > 64:
        raise ValueError("a mask holds 64 languages at most")
    if not languages:
        return LanguageFilters([], np.zeros(slots, np.uint64), size, probes)
    taught = usable
    if rows_per_lang is not None:
        # Without sorting a language: keep ids whose hash lies below the share that is needed.
        share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, rows_per_lang / n))])
        at = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        taught = usable.filter(at < F.element_at(share, F.col("lang")))

    def counted(batches):
        for lang, code, n in gram_counts(pairs_of(batches), size):
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(code)), pa.array(code.view(np.int64)), pa.array(n)], names=["lang", "code", "n"])

    counts = taught.select("lang", "text").mapInArrow(counted, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # 64 rows at most
    rate = counts.filter(F.col("n") >= least_count).join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))
    frequent = rate.groupBy("code").agg(F.max("rate").alias("top"), F.collect_list(F.struct("lang", "rate")).alias("in"))
    bit = F.create_map(*[F.lit(x) for i, k in enumerate(languages) for x in (k, 1 << i if i < 63 else -(1 << 63))])
    masks = frequent.select("code", F.aggregate(
        "in", F.lit(0).cast("long"),
        lambda m, x: m.bitwiseOR(F.when(x["rate"] >= least_share * F.col("top"), F.element_at(bit, x["lang"]).cast("long")).otherwise(F.lit(0).cast("long")))
    ).alias("mask"))

    def inserted(batches):
        for pdf in batches:
            code = pdf["code"].to_numpy(np.int64).view(np.uint64)
            for p in range(probes):
                yield pd.DataFrame({"slot": slots_of(code, p, slots), "mask": pdf["mask"]})

    pdf = masks.mapInPandas(inserted, "slot long, mask long").groupBy("slot").agg(F.bit_or("mask").alias("mask")).toPandas()
    filled = np.zeros(slots, np.uint64)
    filled[pdf["slot"].to_numpy(np.int64)] = pdf["mask"].to_numpy(np.int64).view(np.uint64)
    # The narrowest type that holds all bits keeps the filters in the cache of a core.
    kind = next(t for t, n in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64)) if len(languages) <= n)
    return LanguageFilters(languages, filled.astype(kind), size, probes)


def predict(docs: DataFrame, model: LanguageFilters) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to a table with a column ``text``; the model travels as one broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.masks, model.size, model.probes))

    @F.arrow_udf("lang_pred string, score double")
    def tagged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        filters = LanguageFilters(*sent.value)
        for texts in batches:
            # One text is a Python string at a time; all of a batch, in two or four bytes a character, would outweigh the batch.
            found = [filters.predict(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], ["lang_pred", "score"])

    return docs.withColumn("_tag", tagged("text")).select(*docs.columns, "_tag.lang_pred", "_tag.score")


def band(text: Column) -> Column:
    """Length class of a text: whole part of the binary logarithm of its code points."""
    return F.floor(F.log2(F.greatest(F.lit(1), F.length(F.coalesce(text, F.lit("")))))).cast("int")


def calibrated(labelled: DataFrame, model: LanguageFilters, error: float = ERROR, rows: int | None = None) -> dict[int, float]:
    """Per length class a cut well below the score that ``error`` of the labelled texts miss; short texts vary more than long ones.

    Scores all labelled texts, or ``rows`` of them on average. A class with fewer than 1 / ``error`` of them can't be judged and has no cut.
    """
    usable = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    if rows is not None:
        at = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        usable = usable.filter(at < min(1.0, rows / max(1, usable.count())))
    seen = predict(usable.select("text", "lang"), model).filter("lang_pred <> 'und'")
    cuts = seen.groupBy(band(F.col("text")).alias("band")).agg((MARGIN * F.percentile_approx("score", error, 10_000)).alias("cut"), F.count(F.lit(1)).alias("n")).filter(F.col("n") * error >= 1)
    return {r["band"]: r["cut"] for r in cuts.collect()}  # a row per length class


def accepted(tagged: DataFrame, cuts: dict[int, float]) -> DataFrame:
    """Rows of predicted texts that are in a learned language and don't score below their class's cut."""
    least = F.lit(0.0)
    if cuts:
        least = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in cuts.items() for x in kv]), band(F.col("text"))), least)
    return tagged.filter((F.col("lang_pred") != "und") & (F.col("score") >= least))


def op9_language_filters(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out")), model).drop("text")


QUERIES = {"op9_language_filters": op9_language_filters}
ORACLES = {}
