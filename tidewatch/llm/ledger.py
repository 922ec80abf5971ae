"""Operator 11: quality rules as a ledger of bits.

Every document is measured once and every rule is evaluated once on the measurements. The
ledger keeps, per document, the measurements and one long whose bits say which rules failed.
Decisions are made afterwards: a policy is a version with two masks, and applying it is one AND
and one bit count, so another policy never reads a text again. Ablations work on the counts per
bit pattern, of which there are at most 2 to the number of rules, whatever the corpus holds.

Texts are measured in Arrow batches: words are numbered exactly, and windows of words get exact names
by pairing the names of windows half as long, so no hash decides and a text costs n log n.

Defined results: a null text is the empty text, with no words and no lines (it fails ``few_words``);
rows with null or repeated ids are rows of their own; texts of any length are measured whole; an
empty table gives an empty ledger and ablations of zero; a rule that divides by words compares products,
so texts without words need no special case; other columns pass through ``ledger`` unless they bear one
of its names, in which case the ledger's replace them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored, table

#: Characters that count as symbols, words in a window.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 8
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_upper_words"]

#: The rules in the order of their bits, as conditions on the measurements under which a text fails.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "word_length": "word_chars < 3 * n_words OR word_chars > 12 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "few_letters": "5 * n_letter_words < 4 * n_words",
    "upper_case": "2 * n_upper_words > n_words",
}
BIT = {rule: 1 << i for i, rule in enumerate(RULES)}


def mask(*rules: str) -> int:
    return sum(BIT[r] for r in rules)


BASE = mask("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A document stays if no ``hard`` rule failed and at most ``allowed`` of the ``soft`` ones."""

    version: int
    hard: int
    soft: int = 0
    allowed: int = 0

    def keeps(self, bits: Column, without: Column | int = 0) -> Column:
        """Verdict on failure bits, as if the rules ``without`` did not exist."""
        left = bits.bitwiseAND(F.bitwise_not(F.lit(without) if isinstance(without, int) else without))
        return (left.bitwiseAND(F.lit(self.hard)) == 0) & (F.bit_count(left.bitwiseAND(F.lit(self.soft))) <= self.allowed)


POLICIES = [
    Policy(1, BASE),
    Policy(2, BASE | mask("symbols", "word_length"), mask("duplicate_lines", "few_letters", "upper_case"), 1),
    Policy(3, sum(BIT.values())),
]
CURRENT = POLICIES[-1]


def words_in_repeats(ids: np.ndarray, size: int = WINDOW) -> int:
    """How many of the numbered words lie in a window of ``size`` words that occurs at least twice."""
    if len(ids) <= size:
        return 0
    names, width = ids, 1
    while width < size:
        step = min(width, size - width)  # two windows of one width, overlapping if need be, make the next
        pairs = names[:-step] * (int(names.max()) + 1) + names[step:]
        _, names, count = np.unique(pairs, return_inverse=True, return_counts=True)
        if count.max() == 1:  # longer windows cannot repeat either
            return 0
        width += step
    starts = np.flatnonzero(count[names] > 1)
    change = np.zeros(len(ids) + 1, np.int64)
    change[starts] += 1
    change[starts + size] -= 1
    return int((np.cumsum(change) > 0).sum())


def _measured(text: str) -> tuple:
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    # What a word looks like is asked once for each different word.
    letters = np.fromiter((w.isalpha() or any(c > 127 or chr(c).isalpha() for c in w) for w in numbers), bool, len(numbers))
    upper = np.fromiter((w.isupper() and w.isascii() for w in numbers), bool, len(numbers))
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)),
        words_in_repeats(ids), int(letters[ids].sum()), int(upper[ids].sum()))


def measured(text: Column) -> Column:
    """Struct of the measurements of a text."""

    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([_measured(t or "") for t in texts], columns=MEASURES, dtype="int64")

    return run(text)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows without their text, with the measurements and ``failed_bits``; every rule is evaluated once."""
    own = {*MEASURES, "failed_bits", text}
    others = [c for c in docs.columns if c not in own]
    m = docs.select(*[F.col(f"`{c}`") for c in others], measured(F.coalesce(F.col(text), F.lit(""))).alias("_m")).select(
        *[F.col(f"`{c}`") for c in others], *[F.col(f"_m.{x}").alias(x) for x in MEASURES])
    bits = F.lit(0).cast("long")
    for rule, fails in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BIT[rule]).cast("long")).otherwise(F.lit(0).cast("long")))
    return m.withColumn("failed_bits", bits)


def rule_names(bits: Column) -> Column:
    """Array of the names of the failed rules."""
    named = F.array(*[F.when(bits.bitwiseAND(F.lit(b)) != 0, F.lit(r)) for r, b in BIT.items()])
    return F.array_compact(named)


def patterns(book: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, failed_bits, docs, words): the ledger folded to its bit patterns, before anything is shuffled."""
    return book.groupBy(*keys, "failed_bits").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_words").alias("words"))


def overview(book: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Per group: rules that some document failed, rules that all failed, and the failures of each rule."""
    hit = lambda b: F.sum(F.when(F.col("failed_bits").bitwiseAND(F.lit(b)) != 0, F.col("docs")).otherwise(0))
    return patterns(book, keys).groupBy(*keys).agg(
        F.bit_or("failed_bits").alias("ever"), F.bit_and("failed_bits").alias("always"), F.sum("docs").alias("docs"),
        *[hit(b).alias(r) for r, b in BIT.items()])


def ablations(book: DataFrame, policies: list[Policy] = POLICIES) -> DataFrame:
    """(version, rule, docs, kept, failed, failed_alone, kept_without, words_without) for each policy and rule.

    ``failed_alone`` counts documents whose only failure under the policy's masks is this rule; ``kept_without``
    and ``words_without`` are what the policy would keep if the rule were struck out.
    """
    counted = stored(patterns(book), "bit-patterns")
    bits, parts = F.col("failed_bits"), []
    add = lambda when, what: F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0)).cast("long")
    for p in policies:
        asked = bits.bitwiseAND(F.lit(p.hard | p.soft))
        for rule, b in BIT.items():
            if (p.hard | p.soft) & b:
                parts.append(counted.agg(
                    F.lit(p.version).alias("version"), F.lit(rule).alias("rule"), add(F.lit(True), "docs").alias("docs"),
                    add(p.keeps(bits), "docs").alias("kept"), add(asked.bitwiseAND(F.lit(b)) != 0, "docs").alias("failed"),
                    add(asked == b, "docs").alias("failed_alone"), add(p.keeps(bits, b), "docs").alias("kept_without"),
                    add(p.keeps(bits, b), "words").alias("words_without")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op11_rule_ledger(spark, sf_dir):
    """All documents under the current policy; the verdict needs the bits only."""
    book = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    bits = F.col("failed_bits")
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (bits.bitwiseAND(F.lit(BASE)) != 0).alias("base_failed"), CURRENT.keeps(bits).alias("kept"),
        bits.alias("failed_bits"), F.lit(CURRENT.version).alias("policy"))


_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, i, words[i:i + 7] AS gram FROM w, unnest(range(1, len(words) - 6)) AS u(i)),
r AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
c AS (SELECT rid, count(DISTINCT i + k)::BIGINT AS n_repeat_words FROM r, range(8) AS t(k) GROUP BY rid),
m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')))::BIGINT AS n_letter_words,
         len(list_filter(words, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]|[^\x00-\x7F]')))::BIGINT AS n_upper_words
  FROM w LEFT JOIN c USING (rid)),
b AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN word_chars < 3 * n_words OR word_chars > 12 * n_words THEN 4 ELSE 0 END + CASE WHEN 10 * n_symbols > n_words THEN 8 ELSE 0 END
    + CASE WHEN 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END + CASE WHEN 5 * n_letter_words < 4 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_upper_words > n_words THEN 64 ELSE 0 END)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept,
       failed_bits, 3 AS policy FROM b
"""

QUERIES = {"op11_rule_ledger": op11_rule_ledger}
ORACLES = {"op11_rule_ledger": _SQL}
