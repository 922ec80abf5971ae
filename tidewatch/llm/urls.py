"""Operator 4: URL filter by a character language-model ratio, in SQL functions only.

Fixed rules decide what they fit. URLs that a rule allows or blocks train two character Markov
models of variable order, one for accepted and one for rejected URLs; the others are
judged by the difference of their log-likelihoods per character, against a threshold
that is calibrated on labelled URLs kept out of training.

A URL is judged by its host and path. The probability of a character is interpolated from order 0 up to ``ORDER``: each
order adds what it counted and hands the rest to the next shorter context. Counts are
over all labelled URLs and kept by the n-gram itself, so none share them and the tables grow with
the n-grams. The longest n-gram of a character holds all shorter ones, so the difference is worked out
once per distinct n-gram; a table is broadcast only if its measured size is below ``BROADCAST_BYTES``.

Defined results: a null URL, or one without ``://``, has empty host and path, no rule and, having
no characters, is allowed unless the threshold says otherwise (difference 0); repeated URLs are judged alike and count each
time; null ids are kept; with one class of labels missing, or both, the difference is 0 and the threshold
-infinity (allow); columns beyond id and url are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import BROADCAST_BYTES, UPPER, LOWER, stored, table

# Verdict, host, path.
RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
ORDER = 4
#: Bytes of an n-gram and its numbers when broadcast, with room for four-byte characters.
ROW_BYTES = 128
#: Weight of the shorter context against what a context has counted.
BACKOFF = 2.0
ALPHABET = 96.0
CALIBRATION = 5  # one labelled URL in so many is kept for calibration
BINS = 2000
BIN_WIDTH = 0.005


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty strings without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules=RULES) -> Column:
    """(size, rule, verdict) of the longest rule that fits, or null."""
    fits = []
    for verdict, h, p in rules:
        fit = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        fits.append(F.when(fit, F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.greatest(*fits)


def characters(urls: DataFrame) -> DataFrame:
    """One row per character of each URL: the n-gram of order ``ORDER`` that ends with it."""
    text = F.concat(F.lit("^" * ORDER), F.col("shown"), F.lit("$"))
    at = F.explode(F.sequence(F.lit(ORDER + 1), F.length("shown") + ORDER + 1))
    rows = urls.filter(F.length("shown") > 0).withColumn("text", text).withColumn("at", at)
    return rows.select("uid", "label", "train", F.substring(F.col("text"), F.col("at") - ORDER, F.lit(ORDER + 1)).alias("gram"))


def joined_by_size(rows: DataFrame, t: DataFrame, key: str, broadcast_bytes: int) -> DataFrame:
    """Join a stored table with one row per key, by broadcast if it is small."""
    small = t.count() * ROW_BYTES <= broadcast_bytes
    return rows.join(F.broadcast(t) if small else t, key)


def differences(chars: DataFrame, broadcast_bytes: int) -> DataFrame:
    """(gram, d): log-likelihood difference of the last character of each distinct n-gram, accepted minus rejected."""
    sides = [F.count(F.when(F.col("train") & (F.col("label") == v), 1)).alias(x) for v, x in (("allow", "a"), ("block", "b"))]
    grams = stored(chars.groupBy("gram").agg(*sides), "url-grams")
    # The character with k before it, and the k before it.
    keys = {f"g{k}": F.substring("gram", ORDER + 1 - k, k + 1) for k in range(ORDER)} | {f"c{k}": F.substring("gram", ORDER + 1 - k, k) for k in range(1, ORDER + 1)}
    rows = grams.select("gram", F.col("a").alias(f"g{ORDER}a"), F.col("b").alias(f"g{ORDER}b"), *[c.alias(n) for n, c in keys.items()])
    for name, key in keys.items():
        t = stored(grams.groupBy(key.alias(name)).agg(F.sum("a").alias(f"{name}a"), F.sum("b").alias(f"{name}b")), "url-counts")
        rows = joined_by_size(rows, t, name, broadcast_bytes)
    rows = rows.crossJoin(F.broadcast(grams.agg(F.sum("a").alias("c0a"), F.sum("b").alias("c0b"))))
    good = bad = F.lit(1.0 / ALPHABET)
    for k in range(ORDER + 1):
        good = (F.col(f"g{k}a") + BACKOFF * good) / (F.col(f"c{k}a") + BACKOFF)
        bad = (F.col(f"g{k}b") + BACKOFF * bad) / (F.col(f"c{k}b") + BACKOFF)
    return stored(rows.select("gram", (F.log(good) - F.log(bad)).alias("d")), "url-differences")


def scored(urls: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(uid, ratio): mean log-likelihood difference per character, accepted minus rejected."""
    chars = characters(urls)
    rows = joined_by_size(chars.select("uid", "gram"), differences(chars, broadcast_bytes), "gram", broadcast_bytes)
    return rows.groupBy("uid").agg(F.avg("d").alias("ratio"))


def threshold(scores: DataFrame) -> float:
    """The lower edge of the bin at which the two error rates on (label, ratio) add up to least.

    Scores are counted in ``BINS`` bins, so the driver sees a bounded table.
    """
    at = F.greatest(F.lit(0), F.least(F.lit(BINS), F.floor(F.col("ratio") / BIN_WIDTH) + BINS // 2)).cast("int")
    found = scores.groupBy(at.alias("bin")).agg(
        F.count(F.when(F.col("label") == "allow", 1)).alias("good"), F.count(F.when(F.col("label") == "block", 1)).alias("bad")).collect()
    good, bad = sum(r["good"] for r in found), sum(r["bad"] for r in found)
    if not good or not bad:
        return float("-inf")
    by_bin = {r["bin"]: r for r in found}
    lost, kept, best = 0, bad, None
    for b in range(BINS + 1):
        error = lost / good + kept / bad
        # Of equal errors, the one nearest to no difference.
        if best is None or (error, abs(b - BINS // 2)) < best[:2]:
            best = (error, abs(b - BINS // 2), b)
        if b in by_bin:
            lost, kept = lost + by_bin[b]["good"], kept - by_bin[b]["bad"]
    return (best[2] - BINS // 2) * BIN_WIDTH


def judged(pages: DataFrame, rules=RULES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict, ratio) of every row."""
    host, path = parts(F.col("url"))
    known = pages.select("page_id", "url", host.alias("host"), path.alias("path")).withColumn("fit", ruled(F.col("host"), F.col("path"), rules))
    kept_out = F.pmod(F.xxhash64("host", "path"), F.lit(CALIBRATION)) == 0
    rows = stored(known.select(
        "page_id", "host", "path", "fit.rule", F.col("fit.verdict").alias("label"),
        F.concat("host", "path").alias("shown"), kept_out.alias("kept_out"), F.monotonically_increasing_id().alias("uid"),
    ).withColumn("train", F.col("label").isNotNull() & ~F.col("kept_out")), "url-rows")
    labels = {r["label"] for r in rows.filter("train").select("label").distinct().collect()}
    if labels < {"allow", "block"}:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("label", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("ratio"))
    ratios = stored(rows.join(scored(rows, broadcast_bytes), "uid", "left").withColumn("ratio", F.coalesce("ratio", F.lit(0.0))), "url-ratios")
    cut = threshold(ratios.filter(F.col("label").isNotNull() & F.col("kept_out")))
    verdict = F.coalesce(F.col("label"), F.when(F.col("ratio") >= cut, "allow").otherwise("block"))
    return ratios.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "ratio")


def op4_url_ratio(spark, sf_dir):
    return judged(table(spark, sf_dir, "pages"))


QUERIES = {"op4_url_ratio": op4_url_ratio}
ORACLES = {}
