"""Exact dedup, near dedup, decontamination and mixing against brute force."""

import collections
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import contamination, exact, mixing, probminhash
from tidewatch.llm.common import shingles, word_hashes

SF = "/root/testdata/sf0.01"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, source string, rid string, row string"


def words(text):
    return WORDS.findall((text or "").translate(UP))


def bag(text, size=5):
    w = words(text)
    return collections.Counter(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else collections.Counter()


def similarity(a, b):
    """The definition, term by term."""
    both = set(a) & set(b)
    every = set(a) | set(b)
    return sum(1 / sum(max(a[i] / a[d], b[i] / b[d]) for i in every) for d in both)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "r", "w") for i, t, s in rows], SCHEMA)


# --- words ---------------------------------------------------------------------

def test_words_and_shingles_of_odd_texts():
    texts = ["", None, "One", "one two", "É!É é", "a b c d e f", "a b c d e f", "--a--b--", "f", "x" * 70000, "a\x00b\x7fc\x80d"]
    column = pa.array(texts, pa.string())
    hashes, rows = word_hashes(column)
    assert np.bincount(rows, minlength=len(texts)).tolist() == [len(words(t)) for t in texts]
    flat = [w for t in texts for w in words(t)]
    by_word = collections.defaultdict(set)
    for w, h in zip(flat, hashes):
        by_word[w].add(int(h))
    assert all(len(v) == 1 for v in by_word.values()) and len({h for v in by_word.values() for h in v}) == len(by_word)
    grams, owners = shingles(column, 5)
    assert np.bincount(owners, minlength=len(texts)).tolist() == [sum(bag(t).values()) for t in texts]
    sliced = column.slice(4, 3)
    assert word_hashes(sliced)[0].tolist() == hashes[(rows >= 4) & (rows < 7)].tolist()


# --- exact dedup -------------------------------------------------------------------

def groups_of(rows):
    by = collections.defaultdict(list)
    for i, t, _ in rows:
        by[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    return by


ODD = [(3, "a  b", "x"), (1, "a\tb", "x"), (7, None, "x"), (5, "", None), (9, " ", "x"), (2, "a b ", "x"), (None, "a b", "x"),
       (4, "c", "y"), (4, "c", "y"), (6, "l" * 300000, "y"), (8, "a b", "y")]


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(spark, weak):
    digest = (lambda text: F.substring(F.sha2(text.cast("binary"), 256), 1, 1)) if weak else exact.sha256
    got = exact.exact_groups(frame(spark, ODD), digest=digest, files_per_batch=1).collect()
    want = groups_of(ODD)
    assert len(got) == len(ODD)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    for r in got:
        ids = by_sha[r["text_sha256"]]
        assert r["doc_id"] in ids and r["group_size"] == len(ids)
        assert r["keep_id"] == min(i for i in ids if i is not None)
    kept = [(r["text_sha256"], r["doc_id"]) for r in got if r["kept"]]
    assert sorted(k for k, _ in kept) == sorted(by_sha)
    stay = exact.deduplicated(frame(spark, ODD)).collect()
    assert sorted(r["doc_id"] for r in stay) == [1, 2, 4, 5, 6, 8, 9] and stay[0]["rid"] == "r"


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert exact.exact_groups(none).count() == 0 and exact.deduplicated(none).count() == 0
    assert probminhash.near_groups(none).count() == 0 and probminhash.one_of_each(none).count() == 0
    assert contamination.decontaminate(none, items).count() == 0 and contamination.clean(none, items).count() == 0
    assert mixing.mix(none).count() == 0


# --- near dedup --------------------------------------------------------------------

def variants(seed, n_base=12, copies=6):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, at = [], 0
    for b in range(n_base):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([4, 5, 30, 200, 400]))]
        if b % 3 == 0:
            base += ["again", "and", "again", "the", "same"] * 20
        for c in range(copies):
            w = list(base)
            for _ in range(draw.randint(0, max(1, len(w) // 40))):
                w[draw.randrange(len(w))] = draw.choice(vocabulary)
            rows.append((at, ("  " if c % 2 else ", ").join(w), "s"))
            at += 1
    return rows + [(at, None, "s"), (at + 1, "", "s"), (at + 2, "?!", "s"), (at + 3, rows[20][1].upper(), None)]


def classes(rows, threshold=0.8):
    bags = [bag(t) for _, t, _ in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j] and similarity(bags[i], bags[j]) >= threshold:
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return {rows[i][0]: rows[top(i)][0] for i in range(len(rows))}


def test_near_groups_match_all_pairs(spark):
    rows = variants(5)
    got = {r["doc_id"]: r for r in probminhash.near_groups(frame(spark, rows)).collect()}
    want = classes(rows)
    assert {i: r["class_id"] for i, r in got.items()} == want
    sizes = collections.Counter(want.values())
    assert all(r["class_size"] == sizes[r["class_id"]] and r["kept"] == (i == r["class_id"]) for i, r in got.items())
    stay = probminhash.one_of_each(frame(spark, rows))
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(set(want.values())) and stay.columns == ["doc_id", "text", "source", "rid", "row"]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_near_groups_of_repeated_and_missing_ids(spark, kind):
    """Rows count, not ids: one id with two texts, rows without an id, whole rows twice, ids that are no numbers."""
    draw = random.Random(8)
    text = lambda: [f"t{draw.randrange(5000)}" for _ in range(120)]
    changed = lambda w, i: " ".join([*w[:i], "other", *w[i + 1:]])
    a, b, c = text(), text(), text()
    name = (lambda i: i) if kind == "long" else (lambda i: None if i is None else f"id-{i}")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, changed(a, 50)), (3, changed(b, 70)), (None, changed(a, 20)), (None, " ".join(c)),
            (None, changed(c, 60)), (4, " ".join(a)), (4, " ".join(a)), (5, None), (5, None), (None, ""), (6, "alone here")]
    df = spark.createDataFrame([(name(i), t, "_of", "_hash", k) for k, (i, t) in enumerate(rows)],
                               f"doc_id {kind}, text string, _of string, _hash string, _one int")
    got = collections.Counter((r["doc_id"], r["class_id"], r["class_size"], r["kept"]) for r in probminhash.near_groups(df).collect())
    want = collections.Counter([
        (1, 1, 5, True), (2, 1, 5, False), (None, 1, 5, False), (4, 1, 5, False), (4, 1, 5, False), (1, 1, 2, True), (3, 1, 2, False),
        (None, None, 2, True), (None, None, 2, False), (5, 5, 1, True), (5, 5, 1, True), (None, None, 1, True), (6, 6, 1, True)])
    assert got == collections.Counter({(name(i), name(j), n, k): v for (i, j, n, k), v in want.items()})
    stay = probminhash.one_of_each(df)
    assert stay.columns == df.columns
    at = sorted(r["_one"] for r in stay.collect())
    assert at[:2] == [0, 1] and at[2] in (5, 6) and at[3:] == [9, 10, 11, 12]


def test_one_of_equal_rows_stays(spark):
    rows = [(7, "one two three four five six"), (7, "one two three four five six"), (8, "One, two three four five six!"), (9, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in probminhash.one_of_each(df).collect()) == [7, 9]


def test_links_that_the_first_member_lacks(spark):
    """A chain of texts: neighbours are near, ends are not, and the smallest id stands in the middle of none."""
    draw = random.Random(3)
    w = [f"v{i}" for i in range(300)]
    rows = []
    for i in range(12):
        rows.append(((i * 7) % 12, " ".join(w), "s"))
        for _ in range(3):
            w[draw.randrange(300)] = f"n{draw.random()}"
    want = classes(rows)
    got = {r["doc_id"]: r["class_id"] for r in probminhash.near_groups(frame(spark, rows)).collect()}
    assert got == want and set(want.values()) == {0}


@pytest.mark.parametrize("columns", [7, 1 << 14])
def test_blocks_measure_every_pair(monkeypatch, columns):
    monkeypatch.setattr(probminhash, "COLUMNS", columns)
    draw = random.Random(6)
    base = {i: 1 for i in range(60)}
    texts = []
    for k in range(30):
        x = dict(base)
        for _ in range(draw.randrange(14)):
            x.pop(draw.choice(list(x)))
            x[1000 + draw.randrange(5000)] = 1
        if k % 5 == 0:
            x |= {i: draw.choice([2, 3]) for i in list(x)[:6]}
        texts.append(collections.Counter(x))
    texts.append(collections.Counter())
    bags = [(np.array(sorted(x), np.uint64), np.array([x[i] for i in sorted(x)], float)) for x in texts]
    left, right = np.array([0, 3, 5, 30, 7]), np.arange(31)
    near = probminhash.similar(bags, left, right, 0.8)
    want = [[bool(texts[i]) and bool(texts[j]) and similarity(texts[i], texts[j]) >= 0.8 - 1e-12 for j in right] for i in left]
    assert near.tolist() == want


def test_registers_estimate_the_exact_similarity():
    draw = random.Random(1)
    a = collections.Counter({i: draw.choice([1, 1, 2, 5]) for i in range(80)})
    b = collections.Counter({i: draw.choice([1, 1, 2, 5]) for i in range(20, 100)})
    exact_value = similarity(a, b)
    arrays = [(np.array(sorted(x), np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.array([x[k] for k in sorted(x)], float)) for x in (a, b)]
    (ia, wa), (ib, wb) = [(i[o], w[o]) for i, w in arrays for o in [np.argsort(i)]]
    assert probminhash.probability_jaccard(ia, wa, ib, wb) == pytest.approx(exact_value)
    rows = np.concatenate([np.zeros(len(ia), int), np.ones(len(ib), int)])
    s = probminhash.signatures(rows, np.concatenate([ia, ib]), np.concatenate([wa, wb]), 2, 4096)
    assert np.mean(s[0] == s[1]) == pytest.approx(exact_value, abs=0.03)
    again = probminhash.signatures(np.zeros(len(ib), int), ib, wb, 1, 4096)
    assert (again[0] == s[1]).all()


# --- decontamination ------------------------------------------------------------------

def judged(text, items, size=13):
    w = words(text)
    hit, named = set(), set()
    for item, t in items:
        v = words(t)
        n = min(size, len(v))
        wins = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in wins:
                hit.update(range(i, i + n))
                named.add(item)
    ids = sorted(str(i) for i in named if i is not None)
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("broadcast_bytes", [32 << 20, 4000])
def test_contamination(spark, broadcast_bytes):
    long = " ".join(f"t{i}" for i in range(40))
    items = [(1, long), (2, "One, two three"), (10, "the " * 20), (11, None), (12, "... "), (2, "One, two three"), (13, "t5 t6")]
    texts = [None, "", "one TWO three", "one two", long, "x " * 300 + "t20 t21 t22 t23 t24 t25 t26 t27 t28 t29 t30 t31 t32",
             "the " * 13, "the " * 12, "the " * 50 + "x one two three one two three", "a t5 t6 b " + long.upper() + " one-two;three", "ÉT5 t6"]
    docs = frame(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(4, long, "s"), (None, "t5 t6", None)])
    table = spark.createDataFrame(items, "item_id long, text string")
    got = contamination.decontaminate(docs, table, broadcast_bytes=broadcast_bytes).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = texts[r["doc_id"]] if r["doc_id"] is not None else "t5 t6"
        assert tuple(r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")) == judged(text, items), text
    if broadcast_bytes > 4000:
        stay = {r["doc_id"] for r in contamination.clean(docs, table).collect()}
        assert stay == {i for i, t in enumerate(texts) if not judged(t, items)[4]}
        none = spark.createDataFrame([], "item_id long, text string")
        assert contamination.decontaminate(docs, none).filter("n_hit = 0 and not contaminated").count() == len(got)


# --- mixing -----------------------------------------------------------------------------

def shares(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        by = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if by[s] > most * sizes[s]]
        if not over:
            return fixed | by
        fixed |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("slice_rows", [5, 100000])
def test_mix_comes_near_its_targets(spark, slice_rows):
    draw = random.Random(4)
    rows = [(i, "w " * draw.randint(1, 40), draw.choice(["a", "a", "a", "b", "Z", "é", None, "tiny" if i % 40 == 0 else "b"])) for i in range(900)]
    rows += [(2000, None, "a"), (2001, "", "empty"), (2002, " \t", "empty"), (5, "w w w", "a"), (5, "w w w", "a"), (None, "w", None)]
    got = mixing.mix(frame(spark, rows), rows_per_slice=slice_rows).collect()
    sizes, largest = collections.Counter(), collections.Counter()
    for _, t, s in rows:
        n = len((t or "").split())
        sizes[s] += n
        largest[s] = max(largest[s], n)
    want = shares(sizes)
    assert len(got) == len(rows)
    taken = collections.Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and r["taken"] <= 3 * r["size"]
        assert r["copies"] in (int(want[r["source"]] / max(1, sizes[r["source"]])), int(want[r["source"]] / max(1, sizes[r["source"]])) + 1) or r["size"] == 0
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    again = mixing.mix(frame(spark, rows[::-1]).repartition(3), rows_per_slice=7).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_texts_are_those_of_the_mix(spark):
    rows = [(i, f"word{i} " * (i % 9 + 1), "ab"[i % 2] if i % 5 else None) for i in range(120)]
    rows += [(5, "w w w", "a"), (5, "w w w", "a"), (5, "other text", "a"), (None, "w", None), (None, "v", None), (300, None, "a"), (301, "", "b")]
    docs = frame(spark, rows)
    got = mixing.mixed_texts(docs).collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], r["copies"])
    assert sorted(map(key, got)) == sorted(map(key, mixing.mix(docs).filter("copies > 0").collect()))
    assert {(r["doc_id"], r["text"], r["source"]) for r in got} <= set(rows)
    assert sum(r["copies"] * len(r["text"].split()) for r in got) == sum(r["taken"] for r in got)
    assert mixing.mixed_texts(docs.filter("doc_id < 0")).count() == 0


def test_one_row_stays_of_repeated_and_missing_ids(spark):
    rows = [(5, "a  b"), (5, "a b"), (None, "a\tc"), (None, "a c"), (5, "other"), (7, "a b"), (None, None), (8, ""), (9, "a c")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, _id string, _sha string")
    kept = exact.deduplicated(docs)
    assert kept.columns == docs.columns
    got = sorted((re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or ""), r["doc_id"]) for r in kept.collect())
    assert got == [("", 8), ("a b", 5), ("a c", 9), ("other", 5)]
    lonely = spark.createDataFrame([(None, "a\tc", "x", "y"), (None, "a c", "x", "y")], docs.schema)
    assert exact.deduplicated(lonely).count() == 1


def test_near_dedup_of_many_long_texts_holds_a_step_at_a_time(monkeypatch):
    rng = np.random.default_rng(1)
    words = rng.integers(0, 40_000, 40_000)
    texts = [" ".join(f"w{w}" for w in np.roll(words, -97 * i)[:8_000]) for i in range(120)]
    column = pa.array([texts[0], None, "", *texts[1:]])
    whole = probminhash.bags(column)
    tracemalloc.start()
    stepped = probminhash.bags_by_steps(column)
    held, peak = tracemalloc.get_traced_memory()
    assert peak - held < 100e6
    assert all((a == b).all() for a, b in zip(whole, stepped))
    assert all(len(a) == 0 for a in probminhash.bags_by_steps(pa.array([], pa.string())))
    rows, items, weights = stepped
    edge = np.searchsorted(rows, np.arange(len(column) + 1))
    tracemalloc.stop()
    parts = [(items[a:b], weights[a:b]) for a, b in zip(edge[:-1], edge[1:])]
    near = [probminhash.similar(parts[3:], np.arange(60), np.arange(60, 119), x) for x in (0.8, 0.95)]
    monkeypatch.setattr(probminhash, "CELLS", 5_000)
    assert all((probminhash.similar(parts[3:], np.arange(60), np.arange(60, 119), x) == m).all() for x, m in zip((0.8, 0.95), near))


def test_a_step_of_near_dedup_works_in_little_memory():
    column = pa.array([" ".join(f"w{i % 997}x{i % 89}" for i in range(k, k + 20_000)) for k in range(20)])
    tracemalloc.start()
    parts = [probminhash.bags(column.slice(a, b - a)) for a, b in zip([0, *probminhash.steps(column)], probminhash.steps(column)) if b > a]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(len(rows) for rows, _, _ in parts) == len(probminhash.bags(column)[0])
    assert peak < 20 << 20
