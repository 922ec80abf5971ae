"""Rule ledger, midstate manifest and hard negatives against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import ledger, merkle, negatives

SF = "/root/testdata/sf0.01"


# --- rule ledger ---------------------------------------------------------------------

def measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {i + k for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(hit),
        sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7F]", x)) for x in w),
        sum(bool(re.search(r"[A-Z]", x)) and not re.search(r"[a-z]|[^\x00-\x7F]", x) for x in w))


def failures(m):
    n, chars, symbols, lines, dup, repeat, letters, upper = m
    return [r for r, bad in zip(ledger.RULES, (
        n < 20, 100 * repeat > 30 * n, chars < 3 * n or chars > 12 * n, 10 * symbols > n, 2 * dup > lines, 5 * letters < 4 * n, 2 * upper > n)) if bad]


ODD = [
    None, "", " \n\t", "a", "a b c d e f g h " * 2, "a b c d e f g h " * 3, "x y z " * 400, "É! é\x85word one", "|a| |b| " * 30,
    "SHOUT NOW! " * 15, "one line of it\n" * 9 + "\n \n", "1 2 3 4 5 6 7 8 9 " * 5, "\x00 \x1c \x1d", "w" * 90000,
    " ".join(f"w{i % 1000}" for i in range(60000)), " ".join(map(str, range(9))), "a b c d e f g h i a b c d e f g h j k"]


def test_ledger_of_odd_texts_and_clashing_columns(spark):
    rows = [(i % 4 if i % 5 else None, t, "mine", "kept", 7.5) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, failed_bits string, `a.b` double")
    got = ledger.ledger(docs)
    assert got.columns == ["doc_id", "a.b", *ledger.MEASURES, "failed_bits"]
    want = sorted((i if i is not None else -1, *measures(t), sum(ledger.BIT[r] for r in failures(measures(t)))) for i, t, *_ in rows)
    assert sorted((r[0] if r[0] is not None else -1, *r[2:]) for r in got.collect()) == want
    assert ledger.ledger(docs.limit(0)).count() == 0
    named = {tuple(r[0]) for r in got.select(ledger.rule_names(F.col("failed_bits"))).collect()}
    assert named == {tuple(failures(measures(t))) for t in ODD}


@pytest.mark.parametrize("size", [2, 3, 5, 8, 12])
def test_repeated_windows_of_any_size(size):
    draw = random.Random(size)
    for n in (0, 1, size, size + 1, 40, 300):
        ids = [draw.randrange(3) for _ in range(n)]
        grams = collections.Counter(tuple(ids[i:i + size]) for i in range(n - size + 1))
        hit = {i + k for i in range(n - size + 1) if grams[tuple(ids[i:i + size])] > 1 for k in range(size)}
        assert ledger.words_in_repeats(np.array(ids, np.int64), size) == len(hit)


def test_policies_and_ablations(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    book = ledger.ledger(docs).select("doc_id", "source", "n_words", "failed_bits").cache()
    rows = book.collect()
    got = {(r["version"], r["rule"]): r for r in ledger.ablations(book).collect()}
    stays = lambda p, bits: not bits & p.hard and bin(bits & p.soft).count("1") <= p.allowed
    for p in ledger.POLICIES:
        assert {r["doc_id"] for r in book.filter(p.keeps(F.col("failed_bits"))).collect()} == {r["doc_id"] for r in rows if stays(p, r["failed_bits"])}
        for rule, bit in ledger.BIT.items():
            if not (p.hard | p.soft) & bit:
                assert (p.version, rule) not in got
                continue
            r = got[p.version, rule]
            without = [x for x in rows if stays(p, x["failed_bits"] & ~bit)]
            assert tuple(r)[2:] == (
                len(rows), sum(stays(p, x["failed_bits"]) for x in rows), sum(bool(x["failed_bits"] & bit) for x in rows),
                sum(x["failed_bits"] & (p.hard | p.soft) == bit for x in rows), len(without), sum(x["n_words"] for x in without))
    by = collections.defaultdict(list)
    for r in rows:
        by[r["source"]].append(r["failed_bits"])
    for r in ledger.overview(book, ("source",)).collect():
        bits = by[r["source"]]
        assert (r["ever"], r["always"], r["docs"]) == (np.bitwise_or.reduce(bits), np.bitwise_and.reduce(bits), len(bits))
        assert all(r[rule] == sum(bool(b & bit) for b in bits) for rule, bit in ledger.BIT.items())
    assert all(r["docs"] == r["kept"] == r["kept_without"] == 0 for r in ledger.ablations(book.limit(0)).collect())


def test_good_documents_stay_and_junk_goes(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = ledger.op11_rule_ledger(spark, "/root/testdata/sf0.1").join(labels, "doc_id").filter("n_words >= 20").collect()
    good, bad = [r for r in rows if r["quality"] == 1], [r for r in rows if r["quality"] == 0]
    assert sum(r["kept"] for r in good) / len(good) > 0.99 and sum(not r["kept"] for r in bad) / len(bad) > 0.95


# --- manifest ---------------------------------------------------------------------------

def sha(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    return sha("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text))


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def manifest_of(rows):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    trees = {}
    for s, own in by.items():
        own.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees[s] = tree([leaf_of(r, r.text) for r in own])
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    top = tree([trees[s][-1][0] for s in order])
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            tampered = r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            now, siblings = leaf_of(r, r.text.replace("\n", "") if tampered else r.text), []
            for levels, place in ((trees[s], i), (top, k)):
                for level in levels[:-1]:
                    run, at = level[place // 3 * 3:place // 3 * 3 + 3], place % 3
                    siblings += run[:at] + run[at + 1:]
                    now, place = sha([*run[:at], now, *run[at + 1:]]), place // 3
            yield r.doc_id, trees[s][0][i], trees[s][-1][0], top[-1][0], sha(siblings), now, now == top[-1][0]


def test_states_resume_like_the_standard_hash():
    draw = np.random.default_rng(3)
    digests = draw.integers(0, 256, (50, 32)).astype(np.uint8)
    blocks = merkle.hex_blocks(digests)
    state = np.repeat(merkle.START[:, None], 50, 1)
    for n in range(1, 4):
        state = merkle.absorb(state, np.roll(blocks, n, axis=1))
        want = [sha(digests[(i - k) % 50].tobytes().hex() for k in range(1, n + 1)) for i in range(50)]
        assert [x.tobytes().hex() for x in merkle.finish(state, np.full(50, n))] == want
    assert (merkle.unraw(merkle.raw(state)) == state).all()


def order_of(rows):
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("sizes", [[1], [4, 3], [28, 9, 1, 5], [2200, 1, 731], [1] * 30])
def test_trees_of_all_shapes(spark, sizes):
    """Among them several passes (more than 729 leaves) and a tree of sources of several levels."""
    draw = random.Random(1)
    rows = []
    for s, n in enumerate(sizes):
        for i in range(n):
            text = None if i % 11 == 5 else "x\n" * draw.randrange(4) + f"{i} é"
            rows.append((i if i % 13 else None, None if s == 1 else f"s{s}", "en" if i % 2 else None, i if i % 3 else None, text, "clash", "x"))
    rows += rows[: len(rows) // 20]  # equal rows
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, tree string, digest string")
    got = merkle.folded(merkle.manifest(merkle.document_leaves(docs.repartition(5)))).collect()
    want = order_of(manifest_of(docs.collect()))
    assert order_of((int(r[0]) if r[0] is not None else None, *r[1:]) for r in got) == want


def test_retained_states_lead_to_each_slot(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    book = merkle.manifest(merkle.document_leaves(docs))
    below = collections.defaultdict(list)
    for r in book.sources.leaves.orderBy("index").collect():
        below[r["tree"], 0, r["index"] // 3].append(bytes(r["digest"]).hex())
    parents = book.sources.parents[0].orderBy("level", "index").collect()
    for r in parents:
        below[r["tree"], r["level"], r["index"] // 3].append(bytes(r["digest"]).hex())
    for r in parents:
        children = below[r["tree"], r["level"] - 1, r["index"]]
        assert len(r["states"]) == 32 * len(children) and sha(children) == bytes(r["digest"]).hex()
        for slot in range(len(children)):
            state = merkle.unraw(np.frombuffer(bytes(r["states"][32 * slot:32 * slot + 32]), np.uint8))
            for c in children[slot:]:
                state = merkle.absorb(state, merkle.hex_blocks(np.frombuffer(bytes.fromhex(c), np.uint8)[None, :]))
            assert merkle.finish(state, np.array([len(children)]))[0].tobytes() == bytes(r["digest"])


def test_manifest_of_nothing_and_of_long_texts(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    empty = merkle.manifest(merkle.document_leaves(spark.createDataFrame([], schema)))
    assert empty.root is None and merkle.folded(empty).count() == 0
    docs = spark.createDataFrame([(2, "a", None, 3, "y\n" * 300000), (4, "a", None, 3, "y" * 700000)], schema)
    assert order_of((int(r[0]), *r[1:]) for r in merkle.folded(merkle.manifest(merkle.document_leaves(docs))).collect()) == order_of(manifest_of(docs.collect()))


# --- hard negatives -----------------------------------------------------------------------

def mined(rows):
    """Brute force over (vec_id, embedding, label)."""
    part = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            part.append((i, label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (i, label, v) in enumerate(part):
        if i is None or i % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j if j is not None else negatives.NO_ID, l, b) for b, (j, l, w) in enumerate(part) if b != a]
        scored.sort(key=lambda s: s[:2])
        name = lambda j: None if j == negatives.NO_ID else j
        for score, j, *_ in [s for s in scored if s[2] == label][:5]:
            inside = [s for s in scored if s[2] != label and -50 * score <= -100 * s[0] <= -95 * score][:3]
            out += [(i, name(j), k + 1, name(n), -score, -s) for k, (s, n, *_) in enumerate(inside)]
    return sorted(out, key=str)


def mine(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("clash")).withColumn("cell", F.lit(1))
    got = negatives.hard_negatives(negatives.taking_part(df), (F.col("key") != negatives.NO_ID) & (F.col("key") % 50 == 0), **how)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def vectors(n, seed, dims=12, groups=8, spread=0.15):
    draw = np.random.default_rng(seed)
    centre = draw.normal(size=(groups, dims))
    x = centre[draw.integers(0, groups, n)] + spread * draw.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, [float(np.float32(c)) for c in v], int(draw.integers(0, 4))) for i, v in enumerate(x)]


def test_hard_negatives_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 64)
    monkeypatch.setattr(negatives, "QUERY_ROWS", 4)
    rows = vectors(700, 1)
    rows += [(None, rows[3][1], 1), (None, rows[0][1], 2), (50, rows[9][1], 3), (50, rows[50][1], rows[50][2]), (7, None, 1), (14, rows[1][1], None)]
    rows += [(2000 + i, [1.0, 2.0, bad] + [0.0] * 9, 1) for i, bad in enumerate([None, math.nan, math.inf, -math.inf])]
    rows += [(3000, [], 1), (3050, [0.5], 2), (3100, [0.1] * 15, 2), (3150, [-0.3] * 12, 9)]
    rows += [(4000 + i, rows[50][1], i % 4) for i in range(200)]  # equal vectors: ties by id, one hot cell
    assert mine(spark, rows, cell_rows=40, sample_rows=100) == mined(rows)


def test_no_rows_and_lone_labels(spark):
    assert mine(spark, []) == [] and mine(spark, [(50, [1.0, 0.0], 1)]) == []
    alone = [(50, [1.0, 0.0], 1), (1, [0.5, 0.5], 2), (100, [0.3, 0.1], 3)]
    assert mine(spark, alone) == mined(alone) == []


def test_bounds_hold_and_cells_stay_unvisited(spark):
    rows = vectors(1500, 4, groups=12, spread=0.05)
    index = negatives.build(negatives.taking_part(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")), cell_rows=15)
    held = collections.defaultdict(list)
    for r in index.rows.collect():
        held[r["cell"]].append(r["vec"])
    asked = index.rows.filter("key % 50 = 0")
    for r in negatives.next_cells(index, asked, 0, 3).collect():
        shown = {c: max(float(np.dot(r["vec"], v)) for v in held[c]) for c in held}
        assert len(r["cells"]) == 3 and all(s <= r["bound"] for c, s in shown.items() if c not in r["cells"])
    walked = [list(negatives.walk(np.array(a), np.array(b), {c: 1 for c in range(len(a) * len(b)) if c % 3})) for a, b in (([3.0, 5, 1], [2.0, 2]), ([0.0], [1.0]))]
    for way in walked:
        assert [b for _, b in way] == sorted((b for _, b in way), reverse=True)
    assert sorted(c for c, _ in walked[0]) == [1, 2, 4, 5]
    # Grouped vectors: after 6 of the cells, five positives above the bound of the next cell are certain for nearly all anchors.
    every = index.rows.collect()
    early = [
        sorted((np.dot(r["vec"], o["vec"]) for o in every if o["label"] == r["label"] and o["rid"] != r["rid"]), reverse=True)[4] > r["bound"]
        for r in negatives.next_cells(index, asked, 0, 6).collect()]
    assert len(index.sizes) > 10 and np.mean(early) > 0.9
    assert mine(spark, rows, cell_rows=15) == mined(rows)
