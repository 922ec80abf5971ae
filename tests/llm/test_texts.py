"""Language, main text, URL filter, token rollups and the pipeline."""

import collections
import math
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import article, langid, rollups, urls
from tidewatch.llm.common import new_folder

SF = "/root/testdata/sf0.01"


# --- language ID --------------------------------------------------------------------

def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.op9_language_filters(spark, SF)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == docs.count()
    judged = out.filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").filter("lang is not null")
    assert judged.filter("lang = lang_pred").count() / judged.count() > 0.98
    assert out.filter("score < 0 or score > 1").count() == 0


def test_odd_texts_and_labels(spark):
    learn = [(i, f"the quick brown fox number {i} jumps over the lazy dog", "en") for i in range(20)]
    learn += [(i, f"der schnelle braune Fuchs nummer {i} springt über den faulen Hund", "de") for i in range(20, 40)]
    learn += [(50, None, "en"), (51, "nothing", None), (None, "the dog", "en")]
    schema = "doc_id long, text string, lang string"
    model = langid.fit(spark.createDataFrame(learn, schema))
    assert model.languages == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 !? 3"), (4, "The lazy dog"), (5, "Der faule Hund"), (6, "zzzz qqqq xxxx"), (None, "der braune Fuchs"), (8, "the lazy dog " * 200000)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score_ string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == got[8][0] == "en" and got[5][0] == got[None][0] == "de" and got[6][1] < 0.2
    empty = langid.fit(spark.createDataFrame([], schema))
    assert langid.predict(docs, empty).filter("lang_pred <> 'und'").count() == 0
    assert langid.predict(docs.limit(0), model).count() == 0


def test_all_labelled_texts_teach(spark):
    """Words of three texts each among 6,000 of a language are all learned, and every text counts for the cuts."""
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3)) * 2
    rows = [(i, f"{name(i // 3)} {name(i // 3)[::-1]}", "en") for i in range(6000)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(labelled)
    assert min(model.predict(text)[1] for _, text, _ in rows[::3]) > 0.9
    assert set(langid.calibrated(labelled, model, error=1 / 6000)) == {3}


def test_filters_hold_what_was_inserted_and_know_their_errors():
    draw = np.random.default_rng(2)
    slots, probes = 1 << 12, 3
    inside = {i: draw.integers(0, 1 << 62, 600).astype(np.uint64) for i in range(3)}
    masks = np.zeros(slots, np.uint8)
    for i, codes in inside.items():
        for p in range(probes):
            np.bitwise_or.at(masks, langid.slots_of(codes, p, slots), np.uint8(1 << i))
    filters = langid.LanguageFilters(["a", "b", "c"], masks, 4, probes)
    for i, codes in inside.items():
        assert (filters.languages_of(codes) & np.uint8(1 << i)).all()
    strangers = draw.integers(0, 1 << 62, 50000).astype(np.uint64)
    found = filters.languages_of(strangers)
    for i in range(3):
        assert np.mean(found & np.uint8(1 << i) > 0) == pytest.approx(filters.false_rate[i], abs=0.01)


# --- main text -----------------------------------------------------------------------

STORY = "This is a long paragraph, with commas, and words, which nobody would call a menu. " * 3
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body>
<header><p>Site header, {STORY}</p></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies, {STORY}</div><div id=content><h1>Fish &amp; chips</h1>
<p>{STORY}<p><b>bold
 &nbsp; text</b> here <br>more, {STORY}<ul><li>one</li><li>two</li></ul><blockquote>quoted</blockquote>
<form><p>Your name, {STORY}</p></form><div class="ad">Buy, {STORY}</div></div>
<aside><p>{STORY}</p></aside><section class=comments><p>First!, {STORY}</p></section><footer>&copy;</footer></body></html>"""


def test_article_without_furniture():
    story = " ".join(STORY.split())
    assert article.main_text(PAGE).split("\n") == ["Fish & chips", story, f"bold text here more, {story}", "one", "two", "quoted"]


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain &lt;text&gt;", "plain <text>"), ("<p>a</p><p>b", "a\nb"), ("<nav>only menu</nav>", ""), ("<p", ""), ("a < b", "a < b"),
    ("</p></div>x", "x"), ("<!-- <p>c</p> --><p>d</p>", "d"), ("<script>x", ""), ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep")])
def test_odd_pages(page, want):
    assert article.main_text(page) == want


def test_links_discount_and_siblings_stay():
    links = "".join(f"<li><a href=/{i}>A rather long link text, number {i}</a></li>" for i in range(40))
    page = f"<body><div class=x><ul>{links}</ul></div><div class=y><p>{STORY}</p></div><div class=z><p>{STORY}</p></div></body>"
    story = " ".join(STORY.split())
    assert article.main_text(page) == f"{story}\n{story}"


def test_article_in_several_wrapped_sections_stays_whole():
    story = " ".join(STORY.split())
    wrapped = "".join(f"<div class=row><div class=col><p>{i} {STORY}</p></div></div>" for i in range(3))
    menu = "<ul>" + "".join(f"<li><a href=/{i}>A rather long link text, {i}</a></li>" for i in range(9)) + "</ul>"
    want = [f"{i} {story}" for i in range(3)]
    for page in (f"<body>{menu}<div class=site>{wrapped}</div></body>", f"<body><div class='site has-sidebar comments-open'>{wrapped}</div>{menu}</body>"):
        assert article.main_text(page).split("\n") == want
    mixed = f"<body>{menu}<div><div><p>{STORY * 8}</p></div></div><div><div><p>{STORY}</p></div></div><section><h3>End</h3><p>Short closing.</p></section><pre>x = 1</pre></body>"
    assert article.main_text(mixed).split("\n") == [" ".join((STORY * 8).split()), story, "End", "Short closing.", "x = 1"]
    names = {"sidebar": 1, "site-header": 1, "ad-3": 1, "cookie-notice big": 1, "has-sidebar": 0, "side-by-side": 0, "social-science": 0, "article-header": 0}
    assert {n: int(article.is_bad("div", f' class="{n}"')) for n in names} == names


def test_pages_query(spark):
    out = article.op3_tree_scoring(spark, SF)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert out.filter("n_chars <> length(text) or text is null").count() == 0 and out.count() == 250
    odd = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>a</p>", "x")], "page_id long, url string, html string, text string")
    assert {(r["page_id"], r["text"], r["n_chars"]) for r in article.extracted(odd).collect()} == {(1, "", 0), (None, "a", 1)}
    assert article.extracted(odd.limit(0)).count() == 0


# --- URL filter ----------------------------------------------------------------------

def test_rules(spark):
    cases = {
        None: ("", "", None), "example.com/en/": ("", "", None), "https://a.COM/x": ("a.com", "/x", "com/"), "http://com": ("com", "", None),
        "x://example.com/en/1?q#f": ("example.com", "/en/1", "example.com/en/"), "x://www.Example.com/en/": ("www.example.com", "/en/", "www.example.com/en/"),
        "x://m.example.com/en": ("m.example.com", "/en", "com/"), "x://a.b.net/es/?u=://": ("a.b.net", "/es/", "net/es/"), "x://net/fr/": ("net", "/fr/", "net/fr/"),
        "x://planet/fr/": ("planet", "/fr/", None), "x://org#/fr/": ("org", "", None), "x://a.net?/fr/": ("a.net", "", None), "://A\n.com/": ("a\n.com", "/", "com/"),
    }
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in urls.judged(pages).collect()}
    for i, (url, want) in enumerate(cases.items()):
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == want, url
        assert r["verdict"] == ({v: k for v, k in ((h + p, k) for k, h, p in urls.RULES)}.get(want[2]) or r["verdict"])
    assert urls.judged(pages.limit(0)).count() == 0
    free = urls.judged(pages.filter("page_id = 0 or page_id = 9"))
    assert {r["verdict"] for r in free.collect()} == {"allow"}


def test_ratio_is_the_difference_of_two_smoothed_models(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    out = {r["page_id"]: r for r in urls.judged(pages).collect()}
    host, path = urls.parts(F.col("url"))
    rows = pages.select("page_id", host.alias("h"), path.alias("p"), (F.pmod(F.xxhash64(host, path), F.lit(urls.CALIBRATION)) == 0).alias("out")).collect()
    grams, contexts = [collections.Counter(), collections.Counter()], [collections.Counter(), collections.Counter()]

    def walk(r):
        t = "^" * urls.ORDER + r["h"] + r["p"] + "$"
        for i in range(urls.ORDER, len(t)):
            yield [(t[i - k:i + 1], t[i - k:i]) for k in range(urls.ORDER + 1)]

    verdict = {h + p: v for v, h, p in urls.RULES}
    for r in rows:
        rule = out[r["page_id"]]["rule"]
        if rule and not r["out"]:
            side = verdict[rule] == "block"
            for orders in walk(r):
                for g, c in orders:
                    grams[side][g] += 1
                    contexts[side][len(c), c] += 1
    for r in rows[:40]:
        total = []
        for orders in walk(r):
            both = []
            for side in (0, 1):
                p = 1 / urls.ALPHABET
                for g, c in orders:
                    p = (grams[side][g] + urls.BACKOFF * p) / (contexts[side][len(c), c] + urls.BACKOFF)
                both.append(math.log(p))
            total.append(both[0] - both[1])
        assert out[r["page_id"]]["ratio"] == pytest.approx(sum(total) / len(total), abs=1e-9)


def test_verdicts_on_urls_that_neither_taught_nor_calibrated(spark):
    """Of the labelled URLs that are kept out, one half fits the threshold and the other is judged by it, and the other way round."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    verdict = F.create_map(*[F.lit(x) for v, h, p in urls.RULES for x in (h + p, v)])
    host, path = urls.parts(F.col("url"))
    out = urls.judged(pages).filter("rule is not null").withColumn("label", verdict[F.col("rule")]).join(
        pages.filter(F.pmod(F.xxhash64(host, path), F.lit(urls.CALIBRATION)) == 0).select("page_id"), "page_id").cache()
    right = []
    for half in (0, 1):
        cut = urls.threshold(out.filter(F.col("page_id") % 2 == half).select("label", "ratio"))
        right += [(r["ratio"] >= cut) == (r["label"] == "allow") for r in out.filter(F.col("page_id") % 2 != half).collect()]
    assert len(right) > 150 and sum(right) / len(right) > 0.95


def test_many_ngrams_keep_their_own_counts(spark):
    draw = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789"))
    tails = ["".join(draw.choice(letters, 60)) for _ in range(4000)]
    heads = ["x://a.com/", "x://a.net/fr/", "x://a.org/"]
    rows = [(i, heads[i % 3] + t) for i, t in enumerate(tails)] + [(9001, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judged(pages).collect()}
    host, path = urls.parts(F.col("url"))
    train = {r["page_id"] for r in pages.filter(F.pmod(F.xxhash64(host, path), F.lit(urls.CALIBRATION)) != 0).collect()}
    counts = [collections.Counter(), collections.Counter()]

    def text(i, url):
        return "^" * urls.ORDER + url.split("://")[-1] + "$"

    def orders(t, i):
        return [(t[i - k:i + 1], (k, t[i - k:i])) for k in range(urls.ORDER + 1)]

    for i, url in rows:
        if i in train and got[i]["rule"]:
            t = text(i, url)
            counts[got[i]["rule"] != "com/"].update(x for at in range(urls.ORDER, len(t)) for pair in orders(t, at) for x in pair)
    assert len({x for c in counts for x in c if isinstance(x, str) and len(x) == urls.ORDER + 1}) > 100000
    for i, url in rows[:30] + rows[-1:]:
        t, total = text(i, url or ""), []
        for at in range(urls.ORDER, len(t)):
            p = [1 / urls.ALPHABET] * 2
            for g, c in orders(t, at):
                p = [(counts[s][g] + urls.BACKOFF * p[s]) / (counts[s][c] + urls.BACKOFF) for s in (0, 1)]
            total.append(math.log(p[0]) - math.log(p[1]))
        assert got[i]["ratio"] == pytest.approx(sum(total) / len(total) if url else 0.0, abs=1e-9), url
    shuffled = {r["page_id"]: r for r in urls.judged(pages, broadcast_bytes=0).collect()}
    assert all(shuffled[i]["verdict"] == r["verdict"] and shuffled[i]["ratio"] == pytest.approx(r["ratio"], abs=1e-9) for i, r in got.items())


# --- token rollups ---------------------------------------------------------------------

def test_rollup_applies_every_batch_once(spark):
    store = rollups.Rollup(spark, new_folder(spark, "test-rollup"))
    assert store.totals().count() == 0
    rows = spark.createDataFrame([("a", "en", 3, 5), (None, None, 1, 2), ("a", "en", 3, 5)], "source string, lang string, v1 long, v2 long")
    assert store.commit(1, rollups.inserts(rows, "one", "v1"))
    assert not store.commit(1, rollups.inserts(rows, "one", "v1"))
    seen = lambda: {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"]) for r in store.totals().collect()}
    assert seen() == {("a", "en", "one"): (2, 6), (None, None, "one"): (1, 1)}
    # A batch that failed after its delta was written, before its commit, is not seen and is overwritten.
    rollups.inserts(rows, "two", "v2").groupBy("source", "lang", "tokenizer").agg(F.lit(9).cast("long").alias("docs"), F.lit(9).cast("long").alias("tokens")
                                                                                ).write.parquet(f"{store.deltas}/batch=2")
    assert seen() == {("a", "en", "one"): (2, 6), (None, None, "one"): (1, 1)}
    assert store.commit(2, rollups.revisions(rows, ("one", "v1"), ("two", "v2")))
    assert seen() == {("a", "en", "two"): (2, 10), (None, None, "two"): (1, 2)}
    assert store.commit(3, rollups.inserts(rows.limit(1), "two", "v2", sign=-1))
    assert seen() == {("a", "en", "two"): (1, 5), (None, None, "two"): (1, 2)}


def test_token_totals_of_distinct_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    encode = rollups.encoder(rollups.VOCABULARY).encode_ordinary
    first, want = {}, collections.Counter()
    for r in sorted(docs, key=lambda r: r["doc_id"]):
        first.setdefault(r["text"] or "", r)
    for text, r in first.items():
        want[r["source"], r["lang"], "docs"] += 1
        want[r["source"], r["lang"], "tokens"] += len(encode(text))
    got = collections.Counter()
    for r in rollups.op6_token_rollups(spark, SF).collect():
        assert r["tokenizer"] == rollups.BPE
        got[r["source"], r["lang"], "docs"], got[r["source"], r["lang"], "tokens"] = r["n_docs"], r["n_tokens"]
    assert got == want


# --- pipeline ------------------------------------------------------------------------------

def test_stages_keep_their_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    sys.path.insert(0, "tests/llm")
    from test_groups import classes, groups_of, judged
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.columns
    now = docs.filter("doc_id < 400")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r["doc_id"], r["text"], r["source"]) for r in now.collect()]
        rows = stage(spark, now, SF).collect()
        left = {r["doc_id"] for r in rows}
        assert list(rows[0].asDict()) == columns
        if name == "language_id":
            assert left == {i for i, _, _ in before}
        elif name == "exact_dedup":
            assert left == {min(v) for v in groups_of(before).values()}
        elif name == "near_dedup":
            assert left == set(classes([b for b in before]).values())
        else:
            assert left == {i for i, t, _ in before if not judged(t, items)[4]}
        now = spark.createDataFrame(rows, docs.schema)
    mixed = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in now.collect()}
    assert all(r["text"] == texts[r["doc_id"]] for r in mixed) and len(mixed) == len({r["doc_id"] for r in mixed})
    assert mixed and {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in now.collect()} and all(r["copies"] >= 1 for r in mixed)


def test_language_cuts_keep_clean_documents_of_any_length(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labelled = docs.filter(~langid.held_out(F.col("doc_id")))
    model = langid.fit(labelled)
    cuts = langid.calibrated(labelled, model)
    tagged = langid.predict(docs.filter("lang is not null and text is not null"), model)
    left = langid.accepted(tagged, cuts)
    lost = tagged.join(left.select("doc_id"), "doc_id", "left_anti").filter(langid.held_out(F.col("doc_id")) & (F.col("lang_pred") != "und")).count()
    assert lost <= 0.003 * tagged.filter(langid.held_out(F.col("doc_id"))).count()
    assert left.filter("doc_id = 4616").count() == 1  # "A."
    assert len(cuts) >= 2 and all(0.2 < c <= 0.5 for c in cuts.values())
    odd = spark.createDataFrame([(1, "12 34"), (2, None), (3, "ქართული ენა არის " * 40), (4, "The")], "doc_id long, text string")
    assert {r["doc_id"] for r in langid.accepted(langid.predict(odd, model), cuts).collect()} == {4}
    assert langid.accepted(langid.predict(odd, model), {}).count() == 2


def test_gram_counts_hold_a_part_of_the_texts_and_count_all():
    rng = np.random.default_rng(5)
    texts = ["".join(map(chr, rng.integers(97, 115, 20_000))) for _ in range(300)]
    pairs = [("ab"[i % 2], t) for i, t in enumerate(texts)] + [("b", None), ("a", "12 3")]
    tracemalloc.start()
    counted = list(langid.gram_counts(iter(pairs)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45 << 20  # the codes of all texts of a batch at a time took 76 MB
    for lang in "ab":
        sums = collections.Counter()
        for _, codes, n in (x for x in counted if x[0] == lang):
            sums.update(dict(zip(codes.tolist(), n.tolist())))
        code, n = np.unique(np.concatenate([langid.grams(t) for k, t in pairs[:300] if k == lang]), return_counts=True)
        assert sums == dict(zip(code.tolist(), n.tolist()))


def test_language_id_hands_over_few_rows_and_holds_one_text(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    before = spark.conf.get(name)
    try:
        for given, want in (("10000", "1000"), ("0", "1000"), ("64", "64")):
            spark.conf.set(name, given)
            corpus_pipeline.STAGES[0][1](spark, docs, SF)
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, before)
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 2000), pa.array(["\u4e2d" * 2000] * 2000)], names=["lang", "text"])
    tracemalloc.start()
    assert sum(len(text) for _, text in langid.pairs_of(iter([batch]))) == 4_000_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 20
