"""Operator 5: personal data by bootstrapped contextual extraction, in SQL functions only.

Seeds are what fixed patterns find: mail and network addresses, card and phone numbers.
The words beside seeds are lexical patterns. Patterns and instances form a graph: a pattern is as reliable as
the share of its instances that are of one kind, an instance as likely as the mean
of its patterns. Spark scores the graph for a few rounds; patterns that are reliable and seen
with enough different instances then name identifiers that the fixed patterns miss, if they
look like the kind.

Texts are read once; afterwards only a narrow table of spans is joined and grouped. Edges are
folded to distinct (instance, pattern) first, so a hot word or a copied instance costs one edge per partner.

Defined results: null counts as the empty text and has no spans; rows with equal or null ids are scanned
on their own; repeated rows give repeated results but one instance; ties are ordered by kind and place; columns beyond id
and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import joined, pieces, positions, stored, table

# Fixed patterns. Lookbehind and possessive quantifiers only spare attempts that cannot match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: What may be an identifier: groups of digits with single blanks between them, or a run of characters with a digit or an at sign.
CANDIDATE = (
    r"(?<![^\x00-\x20])(?:[+(]*+[0-9][0-9().-]*+(?:\x20[(]?[0-9][0-9().-]*+)++[^\x00-\x20]*+|[^\x00-\x200-9@]*+[0-9@][^\x00-\x20]*+)")
NAMES = ["email", "ip", "card", "phone"]
PATTERNS = [EMAIL, IP, CARD, PHONE, CANDIDATE]
LOOKS = [r"@", r"[0-9][.:][0-9]", r"[0-9](?:[^A-Za-z0-9]*+[0-9]){11}", r"[0-9](?:[^A-Za-z0-9]*+[0-9]){6}"]
#: Context words are first looked for in so many characters; if they reach further, in the whole text.
NEAR = 48
ROUNDS = 3
LEAST_SUPPORT = 5
LEAST_PATTERN = 0.8
LEAST_INSTANCE = 0.8
PRIOR = 1.0


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    n = F.length(digits)
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), n))
    total = F.aggregate(at, F.lit(0), lambda s, i: s + F.when(
        (n - i) % 2 == 1, F.get(F.array(*map(F.lit, [0, 2, 4, 6, 8, 1, 3, 5, 7, 9])), F.substr(digits, i, F.lit(1)).cast("int"))
    ).otherwise(F.substr(digits, i, F.lit(1)).cast("int")))
    return total % 10 == 0


def _valid(kind: Column, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    parts = F.transform(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return (
        F.when(kind == 1, F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False)))
        .when(kind == 2, F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False))
        .when(kind == 3, F.length(digits).between(8, 15))
        .otherwise(found.isNotNull()))


def word_before(text: Column) -> Column:
    """The last run of characters above the blank, whole; empty if there is none."""
    near = F.substring(text, -NEAR, NEAR)
    whole = F.substring_index(F.rtrim(F.regexp_replace(text, r"[\x00-\x1F]", " ")), " ", -1)
    return F.when((F.length(text) <= NEAR) | near.rlike(r"[\x00-\x20][^\x00-\x20]+[\x00-\x20]*$"), F.regexp_extract(
        near, r"([^\x00-\x20]+)[\x00-\x20]*$", 1)).otherwise(whole)


def word_after(text: Column) -> Column:
    """The first run of characters above the blank, whole; empty if there is none."""
    near = F.substring(text, 1, NEAR)
    whole = F.substring_index(F.ltrim(F.regexp_replace(text, r"[\x00-\x1F]", " ")), " ", 1)
    return F.when((F.length(text) <= NEAR) | near.rlike(r"^[\x00-\x20]*[^\x00-\x20]+[\x00-\x20]"), F.regexp_extract(
        near, r"^[\x00-\x20]*([^\x00-\x20]+)", 1)).otherwise(whole)


def extracted(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, kind, start, end, instance, looks, left, right): base spans and candidates of every document.

    Documents without any have one row without a kind.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    digit = text.rlike("[0-9]")
    when = [F.contains(text, F.lit("@")), digit, digit, F.contains(text, F.lit("+")), digit | F.contains(text, F.lit("@"))]
    found = F.concat(*[pieces(text, p, k, w) for k, (p, w) in enumerate(zip(PATTERNS, when))])
    # The row number comes first: beside a generator it would number the generated rows.
    marked = docs.select("doc_id", found.alias("found")).withColumn("rid", F.monotonically_increasing_id())
    rows = marked.select("rid", "doc_id", F.posexplode_outer("found").alias("pos", "p")).select(
        "rid", "doc_id", "pos", "p.kind", "p.before", "p.found")
    place = Window.partitionBy("rid", "kind").orderBy("pos")
    good = _valid(F.col("kind"), F.col("found"))
    spans = positions(rows).withColumn("after", F.lead("before").over(place)).select(
        "rid", "doc_id", F.when(good, F.col("kind")).alias("kind"), F.when(good, F.col("start")).alias("start"), F.when(good, F.col("end")).alias("end"),
        F.xxhash64("found").alias("instance"), F.sha2(F.col("found").cast("binary"), 256).alias("name"),
        F.array(*[F.col("found").rlike(p) for p in LOOKS]).alias("looks"),
        F.lower(word_before(F.col("before"))).alias("left"), F.lower(word_after(F.col("after"))).alias("right"),
        (F.col("kind").isNull() | (F.col("pos") == 0)).alias("first"))
    return spans.filter("kind is not null or first").drop("first")


def free_candidates(spans: DataFrame) -> DataFrame:
    """Candidates that touch no base span, by the furthest end before and the nearest start after them."""
    base = F.col("kind") < len(NAMES)
    order = Window.partitionBy("rid").orderBy("start", "kind")
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # A base span that starts inside the candidate comes later in order; the nearest start is enough.
    after = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    seen = spans.filter("kind is not null").withColumns({"_before": before, "_after": after})
    free = (F.coalesce("_before", F.lit(-1)) <= F.col("start")) & (F.coalesce("_after", F.col("end")) >= F.col("end"))
    return seen.filter((F.col("kind") == len(NAMES)) & free).drop("_before", "_after")


def bootstrap(
    spans: DataFrame, candidates: DataFrame, rounds: int = ROUNDS, least_support: int = LEAST_SUPPORT,
    least_pattern: float = LEAST_PATTERN, least_instance: float = LEAST_INSTANCE,
) -> DataFrame:
    """(name, kind) of unseen instances that reliable patterns name."""
    left, right = F.nullif(F.col("left"), F.lit("")), F.nullif(F.col("right"), F.lit(""))
    either = F.when(left.isNotNull() | right.isNotNull(), F.concat(F.lit("B "), F.col("left"), F.lit(" "), F.col("right")))
    lexical = F.array_compact(F.array(F.concat(F.lit("L "), left), F.concat(F.lit("R "), right), either))
    known = spans.filter(F.col("kind") < len(NAMES))
    every = known.unionByName(candidates.withColumn("kind", F.lit(-1))).select(
        "name", "kind", "looks", F.explode(lexical).alias("pattern"))
    edges = stored(every.groupBy("name", "kind", "pattern").agg(F.first("looks").alias("looks")), "pii-edges")
    is_kind = [F.coalesce((F.col("kind") == k).cast("double"), F.lit(0.0)) for k in range(len(NAMES))]
    belief = None
    for _ in range(rounds):
        if belief is None:
            mass = edges.withColumns({f"b{k}": is_kind[k] for k in range(len(NAMES))})
        else:
            mass = edges.join(belief, ["name", "kind"], "left").withColumns(
                {f"b{k}": F.when(F.col("kind") >= 0, is_kind[k]).otherwise(F.coalesce(f"b{k}", F.lit(0.0))) for k in range(len(NAMES))})
        patterns = stored(mass.groupBy("pattern").agg(
            *[(F.sum(f"b{k}") / (F.count(F.lit(1)) + PRIOR)).alias(f"c{k}") for k in range(len(NAMES))],
            *[F.sum(is_kind[k]).alias(f"s{k}") for k in range(len(NAMES))]), "pii-patterns")
        unseen = edges.filter("kind = -1").join(patterns, "pattern")
        belief = stored(unseen.groupBy("name", "kind").agg(
            *[F.avg(F.when((F.col(f"s{k}") >= least_support) & F.col("looks")[k], F.col(f"c{k}")).otherwise(0.0)).alias(f"b{k}") for k in range(len(NAMES))],
            *[F.max(F.when((F.col(f"s{k}") >= least_support) & (F.col(f"c{k}") >= least_pattern) & F.col("looks")[k], F.col(f"c{k}"))).alias(f"t{k}")
              for k in range(len(NAMES))]), "pii-belief")
    top = F.greatest(*[F.struct(F.when(F.col(f"t{k}").isNotNull(), F.greatest(f"t{k}", f"b{k}")).otherwise(0.0).alias("score"), F.lit(k).alias("kind")) for k in range(len(NAMES))])
    return belief.select("name", top.alias("top")).filter(F.col("top.score") >= least_instance).select("name", F.col("top.kind").alias("as"))


def find_pii(docs: DataFrame, **how) -> DataFrame:
    """(rid, doc_id, kind, start, end): base spans and discovered ones; a row without a kind if there are none."""
    spans = stored(extracted(docs), "pii-spans")
    candidates = stored(free_candidates(spans), "pii-candidates")
    found = candidates.join(bootstrap(spans, candidates, **how), "name")
    columns = ["rid", "doc_id", "kind", "start", "end"]
    # Rows of candidates stay as rows without a kind, so every document keeps a row.
    base = F.col("kind") < len(NAMES)
    own = spans.select("rid", "doc_id", *[F.when(base, F.col(c)).alias(c) for c in columns[2:]])
    return own.withColumn("found", F.lit(False)).unionByName(
        found.select("rid", "doc_id", F.col("as").alias("kind"), "start", "end").withColumn("found", F.lit(True)))


def op5_bootstrapped_pii(spark, sf_dir):
    return pii_report(find_pii(table(spark, sf_dir, "documents")))


def pii_report(spans: DataFrame) -> DataFrame:
    """Base counts and digest count base spans only; ``spans`` and ``n_found`` also the discovered ones."""
    n = len(NAMES)
    every = F.filter(F.collect_list(F.struct("kind", "start", "end", "found")), lambda s: s["kind"].isNotNull())
    counts = [F.count(F.when((F.col("kind") == k) & ~F.col("found"), 1)).alias(f"n_{NAMES[k]}") for k in range(n)]
    rows = spans.groupBy("rid", "doc_id").agg(*counts, F.count(F.when(F.col("found"), 1)).alias("n_found"), every.alias("all"))
    own = F.filter("all", lambda s: ~s["found"])
    return rows.select(
        "doc_id", *[f"n_{k}" for k in NAMES], F.sha2(joined(own, NAMES, True).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("all"), NAMES, True).alias("spans"), "n_found")


QUERIES = {"op5_bootstrapped_pii": op5_bootstrapped_pii}
ORACLES = {}
