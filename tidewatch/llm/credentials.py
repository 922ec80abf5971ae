"""Operator 2: secret scan with multipart credential linking.

Strong findings (assignments, access keys, long hex strings) come from fixed patterns over
the whole text. Weaker parts are only candidates: account names, opaque strings and
endpoints. An interval join inside a scope (a document) links parts whose
intervals lie within ``reach`` characters; a candidate is reported only if the parts it needs
to make up a credential are there: an opaque string needs an access identifier and an
endpoint or account, an account needs a secret and an endpoint, an endpoint needs both an identifier and a secret.

The join is on (document, role, stretch of text) and returns each candidate once per
role, so its size follows the number of parts, not of pairs.

Defined results: null counts as the empty text and has no spans; repeated rows and rows with
equal or null ids are scanned on their own; ties in place are ordered by kind; columns
beyond id and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import joined, pieces, positions, stored, table

# Fixed patterns of the base findings.
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]++"""
ASSIGN_VALUE = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"[0-9a-f]{32,}+"
# Parts that are no finding alone.
ACCOUNT = r"""(?:[Uu]ser(?:name)?|[Ll]ogin|[Aa]ccount|[Cc]lient_?[Ii][Dd]|[Aa]ccess_?[Kk]ey(?:_?[Ii][Dd])?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}+"""
OPAQUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
ENDPOINT = r"""[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20"'<>]++"""
NAMES = ["assign", "access", "hex", "account", "opaque", "endpoint"]
PATTERNS = [ASSIGN, ACCESS, HEX, ACCOUNT, OPAQUE, ENDPOINT]
#: A cheap test that a text may match at all, per kind.
MAY = [r"[:=]", None, None, r"[:=]", None, None]
HOLDS = [None, "AKIA", None, None, None, "://"]
REACH = 200
BASE_KINDS = 3
#: Roles: 0 identifier, 1 secret, 2 endpoint; by kind. A weak kind needs all its roles in reach.
ROLE_OF = [1, 0, 1, 0, 1, 2]
NEEDS = {3: (1, 2), 4: (0, 2), 5: (0, 1)}


def scanned(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(rid, doc_id, kind, start, end): kept spans of each document, and one row without a kind if it has none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = []
    for kind, (pattern, may, holds) in enumerate(zip(PATTERNS, MAY, HOLDS)):
        when = F.contains(text, F.lit(holds)) if holds else text.rlike(may if may else pattern)
        found.append(pieces(text, pattern, kind, when))
    # The row number comes first: beside a generator it would number the generated rows.
    marked = docs.select("doc_id", F.concat(*found).alias("found")).withColumn("rid", F.monotonically_increasing_id())
    rows = marked.select("rid", "doc_id", F.posexplode_outer("found").alias("pos", "p")).select("rid", "doc_id", "pos", "p.kind", "p.before", "p.found")
    value = F.regexp_extract("found", ASSIGN_VALUE, 1)
    mixed = F.col("found").rlike("[0-9]") & F.col("found").rlike("[A-Z]") & F.col("found").rlike("[a-z]")
    good = (
        F.when(F.col("kind") == 0, F.length(value) >= 8).when(F.col("kind") == 1, F.length("found") >= 16)
        .when(F.col("kind") == 4, mixed).otherwise(F.col("found").isNotNull()))
    parts = positions(rows).select(
        "rid", "doc_id", F.when(good, F.col("kind")).alias("kind"), F.when(good, F.col("start")).alias("start"),
        F.when(good, F.col("end")).alias("end"), (F.col("kind").isNull() | (F.col("pos") == 0)).alias("first"))
    parts = stored(parts.filter("kind is not null or first").drop("first"), "secret-parts")
    return linked(parts, reach)


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """Drop weak candidates whose complementary parts aren't within reach in the same scope."""
    roles = F.element_at(F.array(*map(F.lit, ROLE_OF)), F.col("kind") + 1)
    strong = F.col("kind").isNull() | (F.col("kind") < BASE_KINDS)
    stretch = lambda x: F.floor(x / reach)
    spread = parts.filter("kind is not null").select(
        "rid", roles.alias("role"), F.col("start").alias("s"), F.col("end").alias("e"),
        F.explode(F.sequence(stretch(F.greatest(F.lit(0), F.col("start") - reach)), stretch(F.col("end") + reach))).alias("at"))
    weak = parts.filter(~strong)
    for n in range(2):
        needed = F.element_at(F.array(*[F.lit(NEEDS.get(k, (0, 0))[n]) for k in range(len(NAMES))]), F.col("kind") + 1)
        # A partner before the candidate is within reach of its start, one after it within reach of its end.
        ends = F.explode(F.array_distinct(F.array(stretch(F.col("start")), stretch(F.col("end")))))
        left = weak.withColumn("role", needed).withColumn("at", ends).alias("l")
        near = (F.col("s") - F.col("end") <= reach) & (F.col("start") - F.col("e") <= reach) & (
            # An opaque string inside an assignment isn't a part of its own.
            (F.col("e") <= F.col("start")) | (F.col("s") >= F.col("end")))
        weak = left.join(spread.alias("r"), (F.col("l.rid") == F.col("r.rid")) & (F.col("l.role") == F.col("r.role"))
                         & (F.col("l.at") == F.col("r.at")) & near, "left_semi").drop("role", "at").distinct()
    # A document keeps a row even if all it has are candidates.
    stubs = parts.filter(~strong).select("rid", "doc_id", *[F.lit(None).cast(parts.schema[c].dataType).alias(c) for c in ("kind", "start", "end")])
    return parts.filter(strong).unionByName(weak).unionByName(stubs)


def report(spans: DataFrame, names: list[str], base: int, by_kind: bool) -> DataFrame:
    """Per document: counts of base kinds, the digest of its base spans, and all spans."""
    every = F.filter(F.collect_list(F.struct("kind", "start", "end")), lambda s: s["kind"].isNotNull())
    counts = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{names[k]}") for k in range(base)]
    rows = spans.groupBy("rid", "doc_id").agg(*counts, every.alias("all"))
    own = F.filter("all", lambda s: s["kind"] < base)
    return rows.select(
        "doc_id", *[f"n_{names[k]}" for k in range(base)],
        F.sha2(joined(own, names, by_kind).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("all"), names, by_kind).alias("spans"))


def op2_linked_secrets(spark, sf_dir):
    return report(scanned(table(spark, sf_dir, "documents")), NAMES, BASE_KINDS, by_kind=False)


QUERIES = {"op2_linked_secrets": op2_linked_secrets}
ORACLES = {}
