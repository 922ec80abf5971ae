"""Rule, score, ensemble and report queries, with their SQL counterparts."""

from pyspark.sql import functions as F

from tidewatch.functions import bands
from tidewatch.functions.numbers import rounded
from tidewatch.operators import ensemble, reports, scoring, sequence
from tidewatch.operators.parse import parse_logs, valid_rows
from tidewatch.operators.rules import DEFAULT_RULES, RuleSet
from tidewatch.operators.skew import checkpointed
from tidewatch.plans.features import extract_features

from .data import PARSED, TX, events, raw_logs, to_transactions, transactions
from .features import BASIC, CONTEXT, profile_sql, r, sequence_sql

QUERIES, ORACLES = {}, {}
RULES = RuleSet()


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def ruled(spark, sf, rules=RULES):
    t = transactions(spark, sf)
    return rules.score(extract_features(t), source=t)


_D = lambda cond: f"CAST(coalesce({cond}, false) AS INT)::DOUBLE"
_FEAT = ", " + BASIC + ", " + sequence_sql("stats AS (SELECT quantile_cont(amount, 0.95) AS q95, quantile_cont(amount, 0.8) AS q80, avg(amount) AS am, stddev_samp(amount) AS asd FROM tx)") + ", " + CONTEXT + """,
  feat AS (SELECT hours.*, sequence.* EXCLUDE (tx_id), context.* EXCLUDE (tx_id), profile.* EXCLUDE (user_id), stats.*, e.k
    FROM hours LEFT JOIN sequence USING (tx_id) LEFT JOIN context USING (tx_id) LEFT JOIN profile ON hours.user_id = profile.user_id
    JOIN events_k e ON hours.tx_id = e.event_id, stats)"""
_RULE_SQL = {
    "large_amount": _D("amount > q95 OR abs((amount - am) / asd) > 3"),
    "unusual_hours": _D("hour >= 0 AND hour <= 6"),
    "high_velocity": _D("tx_velocity_24h > 5"),
    "unusual_location": _D("location_rarity > 0.05"),
    "device_change": f"least(0.5 * {_D('device_changed = 1')} + 0.3 * {_D('user_device_diversity > 0.5')}, 1)",
    "amount_deviation": _D("abs(amount_zscore_user) > 2.5"),
    "weekend_activity": _D("is_weekend AND amount > q80"),
    "rare_transaction_type": _D("type_rarity > 0.1"),
    "multiple_locations": _D("user_unique_locations >= 3"),
    "round_amounts": _D("amount % 100 = 0 AND amount >= 100"),
}
WEIGHTS = {x.name: x.weight for x in DEFAULT_RULES}
_SUM = " + ".join(f"rule_{n} * {w}::DOUBLE" for n, w in WEIGHTS.items())


def ruled_sql(tx):
    return f"""{profile_sql(tx)}{_FEAT}, rules0 AS (SELECT *, {', '.join(f'{s} AS rule_{n}' for n, s in _RULE_SQL.items())} FROM feat),
  ruled AS (SELECT *, ({_SUM}) / {sum(WEIGHTS.values())}::DOUBLE AS rule_score FROM rules0)"""


_RULED = ruled_sql(TX)
_RULE_COLS = [f"rule_{n}" for n in WEIGHTS]


@query("rule_scores", f"""WITH {_RULED} SELECT tx_id, {', '.join(_RULE_COLS)}, round_even(rule_score, 8) AS rule_score FROM ruled""")
def _(spark, sf):
    return ruled(spark, sf).select("tx_id", *_RULE_COLS, rounded(F.col("rule_score"), 8).alias("rule_score"))


for _name in WEIGHTS:
    def _rule(spark, sf, _name=_name):
        return ruled(spark, sf).select("tx_id", "user_id", f"rule_{_name}")
    query(f"rule_{_name}", f"WITH {_RULED} SELECT tx_id, user_id, rule_{_name} FROM ruled")(_rule)


_PAIRS = ", ".join(
    f"{{'n': '{n}', 'c': rule_{n} * {w}::DOUBLE, 's': rule_{n}, 'p': {i}}}" for i, (n, w) in enumerate(WEIGHTS.items()))
_PARTS = f"""parts AS (SELECT tx_id, unnest([{_PAIRS}]) AS x FROM ruled),
  fired AS (SELECT tx_id, string_agg(x.n, '; ' ORDER BY x.c DESC, x.p) AS names,
    string_agg(x.n, '; ' ORDER BY x.c DESC, x.p) FILTER (rn <= 3) AS top3, count(*) AS n
    FROM (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY x.c DESC, x.p) AS rn FROM parts WHERE x.s > 0) GROUP BY tx_id)"""
_FIRED = f"{_RULED}, {_PARTS}"


@query("rule_explanations", f"""WITH {_FIRED} SELECT tx_id, coalesce(names, '') AS triggered, round_even(rule_score, 8) AS total_score
  FROM ruled LEFT JOIN fired USING (tx_id)""")
def _(spark, sf):
    out = RULES.explain(ruled(spark, sf))
    names = F.array_join(F.transform("triggered_rules", lambda x: x["rule_name"]), "; ")
    return out.select("tx_id", names.alias("triggered"), rounded(F.col("total_score"), 8).alias("total_score"))


@query("rule_statistics", f"""WITH {_RULED} SELECT * FROM ({' UNION ALL '.join(
    f"SELECT '{n}' AS rule_name, {w}::DOUBLE AS weight, count(*) FILTER (rule_{n} > 0) AS triggered_count, "
    f"round_even(count(*) FILTER (rule_{n} > 0) / count(*), 8) AS trigger_rate, round_even(avg(rule_{n}), 8) AS mean_score, "
    f"max(rule_{n}) AS max_score, round_even(sum(rule_{n} * {w}::DOUBLE), 6) AS contribution_to_total FROM ruled"
    for n, w in WEIGHTS.items())})""")
def _(spark, sf):
    out = RULES.statistics(ruled(spark, sf)).drop("description")
    return out.withColumns({**r(8, "trigger_rate", "mean_score"), **r(6, "contribution_to_total")})


@query("rule_weights", f"""WITH {_RULED} SELECT tx_id, round_even(({_SUM.replace('rule_large_amount * 0.3', 'rule_large_amount * 0.6').replace(
    'rule_multiple_locations * 0.2', 'rule_multiple_locations * 0')}) / {sum(WEIGHTS.values()) + 0.3 - 0.2}::DOUBLE, 8) AS rule_score FROM ruled""")
def _(spark, sf):
    rules = RULES.with_weight("large_amount", 0.6).disabled("multiple_locations")
    return ruled(spark, sf, rules).select("tx_id", rounded(F.col("rule_score"), 8).alias("rule_score"))


@query("custom_rules", f"""WITH {_RULED} SELECT tx_id, {_D("user_tx_count > 60")} AS rule_busy_user, {_D("amount > 150 AND device IS NULL")} AS rule_no_device,
  round_even(({_SUM} + {_D("user_tx_count > 60")} * 0.2::DOUBLE + {_D("amount > 150 AND device IS NULL")} * 0.1::DOUBLE) / {sum(WEIGHTS.values()) + 0.3}::DOUBLE, 8) AS rule_score FROM ruled""")
def _(spark, sf):
    rules = RULES.with_rule(
        "busy_user", lambda p: (F.col("user_tx_count") > p["n"]).cast("double"), 0.2, "Very active user", {"n": 60},
    ).with_rule("no_device", "CAST(amount > 150 AND device IS NULL AS DOUBLE)", 0.1, "Larger amount without a device")
    return ruled(spark, sf, rules).select(
        "tx_id", "rule_busy_user", "rule_no_device", rounded(F.col("rule_score"), 8).alias("rule_score"))


@query("rule_top_anomalies", f"""WITH {_FIRED} SELECT tx_id, user_id, round_even(rule_score, 8) AS anomaly_score, {', '.join(_RULE_COLS)},
  coalesce(top3, '') AS top_triggered_rules FROM ruled LEFT JOIN fired USING (tx_id) ORDER BY rule_score DESC, tx_id LIMIT 10""")
def _(spark, sf):
    return RULES.top_anomalies(ruled(spark, sf), 10).select(
        "tx_id", "user_id", rounded(F.col("anomaly_score"), 8).alias("anomaly_score"), *_RULE_COLS, "top_triggered_rules")


LOG_TX = PARSED.replace("tx AS (", "etx AS (", 1).replace("tx.*", "etx.*").replace("FROM tx JOIN", "FROM etx JOIN") + """,
  tx AS (SELECT tx_id, timestamp, user_id, amount, transaction_type, location, device, currency FROM parsed WHERE is_parsed)"""


@query("logs_to_risk", f"""WITH {ruled_sql(LOG_TX)}, {_PARTS} SELECT tx_id, user_id, amount, round_even(rule_score, 8) AS anomaly_score,
  coalesce(top3, '') AS top_triggered_rules FROM ruled LEFT JOIN fired USING (tx_id) ORDER BY rule_score DESC, tx_id LIMIT 20""")
def _(spark, sf):
    """From raw log lines to the riskiest transactions: parse, clean, features, rules, explanations."""
    parsed = checkpointed(valid_rows(parse_logs(raw_logs(spark, sf))))
    scored = RULES.score(extract_features(parsed), source=parsed)
    return RULES.top_anomalies(scored, 20).select(
        "tx_id", "user_id", "amount", rounded(F.col("anomaly_score"), 8).alias("anomaly_score"), "top_triggered_rules")


@query("rule_flags", f"WITH {_RULED} SELECT rule_score > 0.5 AS is_anomaly, count(*) AS n FROM ruled GROUP BY 1")
def _(spark, sf):
    return RULES.flagged(ruled(spark, sf)).groupBy("is_anomaly").agg(F.count(F.lit(1)).alias("n"))


@query("rules_on_few_columns", f"""WITH {TX}, {BASIC}, stats AS (SELECT quantile_cont(amount, 0.95) AS q95, quantile_cont(amount, 0.8) AS q80,
    avg(amount) AS am, stddev_samp(amount) AS asd FROM tx)
  SELECT tx_id, round_even(({_RULE_SQL['large_amount']} * 0.3 + {_RULE_SQL['unusual_hours']} * 0.15 + {_RULE_SQL['weekend_activity']} * 0.1
    + {_RULE_SQL['round_amounts']} * 0.05) / 1.75, 8) AS rule_score FROM hours, stats""")
def _(spark, sf):
    from tidewatch.operators.basic import time_features
    out = RULES.score(time_features(transactions(spark, sf)).drop("day_of_week"))
    return out.select("tx_id", rounded(F.col("rule_score"), 8).alias("rule_score"))


@query("recent_locations", f"""WITH {TX}, n AS (SELECT a.tx_id, count(DISTINCT b.location) AS c FROM tx a JOIN tx b ON a.user_id = b.user_id
    AND b.timestamp <= a.timestamp AND b.timestamp >= a.timestamp - INTERVAL 24 HOUR GROUP BY a.tx_id)
  SELECT tx_id, coalesce(c, 0) AS recent_locations FROM tx LEFT JOIN n USING (tx_id)""")
def _(spark, sf):
    return sequence.distinct_locations_within(transactions(spark, sf), 24).select("tx_id", "recent_locations")


@query("velocity_1h", f"""WITH {TX}, n AS (SELECT a.tx_id, count(*) AS c FROM tx a JOIN tx b ON a.user_id = b.user_id
    AND b.timestamp < a.timestamp AND b.timestamp >= a.timestamp - INTERVAL 1 HOUR GROUP BY a.tx_id)
  SELECT tx_id, CASE WHEN user_id IS NOT NULL THEN coalesce(c, 0) END AS velocity_1h FROM tx LEFT JOIN n USING (tx_id)""")
def _(spark, sf):
    return sequence.trailing_count(transactions(spark, sf), 1, "velocity_1h").select("tx_id", "velocity_1h")


# --- scores of several methods ----------------------------------------------

#: What the reports and explanations below read besides the scores.
_READ = ["tx_id", "user_id", "amount", "location", "transaction_type"]


def scored(spark, sf):
    """Rule scores with three more score columns scaled from feature columns."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("k")
    t = to_transactions(events(spark, sf), k)
    f = RULES.score(extract_features(t), source=t).filter("tx_id IS NOT NULL").withColumn("_z", F.abs("amount_zscore_user"))
    columns = {"k": "isolation_forest_score", "tx_velocity_24h": "dbscan_score",
               "amount_percentile": "lof_score", "_z": "hdbscan_score"}
    # The ranges and the reports read the features several times: write what they read, once.
    f = checkpointed(f.select(*_READ, *_RULE_COLS, "rule_score", *columns))
    out = ensemble.combine_scores(scoring.minmax(f, columns))
    scores = [*columns.values(), "ensemble_score"]
    # Exploded, so that bands and filters on a score do not repeat its making.
    made = F.inline(F.array(F.struct(*scores)))
    return out.select(*[c for c in out.columns if c not in scores], made).select(*out.columns)


_MM = lambda c: f"coalesce(({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0), 0)"
SCORED = f"""{_RULED}, scored0 AS (SELECT *, CAST({_MM('k')} AS DOUBLE) AS isolation_forest_score, CAST({_MM('tx_velocity_24h')} AS DOUBLE) AS dbscan_score,
    CAST({_MM('amount_percentile')} AS DOUBLE) AS lof_score, CAST({_MM('abs(amount_zscore_user)')} AS DOUBLE) AS hdbscan_score FROM ruled),
  scored AS (SELECT *, least(greatest(rule_score * 0.3::DOUBLE + isolation_forest_score * 0.25::DOUBLE + lof_score * 0.25::DOUBLE + dbscan_score * 0.2::DOUBLE, 0), 1) AS ensemble_score FROM scored0)"""
_METHODS = ["isolation_forest", "lof", "dbscan", "hdbscan"]


@query("minmax_scores", f"""WITH {SCORED} SELECT tx_id, {', '.join(f'round_even({m}_score, 6) AS {m}_score' for m in _METHODS)} FROM scored""")
def _(spark, sf):
    return scored(spark, sf).select("tx_id", *[rounded(F.col(f"{m}_score"), 6).alias(f"{m}_score") for m in _METHODS])


@query("ensemble_scores", f"WITH {SCORED} SELECT tx_id, round_even(ensemble_score, 6) AS ensemble_score FROM scored")
def _(spark, sf):
    return scored(spark, sf).select("tx_id", rounded(F.col("ensemble_score"), 6).alias("ensemble_score"))


@query("detection_summary", f"""WITH {SCORED} SELECT count(*) AS transactions, round_even(avg(ensemble_score), 6) AS mean_score, round_even(stddev_pop(ensemble_score), 6) AS std_score,
  count(*) FILTER (ensemble_score > 0.7) AS anomaly_count_threshold_70, count(*) FILTER (ensemble_score > 0.8) AS anomaly_count_threshold_80,
  count(*) FILTER (ensemble_score > 0.9) AS anomaly_count_threshold_90 FROM scored""")
def _(spark, sf):
    return ensemble.detection_summary(scored(spark, sf)).withColumns(r(6, "mean_score", "std_score"))


@query("statistical_ensemble", f"""WITH {SCORED} SELECT tx_id, round_even((isolation_forest_score + lof_score + dbscan_score + hdbscan_score) / 4, 6) AS equal_weights,
  round_even((isolation_forest_score * 3 + lof_score) / 6, 6) AS given_weights FROM scored""")
def _(spark, sf):
    s = scored(spark, sf)
    out = scoring.statistical_ensemble(scoring.statistical_ensemble(s, output="equal_weights"),
                                       {"isolation_forest": 3, "lof": 1, "other": 2}, "given_weights")
    return out.select("tx_id", rounded(F.col("equal_weights"), 6).alias("equal_weights"),
                      rounded(F.col("given_weights"), 6).alias("given_weights"))


@query("ensemble_weights", f"""WITH {SCORED} SELECT tx_id, round_even(least(greatest(rule_score * 0.5 + isolation_forest_score * 0.125 + lof_score * 0.125 + dbscan_score * 0.25, 0), 1), 6) AS ensemble_score FROM scored""")
def _(spark, sf):
    from tidewatch.config import EnsembleWeights
    w = EnsembleWeights.normalised({"rule_weight": 4, "isolation_weight": 1, "autoencoder_weight": 1, "clustering_weight": 2})
    return ensemble.combine_scores(scored(spark, sf), w).select(
        "tx_id", rounded(F.col("ensemble_score"), 6).alias("ensemble_score"))


@query("model_statistics", f"""WITH {SCORED} {' UNION ALL '.join(
    f"SELECT '{m}' AS method, round_even(avg({m}_score), 6) AS mean_score, round_even(stddev_pop({m}_score), 6) AS std_score, min({m}_score) AS min_score, max({m}_score) AS max_score, "
    f"count(*) FILTER ({m}_score > (SELECT quantile_cont({m}_score, 0.9) FROM scored)) AS anomaly_count_10pct, "
    f"count(*) FILTER ({m}_score > (SELECT quantile_cont({m}_score, 0.95) FROM scored)) AS anomaly_count_5pct, "
    f"count(*) FILTER ({m}_score > (SELECT quantile_cont({m}_score, 0.99) FROM scored)) AS anomaly_count_1pct FROM scored" for m in _METHODS)}""")
def _(spark, sf):
    return scoring.model_statistics(scored(spark, sf)).withColumns(r(6, "mean_score", "std_score"))


@query("method_comparison", f"""WITH {SCORED} {' UNION ALL '.join(
    f"SELECT '{m}' AS method, round_even(avg({m}_score), 6) AS mean_score, round_even(stddev_pop({m}_score), 6) AS std_score, max({m}_score) AS max_score, "
    f"count(*) FILTER ({m}_score > 0.6) AS high_risk_count FROM scored" for m in _METHODS)}""")
def _(spark, sf):
    return scoring.method_comparison(scored(spark, sf)).withColumns(r(6, "mean_score", "std_score"))


def _mode(col, rows, keys="user_id"):
    return f"""(SELECT {keys}, coalesce({col}, 'Unknown') AS v FROM (SELECT {keys}, {col}, row_number() OVER (PARTITION BY {keys}
      ORDER BY {col} IS NULL, count(*) DESC, {col}) AS rn FROM {rows} WHERE user_id IS NOT NULL GROUP BY {keys}, {col}) WHERE rn = 1)"""


_MEAN = "round_even(sum(amount) / count(amount), 4)"
_TOTAL = "round_even(sum(amount), 4)"
_BY_METHOD = f"""{SCORED}, longs AS (SELECT user_id, amount, unnest([{', '.join(f"{{'m': '{m}', 's': {m}_score}}" for m in _METHODS)}]) AS x FROM scored WHERE user_id IS NOT NULL),
  um AS (SELECT x.m AS method, user_id, round_even(avg(x.s), 4) AS mean_score, round_even(max(x.s), 4) AS max_score, count(*) AS tx_count, {_MEAN} AS avg_amount
    FROM longs GROUP BY ALL)"""
_BAND_USER = "CASE WHEN mean_score > 0.8 THEN 'CRITICAL' WHEN mean_score > 0.6 THEN 'HIGH' WHEN mean_score > 0.4 THEN 'MEDIUM' WHEN mean_score > 0.2 THEN 'LOW' ELSE 'NORMAL' END"


@query("top_users_by_method", f"""WITH {_BY_METHOD}, ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY method ORDER BY mean_score DESC, user_id) AS INT) AS rank FROM um)
  SELECT ranked.*, l.v AS main_location, t.v AS main_type, {_BAND_USER} AS risk_level FROM ranked
  JOIN {_mode('location', 'scored')} l USING (user_id) JOIN {_mode('transaction_type', 'scored')} t USING (user_id) WHERE rank <= 5""")
def _(spark, sf):
    return scoring.top_users_by_method(scored(spark, sf))


@query("method_user_summary", f"""WITH {_BY_METHOD} SELECT method, count(*) AS users, count(*) FILTER (mean_score > 0.6) AS high_risk_users,
  count(*) FILTER (mean_score > 0.8) AS critical_users, round_even(sum(mean_score) / count(*), 6) AS avg_score, max(max_score) AS highest_score FROM um GROUP BY 1""")
def _(spark, sf):
    return scoring.method_user_summary(scored(spark, sf)).withColumns(r(6, "avg_score"))


@query("cross_method_users", f"""WITH {SCORED}, u AS (SELECT user_id, round_even(avg(s), 4) AS mean_score, round_even(max(s), 4) AS max_score, count(*) AS tx_count
    FROM (SELECT user_id, (isolation_forest_score + lof_score + dbscan_score + hdbscan_score) / 4 AS s FROM scored WHERE user_id IS NOT NULL) GROUP BY 1)
  SELECT *, {_BAND_USER} AS risk_level FROM u ORDER BY mean_score DESC, user_id LIMIT 5""")
def _(spark, sf):
    return scoring.cross_method_users(scored(spark, sf))


@query("score_correlations", f"""WITH {SCORED} {' UNION ALL '.join(
    f"SELECT '{a}_score' AS first, '{b}_score' AS second, round_even(corr({a}_score, {b}_score), 6) AS correlation FROM scored" for a in _METHODS for b in _METHODS)}""")
def _(spark, sf):
    return scoring.score_correlations(scored(spark, sf), [f"{m}_score" for m in _METHODS]).withColumns(r(6, "correlation"))


# --- ensemble tables and reports ---------------------------------------------

_BAND_REPORT = lambda c: f"CASE WHEN {c} > 0.8 THEN 'CRITICAL' WHEN {c} > 0.7 THEN 'HIGH' WHEN {c} > 0.5 THEN 'MEDIUM' WHEN {c} > 0.3 THEN 'LOW' ELSE 'NORMAL' END"
_BAND_EXPORT = "CASE WHEN ensemble_score <= 0 THEN NULL WHEN ensemble_score > 0.9 THEN 'CRITICAL' WHEN ensemble_score > 0.7 THEN 'HIGH' WHEN ensemble_score > 0.5 THEN 'MEDIUM' WHEN ensemble_score > 0.3 THEN 'LOW' ELSE 'NORMAL' END"
_BAND_TOP = "CASE WHEN ensemble_score > 0.8 THEN 'Critical' WHEN ensemble_score > 0.6 THEN 'High' WHEN ensemble_score > 0.3 THEN 'Medium' ELSE 'Low' END"


@query("risk_bands", f"""WITH {SCORED} SELECT {_BAND_REPORT('ensemble_score')} AS report_band, {_BAND_EXPORT} AS export_band, {_BAND_TOP} AS top_band,
  {_BAND_USER.replace('mean_score', 'ensemble_score')} AS user_band, count(*) AS n FROM scored GROUP BY ALL""")
def _(spark, sf):
    s = F.col("ensemble_score")
    return scored(spark, sf).groupBy(
        bands.risk_band_report(s).alias("report_band"), bands.risk_band_export(s).alias("export_band"),
        bands.risk_band_top(s).alias("top_band"), bands.risk_band_user(s).alias("user_band")).agg(F.count(F.lit(1)).alias("n"))


_SHARES = [("rule_based", "rule_score", 0.3), ("statistical_isolation_forest", "isolation_forest_score", 0.25), ("statistical_lof", "lof_score", 0.25),
           ("statistical_dbscan", "dbscan_score", 0.2), ("statistical_hdbscan", "hdbscan_score", 0.1)]


@query("explain_top", f"""WITH {_FIRED.replace(_RULED, SCORED)} SELECT tx_id, round_even(ensemble_score, 6) AS ensemble_score, coalesce(names, '') AS triggered,
  {', '.join(f"round_even({c} * {w}::DOUBLE, 6) AS {n}" for n, c, w in _SHARES)} FROM scored LEFT JOIN fired USING (tx_id) ORDER BY scored.ensemble_score DESC, tx_id LIMIT 10""")
def _(spark, sf):
    out = ensemble.explain_top(scored(spark, sf))
    part = lambda i: rounded(F.col("component_contributions")[i]["contribution"], 6)
    order = ["rule_based", "statistical_isolation_forest", "statistical_lof", "statistical_dbscan", "statistical_hdbscan"]
    return out.select(
        "tx_id", rounded(F.col("ensemble_score"), 6).alias("ensemble_score"),
        F.array_join(F.transform("triggered_rules", lambda x: x["rule_name"]), "; ").alias("triggered"),
        *[part(i).alias(n) for i, n in enumerate(order)])


@query("ensemble_top_anomalies", f"""WITH {SCORED} SELECT tx_id, user_id, amount, round_even(ensemble_score, 6) AS ensemble_score, round_even(rule_score, 6) AS rule_score,
  round_even(isolation_forest_score, 6) AS isolation_forest_score, round_even(lof_score, 6) AS lof_score, {_BAND_TOP} AS risk_level
  FROM scored ORDER BY scored.ensemble_score DESC, tx_id LIMIT 100""")
def _(spark, sf):
    cols = ["ensemble_score", "rule_score", "isolation_forest_score", "lof_score"]
    return ensemble.top_anomalies(scored(spark, sf)).withColumns(r(6, *cols)).select(
        "tx_id", "user_id", "amount", *cols, "risk_level")


@query("ensemble_statistics", f"""WITH {SCORED} SELECT round_even(avg(ensemble_score), 6) AS mean_score, round_even(stddev_pop(ensemble_score), 6) AS std_score,
  round_even(min(ensemble_score), 6) AS min_score, round_even(max(ensemble_score), 6) AS max_score, round_even(avg(rule_score), 6) AS rule_mean_score,
  count(*) FILTER (rule_score > 0) AS rule_triggered_transactions, round_even(count(*) FILTER (rule_score > 0) / count(*), 6) AS rule_trigger_rate,
  {', '.join(f'round_even(quantile_cont(ensemble_score, {p / 100}), 6) AS p{p}' for p in (50, 75, 90, 95, 99))} FROM scored""")
def _(spark, sf):
    out = ensemble.ensemble_statistics(scored(spark, sf))
    return out.withColumns(r(6, *[c for c in out.columns if c != "rule_triggered_transactions"]))


@query("rule_feature_importance", f"""WITH {_RULED}, used AS (SELECT rule, count(*) FILTER (s > 0) AS fired FROM (SELECT unnest([{_PAIRS}]) AS x FROM ruled)
    , LATERAL (SELECT x.n AS rule, x.s AS s) GROUP BY rule),
  map AS (SELECT unnest([{', '.join(f"{{'r': '{n}', 'f': '{f}', 'w': {WEIGHTS[n] / len(fs)}::DOUBLE}}" for n, fs in ensemble.RULE_FEATURES.items() for f in fs)}]) AS m)
  SELECT m.f AS feature, round_even(sum(m.w), 8) AS importance, CAST(sum(fired) AS BIGINT) AS times_triggered FROM map JOIN used ON m.r = rule GROUP BY 1""")
def _(spark, sf):
    weights = ensemble.rule_feature_importance(spark)
    fired = RULES.statistics(ruled(spark, sf)).select("rule_name", "triggered_count")
    pairs = spark.createDataFrame(
        [(n, f) for n, fs in ensemble.RULE_FEATURES.items() for f in fs], "rule_name string, feature string")
    used = pairs.join(fired, "rule_name").groupBy("feature").agg(F.sum("triggered_count").alias("times_triggered"))
    return weights.withColumns(r(8, "importance")).join(used, "feature")


@query("risk_breakdown", f"""WITH {SCORED}, n AS (SELECT {_BAND_REPORT('ensemble_score')} AS risk_level, count(*) AS c FROM scored GROUP BY 1)
  SELECT l.risk_level, coalesce(c, 0) AS transactions, round_even(coalesce(c, 0) / (SELECT count(*) FROM scored) * 100, 6) AS percentage
  FROM (SELECT unnest(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW', 'NORMAL']) AS risk_level) l LEFT JOIN n USING (risk_level)""")
def _(spark, sf):
    return reports.risk_breakdown(scored(spark, sf)).withColumns(r(6, "percentage"))


_USER_RISK = f"""round_even(avg(ensemble_score), 4) AS mean_score, round_even(max(ensemble_score), 4) AS max_score, count(*) AS tx_count,
  {_MEAN} AS avg_amount, {_TOTAL} AS total_amount"""
_TOP_BANDS = f"""u AS (SELECT risk_level, user_id, {_USER_RISK} FROM rows GROUP BY 1, 2),
  ranked AS (SELECT u.*, l.v AS main_location, CAST(row_number() OVER (PARTITION BY u.risk_level ORDER BY mean_score DESC, user_id) AS INT) AS rank
    FROM u JOIN {_mode('location', 'rows', 'risk_level, user_id')} l USING (risk_level, user_id))
  SELECT * FROM ranked WHERE rank <= CASE risk_level WHEN 'MEDIUM' THEN 5 ELSE 10 END"""
_BANDED = f"""{SCORED}, banded AS (SELECT *, {_BAND_REPORT('ensemble_score')} AS risk_level FROM scored WHERE user_id IS NOT NULL)"""


@query("users_by_band", f"WITH {_BANDED}, rows AS (SELECT * FROM banded WHERE risk_level IN ('CRITICAL', 'HIGH', 'MEDIUM')), {_TOP_BANDS}")
def _(spark, sf):
    return reports.users_by_band(scored(spark, sf))


@query("users_by_band_all_rows", f"""WITH {_BANDED}, cols AS (SELECT user_id, ensemble_score, amount, location, risk_level FROM banded),
  rows AS (SELECT 'CRITICAL' AS risk_level, user_id, ensemble_score, amount, location FROM cols WHERE user_id IN (SELECT user_id FROM cols WHERE risk_level = 'CRITICAL')
    UNION ALL SELECT 'HIGH', user_id, ensemble_score, amount, location FROM cols WHERE user_id IN (SELECT user_id FROM cols WHERE risk_level = 'HIGH')
    UNION ALL SELECT 'MEDIUM', user_id, ensemble_score, amount, location FROM cols WHERE risk_level = 'MEDIUM'), {_TOP_BANDS}""")
def _(spark, sf):
    return reports.users_by_band_all_rows(scored(spark, sf))


for _by in ("max", "mean"):
    def _top(spark, sf, _by=_by):
        return reports.top_users(scored(spark, sf), by=_by)
    query(f"top_users_by_{_by}", f"""WITH {SCORED}, u AS (SELECT user_id, round_even(avg(ensemble_score), 4) AS mean_ensemble, round_even(max(ensemble_score), 4) AS max_ensemble,
        count(*) AS tx_count, round_even(avg(rule_score), 4) AS mean_rule, {_MEAN} AS avg_amount, {_TOTAL} AS total_amount FROM scored WHERE user_id IS NOT NULL GROUP BY 1)
      SELECT u.*, l.v AS main_location, t.v AS main_type, {_BAND_REPORT(f'{_by}_ensemble')} AS risk_level FROM u JOIN {_mode('location', 'scored')} l USING (user_id)
      JOIN {_mode('transaction_type', 'scored')} t USING (user_id) ORDER BY {_by}_ensemble DESC, user_id LIMIT 10""")(_top)


@query("component_analysis", f"""WITH {SCORED} {' UNION ALL '.join(
    f"SELECT '{n}' AS component, round_even(avg({c}), 6) AS mean_score, CAST({w} AS DOUBLE) AS weight, count(*) FILTER ({c} > 0.7) AS high_risk FROM scored"
    for n, c, w in [('rule_based', 'rule_score', 0.3), ('isolation_forest', 'isolation_forest_score', 0.25), ('lof', 'lof_score', 0.25), ('dbscan', 'dbscan_score', 0.2), ('hdbscan', 'hdbscan_score', 'NULL')])}""")
def _(spark, sf):
    return reports.component_analysis(scored(spark, sf)).withColumns(r(6, "mean_score"))


@query("suspicious_users", f"WITH {SCORED} SELECT user_id, count(*) AS high_risk_transactions FROM scored WHERE ensemble_score > 0.7 AND user_id IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return reports.suspicious_users(scored(spark, sf))


@query("detection_rate", f"""WITH {SCORED} SELECT count(*) AS transactions, count(*) FILTER (ensemble_score > 0.7) AS flagged,
  round_even(count(*) FILTER (ensemble_score > 0.7) / count(*) * 100, 6) AS detection_rate,
  CASE WHEN stddev_pop(ensemble_score) > 0.1 THEN 'HIGH' WHEN stddev_pop(ensemble_score) > 0.05 THEN 'MEDIUM' ELSE 'LOW' END AS confidence_by_spread,
  CASE WHEN avg(ensemble_score) > 0.5 THEN 'HIGH' WHEN avg(ensemble_score) > 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS confidence_by_mean FROM scored""")
def _(spark, sf):
    return reports.detection_rate(scored(spark, sf)).withColumns(r(6, "detection_rate"))


@query("high_risk_counters", f"""WITH {SCORED} SELECT count(*) FILTER (rule_score > 0.5) AS rule_anomalies,
  {' + '.join(f'count(*) FILTER ({m}_score > 0.5)' for m in _METHODS)} AS statistical_anomalies, count(*) FILTER (ensemble_score > 0.5) AS ensemble_anomalies FROM scored""")
def _(spark, sf):
    return reports.high_risk_counters(scored(spark, sf))


@query("detailed_report", f"""WITH {SCORED} SELECT user_id, round_even(ensemble_score, 6) AS ensemble_score, round_even(rule_score, 6) AS rule_score, amount, location,
  transaction_type, {_BAND_EXPORT} AS risk_level FROM scored""")
def _(spark, sf):
    return reports.detailed_report(scored(spark, sf)).withColumns(r(6, "ensemble_score", "rule_score"))


_LINES = f"""SELECT 0 AS section, unnest([
    {{'position': 0, 'line': 'Total transactions: ' || n}}, {{'position': 1, 'line': printf('Mean ensemble score: %.4f', a)}},
    {{'position': 2, 'line': printf('Standard deviation: %.4f', s)}}, {{'position': 3, 'line': printf('Highest score: %.4f', hi)}},
    {{'position': 4, 'line': printf('Lowest score: %.4f', lo)}}]) AS x
    FROM (WITH {SCORED} SELECT count(*) AS n, avg(ensemble_score) AS a, stddev_pop(ensemble_score) AS s, max(ensemble_score) AS hi, min(ensemble_score) AS lo FROM scored)
  UNION ALL SELECT 1, {{'position': list_position(['CRITICAL', 'HIGH', 'MEDIUM', 'LOW', 'NORMAL'], risk_level),
    'line': printf('%s: %d transactions (%.1f%%)', risk_level, transactions, transactions / sum(transactions) OVER () * 100)}} FROM ({ORACLES['risk_breakdown']})
  UNION ALL SELECT 2, {{'position': 0, 'line': printf('%s: mean %.4f, above 0.7: %d', component, mean_score, high_risk)}} FROM ({ORACLES['component_analysis']})
  UNION ALL SELECT 3, {{'position': row_number() OVER (ORDER BY mean_ensemble DESC, user_id),
    'line': printf('%s: mean %.4f, rule %.4f, %d transactions, total %.1f, %s, %s, %s', user_id, mean_ensemble, mean_rule, tx_count, total_amount,
      main_location, main_type, risk_level)}} FROM ({ORACLES['top_users_by_mean']})"""


@query("fraud_report_lines", f"SELECT CAST(section AS INT) AS section, CAST(x.position AS INT) AS position, x.line AS line FROM ({_LINES})")
def _(spark, sf):
    return reports.fraud_report_lines(scored(spark, sf))
