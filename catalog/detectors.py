"""Detector, storage and streaming queries, with SQL counterparts where SQL can express them."""

import uuid

from pyspark.sql import functions as F

from tidewatch.functions.numbers import rounded
from tidewatch.config import DEFAULTS, HashParams
from tidewatch.operators import hashed, matrix as M, profiling, scoring
from tidewatch.operators.dbscan import dbscan_labels, dbscan_scores
from tidewatch.operators.forest import fit_isolation_forest
from tidewatch.operators.hierarchy import hierarchy_scores
from tidewatch.operators.importance import permutation_importance
from tidewatch.operators.lof import fit_lof, lof_scores
from tidewatch.operators.neighbours import build_index, nearest_points, weighted_points
from tidewatch.operators.oneclass import fit_oneclass, oneclass_scores
from tidewatch.operators.skew import checkpointed, shared_folder
from tidewatch.plans import detect
from tidewatch.plans.features import extract_features
from tidewatch.sources import stores
from tidewatch.streaming import run, score, sequence, windows

from .data import PARSED, TX, event_stream, events, raw_logs, to_raw_logs, to_transactions, transactions
from .features import r, sequence_sql
from .rules import LOG_TX, WEIGHTS, ruled_sql

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def _fresh(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def features(spark, sf):
    return checkpointed(extract_features(transactions(spark, sf)))


def vectors(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    return M.vector_matrix(e, "vec_id", "embedding", scale=False)


# --- matrix --------------------------------------------------------------------

_LABELS = ["location", "device", "transaction_type", "currency"]


@query("label_encoding", f"""WITH {TX}, v AS ({' UNION '.join(f"SELECT '{c}' AS feature, coalesce({c}, 'unknown') AS value FROM tx" for c in _LABELS)})
  SELECT feature, value, CAST(row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS DOUBLE) AS label FROM v""")
def _(spark, sf):
    return M.label_table(transactions(spark, sf), _LABELS)


@query("label_encoded_rows", f"""WITH {TX}, v AS (SELECT DISTINCT coalesce(location, 'unknown') AS value FROM tx), l AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS label FROM v)
  SELECT tx_id, CAST(label AS DOUBLE) AS location_encoded FROM tx JOIN l ON coalesce(location, 'unknown') = value""")
def _(spark, sf):
    t = transactions(spark, sf)
    return M.encode(t, M.label_table(t, ["location"]), ["location"]).select("tx_id", "location_encoded")


@query("standard_scaling", """WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
  s AS (SELECT i, avg(v) AS m, stddev_pop(v) AS sd FROM e GROUP BY 1)
  SELECT vec_id AS tx_id, CAST(e.i - 1 AS INT) AS dim, round_even((v - m) / nullif(sd, 0), 5) AS value FROM e JOIN s USING (i)""")
def _(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    x = M.vector_matrix(e, "vec_id", "embedding", scale=True)
    return x.select("tx_id", F.posexplode("features").alias("dim", "value")).withColumns(r(5, "value"))


@query("column_scaling", f"""WITH {TX}, f AS (SELECT tx_id, coalesce(amount, 0) AS amount, coalesce(hour(timestamp), 0) AS hour FROM tx)
  SELECT tx_id, round_even((amount - avg(amount) OVER ()) / stddev_pop(amount) OVER (), 6) AS amount_scaled,
  round_even((hour - avg(hour) OVER ()) / stddev_pop(hour) OVER (), 6) AS hour_scaled FROM f""")
def _(spark, sf):
    t = transactions(spark, sf).select(
        "tx_id", F.coalesce("amount", F.lit(0.0)).alias("amount"),
        F.coalesce(F.hour("timestamp").cast("double"), F.lit(0.0)).alias("hour"))
    out = profiling.zscaled(t, ["amount", "hour"]).withColumns(r(6, "amount_scaled", "hour_scaled"))
    return out.select("tx_id", "amount_scaled", "hour_scaled")


@query("feature_matrix", None)
def _(spark, sf):
    f = features(spark, sf)
    return M.fit_matrix(f).transform(f)


@query("feature_matrix_numeric", None)
def _(spark, sf):
    f = features(spark, sf)
    return M.fit_matrix(f, numeric_only=True).transform(f)


@query("principal_components", None)
def _(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    out, _ = M.principal_components(M.vector_matrix(e, "vec_id", "embedding"))
    return out


# --- detectors on the vector table ------------------------------------------------

_K = 20
_PAIRS = """pairs AS (SELECT a.vec_id AS g, b.vec_id AS o, sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE)))) AS d
  FROM embeddings a, embeddings b)"""


@query("nearest_vectors", f"""WITH {_PAIRS} SELECT g AS gid, o AS nid, round_even(d, 6) AS dist FROM
  (SELECT *, row_number() OVER (PARTITION BY g ORDER BY d, o) AS rn FROM pairs) WHERE rn <= {_K}""")
def _(spark, sf):
    lists = nearest_points(build_index(checkpointed(weighted_points(vectors(spark, sf))), 200), _K)
    return lists.select("gid", F.inline("neighbours")).select("gid", "nid", rounded(F.col("dist"), 6).alias("dist"))


@query("hashed_neighbour_recall", f"""SELECT count(*) AS points, count(*) AS full_lists, {_K} AS k, true AS recall_reached, true AS moved_in_bounds FROM embeddings""")
def _(spark, sf):
    """Lists from hashed buckets held against the exact ones: recall of at least 0.9, and how often a row is moved."""
    points, params = checkpointed(weighted_points(vectors(spark, sf))), HashParams(trees=16, probes=3, leaf_rows=128, recall=0.9)
    index = hashed.build_hashed(points, params)
    ids = lambda lists, name: lists.select("gid", F.transform("neighbours", lambda z: z["nid"]).alias(name))
    found = ids(hashed.nearest_points(index, _K), "found").join(ids(nearest_points(build_index(points, 200), _K), "wanted"), "gid")
    moved = hashed.asked_buckets(index, points).unionByName(index.buckets).agg(F.count(F.lit(1)).alias("moved"))
    out = found.agg(
        F.count(F.lit(1)).alias("points"), F.count_if(F.size("found") == _K).alias("full_lists"),
        (F.avg(F.size(F.array_intersect("found", "wanted")) / F.size("wanted")) >= 0.9).alias("recall_reached"))
    bound = params.trees * (params.probes + 1) * F.col("points")
    return out.withColumn("moved", moved.scalar()).select(
        "points", "full_lists", F.lit(_K).alias("k"), "recall_reached", (F.col("moved") <= bound).alias("moved_in_bounds"))


_LOF = f"""WITH {_PAIRS}, rx AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY d, o) AS rn FROM pairs),
  rf AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY d, o) AS rn FROM pairs WHERE g <> o),
  nx AS (SELECT * FROM rx WHERE rn <= {_K}), nf AS (SELECT * FROM rf WHERE rn <= {_K}),
  kd AS (SELECT g, max(d) AS kdist FROM nf GROUP BY 1),
  lf AS (SELECT nf.g, 1 / (avg(greatest(d, kdist)) + 1e-10) AS dens FROM nf JOIN kd ON nf.o = kd.g GROUP BY 1),
  lx AS (SELECT nx.g, 1 / (avg(greatest(d, kdist)) + 1e-10) AS dens FROM nx JOIN kd ON nx.o = kd.g GROUP BY 1)
  SELECT nx.g AS tx_id, round_even(avg(lf.dens) / any_value(lx.dens), 6) AS lof FROM nx JOIN lf ON nx.o = lf.g JOIN lx ON nx.g = lx.g GROUP BY 1"""


@query("lof_vectors", _LOF)
def _(spark, sf):
    return lof_scores(vectors(spark, sf), _K, "lof", chunk_rows=200).select("tx_id", rounded(F.col("lof"), 6).alias("lof"))


@query("lof_hashed_vectors", _LOF)
def _(spark, sf):
    """The approximate search; a table of one bucket is searched whole, so there the factors are those of the exact one."""
    return lof_scores(vectors(spark, sf), _K, "lof", hashing=HashParams()).select("tx_id", rounded(F.col("lof"), 6).alias("lof"))


@query("lof_new_rows", f"""WITH {_PAIRS}, rx AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY d, o) AS rn FROM pairs WHERE g % 2 = 1 AND o % 2 = 0),
  rf AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY d, o) AS rn FROM pairs WHERE g % 2 = 0 AND o % 2 = 0 AND g <> o),
  nx AS (SELECT * FROM rx WHERE rn <= {_K}), nf AS (SELECT * FROM rf WHERE rn <= {_K}),
  kd AS (SELECT g, max(d) AS kdist FROM nf GROUP BY 1),
  lf AS (SELECT nf.g, 1 / (avg(greatest(d, kdist)) + 1e-10) AS dens FROM nf JOIN kd ON nf.o = kd.g GROUP BY 1),
  lx AS (SELECT nx.g, 1 / (avg(greatest(d, kdist)) + 1e-10) AS dens FROM nx JOIN kd ON nx.o = kd.g GROUP BY 1)
  SELECT nx.g AS tx_id, round_even(avg(lf.dens) / any_value(lx.dens), 6) AS lof FROM nx JOIN lf ON nx.o = lf.g JOIN lx ON nx.g = lx.g GROUP BY 1""")
def _(spark, sf):
    """A model of the even rows judges the odd ones, as new data."""
    x = checkpointed(vectors(spark, sf))
    model = fit_lof(x.filter("tx_id % 2 = 0"), _K, chunk_rows=200)
    return model.score(x.filter("tx_id % 2 = 1"), "lof").select("tx_id", rounded(F.col("lof"), 6).alias("lof"))


_EPS = 1.165
_DBSCAN = f"""{_PAIRS}, near AS (SELECT g, o FROM pairs WHERE d <= {_EPS}), core AS (SELECT g FROM near GROUP BY 1 HAVING count(*) >= 5),
  ce AS (SELECT near.g, near.o FROM near JOIN core a ON near.g = a.g JOIN core b ON near.o = b.g),
  reach(g, o) AS (SELECT g, o FROM ce UNION SELECT reach.g, ce.o FROM reach JOIN ce ON reach.o = ce.g),
  comp AS (SELECT g, min(o) AS cluster FROM reach GROUP BY 1),
  border AS (SELECT near.g, min(cluster) AS cluster FROM near JOIN comp ON near.o = comp.g WHERE near.g NOT IN (SELECT g FROM core) GROUP BY 1),
  labels AS (SELECT vec_id AS tx_id, coalesce(comp.cluster, border.cluster) AS cluster FROM embeddings LEFT JOIN comp ON vec_id = comp.g LEFT JOIN border ON vec_id = border.g)"""


@query("dbscan_vectors", f"WITH RECURSIVE {_DBSCAN} SELECT * FROM labels")
def _(spark, sf):
    return dbscan_labels(vectors(spark, sf), _EPS, 5, chunk_rows=200).select("tx_id", "cluster")


@query("dbscan_hashed_vectors", f"WITH RECURSIVE {_DBSCAN} SELECT * FROM labels")
def _(spark, sf):
    return dbscan_labels(vectors(spark, sf), _EPS, 5, hashing=HashParams()).select("tx_id", "cluster")


@query("dbscan_score_vectors", f"""WITH RECURSIVE {_DBSCAN}, e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
  m AS (SELECT cluster, i, avg(v) AS c FROM e JOIN labels ON vec_id = tx_id WHERE cluster IS NOT NULL GROUP BY 1, 2),
  gap AS (SELECT vec_id, sqrt(sum((v - c) * (v - c))) AS d FROM e JOIN labels ON vec_id = tx_id JOIN m USING (cluster, i) GROUP BY 1),
  n AS (SELECT count(DISTINCT coalesce(cluster, -1)) AS k FROM labels)
  SELECT tx_id, round_even(CASE WHEN cluster IS NULL THEN 1 WHEN k > 1 THEN coalesce(d / nullif(max(d) OVER (), 0) * 0.5, 0) ELSE 0 END, 6) AS dbscan_score
  FROM labels LEFT JOIN gap ON tx_id = vec_id, n""")
def _(spark, sf):
    labels = dbscan_labels(vectors(spark, sf), _EPS, 5, chunk_rows=200)
    return dbscan_scores(labels).select("tx_id", rounded(F.col("dbscan_score"), 6).alias("dbscan_score"))


@query("isolation_forest", None)
def _(spark, sf):
    f = features(spark, sf)
    x = checkpointed(M.fit_matrix(f).transform(f))
    scored = checkpointed(fit_isolation_forest(x).score(x, "raw").select("tx_id", "raw"))
    return scoring.minmax(scored, {"raw": "isolation_forest_score"})


@query("one_class_svm", None)
def _(spark, sf):
    x = vectors(spark, sf)
    return scoring.minmax(oneclass_scores(x, output="raw").select("tx_id", "raw"), {"raw": "one_class_svm_score"})


@query("one_class_optimum", "SELECT count(*) AS n_rows, true AS gap_met, true AS share_near_nu FROM embeddings")
def _(spark, sf):
    """The fit is optimal: its duality gap is closed, and the share of outliers is nu to one in a hundred."""
    x = vectors(spark, sf)
    model = fit_oneclass(x, nu=0.1)
    return model.score(x, "raw").agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(model.gap <= 1e-3).alias("gap_met"),
        (F.abs(F.avg((F.col("raw") > 0).cast("double")) - 0.1) <= 0.01).alias("share_near_nu"))


@query("hierarchy_scores", None)
def _(spark, sf):
    return hierarchy_scores(vectors(spark, sf), chunk_rows=200).select("tx_id", "hierarchy_raw")


@query("ensemble_detection", None)
def _(spark, sf):
    f = features(spark, sf)
    out = detect.fit_detectors(f).score(f)
    return out.select("tx_id", "user_id", "rule_score", "isolation_forest_score", "lof_score", "dbscan_score", "ensemble_score")


@query("detect_all_methods", None)
def _(spark, sf):
    """The scores of all five methods on one feature table."""
    f = features(spark, sf)
    out = detect.fit_detectors(f, methods=detect.ALL_METHODS).score(f)
    return out.select("tx_id", "user_id", "rule_score", *map(scoring.score_column, detect.ALL_METHODS), "ensemble_score")


@query("permutation_importance", None)
def _(spark, sf):
    f = features(spark, sf)
    # Importance asks the forest alone, so no other method is fitted.
    return detect.fit_detectors(f, methods=("isolation_forest",)).feature_importance(f)


@query("permutation_spread", None)
def _(spark, sf):
    """Importance by permutation alone, with its spread over the repeats."""
    f = features(spark, sf)
    matrix = M.fit_matrix(f)
    x = checkpointed(matrix.transform(f))
    return permutation_importance(x, matrix.names, fit_isolation_forest(x))


# --- evaluation ----------------------------------------------------------------------

@query("evaluation", """WITH s AS (SELECT quality, ntile / 100 AS score FROM (SELECT l.quality, d.n_chars % 101 AS ntile FROM labels l JOIN documents d USING (doc_id))),
  t AS (SELECT quality = 1 AS y, score > th AS hit, th AS threshold FROM s, (SELECT unnest([0.3::DOUBLE, 0.5::DOUBLE, 0.7::DOUBLE]) AS th)),
  c AS (SELECT threshold, count(*) FILTER (hit AND y) AS true_positives, count(*) FILTER (hit AND NOT y) AS false_positives,
    count(*) FILTER (NOT hit AND y) AS false_negatives, count(*) FILTER (NOT hit AND NOT y) AS true_negatives FROM t GROUP BY 1)
  SELECT *, round_even(coalesce(true_positives / nullif(true_positives + false_positives, 0), 0), 6) AS precision,
  round_even(coalesce(true_positives / nullif(true_positives + false_negatives, 0), 0), 6) AS recall FROM c""")
def _(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars")
    scored = labels.join(docs, "doc_id").withColumn("score", (F.col("n_chars") % 101) / 100)
    return detect.evaluate(scored, "quality", "score", [0.3, 0.5, 0.7]).withColumns(r(6, "precision", "recall"))


@query("validation_sample", f"WITH {TX} SELECT * FROM tx ORDER BY md5(tx_id || ':42'), tx_id LIMIT {DEFAULTS.validation_sample}")
def _(spark, sf):
    out = detect.validation_sample(transactions(spark, sf))
    return out.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# --- stores ---------------------------------------------------------------------------

@query("parsed_store", f"WITH {PARSED} SELECT tx_id, timestamp, user_id, amount, currency, location FROM parsed")
def _(spark, sf):
    from tidewatch.operators.parse import parse_logs
    path = _fresh(spark, "parsed")
    stores.write_parsed(parse_logs(raw_logs(spark, sf)), path)
    out = stores.read_parsed(spark, path).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return out.select("tx_id", "timestamp", "user_id", "amount", "currency", "location")


@query("csv_ingest", f"WITH {PARSED} SELECT count(*) AS lines, count(user_id) AS users, round_even(sum(amount), 2) AS amount FROM parsed")
def _(spark, sf):
    from tidewatch.operators.parse import parse_logs
    from tidewatch.sources.logs import CSV, read_uploaded_logs
    path = f"{_fresh(spark, 'raw')}.csv"
    raw_logs(spark, sf).select("raw_log").write.options(
        **CSV, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return parse_logs(read_uploaded_logs(spark, path)).agg(
        F.count(F.lit(1)).alias("lines"), F.count("user_id").alias("users"),
        rounded(F.sum("amount"), 2).alias("amount"))


@query("statistics_document", None)
def _(spark, sf):
    from tidewatch.operators.quality import format_report, parsing_counters, parsing_errors
    raw = raw_logs(spark, sf)
    return stores.statistics_document(parsing_counters(raw), parsing_errors(raw), format_report(raw))


@query("detector_store", None)
def _(spark, sf):
    f = features(spark, sf)
    path = _fresh(spark, "model")
    detect.fit_detectors(f, methods=("isolation_forest",)).save(path)
    out = detect.load_detectors(spark, path).score(f, refit_thresholds=False)
    return out.select("tx_id", "rule_score", "isolation_forest_score", "ensemble_score")


# --- streams ----------------------------------------------------------------------------

# A line on a stream has no features of a user's order: two rules cannot fire, and velocity falls back on the user's count.
_STREAM_RULES = {**{f"rule_{n}": f"rule_{n}" for n in WEIGHTS}, "rule_device_change": "0", "rule_amount_deviation": "0",
                 "rule_high_velocity": "CAST(coalesce(user_tx_count > 5, false) AS INT)"}
_STREAM_SUM = " + ".join(f"{_STREAM_RULES[f'rule_{n}']} * {w}::DOUBLE" for n, w in WEIGHTS.items())


@query("stream_scores", f"""WITH {ruled_sql(LOG_TX)} SELECT tx_id, timestamp, user_id, amount,
  round_even(({_STREAM_SUM}) / {sum(WEIGHTS.values())}::DOUBLE, 8) AS rule_score FROM ruled""")
def _(spark, sf):
    from tidewatch.operators.parse import parse_logs, valid_rows
    path = _fresh(spark, "profile")
    score.save_profile(valid_rows(parse_logs(raw_logs(spark, sf))), path)
    scored = score.score_lines(to_raw_logs(event_stream(spark, sf)), score.load_profile(spark, path))
    out = run.run_available(scored.select("tx_id", "timestamp", "user_id", "amount", "rule_score"))
    return out.withColumns({**r(8, "rule_score"), "timestamp": F.col("timestamp").cast("timestamp_ntz")})


_STREAMED = ["user_id", "tx_id", "timestamp", "tx_velocity_24h", "time_since_last_tx", "location_changed", "device_changed"]


@query("stream_sequence", f"""WITH {sequence_sql(TX)} SELECT tx_id, user_id, timestamp, tx_velocity_24h,
  round_even(time_since_last_tx, 6) AS time_since_last_tx, location_changed, device_changed FROM sequence JOIN tx USING (tx_id)
  WHERE user_id IS NOT NULL AND timestamp IS NOT NULL""")
def _(spark, sf):
    out = run.run_finite(sequence.stream_sequence, to_transactions(event_stream(spark, sf)))
    return out.select(*_STREAMED).withColumns({**r(6, "time_since_last_tx"), "timestamp": F.col("timestamp").cast("timestamp_ntz")})


def _amount_band(c):
    return F.when(c > 100, "large").when(c > 30, "medium").otherwise("small")


_WIN = "CASE WHEN amount > 100 THEN 'large' WHEN amount > 30 THEN 'medium' ELSE 'small' END"


@query("stream_daily_counts", f"""WITH {TX} SELECT date_trunc('day', timestamp)::TIMESTAMP AS window_start, (date_trunc('day', timestamp) + INTERVAL 1 DAY)::TIMESTAMP AS window_end,
  {_WIN} AS risk_level, count(*) AS n FROM tx WHERE timestamp IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    t = to_transactions(event_stream(spark, sf))
    out = run.run_complete(windows.windowed_risk_counts(t, band=_amount_band(F.col("amount"))))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("stream_sliding_counts", f"""WITH {TX}, w AS (SELECT *, unnest([0, 6, 12, 18]) AS back FROM tx WHERE timestamp IS NOT NULL)
  SELECT (time_bucket(INTERVAL 6 HOUR, timestamp) - back * INTERVAL 1 HOUR)::TIMESTAMP AS window_start,
  (time_bucket(INTERVAL 6 HOUR, timestamp) - back * INTERVAL 1 HOUR + INTERVAL 1 DAY)::TIMESTAMP AS window_end, {_WIN} AS risk_level, count(*) AS n FROM w GROUP BY ALL""")
def _(spark, sf):
    t = to_transactions(event_stream(spark, sf))
    out = run.run_complete(windows.windowed_risk_counts(t, "1 day", "6 hours", band=_amount_band(F.col("amount"))))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


_SESSIONS = f"""WITH {TX}, g AS (SELECT *, CASE WHEN timestamp > lag(timestamp) OVER w + INTERVAL 12 HOUR OR lag(timestamp) OVER w IS NULL THEN 1 ELSE 0 END AS s
    FROM tx WHERE timestamp IS NOT NULL AND user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY timestamp)),
  i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS k FROM g)
  SELECT user_id, min(timestamp) AS session_start, max(timestamp) + INTERVAL 12 HOUR AS session_end, count(*) AS n, round_even(sum(amount), 4) AS amount FROM i GROUP BY user_id, k"""


@query("stream_sessions", _SESSIONS)
def _(spark, sf):
    """Sessions whose state merges on the stream, in append mode; a closing row ends the last ones."""
    rows = to_transactions(event_stream(spark, sf)).select("tx_id", "user_id", "timestamp", "amount")
    out = run.run_finite(lambda t: windows.session_counts(t, "12 hours"), rows).withColumns(r(4, "amount"))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query("user_sessions", _SESSIONS)
def _(spark, sf):
    out = windows.session_counts(transactions(spark, sf), "12 hours").withColumns(r(4, "amount"))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
