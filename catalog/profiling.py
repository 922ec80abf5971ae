"""Exploration queries, with their SQL counterparts."""

from pyspark.sql import functions as F

from tidewatch.functions.numbers import rounded
from tidewatch.operators import profiling as P, users
from tidewatch.operators.basic import basic_features, time_features
from tidewatch.operators.rules import RuleSet

from .data import TX, order_transactions, transactions
from .features import r

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


_SHARES = ", ".join(f"count({f}) / count(*) * 100 AS {f}" for f in P.FIELDS)


@query("completeness", f"""WITH {TX}, s AS (SELECT {_SHARES} FROM tx), l AS (
  {' UNION ALL '.join(f"SELECT '{f}' AS field, {f} AS v FROM s" for f in P.FIELDS)}
  UNION ALL SELECT 'overall', ({' + '.join(P.FIELDS)}) / {len(P.FIELDS)} FROM s)
  SELECT field, round_even(v, 6) AS completeness, round_even(100 - v, 6) AS missing FROM l""")
def _(spark, sf):
    return P.completeness(transactions(spark, sf)).withColumns(r(6, "completeness", "missing"))


for _c in ("transaction_type", "currency", "location"):
    def _freq(spark, sf, _c=_c):
        return P.value_frequencies(transactions(spark, sf), _c, 10)
    query(f"top_{_c}", f"WITH {TX} SELECT {_c} AS value, count(*) AS n FROM tx WHERE {_c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")(_freq)


def _describe_sql(rel, c):
    return f"""SELECT '{c}' AS "column", count({c}) AS count, round_even(avg({c}), 4) AS mean, round_even(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min,
  round_even(quantile_cont({c}, 0.25), 4) AS q25, round_even(quantile_cont({c}, 0.5), 4) AS q50, round_even(quantile_cont({c}, 0.75), 4) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM {rel}"""


@query("describe_amount", f"WITH {TX} {_describe_sql('tx', 'amount')}")
def _(spark, sf):
    return P.describe(transactions(spark, sf), ["amount"]).withColumns(r(4, "mean", "std", "q25", "q50", "q75"))


_USERS = f"""{TX}, us AS (SELECT user_id, count(amount) AS tx_count, round_even(sum(amount) / count(amount), 2) AS avg_amount,
  round_even(stddev_samp(amount), 2) AS std_amount, round_even(min(amount), 2) AS min_amount, round_even(max(amount), 2) AS max_amount,
  round_even(sum(amount), 2) AS total_amount, count(DISTINCT location) AS unique_locations, count(DISTINCT device) AS unique_devices,
  count(DISTINCT transaction_type) AS unique_types FROM tx WHERE user_id IS NOT NULL GROUP BY 1)"""


@query("user_statistics", f"WITH {_USERS} SELECT * FROM us")
def _(spark, sf):
    return users.user_statistics(transactions(spark, sf))


@query("describe_users", f"WITH {_USERS} {' UNION ALL '.join(_describe_sql('us', c) for c in ('tx_count', 'avg_amount', 'unique_devices'))}")
def _(spark, sf):
    u = users.user_statistics(transactions(spark, sf)).withColumn("avg_amount", F.col("avg_amount").cast("double"))
    return P.describe(u, ["tx_count", "avg_amount", "unique_devices"]).withColumns(r(4, "mean", "std", "q25", "q50", "q75"))


for _n in (10, 15):
    def _active(spark, sf, _n=_n):
        return users.most_active_users(transactions(spark, sf), _n)
    query(f"most_active_{_n}", f"WITH {_USERS} SELECT * FROM us ORDER BY tx_count DESC, user_id LIMIT {_n}")(_active)


@query("overview", f"""WITH {TX} SELECT count(*) AS transactions, count(DISTINCT user_id) AS users, count(DISTINCT transaction_type) AS transaction_types,
  count(DISTINCT location) AS locations, count(DISTINCT currency) AS currencies, count(DISTINCT device) AS devices, CAST(min(timestamp) AS DATE) AS first_day,
  CAST(max(timestamp) AS DATE) AS last_day, round_even(sum(amount) / count(amount), 4) AS avg_amount,
  round_even(sum(amount), 2) AS total_amount FROM tx""")
def _(spark, sf):
    return P.overview(transactions(spark, sf)).withColumns({**r(4, "avg_amount"), **r(2, "total_amount")})


def _hist_sql(rel, c, bins):
    return f"""span AS (SELECT min({c}) AS lo, max({c}) AS hi FROM {rel}), n AS (SELECT CAST(least(floor(({c} - lo) / (hi - lo) * {bins}), {bins - 1}) AS INT) AS bin, count(*) AS n
    FROM {rel}, span WHERE {c} IS NOT NULL GROUP BY 1)
  SELECT CAST(b.bin AS INT) AS bin, round_even(lo + (hi - lo) / {bins} * b.bin, 6) AS bin_start, round_even(lo + (hi - lo) / {bins} * (b.bin + 1), 6) AS bin_end, coalesce(n, 0) AS n
  FROM (SELECT unnest(range({bins})) AS bin) b LEFT JOIN n ON b.bin = n.bin, span"""


for _name, _bins in (("amounts", 50), ("log_amounts", 50)):
    def _hist(spark, sf, _name=_name, _bins=_bins):
        t = transactions(spark, sf).withColumn("log_amount", F.log1p("amount"))
        return P.histogram(t, "amount" if _name == "amounts" else "log_amount", _bins).withColumns(r(6, "bin_start", "bin_end"))
    query(f"histogram_{_name}", f"WITH {TX}, h AS (SELECT {'amount' if _name == 'amounts' else 'ln(1 + amount)'} AS v FROM tx), {_hist_sql('h', 'v', _bins)}")(_hist)

for _c, _bins in (("tx_count", 30), ("unique_locations", 20), ("unique_types", 15), ("unique_devices", 10)):
    def _uh(spark, sf, _c=_c, _bins=_bins):
        return P.histogram(users.user_statistics(transactions(spark, sf)), _c, _bins).withColumns(r(6, "bin_start", "bin_end"))
    _lo = "CASE WHEN min(v) = max(v) THEN min(v) - 0.5::DOUBLE ELSE min(v) END AS lo, CASE WHEN min(v) = max(v) THEN max(v) + 0.5::DOUBLE ELSE max(v) END AS hi"
    query(f"histogram_user_{_c}", f"WITH {_USERS}, h AS (SELECT CAST({_c} AS DOUBLE) AS v FROM us), " +
          _hist_sql("h", "v", _bins).replace("min(v) AS lo, max(v) AS hi", _lo))(_uh)


@query("daily_counts_filled", f"""WITH {TX}, n AS (SELECT CAST(timestamp AS DATE) AS day, count(*) AS n FROM tx WHERE timestamp IS NOT NULL GROUP BY 1)
  SELECT CAST(d AS DATE) AS day, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series((SELECT min(day) FROM n), (SELECT max(day) FROM n), INTERVAL 1 DAY)) AS d) LEFT JOIN n ON CAST(d AS DATE) = day""")
def _(spark, sf):
    return P.daily_counts(transactions(spark, sf), fill=True)


@query("daily_counts_filled_orders", """WITH n AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
  SELECT CAST(d AS DATE) AS day, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series((SELECT min(day) FROM n), (SELECT max(day) FROM n), INTERVAL 1 DAY)) AS d) LEFT JOIN n ON CAST(d AS DATE) = day""")
def _(spark, sf):
    return P.daily_counts(order_transactions(spark, sf), fill=True)


@query("daily_activity", f"WITH {TX} SELECT CAST(timestamp AS DATE) AS day, count(*) AS n FROM tx WHERE timestamp IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return P.daily_counts(transactions(spark, sf))


@query("daily_summary", f"""WITH {TX}, n AS (SELECT CAST(timestamp AS DATE) AS day, count(*) AS n FROM tx WHERE timestamp IS NOT NULL GROUP BY 1)
  SELECT (SELECT day FROM n ORDER BY n DESC, day LIMIT 1) AS peak_day, max(n) AS peak_count, round_even(avg(n), 4) AS avg_daily FROM n""")
def _(spark, sf):
    return P.daily_summary(transactions(spark, sf)).withColumns(r(4, "avg_daily"))


@query("hourly_counts", f"WITH {TX} SELECT CAST(hour(timestamp) AS INT) AS hour, count(*) AS n FROM tx WHERE timestamp IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return P.hourly_counts(transactions(spark, sf))


@query("weekday_counts", f"WITH {TX} SELECT CAST(isodow(timestamp) - 1 AS INT) AS day_of_week, count(*) AS n FROM tx WHERE timestamp IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return P.weekday_counts(transactions(spark, sf))


_DAYS = "(epoch_us({a}) - epoch_us({b})) // 86400000000"
_REC = f"""{TX}, rec AS (SELECT user_id, {_DAYS.format(a='(SELECT max(timestamp) FROM tx)', b='max(timestamp)')} AS d FROM tx WHERE user_id IS NOT NULL GROUP BY 1)"""


@query("user_recency", f"WITH {_REC} SELECT user_id, CAST(d AS BIGINT) AS days_since_last FROM rec")
def _(spark, sf):
    return P.user_recency(transactions(spark, sf))


_RECM = """round_even(avg(d), 6) AS avg_days_since_last_transaction, count(*) FILTER (d <= 7) AS recent_users_7_days,
  count(*) FILTER (d <= 30) AS recent_users_30_days, count(*) FILTER (d > 90) AS inactive_users_90_days"""


@query("recency_metrics", f"WITH {_REC} SELECT {_RECM} FROM rec")
def _(spark, sf):
    return P.recency_metrics(transactions(spark, sf)).withColumns(r(6, "avg_days_since_last_transaction"))


_ORDERS_REC = "WITH tx AS (SELECT 'user' || o_custkey AS user_id, CAST(o_orderdate AS TIMESTAMP) AS timestamp FROM orders JOIN customer ON o_custkey = c_custkey)"


@query("recency_metrics_orders", f"""{_ORDERS_REC}, rec AS (SELECT user_id, {_DAYS.format(a='(SELECT max(timestamp) FROM tx)', b='max(timestamp)')} AS d FROM tx GROUP BY 1)
  SELECT {_RECM} FROM rec""")
def _(spark, sf):
    return P.recency_metrics(order_transactions(spark, sf)).withColumns(r(6, "avg_days_since_last_transaction"))


@query("activity_span_metrics", f"""WITH {TX}, s AS (SELECT user_id, {_DAYS.format(a='max(timestamp)', b='min(timestamp)')} AS d FROM tx WHERE user_id IS NOT NULL GROUP BY 1)
  SELECT round_even(avg(d), 6) AS avg_activity_span_days, CAST(max(d) AS BIGINT) AS max_activity_span_days, count(*) FILTER (d = 0) AS users_with_span_1_day FROM s""")
def _(spark, sf):
    return P.activity_span_metrics(transactions(spark, sf)).withColumns(r(6, "avg_activity_span_days"))


@query("diversity_metrics", f"""WITH {_USERS} SELECT round_even(avg(unique_locations), 6) AS avg_unique_locations, count(*) FILTER (unique_locations > 1) AS mobile_users_multiple_locations,
  round_even(avg(unique_devices), 6) AS avg_unique_devices, count(*) FILTER (unique_devices > 1) AS multi_device_users, round_even(avg(unique_types), 6) AS avg_unique_transaction_types,
  count(*) FILTER (unique_types > 1) AS diverse_transaction_users FROM us""")
def _(spark, sf):
    return P.diversity_metrics(transactions(spark, sf)).withColumns(
        r(6, "avg_unique_locations", "avg_unique_devices", "avg_unique_transaction_types"))


_MONEY = f"""{TX}, m AS (SELECT user_id, sum(amount) AS t, sum(amount) / count(amount) AS a
  FROM tx WHERE user_id IS NOT NULL GROUP BY 1)"""


@query("monetary_metrics", f"""WITH {_MONEY} SELECT round_even(avg(t), 4) AS avg_total_value_per_user, count(*) FILTER (t > (SELECT quantile_cont(t, 0.9) FROM m)) AS high_value_users_90th_percentile,
  round_even(avg(a), 4) AS avg_transaction_amount FROM m""")
def _(spark, sf):
    return P.monetary_metrics(transactions(spark, sf)).withColumns(r(4, "avg_total_value_per_user", "avg_transaction_amount"))


@query("behaviour_summary", f"""WITH {_MONEY}, rec AS (SELECT user_id, {_DAYS.format(a='(SELECT max(timestamp) FROM tx)', b='max(timestamp)')} AS d FROM tx WHERE user_id IS NOT NULL GROUP BY 1)
  SELECT count(DISTINCT user_id) AS total_users, count(*) AS total_transactions, round_even(count(*) / count(DISTINCT user_id), 6) AS avg_transactions_per_user,
  CAST(CAST(min(timestamp) AS DATE) AS VARCHAR) || ' to ' || CAST(CAST(max(timestamp) AS DATE) AS VARCHAR) AS date_range,
  (SELECT count(*) FILTER (d <= 7) FROM rec) AS recent_users_7_days, (SELECT count(*) FILTER (t > (SELECT quantile_cont(t, 0.9) FROM m)) FROM m) AS high_value_users FROM tx""")
def _(spark, sf):
    s = P.behaviour_summary(transactions(spark, sf))
    return s.select("overall_statistics.*", F.col("recency_metrics.recent_users_7_days").alias("recent_users_7_days"),
                    F.col("monetary_metrics.high_value_users_90th_percentile").alias("high_value_users")).withColumns(
        r(6, "avg_transactions_per_user"))


_VEC = ["transaction_count", "avg_amount", "amount_std", "activity_span"]


@query("behaviour_vectors", f"""WITH {TX}, v AS (SELECT user_id, CAST(count(amount) AS DOUBLE) AS transaction_count,
    coalesce(sum(amount) / count(amount), 0) AS avg_amount, coalesce(stddev_samp(amount), 0) AS amount_std,
    coalesce(CAST({_DAYS.format(a='max(timestamp)', b='min(timestamp)')} AS DOUBLE), 0) AS activity_span FROM tx WHERE user_id IS NOT NULL GROUP BY 1)
  SELECT user_id, {', '.join(f'round_even(({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0), 6) AS {c}_scaled' for c in _VEC)} FROM v""")
def _(spark, sf):
    cols = [f"{c}_scaled" for c in _VEC]
    return P.behaviour_vectors(transactions(spark, sf)).select("user_id", *[rounded(F.col(c), 6).alias(c) for c in cols])


for _g in ("transaction_type", "currency"):
    def _box(spark, sf, _g=_g):
        return P.boxplot(transactions(spark, sf), "amount", _g).withColumns(r(4, "q1", "median", "q3"))
    query(f"boxplot_by_{_g}", f"""WITH {TX}, q AS (SELECT {_g}, quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.5) AS median, quantile_cont(amount, 0.75) AS q3
        FROM tx WHERE {_g} IS NOT NULL GROUP BY 1), i AS (SELECT tx.{_g}, amount, q1, median, q3, amount >= q1 - 1.5 * (q3 - q1) AND amount <= q3 + 1.5 * (q3 - q1) AS inside
        FROM tx JOIN q USING ({_g}) WHERE amount IS NOT NULL)
      SELECT {_g}, count(*) AS n, round_even(any_value(q1), 4) AS q1, round_even(any_value(median), 4) AS median, round_even(any_value(q3), 4) AS q3,
      min(amount) FILTER (inside) AS whisker_low, max(amount) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers FROM i GROUP BY 1""")(_box)


@query("amount_by_currency", f"""WITH {TX} SELECT currency, round_even(sum(amount) / count(amount), 4) AS mean,
  round_even(stddev_samp(amount), 4) AS std, count(amount) AS count FROM tx WHERE currency IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return P.amount_by_group(transactions(spark, sf), "currency").withColumns(r(4, "mean", "std"))


_PROF = ["amount", "hour", "month", "user_id", "location"]


@query("feature_profile", f"""WITH {TX}, h AS (SELECT amount, CAST(hour(timestamp) AS INT) AS hour, CAST(month(timestamp) AS INT) AS month, user_id, location FROM tx) {' UNION ALL '.join(
    f"SELECT '{c}' AS feature, '{t}' AS data_type, count({c}) AS non_null, count(*) - count({c}) AS nulls, round_even((count(*) - count({c})) / count(*) * 100, 6) AS null_percentage, "
    + (f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round_even(avg({c}), 4) AS mean" if t != 'string' else "NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean") + " FROM h"
    for c, t in zip(_PROF, ['double', 'int', 'int', 'string', 'string']))}""")
def _(spark, sf):
    t = time_features(transactions(spark, sf)).select(*_PROF)
    return P.feature_profile(t).withColumns({**r(6, "null_percentage"), **r(4, "mean")})


@query("top_feature_values", f"""WITH {TX}, l AS (SELECT 'location' AS feature, location AS value FROM tx UNION ALL SELECT 'device', device FROM tx UNION ALL SELECT 'user_id', user_id FROM tx),
  c AS (SELECT feature, value, count(*) AS n FROM l WHERE value IS NOT NULL GROUP BY 1, 2)
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS INT) AS rank FROM c) WHERE rank <= 3""")
def _(spark, sf):
    return P.top_values(transactions(spark, sf), ["location", "device", "user_id"])


@query("user_amount_pattern", f"""WITH {TX} SELECT user_id, round_even(coalesce(sum(amount) / count(amount), 0), 4) AS mean,
  round_even(coalesce(stddev_samp(amount), 0), 4) AS std FROM tx WHERE user_id IS NOT NULL GROUP BY 1""")
def _(spark, sf):
    return P.user_amount_pattern(transactions(spark, sf)).withColumns(r(4, "mean", "std"))


_FEW = f"""{TX}, stats AS (SELECT quantile_cont(amount, 0.95) AS q95, quantile_cont(amount, 0.8) AS q80, avg(amount) AS am, stddev_samp(amount) AS asd FROM tx),
  s AS (SELECT tx_id, user_id, transaction_type, location, CAST(hour(timestamp) AS INT) AS hour, amount,
    (CAST(coalesce(amount > q95 OR abs((amount - am) / asd) > 3, false) AS INT) * 0.3::DOUBLE + CAST(coalesce(hour(timestamp) <= 6, false) AS INT) * 0.15::DOUBLE
     + CAST(coalesce(isodow(timestamp) >= 6 AND amount > q80, false) AS INT) * 0.1::DOUBLE
     + CAST(coalesce(amount % 100 = 0 AND amount >= 100, false) AS INT) * 0.05::DOUBLE) / 1.75::DOUBLE AS rule_score FROM tx, stats),
  top AS (SELECT * FROM s ORDER BY rule_score DESC, tx_id LIMIT 100)"""


def _few(spark, sf):
    return RuleSet().score(time_features(transactions(spark, sf)))


for _c in ("location", "hour"):
    def _by(spark, sf, _c=_c):
        top = _few(spark, sf).orderBy(F.col("rule_score").desc(), "tx_id").limit(100)
        return P.anomalies_by(top, _c)
    query(f"anomalies_by_{_c}", f"WITH {_FEW} SELECT {_c} AS value, count(*) AS n FROM top WHERE {_c} IS NOT NULL GROUP BY 1")(_by)


@query("anomaly_scatter", f"WITH {_FEW} SELECT amount AS x, hour AS y, rule_score > 0.2 AS flag, user_id, transaction_type FROM s")
def _(spark, sf):
    s = _few(spark, sf).withColumn("is_anomaly", F.col("rule_score") > 0.2)
    return P.scatter_points(s, "amount", "hour")
