"""Feature queries, with their SQL counterparts."""

import uuid

from pyspark.sql import functions as F

from tidewatch.functions.numbers import rounded
from tidewatch.operators import basic, context, sequence, users
from tidewatch.operators.profiling import feature_profile
from tidewatch.operators.skew import shared_folder
from tidewatch.plans.features import extract_features, feature_catalogue
from tidewatch.sources.stores import read_features, write_features

from .data import ORDER_TX, TX, order_transactions, transactions

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def r(digits, *cols):
    return {c: rounded(F.col(c), digits) for c in cols}


BASIC = """hours AS (SELECT *, CAST(hour(timestamp) AS INT) AS hour, CAST(isodow(timestamp) - 1 AS INT) AS day_of_week,
  coalesce(isodow(timestamp) >= 6, false) AS is_weekend, CAST(month(timestamp) AS INT) AS month,
  CAST(day(timestamp) AS INT) AS day_of_month FROM tx)"""
_HOURCAT = """CASE WHEN hour <= 6 THEN 'night' WHEN hour <= 12 THEN 'morning' WHEN hour <= 18 THEN 'afternoon'
  WHEN hour <= 24 THEN 'evening' END"""


@query("time_features", f"""WITH {TX}, {BASIC} SELECT tx_id, hour, day_of_week, is_weekend, month, day_of_month,
  {_HOURCAT} AS hour_category FROM hours""")
def _(spark, sf):
    return basic.time_features(transactions(spark, sf)).select(
        "tx_id", "hour", "day_of_week", "is_weekend", "month", "day_of_month", "hour_category")


@query("amount_features", f"""WITH {TX}, q AS (SELECT quantile_cont(amount, [0.25, 0.5, 0.75]) AS q FROM tx)
  SELECT tx_id, round_even(ln(1 + amount), 6) AS amount_log, round_even(amount / 10, 0) * 10 AS amount_rounded,
  CASE WHEN amount < 0 THEN NULL WHEN amount <= q[1] THEN 'low' WHEN amount <= q[2] THEN 'medium'
    WHEN amount <= q[3] THEN 'high' WHEN amount IS NOT NULL THEN 'very_high' END AS amount_category FROM tx, q""")
def _(spark, sf):
    out = basic.basic_features(transactions(spark, sf)).select("tx_id", "amount_log", "amount_rounded", "amount_category")
    return out.withColumns(r(6, "amount_log"))


@query("filled_features", f"""WITH {TX} SELECT tx_id, currency IS NOT NULL AS has_currency, location IS NOT NULL AS has_location,
  device IS NOT NULL AS has_device, coalesce(currency, 'unknown') AS currency_filled, coalesce(location, 'unknown') AS location_filled,
  coalesce(device, 'unknown') AS device_filled, transaction_type AS transaction_type_filled,
  CASE device WHEN 'iPhone 13' THEN 'iPhone' WHEN 'Samsung Galaxy S10' THEN 'Samsung' WHEN 'Pixel 6' THEN 'Pixel'
    WHEN 'Nokia 3310' THEN 'Nokia' WHEN 'Xiaomi Mi 11' THEN 'Xiaomi' WHEN 'Huawei P30' THEN 'Huawei' WHEN 'None' THEN 'unknown' END AS device_brand,
  CASE WHEN transaction_type IN ('withdrawal', 'cashout', 'debit') THEN 'cash' WHEN transaction_type IN ('transfer', 'top-up', 'purchase') THEN 'digital'
    WHEN transaction_type IN ('deposit', 'refund') THEN 'account' ELSE 'other' END AS transaction_group FROM tx""")
def _(spark, sf):
    return basic.basic_features(transactions(spark, sf)).select(
        "tx_id", "has_currency", "has_location", "has_device", "currency_filled", "location_filled", "device_filled",
        "transaction_type_filled", "device_brand", "transaction_group")


def profile_sql(tx):
    return f"""{tx}, agg AS (SELECT user_id, count(amount) AS n,
  sum(amount) AS s, stddev_samp(amount) AS sd, min(amount) AS mn, max(amount) AS mx,
  min(timestamp) AS t0, max(timestamp) AS t1, count(DISTINCT location) AS ul, count(DISTINCT device) AS ud,
  count(DISTINCT transaction_type) AS ut, count(DISTINCT currency) AS uc FROM tx WHERE user_id IS NOT NULL GROUP BY user_id),
base AS (SELECT user_id, n AS user_tx_count, coalesce(round_even(s / nullif(n, 0), 4), 0) AS user_avg_amount,
  round_even(sd, 4) AS sd4, round_even(s / nullif(n, 0), 4) AS av4, coalesce(round_even(sd, 4), 0) AS user_std_amount,
  coalesce(round_even(mn, 4), 0) AS user_min_amount, coalesce(round_even(mx, 4), 0) AS user_max_amount,
  coalesce(round_even(s, 4), 0) AS user_total_amount, t0 AS user_first_tx_time, t1 AS user_last_tx_time,
  ul AS user_unique_locations, ud AS user_unique_devices, ut AS user_unique_types, uc AS user_unique_currencies,
  (epoch_us(t1) - epoch_us(t0)) / 86400000000.0::DOUBLE AS days FROM agg),
profile AS (SELECT * EXCLUDE (sd4, av4, days), coalesce(days, 0) AS user_activity_days,
  coalesce(round_even(user_tx_count / (days + 1), 4), 0) AS user_tx_per_day,
  round_even(coalesce(sd4 / nullif(av4, 0), 0), 4) AS user_amount_cv,
  coalesce(round_even(user_unique_locations / nullif(user_tx_count, 0), 4), 0) AS user_location_diversity,
  coalesce(round_even(user_unique_devices / nullif(user_tx_count, 0), 4), 0) AS user_device_diversity FROM base)"""


_PROFILE_OUT = "* REPLACE (round_even(user_activity_days, 6) AS user_activity_days)"


@query("user_profile", f"WITH {profile_sql(TX)} SELECT {_PROFILE_OUT} FROM profile")
def _(spark, sf):
    out = users.user_profile(transactions(spark, sf)).withColumns(r(6, "user_activity_days"))
    return ntz(out, "user_first_tx_time", "user_last_tx_time")


@query("user_profile_orders", f"WITH {profile_sql(ORDER_TX)} SELECT {_PROFILE_OUT} FROM profile")
def _(spark, sf):
    out = users.user_profile(order_transactions(spark, sf)).withColumns(r(6, "user_activity_days"))
    return ntz(out, "user_first_tx_time", "user_last_tx_time")


@query("user_features", f"""WITH {profile_sql(TX)} SELECT tx_id, profile.* EXCLUDE (user_id, user_first_tx_time, user_last_tx_time)
  REPLACE (round_even(user_activity_days, 6) AS user_activity_days) FROM tx LEFT JOIN profile ON tx.user_id = profile.user_id""")
def _(spark, sf):
    out = users.user_features(transactions(spark, sf)).withColumns(r(6, "user_activity_days"))
    return out.select("tx_id", *[c for c in users.PROFILE_COLUMNS if not c.endswith("_time")])


def sequence_sql(tx):
    return f"""{tx}, seq AS (SELECT *, lag(timestamp) OVER w AS p_ts, lead(timestamp) OVER w AS n_ts,
    lag(location) OVER w AS p_loc, lag(device) OVER w AS p_dev,
    avg(amount) OVER (PARTITION BY user_id) AS av, stddev_samp(amount) OVER (PARTITION BY user_id) AS sd
    FROM tx WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY timestamp NULLS LAST, tx_id)),
  vel AS (SELECT a.tx_id, count(b.tx_id) AS v FROM tx a JOIN tx b ON a.user_id = b.user_id
    AND b.timestamp < a.timestamp AND b.timestamp >= a.timestamp - INTERVAL 24 HOUR GROUP BY a.tx_id),
  sequence AS (SELECT tx.tx_id, coalesce((epoch_us(tx.timestamp) - epoch_us(p_ts)) / 3600000000.0::DOUBLE, 0) AS time_since_last_tx,
    coalesce((epoch_us(n_ts) - epoch_us(tx.timestamp)) / 3600000000.0::DOUBLE, 0) AS time_until_next_tx,
    CASE WHEN tx.user_id IS NOT NULL THEN coalesce(v, 0) END AS tx_velocity_24h,
    CAST(coalesce(p_loc <> tx.location, true) AS INT) AS location_changed,
    CAST(coalesce(p_dev <> tx.device, true) AS INT) AS device_changed,
    CASE WHEN sd IS NOT NULL THEN round_even((tx.amount - av) / greatest(sd, 1e-8), 4) END AS amount_zscore_user,
    CAST(coalesce(hour(tx.timestamp) < 6 OR hour(tx.timestamp) > 22, false) AS INT) AS is_unusual_hour,
    CAST(coalesce(hour(tx.timestamp) < 6, false) AS INT) AS is_night_transaction
    FROM tx LEFT JOIN seq USING (tx_id) LEFT JOIN vel USING (tx_id))"""


_SEQ = """tx_id, round_even(time_since_last_tx, 6) AS time_since_last_tx, round_even(time_until_next_tx, 6) AS time_until_next_tx,
  tx_velocity_24h, location_changed, device_changed, amount_zscore_user, is_unusual_hour, is_night_transaction"""


@query("sequence_features", f"WITH {sequence_sql(TX)} SELECT {_SEQ} FROM sequence")
def _(spark, sf):
    return sequence.sequence_features(transactions(spark, sf)).select("tx_id", *sequence.SEQUENCE_COLUMNS).withColumns(
        r(6, "time_since_last_tx", "time_until_next_tx"))


@query("sequence_features_orders", f"WITH {sequence_sql(ORDER_TX)} SELECT {_SEQ} FROM sequence")
def _(spark, sf):
    return sequence.sequence_features(order_transactions(spark, sf)).select("tx_id", *sequence.SEQUENCE_COLUMNS).withColumns(
        r(6, "time_since_last_tx", "time_until_next_tx"))


CONTEXT = """labelled AS (SELECT *, coalesce(location, 'None') || '_' || coalesce(device, 'None') AS location_device,
    coalesce(CAST(hour(timestamp) AS VARCHAR), 'None') || '_' || coalesce(transaction_type, 'None') AS hour_type FROM tx),
  lf AS (SELECT location, count(*) AS f, sum(amount) / count(amount) AS m FROM tx WHERE location IS NOT NULL GROUP BY 1),
  df AS (SELECT device, count(*) AS f FROM tx WHERE device IS NOT NULL GROUP BY 1),
  tf AS (SELECT transaction_type, count(*) AS f, sum(amount) / count(amount) AS m FROM tx WHERE transaction_type IS NOT NULL GROUP BY 1),
  ldf AS (SELECT location_device, count(*) AS f FROM labelled GROUP BY 1), htf AS (SELECT hour_type, count(*) AS f FROM labelled GROUP BY 1),
  pct AS (SELECT tx_id, (rank() OVER (ORDER BY amount) + (count(*) OVER (PARTITION BY amount) - 1) / 2) / count(*) OVER () AS amount_percentile
    FROM tx WHERE amount IS NOT NULL),
  context AS (SELECT tx_id, lf.f AS location_frequency, 1 / (lf.f + 1) AS location_rarity,
    CAST(coalesce(1 / (lf.f + 1) > 0.1, false) AS INT) AS location_risk_score, df.f AS device_frequency, 1 / (df.f + 1) AS device_rarity,
    tf.f AS type_frequency, 1 / (tf.f + 1) AS type_rarity, location_device, ldf.f AS location_device_frequency,
    1 / (ldf.f + 1) AS location_device_rarity, hour_type, htf.f AS hour_type_frequency, 1 / (htf.f + 1) AS hour_type_rarity,
    amount_percentile, abs(amount - lf.m) AS amount_deviation_location, abs(amount - tf.m) AS amount_deviation_type
    FROM labelled LEFT JOIN lf USING (location) LEFT JOIN df USING (device) LEFT JOIN tf USING (transaction_type)
    LEFT JOIN ldf USING (location_device) LEFT JOIN htf USING (hour_type) LEFT JOIN pct USING (tx_id))"""
_CTX_ROUND = {
    "location_rarity": 8, "device_rarity": 8, "type_rarity": 8, "location_device_rarity": 8, "hour_type_rarity": 8,
    "amount_percentile": 6, "amount_deviation_location": 4, "amount_deviation_type": 4,
}
_CTX = ", ".join(
    f"round_even({c}, {_CTX_ROUND[c]}) AS {c}" if c in _CTX_ROUND else c for c in ["tx_id", *context.CONTEXT_COLUMNS])


def context_rounded(df):
    return df.withColumns({c: rounded(F.col(c), d) for c, d in _CTX_ROUND.items()})


@query("contextual_features", f"WITH {TX}, {CONTEXT} SELECT {_CTX} FROM context")
def _(spark, sf):
    t = basic.time_features(transactions(spark, sf))
    return context_rounded(context.contextual_features(t).select("tx_id", *context.CONTEXT_COLUMNS))


@query("contextual_features_orders", f"WITH {ORDER_TX}, {CONTEXT} SELECT {_CTX} FROM context")
def _(spark, sf):
    t = basic.time_features(order_transactions(spark, sf))
    return context_rounded(context.contextual_features(t).select("tx_id", *context.CONTEXT_COLUMNS))


@query("amount_percentile", f"WITH {TX}, {CONTEXT} SELECT tx_id, round_even(amount_percentile, 6) AS amount_percentile FROM context")
def _(spark, sf):
    return context.amount_percentile(transactions(spark, sf)).select(
        "tx_id", rounded(F.col("amount_percentile"), 6).alias("amount_percentile"))


_ALL = ["tx_id", "hour", "is_weekend", "amount_category", "device_brand", "user_tx_count", "user_avg_amount",
        "user_unique_locations", "user_device_diversity", "tx_velocity_24h", "location_changed", "device_changed",
        "amount_zscore_user", "location_frequency", "type_frequency", "location_device_frequency",
        "hour_type_frequency", "amount_percentile", "amount_deviation_type"]


@query("all_features", f"""WITH {profile_sql(TX)}, {sequence_sql('q AS (SELECT quantile_cont(amount, [0.25, 0.5, 0.75]) AS q FROM tx)')}, {CONTEXT}
  SELECT tx.tx_id, CAST(hour(timestamp) AS INT) AS hour, coalesce(isodow(timestamp) >= 6, false) AS is_weekend,
  CASE WHEN amount < 0 THEN NULL WHEN amount <= q[1] THEN 'low' WHEN amount <= q[2] THEN 'medium'
    WHEN amount <= q[3] THEN 'high' WHEN amount IS NOT NULL THEN 'very_high' END AS amount_category,
  CASE device WHEN 'iPhone 13' THEN 'iPhone' WHEN 'Samsung Galaxy S10' THEN 'Samsung' WHEN 'Pixel 6' THEN 'Pixel'
    WHEN 'Nokia 3310' THEN 'Nokia' WHEN 'Xiaomi Mi 11' THEN 'Xiaomi' WHEN 'Huawei P30' THEN 'Huawei' END AS device_brand,
  user_tx_count, user_avg_amount, user_unique_locations, user_device_diversity, tx_velocity_24h, location_changed, device_changed,
  amount_zscore_user, location_frequency, type_frequency, location_device_frequency, hour_type_frequency,
  round_even(amount_percentile, 6) AS amount_percentile, round_even(amount_deviation_type, 4) AS amount_deviation_type
  FROM tx LEFT JOIN profile ON tx.user_id = profile.user_id LEFT JOIN sequence USING (tx_id) LEFT JOIN context USING (tx_id), q""")
def _(spark, sf):
    return _shown(extract_features(transactions(spark, sf)))


def _shown(features):
    return features.select(*_ALL).withColumns({**r(6, "amount_percentile"), **r(4, "amount_deviation_type")})


@query("feature_store", ORACLES["all_features"])
def _(spark, sf):
    """The feature table, written by day and read again."""
    path = f"{shared_folder(spark).rstrip('/')}/features-{uuid.uuid4().hex}"
    write_features(extract_features(transactions(spark, sf)), path)
    return _shown(read_features(spark, path))


@query("feature_catalogue", None)
def _(spark, sf):
    """Categories of the features, with the completeness of each over the whole table."""
    f = extract_features(transactions(spark, sf))
    return feature_catalogue(f).join(feature_profile(f), "feature")
