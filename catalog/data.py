"""Transactions and raw log lines derived from the given tables, in Spark and in SQL.

The derivation is scaffolding for the checks; the operators start at its result.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

TYPES = {"view": "withdrawal", "click": "transfer", "purchase": "purchase", "signup": "deposit", "error": "top-up"}
PLACES = ["London", "Glasgow", "Birmingham", "Liverpool", "Cardiff", "Leeds", "Manchester"]
DEVICES = ["iPhone 13", "Samsung Galaxy S10", "Pixel 6", "Nokia 3310", "Xiaomi Mi 11", "Huawei P30"]
SYMBOLS = ["£", "$", "€"]


def _pick(index, values):
    return F.try_element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table, read as a stream of files."""
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event; some users, times and amounts are missing."""
    return to_transactions(events(spark, sf_dir))


def to_transactions(e: DataFrame, *keep) -> DataFrame:
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    kinds = F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])
    return e.select(
        F.col("event_id").alias("tx_id"),
        F.when(k != 98, F.col("ts").cast("timestamp")).alias("timestamp"),
        F.when(k != 99, F.concat(F.lit("user"), F.col("user_id"))).alias("user_id"),
        F.when(k != 97, F.col("value")).alias("amount"),
        F.try_element_at(kinds, F.col("event_type")).alias("transaction_type"),
        _pick(k % 8, PLACES).alias("location"),
        _pick(F.col("event_id") % 7, DEVICES).alias("device"),
        _pick(F.col("event_id") % 4, SYMBOLS).alias("currency"),
        *keep,
    )


def _sql_pick(index, values):
    return f"list_extract([{', '.join(repr(v) for v in values)}], CAST({index} + 1 AS INT))"


_KIND = "CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in TYPES.items()) + " END"
TX = f"""events_k AS (SELECT *, CAST(regexp_extract(props, '(\\d+)', 1) AS INT) AS k FROM events),
tx AS (SELECT event_id AS tx_id, CASE WHEN k <> 98 THEN ts END AS timestamp,
  CASE WHEN k <> 99 THEN 'user' || user_id END AS user_id, CASE WHEN k <> 97 THEN value END AS amount,
  {_KIND} AS transaction_type, {_sql_pick('k % 8', PLACES)} AS location,
  {_sql_pick('event_id % 7', DEVICES)} AS device, {_sql_pick('event_id % 4', SYMBOLS)} AS currency
  FROM events_k)"""


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per order; dates are whole days, so times tie."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    return (
        o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
        .select(
            F.col("o_orderkey").alias("tx_id"),
            F.col("o_orderdate").cast("timestamp").alias("timestamp"),
            F.concat(F.lit("user"), F.col("o_custkey")).alias("user_id"),
            F.col("o_totalprice").alias("amount"),
            F.lower("o_orderpriority").alias("transaction_type"),
            F.col("n_name").alias("location"),
            F.col("o_orderstatus").alias("device"),
            F.lit("£").alias("currency"),
        )
    )


ORDER_TX = """tx AS (SELECT o_orderkey AS tx_id, CAST(o_orderdate AS TIMESTAMP) AS timestamp,
  'user' || o_custkey AS user_id, o_totalprice AS amount, lower(o_orderpriority) AS transaction_type,
  n_name AS location, o_orderstatus AS device, '£' AS currency
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a log line in one of ten shapes (seven layouts, empty, malformed, free text)."""
    return to_raw_logs(events(spark, sf_dir))


def to_raw_logs(e: DataFrame) -> DataFrame:
    t = to_transactions(e, "ts", "value", F.col("user_id").alias("uid"), "props")
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    slash = F.date_format(F.col("ts").cast("timestamp"), "dd/MM/yyyy HH:mm:ss")
    user = F.concat(F.lit("user"), F.col("uid"))
    money = F.concat(F.coalesce("currency", F.lit("")), F.col("value").cast("string"))
    suffixed = F.concat(F.col("value").cast("string"), F.coalesce("currency", F.lit("")))
    place, dev = F.coalesce("location", F.lit("None")), F.coalesce("device", F.lit("None"))
    kind, plain = F.col("transaction_type"), F.col("value").cast("string")
    cat = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    shape = F.col("tx_id") % 10
    line = (
        F.when(shape == 0, cat(iso, " | user: ", user, " | txn: ", kind, " of ", money, " from ", place, " | device: ", dev))
        .when(shape == 1, cat(iso, "::", user, "::", kind, "::", plain, "::", place, "::", dev))
        .when(shape == 2, cat("usr:", user, "|", kind, "|", money, "|", place, "|", iso, "|", dev))
        .when(shape == 3, cat(iso, " >> [", user, "] did ", kind, " - amt=", money, " - ", place, " // dev:", dev))
        .when(shape == 4, cat(slash, " ::: ", user, " *** ", F.upper(kind), " ::: amt:", suffixed, " @ ", place, " <", dev, ">"))
        .when(shape == 5, cat(iso, " - user=", user, " - action=", kind, " ", money, " - ATM: ", place, " - device=", dev))
        .when(shape == 6, cat(user, " ", iso, " ", kind, " ", plain, " ", place, " ", dev))
        .when(shape == 7, F.lit('""'))
        .when(shape == 8, F.lit("MALFORMED_LOG"))
        .otherwise(cat(F.upper(kind), " by ", F.initcap(user), " for ", money, " near ", place, " via ", dev, " at ", slash))
    )
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    line = F.when(k == 96, F.concat(F.lit("  "), line, F.lit("\t "))).when(k != 99, line)
    # Exploded, so that later tests of the line do not repeat its making.
    return t.select("tx_id", F.explode(F.array(line)).alias("raw_log"))


RAW = f"""{TX},
src AS (SELECT tx.*, k, strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso, strftime(ts, '%d/%m/%Y %H:%M:%S') AS slash,
  'user' || e.user_id AS u, coalesce(currency, '') || CAST(value AS VARCHAR) AS money,
  CAST(value AS VARCHAR) || coalesce(currency, '') AS suffixed, CAST(value AS VARCHAR) AS plain,
  coalesce(location, 'None') AS place, coalesce(device, 'None') AS dev
  FROM tx JOIN events_k e ON tx_id = event_id),
lines AS (SELECT tx_id, k, CASE tx_id % 10
  WHEN 0 THEN iso || ' | user: ' || u || ' | txn: ' || transaction_type || ' of ' || money || ' from ' || place || ' | device: ' || dev
  WHEN 1 THEN iso || '::' || u || '::' || transaction_type || '::' || plain || '::' || place || '::' || dev
  WHEN 2 THEN 'usr:' || u || '|' || transaction_type || '|' || money || '|' || place || '|' || iso || '|' || dev
  WHEN 3 THEN iso || ' >> [' || u || '] did ' || transaction_type || ' - amt=' || money || ' - ' || place || ' // dev:' || dev
  WHEN 4 THEN slash || ' ::: ' || u || ' *** ' || upper(transaction_type) || ' ::: amt:' || suffixed || ' @ ' || place || ' <' || dev || '>'
  WHEN 5 THEN iso || ' - user=' || u || ' - action=' || transaction_type || ' ' || money || ' - ATM: ' || place || ' - device=' || dev
  WHEN 6 THEN u || ' ' || iso || ' ' || transaction_type || ' ' || plain || ' ' || place || ' ' || dev
  WHEN 7 THEN '""' WHEN 8 THEN 'MALFORMED_LOG'
  ELSE upper(transaction_type) || ' by ' || 'User' || substr(u, 5) || ' for ' || money || ' near ' || place || ' via ' || dev || ' at ' || slash
  END AS line FROM src),
raw AS (SELECT tx_id, CASE WHEN k = 96 THEN '  ' || line || chr(9) || ' ' WHEN k <> 99 THEN line END AS raw_log FROM lines)"""

# An independent SQL reading of the same log layouts.
_T8 = "(?i)(withdrawal|deposit|cashout|purchase|transfer|top-up|debit|refund)"
_L8 = "(?i)(London|Glasgow|Birmingham|Liverpool|Cardiff|Leeds|Manchester|None)"
_D8 = "(?i)(iPhone 13|Samsung Galaxy S10|Pixel 6|Nokia 3310|Xiaomi Mi 11|Huawei P30|None)"


def _rx(text, pattern, group=1):
    return f"nullif(regexp_extract({text}, '{pattern}', {group}), '')"


PARSED = f"""{RAW},
cls AS (SELECT tx_id, trim(raw_log, ' ' || chr(9) || chr(10) || chr(13)) AS r, raw_log AS given FROM raw),
logs AS (SELECT tx_id, r FROM cls WHERE r IS NOT NULL AND r NOT IN ('', '""', 'MALFORMED_LOG')),
shaped AS (SELECT *, CASE
  WHEN contains(r, '|') AND contains(r, 'user:') AND len(string_split(r, '|')) >= 3 THEN 1
  WHEN contains(r, '::') AND len(string_split(r, '::')) >= 4 THEN 2
  WHEN starts_with(r, 'usr:') AND len(string_split(r, '|')) >= 4 THEN 3
  WHEN contains(r, '>>') AND contains(r, '[') THEN 4
  WHEN contains(r, ':::') AND contains(r, '***') AND len(string_split(r, ':::')) >= 3 THEN 5
  WHEN contains(r, 'user=') AND contains(r, 'action=') AND len(string_split(r, ' - ')) >= 3 THEN 6
  WHEN starts_with(r, 'user') AND len(regexp_split_to_array(r, '\\s+')) >= 4 THEN 7 ELSE 8 END AS format_id FROM logs),
cut AS (SELECT *, CASE WHEN format_id IN (1, 3) THEN string_split(r, '|') WHEN format_id = 2 THEN string_split(r, '::')
  WHEN format_id = 4 THEN string_split(r, '>>') WHEN format_id = 5 THEN string_split(r, ':::')
  WHEN format_id = 6 THEN string_split(r, ' - ') WHEN format_id = 7 THEN regexp_split_to_array(r, '\\s+') ELSE [r] END AS p FROM shaped),
texts AS (SELECT tx_id, r, format_id,
  trim(CASE format_id WHEN 3 THEN p[5] WHEN 7 THEN p[2] || ' ' || p[3]
    WHEN 8 THEN coalesce({_rx('r', r'(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})')}, {_rx('r', r'(\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2})')})
    ELSE p[1] END) AS t,
  CASE format_id WHEN 1 THEN trim(split_part(p[2], 'user:', 2)) WHEN 2 THEN p[2] WHEN 3 THEN split_part(p[1], 'usr:', 2)
    WHEN 4 THEN {_rx('r', r'\[([^\]]+)\]')} WHEN 5 THEN {_rx('p[2]', r'(\w+) \*\*\* \w+')}
    WHEN 6 THEN {_rx('r', r'user=([^ ]*)')} WHEN 7 THEN p[1]
    ELSE CASE WHEN starts_with({_rx('r', r'(?i)(user\d+)')}, 'user') THEN {_rx('r', r'(?i)(user\d+)')}
      ELSE 'user' || {_rx('r', r'(?i)(user\d+)')} END END AS user_id,
  CASE format_id WHEN 1 THEN lower({_rx('p[3]', _T8)}) WHEN 2 THEN p[3] WHEN 3 THEN p[2] WHEN 4 THEN {_rx('r', r'did (\w+)')}
    WHEN 5 THEN lower({_rx('p[2]', r'\w+ \*\*\* (\w+)')}) WHEN 6 THEN {_rx('r', r'action=([^ ]+)')} WHEN 7 THEN p[4]
    ELSE lower({_rx('r', _T8)}) END AS transaction_type,
  CASE format_id WHEN 1 THEN split_part(p[3], 'txn:', 2) WHEN 2 THEN p[4] WHEN 3 THEN p[3]
    WHEN 4 THEN {_rx('r', r'amt=([£$€]?\d+\.?\d*)')} WHEN 5 THEN {_rx('r', r'amt:([£$€]?\d+\.?\d*)')}
    WHEN 6 THEN {_rx('r', r'action=[^ ]+ ([^ ]+)')} WHEN 7 THEN p[5] ELSE r END AS amt,
  CASE format_id WHEN 1 THEN {_rx('p[3]', _L8)} WHEN 2 THEN p[5] WHEN 3 THEN p[4]
    WHEN 4 THEN trim({_rx('p[2]', '- ([^/]+?)( //| dev:)')}) WHEN 5 THEN trim({_rx('p[3]', '@ ([^<]+)')})
    WHEN 6 THEN trim({_rx('r', 'ATM:(.*?) - ')}) WHEN 7 THEN p[6] ELSE {_rx('r', _L8)} END AS loc,
  CASE format_id WHEN 1 THEN trim(split_part(p[4], 'device:', 2)) WHEN 2 THEN p[6] WHEN 3 THEN p[6]
    WHEN 4 THEN trim({_rx('r', 'dev:([^$]+)$')}) WHEN 5 THEN trim({_rx('p[3]', '<([^>]+)>')})
    WHEN 6 THEN {_rx('r', 'device=(.*)$')} WHEN 7 THEN p[7] ELSE {_rx('r', _D8)} END AS dev FROM cut),
fields AS (SELECT tx_id, r AS raw_log, format_id,
  coalesce(try_strptime(t, '%Y-%m-%d %H:%M:%S'), try_strptime(t, '%d/%m/%Y %H:%M:%S')) AS timestamp, user_id, transaction_type,
  CASE WHEN format_id = 7 THEN TRY_CAST(amt AS DOUBLE) ELSE TRY_CAST({_rx('amt', r'([£$€]?)(\d+\.?\d*)', 2)} AS DOUBLE) END AS amount,
  CASE format_id WHEN 7 THEN NULL WHEN 8 THEN 'GBP' ELSE {_rx('amt', r'([£$€]?)(\d+\.?\d*)', 1)} END AS currency,
  nullif(loc, 'None') AS location, CASE WHEN format_id = 1 THEN dev ELSE nullif(dev, 'None') END AS device FROM texts),
lined AS (SELECT * FROM fields),
clean AS (SELECT * REPLACE (CASE WHEN contains(location, '-') THEN trim(list_extract(string_split(location, '-'), -1)) ELSE location END AS location) FROM fields),
parsed AS (SELECT tx_id, raw_log, timestamp, user_id, transaction_type, amount AS amount_raw,
  round_even(amount * CASE cur WHEN '$' THEN 0.75::DOUBLE WHEN '€' THEN 0.87::DOUBLE ELSE 1.0::DOUBLE END, 2) AS amount, cur AS currency,
  location, device, true AS is_parsed, CAST(NULL AS VARCHAR) AS parse_errors, format_id
  FROM (SELECT *, CASE WHEN currency IS NULL AND location IS NOT NULL THEN '£' ELSE currency END AS cur FROM clean))"""
