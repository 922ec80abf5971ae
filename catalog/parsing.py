"""Queries over log lines, with their SQL counterparts."""

from pyspark.sql import functions as F

from tidewatch.functions.numbers import rounded
from tidewatch.operators import parse, quality

from .data import PARSED, RAW, TX, raw_logs, transactions

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def _ntz(df):
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _parsed(spark, sf):
    return parse.parse_logs(raw_logs(spark, sf))


@query("log_class", f"""WITH {PARSED} SELECT CASE WHEN r IS NULL OR r IN ('', '""') THEN 'empty'
  WHEN r = 'MALFORMED_LOG' THEN 'malformed' ELSE 'log' END AS log_class, count(*) AS n FROM cls GROUP BY 1""")
def _(spark, sf):
    return raw_logs(spark, sf).groupBy(parse.log_class(F.col("raw_log")).alias("log_class")).agg(
        F.count(F.lit(1)).alias("n"))


_PARSED_COLS = """tx_id, raw_log, timestamp, user_id, transaction_type, amount_raw, amount, currency, location,
  device, is_parsed, parse_errors, format_id"""


@query("parse_logs", f"WITH {PARSED} SELECT {_PARSED_COLS} FROM parsed")
def _(spark, sf):
    return _ntz(_parsed(spark, sf))


for _id, _name in parse.FORMAT_NAMES.items():
    def _one(spark, sf, _id=_id):
        return _ntz(_parsed(spark, sf)).filter(F.col("format_id") == _id).drop("parse_errors", "is_parsed")
    query(f"parse_{_name}", f"""WITH {PARSED} SELECT * EXCLUDE (parse_errors, is_parsed) FROM parsed
      WHERE format_id = {_id}""")(_one)


@query("parse_single_entries", f"""WITH {PARSED} SELECT tx_id, format_id, timestamp, user_id, transaction_type,
  amount, currency, location, device FROM lined""")
def _(spark, sf):
    lines = parse.parse_lines(raw_logs(spark, sf))
    return _ntz(lines.filter(F.col("log_class") == "log")).select(
        "tx_id", "format_id", "timestamp", "user_id", "transaction_type", "amount", "currency", "location", "device")


@query("parse_timestamps", f"""WITH {PARSED} SELECT CAST(timestamp AS DATE) AS day, format_id, count(*) AS n
  FROM parsed GROUP BY ALL""")
def _(spark, sf):
    return _parsed(spark, sf).groupBy(F.to_date("timestamp").alias("day"), "format_id").agg(
        F.count(F.lit(1)).alias("n"))


@query("currency_to_gbp", f"""WITH {TX} SELECT tx_id, currency, amount AS amount_raw,
  round_even(amount * CASE currency WHEN '$' THEN 0.75::DOUBLE WHEN '€' THEN 0.87::DOUBLE ELSE 1.0::DOUBLE END, 2) AS amount FROM tx""")
def _(spark, sf):
    t = transactions(spark, sf)
    return t.select("tx_id", "currency", F.col("amount").alias("amount_raw"),
                    parse.gbp_amount(F.col("amount"), F.col("currency")).alias("amount"))


@query("location_cleanup", f"""WITH {PARSED} SELECT location, count(*) AS n FROM parsed GROUP BY 1""")
def _(spark, sf):
    return _parsed(spark, sf).groupBy("location").agg(F.count(F.lit(1)).alias("n"))


@query("currency_imputation", f"""WITH {TX} SELECT tx_id, location,
  CASE WHEN currency IS NULL AND location IS NOT NULL THEN '£' ELSE currency END AS currency FROM tx""")
def _(spark, sf):
    return transactions(spark, sf).select(
        "tx_id", "location", parse.impute_currency(F.col("currency"), F.col("location")).alias("currency"))


@query("valid_rows", f"WITH {PARSED} SELECT tx_id, user_id, amount FROM parsed WHERE is_parsed")
def _(spark, sf):
    return parse.valid_rows(_parsed(spark, sf)).select("tx_id", "user_id", "amount")


_COUNTERS = f"""{PARSED}, counters AS (SELECT (SELECT count(*) FROM raw) AS total_logs,
  (SELECT count(*) FROM parsed WHERE is_parsed) AS parsed_successfully,
  (SELECT count(*) FROM parsed WHERE NOT is_parsed) AS parsing_failed,
  (SELECT count(*) FROM cls WHERE r IS NULL OR r IN ('', '""')) AS empty_logs,
  (SELECT count(*) FROM cls WHERE r = 'MALFORMED_LOG') AS malformed_logs),
rates AS (SELECT *, parsed_successfully / total_logs * 100 AS sr, parsing_failed / total_logs * 100 AS fr,
  empty_logs / total_logs * 100 AS er, malformed_logs / total_logs * 100 AS mr FROM counters)"""


def _counters(spark, sf):
    return quality.parsing_counters(raw_logs(spark, sf))


@query("parsing_counters", f"""WITH {_COUNTERS} SELECT *, parsed_successfully AS success,
  parsing_failed + empty_logs + malformed_logs AS failed FROM counters""")
def _(spark, sf):
    return _counters(spark, sf)


@query("quality_report", f"""WITH {_COUNTERS} SELECT total_logs, parsed_successfully, parsing_failed, empty_logs, malformed_logs,
  round_even(sr, 2) AS success_rate_percent, round_even(fr, 2) AS failure_rate_percent,
  round_even(er, 2) AS empty_rate_percent, round_even(mr, 2) AS malformed_rate_percent,
  CASE WHEN sr >= 80 THEN 'High' WHEN sr >= 60 THEN 'Medium' ELSE 'Low' END AS parsing_efficiency,
  CASE WHEN er + mr <= 20 THEN 'Good' WHEN er + mr <= 40 THEN 'Fair' ELSE 'Poor' END AS data_quality,
  round_even(sr, 2) AS usable_data_ratio,
  CASE WHEN sr >= 80 THEN 'Good' WHEN sr >= 60 THEN 'Fair' ELSE 'Poor' END AS usable_data_grade,
  parsing_failed + empty_logs + malformed_logs AS total_errors FROM rates""")
def _(spark, sf):
    return quality.quality_report(_counters(spark, sf))


@query("recommendations", f"""WITH {_COUNTERS}, advice AS (SELECT CASE WHEN sr < 70 THEN
    ['Consider adding more format parsers to improve success rate', 'Review failed logs to identify new patterns'] ELSE [] END
  || CASE WHEN fr > 20 THEN ['High failure rate detected - investigate parsing logic', 'Consider implementing additional regex patterns'] ELSE [] END
  || CASE WHEN er > 15 THEN ['High number of empty logs - check data source quality', 'Consider filtering empty entries at source'] ELSE [] END
  || CASE WHEN mr > 15 THEN ['High malformed log rate - investigate data generation process', 'Consider implementing data validation at source'] ELSE [] END
  || CASE WHEN sr >= 85 THEN ['Excellent parsing performance - system is production ready'] ELSE [] END AS a FROM rates),
  whole AS (SELECT CASE WHEN len(a) > 0 THEN a ELSE ['Parsing performance is within acceptable ranges',
    'Monitor trends over time for any degradation'] END AS a FROM advice)
  SELECT CAST(generate_subscripts(a, 1) - 1 AS INT) AS position, unnest(a) AS recommendation FROM whole""")
def _(spark, sf):
    return quality.recommendations(_counters(spark, sf))


@query("parsing_summary", f"""WITH {_COUNTERS} SELECT 'Total Logs' AS category, total_logs AS count, '100.0%' AS percentage FROM rates
  UNION ALL SELECT 'Successfully Parsed', parsed_successfully, CAST(round_even(sr, 2) AS VARCHAR) || '%' FROM rates
  UNION ALL SELECT 'Parsing Failures', parsing_failed, CAST(round_even(fr, 2) AS VARCHAR) || '%' FROM rates
  UNION ALL SELECT 'Empty Logs', empty_logs, CAST(round_even(er, 2) AS VARCHAR) || '%' FROM rates
  UNION ALL SELECT 'Malformed Logs', malformed_logs, CAST(round_even(mr, 2) AS VARCHAR) || '%' FROM rates""")
def _(spark, sf):
    return quality.summary_table(_counters(spark, sf))


@query("separator_counts", f"""WITH {RAW} SELECT count(*) FILTER (contains(raw_log, '|')) AS pipe,
  count(*) FILTER (contains(raw_log, '::')) AS double_colon, count(*) FILTER (contains(raw_log, '>>')) AS arrow,
  count(*) FILTER (contains(raw_log, ':::')) AS triple_colon, count(*) FILTER (contains(raw_log, 'usr:')) AS usr_prefix,
  count(*) FILTER (starts_with(raw_log, 'user')) AS user_start, count(*) FILTER (raw_log IS NULL) AS null_lines,
  count(*) FILTER (raw_log IS NULL OR trim(raw_log, ' ' || chr(9)) IN ('', '""')) AS empty_lines,
  count(*) FILTER (trim(raw_log, ' ' || chr(9)) = 'MALFORMED_LOG') AS malformed_lines FROM raw""")
def _(spark, sf):
    return quality.separator_counts(raw_logs(spark, sf))


@query("format_report", f"""WITH {PARSED} SELECT format_id, CASE format_id {' '.join(
    f"WHEN {i} THEN '{n}'" for i, n in parse.FORMAT_NAMES.items())} END AS format, count(*) AS lines,
  count(*) FILTER (is_parsed) AS parsed, round_even(count(*) FILTER (is_parsed) / count(*) * 100, 2) AS success_rate_percent
  FROM parsed GROUP BY format_id""")
def _(spark, sf):
    return quality.format_report(raw_logs(spark, sf))


@query("parsing_errors", f"""WITH {PARSED} SELECT 'none' AS error, 1 AS occurrences WHERE
  (SELECT count(*) FROM parsed WHERE NOT is_parsed AND parse_errors IS NOT NULL) > 0""")
def _(spark, sf):
    return quality.parsing_errors(raw_logs(spark, sf))


@query("sample_valid_lines", f"""WITH {PARSED} SELECT tx_id, given AS raw_log FROM cls WHERE r IS NOT NULL AND r NOT IN ('', '""', 'MALFORMED_LOG') ORDER BY tx_id LIMIT 10""")
def _(spark, sf):
    return parse.sample_valid_lines(raw_logs(spark, sf))


@query("region_currency", """SELECT c_custkey, n_name AS location, CASE WHEN regexp_matches(lower(n_name),
  'london|glasgow|birmingham|liverpool|cardiff|leeds|manchester') THEN 'GBP' WHEN regexp_matches(lower(n_name),
  'new york|los angeles|chicago|houston|phoenix|philadelphia') THEN 'USD' WHEN regexp_matches(lower(n_name),
  'paris|berlin|madrid|rome|amsterdam|brussels') THEN 'EUR' ELSE 'GBP' END AS currency
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(spark, sf):
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_nationkey")
    n = spark.read.parquet(f"{sf}/nation.parquet").select("n_nationkey", "n_name")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col("n_name").alias("location"), parse.infer_region_currency(F.col("n_name")).alias("currency"))


@query("currency_conversion_stats", f"""WITH {TX} SELECT coalesce(currency, 'none') AS original_currency,
  count(*) AS transactions, count(amount) AS transactions_with_amount,
  round_even(sum(amount), 4) AS total_amount FROM tx GROUP BY 1""")
def _(spark, sf):
    out = parse.currency_conversion_stats(transactions(spark, sf))
    return out.withColumn("total_amount", rounded(F.col("total_amount"), 4))


# Whole texts of other tables, read as if they were log lines: every text is a row, whatever layout claims it.
_WHOLE = PARSED[len(RAW):] + """ SELECT cls.tx_id, format_id, timestamp, user_id, transaction_type, amount,
  CASE WHEN format_id = 8 AND amount IS NULL THEN NULL ELSE currency END AS currency, fields.location, device,
  CASE WHEN format_id = 8 THEN coalesce(timestamp IS NOT NULL OR user_id IS NOT NULL OR transaction_type IS NOT NULL OR amount <> 0
    OR fields.location IS NOT NULL OR device IS NOT NULL, false) ELSE format_id IS NOT NULL END AS is_parsed,
  CASE WHEN format_id IS NULL THEN 'Empty or malformed log' WHEN format_id = 8 AND amount > 1000000 THEN 'Unusually large amount' END AS parse_errors
  FROM cls LEFT JOIN fields USING (tx_id)"""

for _table, _key, _text in (("documents", "doc_id", "text"), ("conversations", "conv_id * 1000 + turn", "text"), ("pages", "page_id", "html")):
    def _as_logs(spark, sf, _table=_table, _key=_key, _text=_text):
        d = spark.read.parquet(f"{sf}/{_table}.parquet").select(F.expr(_key).alias("tx_id"), F.col(_text).alias("raw_log"))
        return parse.parse_lines(d).select(
            "tx_id", "format_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "user_id", "transaction_type", "amount",
            "currency", "location", "device", "is_parsed", "parse_errors")
    query(f"{_table}_as_logs", f"WITH raw AS (SELECT {_key} AS tx_id, {_text} AS raw_log FROM {_table}) {_WHOLE}")(_as_logs)
