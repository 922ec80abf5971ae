"""Registered queries against their SQL, on the smallest tables. One or two per group."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
NAMES = ["parse_logs", "quality_report", "documents_as_logs", "user_profile_orders", "sequence_features_orders",
         "contextual_features", "rule_explanations", "model_statistics", "users_by_band_all_rows", "top_users_by_mean",
         "logs_to_risk", "boxplot_by_currency", "daily_counts_filled", "behaviour_vectors", "stream_sliding_counts", "feature_store",
         "stream_scores", "fraud_report_lines", "statistics_fields", "component_variances"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    key = lambda row: tuple(repr(v) for v in row)
    got = sorted(key(r) for r in df.select(*cols).collect())
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == sorted(key([r[i] for i in order]) for r in cur.fetchall())


def test_bands_of_a_score_do_not_repeat_its_making(spark):
    from catalog.rules import scored
    from tidewatch.functions.bands import risk_band_report
    s = scored(spark, "/root/testdata/sf0.001")
    upper = s.filter(risk_band_report(F.col("ensemble_score")).isin("HIGH", "MEDIUM"))
    lines = upper._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert [x for x in lines if "Filter" in x and "HIGH" in x] and not [x for x in lines if "HIGH" in x and "rule_score" in x]
    assert upper.count() == sum(0.3 < r[0] <= 0.8 and (r[0] > 0.5) for r in s.select("ensemble_score").collect())
