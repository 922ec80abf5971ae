"""Stores, detector persistence, and the shape of plans."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog.data import transactions
from tidewatch.operators.parse import parse_logs
from tidewatch.operators.skew import checkpointed
from tidewatch.plans import detect
from tidewatch.plans.features import extract_features
from tidewatch.sources import stores

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def features(spark):
    return checkpointed(extract_features(transactions(spark, SF)))


def test_detection_and_persistence(spark, features, tmp_path):
    model = detect.fit_detectors(features, methods=("isolation_forest", "lof", "dbscan"))
    scored = model.score(features)
    assert scored.count() == features.count()
    bad = scored.filter((F.col("ensemble_score") < 0) | (F.col("ensemble_score") > 1) | F.col("ensemble_score").isNull())
    assert bad.count() == 0
    w = model.options.ensemble
    parts = {"rule_score": w.rule_weight, "isolation_forest_score": w.isolation_weight,
             "lof_score": w.autoencoder_weight, "dbscan_score": w.clustering_weight}
    for row in scored.select("ensemble_score", *parts).collect():
        assert row["ensemble_score"] == pytest.approx(min(1, max(0, sum(row[c] * v for c, v in parts.items()))))
    path = str(tmp_path / "model")
    model.save(path)
    again = detect.load_detectors(spark, path).score(features)
    pick = lambda d: {r["tx_id"]: (r["rule_score"], round(r["isolation_forest_score"], 9), round(r["lof_score"], 6)) for r in d.collect()}
    assert pick(scored) == pick(again)


def test_reports_are_written(spark, features, tmp_path):
    scored = detect.fit_detectors(features, methods=("isolation_forest",)).score(features)
    stores.write_detailed_report(scored, str(tmp_path / "detail"))
    stores.write_text_report(scored, str(tmp_path / "text"))
    detail = spark.read.option("header", True).csv(str(tmp_path / "detail"))
    assert detail.count() == features.count() and detail.columns[0] == "user_id"
    text = [r[0] for r in spark.read.text(str(tmp_path / "text")).collect()]
    assert text[0] == f"Total transactions: {features.count()}"


def test_statistics_document(spark):
    from tidewatch.operators.quality import parsing_counters
    raw = spark.createDataFrame([("a",), ("MALFORMED_LOG",), ("",)], "raw_log string")
    errors = spark.createDataFrame([("late", 2), ("odd", 5), ("also", 2)], "error string, occurrences long")
    formats = spark.createDataFrame(
        [(2, "b", 4, 2, 50.0), (1, "a", 1, 1, 100.0)], "format_id int, format string, lines long, parsed long, success_rate_percent double")
    counters = parsing_counters(raw)
    doc = json.loads(stores.statistics_document(counters, errors, formats).first()["value"])
    assert doc["common_errors"] == [
        {"error": "odd", "occurrences": 5}, {"error": "also", "occurrences": 2}, {"error": "late", "occurrences": 2}]
    assert [f["format"] for f in doc["format_analysis"]] == ["a", "b"] and doc["format_analysis"][1]["success_rate_percent"] == 50.0
    assert doc["raw_parsing_data"]["total_logs"] == 3
    none = json.loads(stores.statistics_document(counters, errors.limit(0), formats.limit(0)).first()["value"])
    assert none["common_errors"] == [] and none["format_analysis"] == []
    assert "common_errors" not in json.loads(stores.statistics_document(counters).first()["value"])


def test_scan_reads_only_needed_columns(spark):
    from tidewatch.operators.users import user_profile
    plan = user_profile(transactions(spark, SF)).select("user_id", "user_tx_count")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "event_type" not in text.split("ReadSchema")[-1] and "ts:" not in text.split("ReadSchema")[-1]


def test_parsing_stays_out_of_python(spark):
    df = spark.createDataFrame([(1, "x")], "tx_id long, raw_log string")
    text = parse_logs(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text


def test_every_query_has_a_sound_entry(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("multi_line", [False, True])
def test_quoted_csv(spark, tmp_path, multi_line):
    from tidewatch.sources.logs import read_logs, read_uploaded_logs
    lines = ['a, "b" and ""c""', "back\\slash", '""', "2025-07-05 19:18:10::user1069::debit::2995.12::London::Pixel \"6\""]
    lines += ["two\nlines, quoted"] if multi_line else []
    path = tmp_path / "logs.csv"
    path.write_text("raw_log\n" + "".join('"' + x.replace('"', '""') + '"\n' for x in lines))
    for read in (read_logs, read_uploaded_logs):
        assert [r["raw_log"] for r in read(spark, str(path), multi_line=multi_line).orderBy("tx_id").collect()] == lines


def test_scored_table_stores_only_what_reports_read(spark):
    """No wide feature row is moved by id or written: the table of the reports is narrow, and its scores need no shuffle."""
    from catalog import rules
    out = rules.scored(spark, "/root/testdata/sf0.001")
    assert len(out.columns) <= 25
    assert {*rules._READ, *rules._RULE_COLS, "rule_score", "ensemble_score", "hdbscan_score"} <= set(out.columns)
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
