from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.config import DEFAULTS, EnsembleWeights, ScaleLimits
from tidewatch.functions import bands
from tidewatch.operators import basic, context, ensemble, matrix, users
from tidewatch.operators.rules import RuleSet
from tidewatch.plans.features import extract_features, feature_catalogue

COLUMNS = "tx_id long, user_id string, timestamp timestamp, amount double, transaction_type string, location string, device string, currency string"


@pytest.fixture(scope="module")
def five(spark):
    at = lambda d, h: datetime(2024, 1, d, h)
    rows = [
        (1, "user1", at(1, 10), 100.0, "purchase", "London", "iPhone 13", "GBP"),
        (2, "user1", at(1, 15), 200.0, "withdrawal", "London", "iPhone 13", "GBP"),
        (3, "user2", at(1, 12), 150.0, "transfer", "Glasgow", "Samsung Galaxy S10", "GBP"),
        (4, "user2", at(2, 9), 300.0, "deposit", "Birmingham", "Pixel 6", "GBP"),
        (5, "user3", at(1, 14), 75.0, "purchase", "Cardiff", "Nokia 3310", "GBP"),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def test_profile_of_small_users(five):
    out = {r["user_id"]: r for r in users.user_profile(five).collect()}
    assert (out["user1"]["user_tx_count"], out["user1"]["user_avg_amount"], out["user1"]["user_std_amount"]) == (2, 150.0, 70.7107)
    assert out["user1"]["user_amount_cv"] == 0.4714
    assert out["user3"]["user_std_amount"] == 0.0 and out["user3"]["user_amount_cv"] == 0.0
    assert out["user2"]["user_location_diversity"] == 1.0
    assert out["user2"]["user_activity_days"] == 0.875 and out["user2"]["user_tx_per_day"] == 1.0667


def test_feature_table(five):
    out = extract_features(five)
    made = set(out.columns) - set(five.columns)
    assert len(made) == 60
    rows = {r["tx_id"]: r for r in out.collect()}
    assert len(rows) == 5
    assert rows[2]["tx_velocity_24h"] == 1 and rows[2]["location_changed"] == 0 and rows[4]["device_changed"] == 1
    assert rows[1]["location_frequency"] == 2 and rows[1]["location_rarity"] == pytest.approx(1 / 3)
    assert rows[5]["amount_category"] == "low" and rows[5]["amount_percentile"] == 0.2
    assert rows[1]["hour_type"] == "10_purchase" and rows[1]["location_device"] == "London_iPhone 13"
    cats = {(r["category"], r["feature"]) for r in feature_catalogue(out).collect()}
    assert ("contextual", "location_rarity") in cats and ("location", "location_rarity") in cats
    assert not any(f == "amount" for _, f in cats)


def test_lookup_limits_do_not_change_features(five):
    narrow = DEFAULTS.with_(limits=ScaleLimits(broadcast_rows=0, quantile_values=1, rows_per_task=1))
    cols = ["tx_id", *context.CONTEXT_COLUMNS]
    key = lambda df: sorted(tuple(r) for r in df.select(*cols).collect())
    assert key(extract_features(five, narrow)) == key(extract_features(five))


def test_missing_columns_degrade(spark):
    df = spark.createDataFrame([(1, "u", datetime(2024, 1, 6, 3))], "tx_id long, user_id string, timestamp timestamp")
    with pytest.warns(UserWarning):
        row = extract_features(df).first()
    assert row["user_tx_count"] == 1 and row["user_avg_amount"] == 0.0 and row["is_weekend"]
    assert "amount_log" not in row.asDict()


def test_null_semantics(spark):
    df = spark.createDataFrame([
        (1, None, None, None, None, None, None, None), (2, "u", None, 5.0, None, None, None, None)], COLUMNS)
    rows = {r["tx_id"]: r for r in extract_features(df).collect()}
    assert rows[1]["user_tx_count"] is None and rows[1]["tx_velocity_24h"] is None and rows[1]["location_changed"] == 1
    assert rows[2]["location_frequency"] is None and rows[2]["location_device"] == "None_None"
    assert rows[2]["device_brand"] is None and not rows[2]["is_weekend"] and rows[2]["hour_category"] is None


def test_rules_on_edges(spark):
    df = spark.createDataFrame([
        (1, 100.0, 6, True, 6, 0.06, 1, 0.6, 2.6, 0.2, 3), (2, 250.0, 7, False, 5, 0.05, 0, 0.5, -2.5, 0.1, 2),
        (3, None, None, None, None, None, None, None, None, None, None)],
        "tx_id long, amount double, hour int, is_weekend boolean, tx_velocity_24h long, location_rarity double, "
        "device_changed int, user_device_diversity double, amount_zscore_user double, type_rarity double, user_unique_locations long")
    rows = {r["tx_id"]: r for r in RuleSet().score(df).collect()}
    fired = lambda i: {r.name: rows[i][f"rule_{r.name}"] for r in RuleSet().rules if rows[i][f"rule_{r.name}"]}
    assert fired(1) == {"unusual_hours": 1.0, "high_velocity": 1.0, "unusual_location": 1.0, "device_change": 0.8,
                        "amount_deviation": 1.0, "rare_transaction_type": 1.0, "multiple_locations": 1.0, "round_amounts": 1.0}
    assert fired(2) == {"large_amount": 1.0} and fired(3) == {}


def test_rule_set_changes(five):
    rules = RuleSet()
    assert rules.total_weight == pytest.approx(1.75)
    assert rules.disabled("large_amount").total_weight == pytest.approx(1.45)
    for bad in (lambda: rules.with_weight("none", 0.1), lambda: rules.with_weight("large_amount", 1.1)):
        with pytest.raises(ValueError):
            bad()
    custom = rules.with_rule("fixed", lambda p: F.lit(p["v"]), 0.25, "always", {"v": 1.0})
    scored = custom.score(basic.time_features(five))
    assert {r["rule_fixed"] for r in scored.collect()} == {1.0}
    top = custom.explain(scored).filter("tx_id = 3").first()
    assert [x["rule_name"] for x in top["triggered_rules"]] == ["fixed"]
    assert top["total_score"] == pytest.approx(0.25 / 2.0)


def test_pandas_udf_rule(five):
    import pandas as pd

    @F.pandas_udf("double")
    def odd(s: pd.Series) -> pd.Series:
        return (s % 2).astype(float)

    rules = RuleSet(rules=()).with_rule("odd", lambda p: odd("tx_id"), 1.0, "odd ids")
    assert {r["tx_id"]: r["rule_score"] for r in rules.score(five).collect()} == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1}


def test_ensemble_weights():
    w = EnsembleWeights.normalised({"rule_weight": 1, "isolation_weight": 1, "autoencoder_weight": 1, "clustering_weight": 1})
    assert w.rule_weight == 0.25
    with pytest.raises(ValueError):
        EnsembleWeights.normalised({"rule_weight": 1})
    with pytest.raises(ValueError):
        EnsembleWeights.normalised(dict.fromkeys(EnsembleWeights.NAMES, 0))


def test_bands(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.3, 0.31, 0.7, 0.71, 0.9, 0.95, None)], "s double")
    s = F.col("s")
    out = df.select(
        bands.risk_band_report(s), bands.risk_band_export(s), bands.risk_band_top(s), bands.risk_band_user(s)).collect()
    assert [tuple(r) for r in out] == [
        ("NORMAL", None, "Low", "NORMAL"), ("NORMAL", "NORMAL", "Low", "LOW"), ("LOW", "LOW", "Medium", "LOW"),
        ("MEDIUM", "MEDIUM", "High", "HIGH"), ("HIGH", "HIGH", "High", "HIGH"),
        ("CRITICAL", "HIGH", "Critical", "CRITICAL"), ("CRITICAL", "CRITICAL", "Critical", "CRITICAL"),
        (None, None, None, None)]


def test_missing_components_count_zero(spark):
    df = spark.createDataFrame([(1.0,)], "rule_score double")
    assert ensemble.combine_scores(df).first()["ensemble_score"] == pytest.approx(0.3)


def test_label_encoding_of_unseen_values(spark):
    fit = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    labels = matrix.label_table(fit, ["c"])
    new = spark.createDataFrame([("a",), ("b",), ("new",), (None,)], "c string")
    assert [r["c_encoded"] for r in matrix.encode(new, labels, ["c"]).collect()] == [0.0, 1.0, 2.0, 2.0]


def test_amounts_beyond_the_decimal_range(spark):
    rows = [(i, "u", datetime(2024, 1, 1, i), a, "refund", "L", "x", "£") for i, a in enumerate([1e20, 3e20, 2e20])]
    df = spark.createDataFrame(rows, COLUMNS)
    assert users.user_profile(df).first()["user_total_amount"] == pytest.approx(6e20)
    out = {r["tx_id"]: r for r in RuleSet().score(extract_features(df)).collect()}
    assert out[0]["amount_deviation_type"] == pytest.approx(1e20) and out[1]["user_avg_amount"] == pytest.approx(2e20)
