import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.config import ScaleLimits
from tidewatch.operators import basic, context, profiling, scoring, skew

SMALL = ScaleLimits(broadcast_rows=2, quantile_values=10, rows_per_task=20)


@pytest.fixture(scope="module")
def values(spark):
    rng = np.random.default_rng(3)
    x = np.round(np.concatenate([rng.normal(50, 20, 400), np.full(250, 42.0)]), 1)
    g = np.where(np.arange(len(x)) % 3 == 0, "a", "b")
    pdf = pd.DataFrame({"tx_id": np.arange(len(x)), "amount": x, "g": g})
    return pdf, spark.createDataFrame(pdf).repartition(6)


@pytest.mark.parametrize("limits", [ScaleLimits(), SMALL], ids=["one task", "split"])
def test_quantiles(values, limits):
    pdf, df = values
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 0.95, 1.0]
    got = skew.quantiles(df, "amount", probs, limits).first()["q"]
    assert np.allclose(got, pdf["amount"].quantile(probs))


@pytest.mark.parametrize("limits", [ScaleLimits(), SMALL], ids=["one task", "split"])
def test_quantiles_by_group(values, limits):
    pdf, df = values
    got = {r["g"]: r["q"] for r in skew.quantiles(df, "amount", [0.25, 0.5], limits, keys=("g",)).collect()}
    for g, part in pdf.groupby("g"):
        assert np.allclose(got[g], part["amount"].quantile([0.25, 0.5]))


@pytest.mark.parametrize("limits", [ScaleLimits(), SMALL], ids=["one task", "split"])
def test_percentile_rank(values, limits):
    pdf, df = values
    got = context.amount_percentile(df, limits).toPandas().sort_values("tx_id")["amount_percentile"].to_numpy()
    assert np.allclose(got, pdf["amount"].rank(pct=True))


@pytest.mark.parametrize("limits", [ScaleLimits(), SMALL], ids=["one task", "split"])
def test_amount_statistics(values, limits):
    pdf, df = values
    row = basic.amount_statistics(df, limits, [0.5]).first()
    assert np.allclose([row["q"][0], row["mean"], row["std"]], [
        pdf["amount"].median(), pdf["amount"].mean(), pdf["amount"].std()])


@pytest.mark.parametrize("limits", [ScaleLimits(), SMALL], ids=["one task", "split"])
def test_running_total(values, limits):
    pdf, df = values
    steps = df.groupBy("g", "amount").agg(F.count(F.lit(1)).alias("n"))
    for inclusive in (True, False):
        got = skew.running_total(steps, "g", "amount", "n", limits, inclusive).toPandas().sort_values(["g", "amount"])
        want = got.groupby("g")["n"].cumsum() - (0 if inclusive else got["n"])
        assert (got["_sum"] == want).all()


def test_amount_categories_with_equal_edges(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 5.0), (4, 9.0), (5, -1.0), (6, None)], "tx_id int, amount double")
    out = {r["tx_id"]: r["amount_category"] for r in basic.basic_features(df).collect()}
    assert out[1] == "low" and out[4] == "very_high" and out[5] is None and out[6] is None


def test_minmax_edges(spark):
    df = spark.createDataFrame([(1, 3.0, 1.0), (2, 3.0, 5.0), (3, 3.0, None)], "tx_id int, a double, b double")
    out = scoring.minmax(df, {"a": "x", "b": "y"}).orderBy("tx_id").collect()
    assert [r["x"] for r in out] == [0.0, 0.0, 0.0] and [r["y"] for r in out] == [0.0, 1.0, 0.0]


def test_histogram_matches_numpy(values):
    pdf, df = values
    out = profiling.histogram(df, "amount", 13).orderBy("bin").collect()
    counts, edges = np.histogram(pdf["amount"], bins=13)
    assert [r["n"] for r in out] == counts.tolist()
    assert np.allclose([r["bin_start"] for r in out], edges[:-1])


def test_mode_prefers_the_smallest(spark):
    df = spark.createDataFrame([("u", "b"), ("u", "a"), ("u", None), ("v", None)], "user_id string, location string")
    out = {r["user_id"]: r["m"] for r in scoring.modal_value(df, ["user_id"], "location", "m").collect()}
    assert out == {"u": "a", "v": "Unknown"}


def test_daily_counts_fill_gaps(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 05:00' AS timestamp UNION ALL SELECT timestamp'2024-01-04 01:00'")
    assert [r["n"] for r in profiling.daily_counts(df, fill=True).orderBy("day").collect()] == [1, 0, 0, 1]
    assert profiling.daily_counts(df).count() == 2
    s = profiling.daily_summary(df).first()
    assert str(s["peak_day"]) == "2024-01-01" and s["peak_count"] == 1


def test_lookup_without_broadcast(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    table = spark.createDataFrame([("a", 9)], "k string, v int")
    for limits in (ScaleLimits(), ScaleLimits(broadcast_rows=0)):
        out = {r["id"]: r["v"] for r in skew.lookup(df, table, ["k"], 1, limits).collect()}
        assert out == {1: 9, 2: None, 3: None}


@pytest.mark.parametrize("amounts", [[1e9, 1e9 + 1, 1e9 + 2], [1e-5, 2e-5, 4e-5], [1e15, 1e15 + 8, 3.0]])
def test_spread_of_large_close_amounts(spark, amounts):
    df = spark.createDataFrame([(i, a, "u") for i, a in enumerate(amounts)], "tx_id long, amount double, user_id string")
    row = basic.amount_statistics(df).first()
    assert row["mean"] == pytest.approx(np.mean(amounts)) and row["std"] == pytest.approx(np.std(amounts, ddof=1))
    from tidewatch.functions.numbers import total
    assert df.agg(total(F.col("amount"))).first()[0] == pytest.approx(sum(amounts))


def test_report_lines_round_ties_to_even(spark):
    from tidewatch.operators.reports import fraud_report_lines
    scored = spark.createDataFrame(
        [("u", 0.25, "London", "purchase", 0.03125, 0.0, 0.03125)],
        "user_id string, amount double, location string, transaction_type string, ensemble_score double, rule_score double, lof_score double")
    lines = [r["line"] for r in fraud_report_lines(scored).collect()]
    assert "Mean ensemble score: 0.0312" in lines and "lof: mean 0.0312, above 0.7: 0" in lines
    assert any("total 0.2," in x for x in lines)


def test_means_of_users_do_not_depend_on_the_order(spark):
    rng, want = np.random.default_rng(1), 22.7 / 80  # 0.28375, halfway between two fourth digits
    v = np.repeat([0.1, 0.2, 0.3, 0.4, 0.5, 0.8], [18, 21, 20, 1, 19, 1])
    while np.rint(np.add.accumulate(v)[-1] / 80 * 1e4) / 1e4 == 0.2838:
        v = rng.permutation(v)
    rows = spark.createDataFrame([("u", 1.0, "x", "y", float(a)) for a in v],
                                 "user_id string, amount double, location string, transaction_type string, lof_score double").coalesce(1)
    assert abs(v.sum() / 80 - want) < 1e-12 and scoring.users_by_method(rows).first()["mean_score"] == 0.2838
