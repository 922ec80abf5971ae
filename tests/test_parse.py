from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import parse, quality
from tidewatch.sources.logs import read_uploaded_logs, validate_schema

LINES = {
    1: "2024-03-01 09:15:00 | user: user7 | txn: Purchase of €20.5 from Leeds | device: None",
    2: "2024-03-01 09:15:00::user7::refund::12.00::None::Pixel 6",
    3: "usr:user7|cashout|$100|Cardiff|01/03/2024 09:15:00|None",
    4: "2024-03-01 09:15:00 >> [user7] did top-up - amt=£5.25 - None // dev:iPhone 13",
    5: "01/03/2024 09:15:00 ::: user7 *** TOP-UP ::: amt:7.5$ @ London <Huawei P30>",
    6: "2024-03-01 09:15:00 - user=user7 - action=debit $44.1 - ATM: Leeds - device=None",
    7: "user7 2024-03-01 09:15:00 withdrawal 33.3 Leeds Huawei P30",
    8: "Refund for USER7 at london, 2024-03-01 09:15:00, using pixel 6",
}


def rows(spark, lines, **kw):
    df = spark.createDataFrame([(i, s) for i, s in lines], "tx_id long, raw_log string")
    return {r["tx_id"]: r for r in parse.parse_logs(df, **kw).collect()}


def test_every_layout(spark):
    out = rows(spark, LINES.items())
    when = datetime(2024, 3, 1, 9, 15)
    get = lambda i: tuple(out[i][c] for c in (
        "format_id", "user_id", "transaction_type", "amount_raw", "amount", "currency", "location", "device"))
    assert all(out[i]["timestamp"] == when for i in LINES)
    assert get(1) == (1, "user7", "purchase", 20.5, 17.84, "€", "Leeds", "None")
    assert get(2) == (2, "user7", "refund", 12.0, 12.0, None, None, "Pixel 6")
    assert get(3) == (3, "user7", "cashout", 100.0, 75.0, "$", "Cardiff", None)
    # The arrow layout takes the location from the first dash on; the clean-up repairs it.
    assert get(4) == (4, "user7", "top", 5.25, 5.25, "£", "None", "iPhone 13")
    # A currency after the number is not seen, so the location decides.
    assert get(5) == (5, "user7", "top", 7.5, 7.5, "£", "London", "Huawei P30")
    assert get(6) == (6, "user7", "debit", 44.1, 33.08, "$", "Leeds", None)
    assert get(7) == (7, "user7", "withdrawal", 33.3, 33.3, "£", "Leeds", "Huawei")
    # Free text: the first digits of the line are taken for the amount.
    assert get(8) == (8, "userUSER7", "refund", 7.0, 7.0, "GBP", "london", "pixel 6")


def test_single_entry_location_keeps_its_prefix(spark):
    df = spark.createDataFrame([(1, LINES[4])], "tx_id long, raw_log string")
    assert parse.parse_lines(df).first()["location"] == "amt=£5.25 - None"


def test_corrected_mode(spark):
    out = rows(spark, LINES.items(), compat=False)
    assert out[1]["device"] is None
    assert (out[4]["transaction_type"], out[4]["location"]) == ("top-up", None)
    assert (out[5]["transaction_type"], out[5]["currency"], out[5]["amount"]) == ("top-up", "$", 5.62)
    assert out[7]["device"] == "Huawei P30"
    assert out[8]["amount"] is None


@pytest.mark.parametrize("text, expected", [
    ("2024-3-1 9:5:7", datetime(2024, 3, 1, 9, 5, 7)),
    ("31/12/2024 10:00:00", datetime(2024, 12, 31, 10)),
    ("12/31/2024 10:00:00", datetime(2024, 12, 31, 10)),
    ("05/06/2024 10:00:00", datetime(2024, 6, 5, 10)),
    ("2024/06/05 10:00:00", datetime(2024, 6, 5, 10)),
    ("2024-06-05 10:00:00.25", datetime(2024, 6, 5, 10, 0, 0, 250000)),
    ("05/06/2024 10:00:00.5", datetime(2024, 6, 5, 10, 0, 0, 500000)),
    ("2024-06-05  10:00:00", datetime(2024, 6, 5, 10)),
    ("2024/06/05 10:00:00.5", None), ("31/02/2024 10:00:00", None), ("2024-13-01 10:00:00", None), ("soon", None),
])
def test_timestamps(spark, text, expected):
    out = rows(spark, [(1, f"{text}::u::t::1::L::D")])
    assert out[1]["timestamp"] == expected


def test_classes_and_counters(spark):
    lines = [None, "", "  ", '""', "MALFORMED_LOG", " MALFORMED_LOG ", "nothing to see", LINES[2], "\tuser1 a b c\n"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "tx_id long, raw_log string")
    c = quality.parsing_counters(df).first()
    assert (c["total_logs"], c["parsed_successfully"], c["parsing_failed"], c["empty_logs"], c["malformed_logs"]) == (
        9, 2, 1, 4, 2)
    assert (c["success"], c["failed"]) == (2, 7)
    parsed = parse.parse_logs(df)
    assert parsed.count() == 3 and parse.valid_rows(parsed).count() == 2
    assert parsed.filter("tx_id = 8").first()["raw_log"] == "user1 a b c"


def test_free_text_errors_and_zero(spark):
    out = rows(spark, [(1, "paid 2000000 today"), (2, "0"), (3, "no digits")])
    assert out[1]["parse_errors"] == "Unusually large amount" and out[1]["is_parsed"]
    assert not out[2]["is_parsed"] and not out[3]["is_parsed"]


def test_layout_priority(spark):
    # Three colons hold two colons: two such separators make three pieces, three make four.
    out = rows(spark, [(1, "a ::: b *** c ::: d"), (2, "a ::: b *** c ::: d ::: e"), (3, "usr:user: 1|2|3|4")])
    assert [out[i]["format_id"] for i in (1, 2, 3)] == [5, 2, 1]


def test_quality_grades(spark):
    def grade(total, ok, fail, empty, bad):
        c = spark.createDataFrame(
            [(total, ok, fail, empty, bad, ok, fail + empty + bad)],
            "total_logs long, parsed_successfully long, parsing_failed long, empty_logs long, malformed_logs long, "
            "success long, failed long")
        return quality.quality_report(c).first(), [r["recommendation"] for r in quality.recommendations(c).collect()]

    q, advice = grade(100, 85, 0, 10, 5)
    assert (q["parsing_efficiency"], q["data_quality"]) == ("High", "Good") and len(advice) == 1
    q, advice = grade(100, 50, 25, 5, 20)
    assert (q["parsing_efficiency"], q["data_quality"]) == ("Low", "Fair") and len(advice) == 6
    q, _ = grade(0, 0, 0, 0, 0)
    assert q["success_rate_percent"] == 0.0


def test_upload_checks(spark, tmp_path):
    with pytest.raises(ValueError):
        validate_schema(spark.createDataFrame([("x",)], "other string"))
    (tmp_path / "bad.csv").write_text("other\nx\n")
    (tmp_path / "empty.csv").write_text('raw_log\n""\nMALFORMED_LOG\n')
    (tmp_path / "good.csv").write_text(f'id,raw_log\n1,"{LINES[2]}"\n')
    for name in ("bad", "empty"):
        with pytest.raises(ValueError):
            read_uploaded_logs(spark, str(tmp_path / f"{name}.csv"))
    assert parse.parse_logs(read_uploaded_logs(spark, str(tmp_path / "good.csv"))).count() == 1


def test_region_currency(spark):
    df = spark.createDataFrame([("Greater London",), ("New York",), ("Rome",), ("Atlantis",), (None,)], "l string")
    out = [r[0] for r in df.select(parse.infer_region_currency(F.col("l"))).collect()]
    assert out == ["GBP", "USD", "EUR", "GBP", "GBP"]
