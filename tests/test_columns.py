import math
from decimal import Decimal

import pytest
from helpers import by, tx_frame
from pyspark.sql import functions as F

from txguard.functions import geo, hashing, labels
from txguard.operators import features, privacy, rules


@pytest.fixture(scope="module")
def points(spark):
    rows = [
        ("same", 10.0, 20.0, 10.0, 20.0),
        ("antipodes", 0.0, 0.0, 0.0, 180.0),
        ("poles", 90.0, 0.0, -90.0, 0.0),
        ("near_antipodes", 37.1, -12.3, -37.1, 167.7),
        ("null_a", None, 0.0, 1.0, 1.0),
        ("null_b", 0.0, 0.0, 1.0, None),
        ("one_degree", 0.0, 0.0, 0.0, 1.0),
    ]
    return spark.createDataFrame(rows, "id string, a double, b double, c double, d double")


def test_distance_edges(points):
    km = by(points.select("id", geo.haversine_km("a", "b", "c", "d").alias("km")), "id", "km")
    half = math.pi * 6371.0
    assert km["same"] == 0.0
    assert km["antipodes"] == pytest.approx(half) and km["poles"] == pytest.approx(half)
    assert km["near_antipodes"] == pytest.approx(half, rel=1e-6)
    assert km["null_a"] is None and km["null_b"] is None
    assert km["one_degree"] == pytest.approx(half / 180)


def test_distance_is_symmetric(points):
    there = geo.haversine_km("a", "b", "c", "d")
    back = geo.haversine_km("c", "d", "a", "b")
    assert points.where(F.abs(there - back) > 1e-6).isEmpty()


def test_calendar(spark):
    seconds = {
        "sat": 1704499200,  # 2024-01-06 00:00
        "sun_08": 1704585600 + 8 * 3600,
        "mon_09": 1704672000 + 9 * 3600,
        "mon_17": 1704672000 + 17 * 3600 + 3599,
        "mon_18": 1704672000 + 18 * 3600,
        "w53": 1609459200,  # 2021-01-01
        "w52": 1640995200,  # 2022-01-01
        "w1": 1704067200,  # 2024-01-01
        "bad": "soon",
    }
    tx = tx_frame(spark, [{"trans_num": k, "unix_time": v} for k, v in seconds.items()])
    got = by(
        features.with_calendar(features.with_event_time(tx)), "trans_num",
        "is_weekend", "is_business_hours", "day_of_week", "week_of_year",
    )
    assert got["sat"] == (True, False, 7, 1)
    assert got["sun_08"] == (True, False, 1, 1)
    assert got["mon_09"][:3] == (False, True, 2)
    assert got["mon_17"][1] is True and got["mon_18"][1] is False
    assert [got[w][3] for w in ("w53", "w52", "w1")] == [53, 52, 1]
    assert got["bad"] == (False, False, None, None)


def test_amounts(spark):
    values = ["-2", "-1", "0", "9.99", "10", "1000", "1000.01", None]
    tx = tx_frame(spark, [{"trans_num": str(v), "amt": v} for v in values])
    got = by(
        features.with_amounts(tx), "trans_num", "amount_log", "amount_squared", "is_high_value",
        "is_low_value",
    )
    assert got["-2"][0] is None and got["-1"][0] is None and got["0"][0] == 0.0
    assert got["9.99"][3] is True and got["10"][3] is False
    assert got["1000"][2] is False and got["1000.01"][2] is True
    assert got["1000.01"][1] == Decimal("1000020.0001")
    assert got["None"] == (None, None, False, False)


def test_risk_levels(spark):
    scores = [0.8, 0.6, 0.4, 0.39, None]
    df = spark.createDataFrame([(s,) for s in scores], "ml_fraud_score double")
    got = by(rules.with_alerts(df), "ml_fraud_score", "risk_level", "alert_generated")
    assert got == {
        0.8: ("HIGH_RISK", True), 0.6: ("MEDIUM_RISK", True), 0.4: ("LOW_RISK", False),
        0.39: ("NO_RISK", False), None: ("NO_RISK", False),
    }
    off = rules.with_alerts(df, enabled=False).first()
    assert (off.risk_level, off.alert_generated) == ("UNKNOWN", False)


def test_tiers_are_strict(spark):
    rows = [
        (1500.0, "1000"), (1500.1, "1000.01"), (1500.1, "1000"), (1000.0, "900"),
        (1000.1, "500.01"), (1000.1, "500"), (None, "2000"),
    ]
    df = spark.createDataFrame(rows, "distance double, amt string").withColumn(
        "amt", F.col("amt").cast("decimal(9,2)")
    )
    got = [r.t for r in df.select(labels.tier(F.col("distance"), F.col("amt")).alias("t")).collect()]
    low, mid, high = "LOW_RISK", "MEDIUM_RISK", "HIGH_RISK"
    assert got == [mid, high, mid, low, mid, low, low]


def test_bucket_is_stable_and_even(spark):
    df = spark.range(20000).withColumn("t", F.col("id").cast("string"))
    counts = by(df.groupBy(hashing.bucket_of("t", 10).alias("b")).count(), "b", "count")
    assert set(counts) == set(range(10)) and min(counts.values()) > 1800
    null = spark.createDataFrame([(None,)], "t string").select(hashing.bucket_of("t").alias("b"))
    assert null.first().b is None


def test_masking(spark):
    tx = tx_frame(spark, [{"trans_num": 1, "cc_num": "4111222233334444", "ssn": "123-45-6789",
                           "first": "Ann", "last": "Li", "acct_num": "12"}, {"trans_num": 2}])
    rows = by(privacy.masked(tx, "s"), "trans_num", "cc_num", "ssn", "first", "acct_num", "card_token")
    assert rows["1"][0] == "************4444" and rows["1"][2] == "Xxx" and rows["1"][3] == "12"
    assert len(rows["1"][1]) == 64 and rows["1"][1] != rows["1"][4]
    assert rows["2"] == (None,) * 5
    other = by(privacy.masked(tx, "t"), "trans_num", "ssn")
    assert other["1"] != rows["1"][1]
