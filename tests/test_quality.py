import pytest
from helpers import by, tx_frame
from pyspark.sql import Observation
from pyspark.sql import functions as F

from txguard import schemas
from txguard.operators import metrics, monitor, quality

GOOD = {"ssn": "s", "cc_num": "c", "amt": "5", "lat": 1, "long": 1}


@pytest.fixture(scope="module")
def faulty(spark):
    rows = [
        {**GOOD, "trans_num": "1"},
        {**GOOD, "trans_num": "2", "ssn": None, "cc_num": None},
        {**GOOD, "trans_num": "3", "amt": None},
        {**GOOD, "trans_num": "4", "amt": "0"},
        {**GOOD, "trans_num": "5", "amt": "-1"},
        {**GOOD, "trans_num": "6", "lat": None},
        *[{**GOOD, "trans_num": "7"}] * 3,
        *[{**GOOD, "trans_num": None}] * 2,
    ]
    return tx_frame(spark, rows)


def test_report(faulty):
    r = quality.quality_report(faulty).first()
    assert (r.total_records, r.null_ssn_count, r.null_cc_num_count, r.null_amount_count) == (11, 1, 1, 1)
    assert (r.invalid_amount_count, r.invalid_coordinates_count) == (2, 1)
    assert (r.duplicate_transactions, r.surplus_copies, r.failed_rows) == (2, 3, 5)
    assert r.data_quality_score == pytest.approx((11 - 1 - 1 - 1 - 2 - 2) / 11 * 100)
    assert r.valid_row_pct == pytest.approx(6 / 11 * 100)


def test_report_of_nothing(faulty):
    r = quality.quality_report(faulty.where("false")).first()
    assert r.total_records == 0 and r.data_quality_score == 0.0 and r.valid_row_pct == 0.0
    assert r.surplus_copies == 0


def test_duplicates(faulty):
    assert by(quality.duplicates(faulty), "trans_num", "copies") == {"7": 3, None: 2}


def test_counts_in_flight(faulty, folder):
    seen = Observation("quality")
    quality.observe_quality(faulty, seen).write.parquet(folder("out"))
    assert seen.get["total_records"] == 11 and seen.get["failed_rows"] == 5


def test_schema(spark, faulty):
    assert quality.schema_matches(faulty, schemas.TRANSACTION)
    other = faulty.withColumn("amt", F.col("amt").cast("string")).withColumn("extra", F.lit(1)).drop("zip")
    other = other.withColumn("amt", F.when(F.col("trans_num") == "4", "x").otherwise(F.col("amt")))
    assert not quality.schema_matches(other, schemas.TRANSACTION)
    report = by(
        quality.schema_report(other, schemas.TRANSACTION), "field", "expected", "actual", "misfits", "matches"
    )
    assert report["amt"] == ("decimal(9,2)", "string", 1, False)
    assert report["zip"] == ("decimal(5,0)", None, 0, False)
    assert report["extra"] == (None, "int", 0, False)
    assert report["ssn"] == ("string", "string", 0, True)
    assert report["lat"][3] is False  # moved one place forward


def test_metrics_sum_up(spark):
    rows = [(1, 1)] * 3 + [(0, 1)] * 2 + [(1, 0)] + [(0, 0)] * 4
    df = spark.createDataFrame(rows, "y int, p int")
    m = metrics.classification_metrics(df, "y", "p").first()
    assert (m.tp, m.fp, m.fn, m.tn, m.n) == (3, 2, 1, 4, 10)
    assert (m.accuracy, m.precision, m.detection_rate) == (0.7, 0.6, 0.75)
    assert m.false_positive_rate == pytest.approx(1 / 3)
    never = metrics.classification_metrics(df.where("p = 0 and y = 0"), "y", "p").first()
    assert never.precision is None and never.detection_rate is None
    cells = metrics.confusion_matrix(df, "y", "p").agg(F.sum("rows")).first()[0]
    assert cells == 10


def test_spikes_compare_neighbours_only(spark):
    rows = [(0, 10, 0.10), (10, 20, 0.11), (20, 30, 0.13), (40, 50, 0.5), (50, 60, 0.0), (60, 70, 0.2)]
    df = spark.createDataFrame(rows, "window_start bigint, window_end bigint, fraud_rate double")
    got = by(monitor.fraud_spikes(df), "window_start", "previous_rate", "is_spike")
    assert got == {
        0: (None, False), 10: (0.10, False), 20: (0.11, True), 40: (None, False),
        50: (0.5, False), 60: (0.0, False),
    }
