import os

import pytest
from compare import differences
from helpers import same_rows
from pyspark.sql import functions as F

from txguard import fixtures as fx
from txguard import schemas
from txguard.config import FraudConfig
from txguard.operators import features, monitor, rules
from txguard.operators.profiles import last_average
from txguard.oracle import ORACLE
from txguard.plans import applications, profiles, queries
from txguard.sinks import tables
from txguard.sources import payload, stream
from txguard.streaming import dedup, runner

EVENT = "event_ts timestamp, trans_num string, is_fraud int"


@pytest.fixture(scope="module")
def arrived(spark, sf, tmp_path_factory):
    """Arriving transactions in several files, by time."""
    path = str(tmp_path_factory.mktemp("arrived") / "t")
    tx = fx.arrivals(spark, sf)
    tx.repartitionByRange(5, "event_time").write.parquet(path)
    return path


@pytest.fixture(scope="module")
def profile_root(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("profiles") / "p")
    profiles.publish_profile(profiles.build_profile(fx.history(spark, sf)), root, 1)
    return root


def source(spark, path, files=2):
    schema = spark.read.parquet(path).schema
    return stream.file_stream(spark, path, schema, files_per_trigger=files)


def test_scored_stream_equals_batch(spark, arrived, profile_root, folder):
    def run():
        q = applications.start_scored_stream(
            spark, source(spark, arrived), profile_root, folder("out"), "scored_test",
            folder("cp"), available_now=True,
        )
        q.awaitTermination()
        return q

    run()
    out = spark.read.parquet(folder("out") + "/scored")
    assert out.select("epoch_id").distinct().count() == 3
    want = applications.score_batch(
        spark.read.parquet(arrived), profiles.read_profile(spark, profile_root, 1)
    )
    same_rows(out.select("trans_num", "distance", "amount_deviation", "final_fraud_status"),
              want.select("trans_num", "distance", "amount_deviation", "final_fraud_status"))
    assert spark.read.parquet(folder("out") + "/customers").count() == want.count()
    # A restart with the same checkpoint finds nothing new.
    run()
    assert spark.read.parquet(folder("out") + "/scored").count() == want.count()


def test_failed_batch_is_repeated_without_duplicates(spark, arrived, folder):
    calls = []

    def failing(batch, epoch):
        calls.append(epoch)
        if calls == [0, 1]:
            raise RuntimeError("sink down")

    def score(batch):
        return rules.final_status(
            rules.without_models(features.with_distance(features.with_calendar(batch)))
        )

    def start():
        return runner.start_scoring(
            source(spark, arrived), score,
            [lambda b, e: tables.write_scored(b, e, folder("s")), failing],
            "retry_test", folder("cp"), trigger=None,
        )

    with pytest.raises(Exception, match="sink down"):
        start().awaitTermination()
    start().awaitTermination()
    assert calls == [0, 1, 1, 2]  # epoch 1 was written by the first sink, failed, and came again
    rows = spark.read.parquet(folder("s"))
    assert rows.count() == rows.select("trans_num").distinct().count()
    assert rows.count() == spark.read.parquet(arrived).count()


def test_new_profile_takes_effect_between_batches(spark, sf, arrived, folder):
    history = fx.history(spark, sf)
    root = folder("p")
    profiles.publish_profile(profiles.build_profile(history), root, 1)
    current = profiles.CurrentProfile(spark, root, max_age=0)
    first = current()
    assert current() is first
    profiles.publish_profile(profiles.build_profile(history.where("cc_num = '1'")), root, 2)
    second = current()
    assert second is not first and second.count() == 1
    current.release()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_flagged_stream(spark, sf, arrived, folder, how):
    known = fx.history(spark, sf).where("cc_num not in ('1', '2', '3')")
    profiles.publish_profile(last_average(known), folder("a"), 1)
    messages = payload.encode(source(spark, arrived).drop("event_time"))
    decoded = payload.decode(messages).drop(schemas.CORRUPT_COLUMN)
    applications.start_flagged_stream(
        spark, decoded, folder("a"), folder("out"), f"flagged_{how}", folder("cp"), how=how,
        config=FraudConfig(broadcast_rows=3), available_now=True,
    ).awaitTermination()
    got = spark.read.parquet(folder("out") + "/flagged")
    batch = spark.read.parquet(arrived)
    want = applications.flag_batch(batch, known, how)
    same_rows(got.select("trans_num", "distance", "status"), want.select("trans_num", "distance", "status"))
    # Customers come from all rows, flagged or not.
    assert spark.read.parquet(folder("out") + "/customers").count() == batch.count()


def test_rule_joins_work_on_a_streaming_frame(spark, sf, arrived, folder):
    averages = last_average(fx.history(spark, sf))
    flagged = rules.relative_rule(source(spark, arrived), averages).select("trans_num", "status")
    assert flagged.isStreaming
    runner.start_copy(flagged, folder("o"), "direct", folder("cp"), trigger=None).awaitTermination()
    want = rules.relative_rule(spark.read.parquet(arrived), averages).select("trans_num", "status")
    same_rows(spark.read.parquet(folder("o")), want)


def in_files(spark, path, files):
    """One file per list of (seconds, id, fraud), in order."""
    for i, rows in enumerate(files):
        frame = spark.createDataFrame(rows, "sec bigint, trans_num string, is_fraud int")
        frame.select(F.timestamp_seconds("sec").alias("event_ts"), "trans_num", "is_fraud").coalesce(
            1
        ).write.mode("append").parquet(path)
    return stream.file_stream(spark, path, EVENT, files_per_trigger=1)


def test_repeats_are_dropped_across_batches(spark, folder):
    files = [
        [(9000, "a", 0), (9000, "a", 0), (9010, "b", 0)],
        [(9020, "a", 0), (9030, "c", 0)],
        [(9040, "b", 0), (9050, "d", 0), (9050, "d", 0)],
    ]
    once = dedup.drop_repeats(in_files(spark, folder("in"), files))
    runner.start_copy(once, folder("o"), "dedup_test", folder("cp"), trigger=None).awaitTermination()
    got = sorted(r.trans_num for r in spark.read.parquet(folder("o")).collect())
    assert got == ["a", "b", "c", "d"]


def test_rows_without_id_or_time_stay(spark, folder):
    files = [
        [(7200, None, 0), (7200, None, 0), (None, "x", 0), (7205, "a", 0)],
        [(7201, None, 0), (7206, "a", 0), (None, None, 0)],
    ]
    once = dedup.drop_repeats(in_files(spark, folder("in"), files))
    runner.start_copy(once, folder("o"), "null_ids", folder("cp"), trigger=None).awaitTermination()
    got = sorted(str(r.trans_num) for r in spark.read.parquet(folder("o")).collect())
    assert got == ["None", "None", "None", "None", "a", "x"]


def test_windows_close_after_the_lateness_and_drop_later_rows(spark, folder):
    day = 86400
    files = [
        [(10, "a", 1), (day - 10, "b", 0)],
        [(day + 10, "c", 0), (20, "late but in time", 1)],
        [(2 * day + 7200, "d", 0)],
        [(3 * day, "e", 1)],
        # Spark judges lateness by the watermark the batch before began with.
        [(30, "too late", 1), (5 * day, "f", 0)],
    ]
    rates = monitor.fraud_rate_windows(
        in_files(spark, folder("in"), files), F.col("is_fraud") == 1, late="1 hour"
    )
    runner.start_copy(rates, folder("o"), "rates_test", folder("cp"), trigger=None).awaitTermination()
    got = {r.window_start: (r.n, r.frauds) for r in spark.read.parquet(folder("o")).collect()}
    assert got == {0: (3, 2), day: (1, 0), 2 * day: (1, 0), 3 * day: (1, 1)}


def test_error_rate_over_a_stream_of_messages(spark, folder):
    path = folder("in")
    rows = [(i, "{" if i < 3 else '{"amt":1}') for i in range(10)] + [(2 * 86400, "{}")]
    spark.createDataFrame(rows, "sec bigint, value string").select(
        F.timestamp_seconds("sec").alias("event_ts"), "value"
    ).coalesce(1).write.parquet(path)
    messages = stream.file_stream(spark, path, "event_ts timestamp, value string")
    decoded = payload.decode(messages, keep=("event_ts",))
    rates = monitor.error_rate_windows(decoded, payload.is_corrupt(), late="1 hour")
    runner.start_copy(rates, folder("o"), "errors_test", folder("cp"), trigger=None).awaitTermination()
    r = spark.read.parquet(folder("o")).first()
    assert (r.n, r.errors, r.error_rate, r.over_limit) == (10, 3, 0.3, True)


@pytest.mark.parametrize(
    "name, folder", [("publish_json_array", "arrays"), ("stream_quality", "stream_quality-in"), ("stream_dedup_late", "late-in")]
)
def test_input_files_grow_in_number_with_the_rows(spark, duck, sf, monkeypatch, name, folder):
    """No file holds a fixed share of the table; the results and the number of micro-batches stay."""
    made = {}

    def new_dir(session, purpose, own=queries.new_dir):
        made[purpose] = own(session, purpose)
        return made[purpose]

    monkeypatch.setattr(queries, "new_dir", new_dir)
    monkeypatch.setattr(queries, "FILE_ROWS", 25)
    monkeypatch.setattr(queries, "ARRAY_ROWS", 25)
    assert differences(queries.QUERIES[name](spark, sf), duck, ORACLE[name]) == ""
    rows = fx.transactions(spark, sf).count()
    files = [os.path.join(d, f) for d, _, names in os.walk(made[folder].removeprefix("file://")) for f in names if f.startswith("part-")]
    assert len(files) >= 0.9 * rows / 25 > 16
