"""Tables of epochs: replays, crashes at every step, merging; and what streams keep in them."""

import os

import numpy as np
import pandas as pd
import pytest
from helpers import by, executed, same_rows, tx_frame
from pyspark.errors.exceptions.captured import StreamingQueryException
from pyspark.sql import functions as F

from txguard import fixtures as fx
from txguard.operators import analytics, monitor, velocity
from txguard.sinks.epochs import EpochTable, into
from txguard.sources.stream import file_stream
from txguard.streaming import duplicates, rates, runner
from txguard.streaming import velocity as keyed


def rows_of(spark, epoch, n=4, kind="a"):
    return spark.range(n).select((F.col("id") + 100 * epoch).alias("x"), F.lit(kind).alias("kind"), (F.col("id") % 2).alias("part"))


def content(table, before=None):
    return sorted((r.x, r.kind, r.epoch_id) for r in table.read(before).collect())


def files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path) for f in names if f.startswith("part-")
    }


def test_replay_replaces_an_epoch_and_may_empty_it(spark, folder):
    table = EpochTable(spark, folder("t"))
    assert table.read() is None
    table.write(rows_of(spark, 0, 5, "old"), 0)
    table.write(rows_of(spark, 1), 1)
    table.write(rows_of(spark, 0, 2, "new"), 0)
    assert content(table) == [(0, "new", 0), (1, "new", 0), *[(100 + i, "a", 1) for i in range(4)]]
    table.write(rows_of(spark, 1).where("false"), 1)
    assert {e for _, _, e in content(table)} == {0}
    assert content(EpochTable(spark, folder("t")), before=1) == content(table)


def test_merging_touches_new_epochs_only(spark, folder):
    table = EpochTable(spark, folder("t"), ("part",), fan=100)
    for epoch in range(6):
        table.write(rows_of(spark, epoch), epoch)
        if epoch == 2:
            table.compact(before=3)
            first = files(folder("t") + "/merged")
    before = content(table)
    state = table.compact(before=5)
    after = files(folder("t") + "/merged")
    assert first and all(after[f] == t for f, t in first.items())  # nothing of the first round is written again
    assert [(g.first, g.last) for g in state.generations] == [(0, 2), (3, 4)] and state.through == 4
    assert set(state.replaced) == {"data/epoch_id=3", "data/epoch_id=4"}
    assert content(table) == before == content(EpochTable(spark, folder("t")))
    new = {f for f in after if f not in first}
    read = spark.read.parquet(*{os.path.dirname(os.path.dirname(f)) for f in new})
    assert {r.epoch_id for r in read.collect()} == {3, 4}
    assert table.compact(before=5) == state  # nothing new
    with pytest.raises(ValueError):
        table.write(rows_of(spark, 4), 4)
    table.write(rows_of(spark, 5, 1, "again"), 5)  # the open epoch can be repeated
    assert [r for r in content(table) if r[2] == 5] == [(500, "again", 5)]


def test_generations_stay_few(spark, folder):
    table = EpochTable(spark, folder("t"), ("part",), fan=2)
    for epoch in range(9):
        table.write(rows_of(spark, epoch, 2), epoch)
        table.compact(before=epoch)
    state = table.state()
    assert [g.level for g in state.generations] == [3] and len(content(table)) == 18
    name = "epochs_view"
    table.register(name)
    assert spark.sql(f"SELECT count(*) FROM {name} WHERE part = 1").first()[0] == 8
    assert "PartitionFilters: [isnotnull(part" in executed(spark.sql(f"SELECT x FROM {name} WHERE part = 1"))


@pytest.mark.parametrize("step", ["_log", "_swap", "_merged"])
def test_a_crash_leaves_what_was_there(spark, folder, monkeypatch, step):
    table = EpochTable(spark, folder("t"), ("part",))
    for epoch in range(3):
        table.write(rows_of(spark, epoch), epoch)
    before = content(table)

    def broken(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(EpochTable, step, broken)
        with pytest.raises(RuntimeError):
            table.write(rows_of(spark, 2, 9, "never"), 2) if step == "_log" else table.compact(before=2)
    assert content(EpochTable(spark, folder("t"))) == before
    again = EpochTable(spark, folder("t"), ("part",))
    again.compact(before=2)
    again.write(rows_of(spark, 2, 1, "new"), 2)
    assert content(again) == [*[r for r in before if r[2] < 2], (200, "new", 2)]


def test_a_crash_between_log_and_state_keeps_later_tries(spark, folder, monkeypatch):
    """Merging copies the open epoch's line first; a newer try made before it is repeated must win."""
    table = EpochTable(spark, folder("t"))
    table.write(rows_of(spark, 0), 0)
    table.write(rows_of(spark, 1, 3, "first"), 1)
    with monkeypatch.context() as m:
        m.setattr(EpochTable, "_swap", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.compact(before=1)
    table = EpochTable(spark, folder("t"))
    table.write(rows_of(spark, 1, 1, "second"), 1)
    table.compact(before=1)
    assert [r for r in content(table) if r[2] == 1] == [(100, "second", 1)]


def test_additive_tables_add_up(spark, folder):
    table = EpochTable(spark, folder("t"), merge=lambda df: df.groupBy("k").agg(F.sum("n").alias("n")), fan=2)
    for epoch in range(5):
        table.write(spark.range(10).groupBy((F.col("id") % 3).alias("k")).agg(F.count("*").alias("n")), epoch)
        table.write(spark.range(10).groupBy((F.col("id") % 3).alias("k")).agg(F.count("*").alias("n")), epoch)
        table.compact(before=epoch)
    assert by(table.read(), "k", "n") == {0: 20, 1: 15, 2: 15}
    assert by(table.read(before=4), "k", "n") in ({0: 16, 1: 12, 2: 12}, {0: 20, 1: 15, 2: 15})


def quarters(spark, df, path):
    for k in range(4):
        df.where(F.col("k") == k).drop("k").coalesce(1).write.mode("append").parquet(path)
    return file_stream(spark, path, df.drop("k").schema, files_per_trigger=1)


def test_a_failing_sink_repeats_the_epoch(spark, folder):
    """The table takes the epoch twice, the second time from a restarted query with another table object."""
    stream = quarters(spark, spark.range(40).select("id", (F.col("id") % 4).alias("k")), folder("in"))
    failures = []

    def fails_once(df, epoch):
        if epoch == 2 and not failures:
            failures.append(epoch)
            raise RuntimeError("sink is gone")

    def run():
        sinks = [into(EpochTable(spark, folder("t"), fan=2), compact_every=1), fails_once]
        runner.start_scoring(stream, lambda df: df, sinks, "fails", folder("cp"), None).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    found = EpochTable(spark, folder("t"))
    assert sorted(r.id for r in found.read().collect()) == list(range(40)) and found.state().through == 2


# Late rates


def event(second, trans, fraud=0):
    return second, str(trans), fraud


def events(spark, rows, more=""):
    frame = spark.createDataFrame(rows, f"event_ts long, trans_num string, is_fraud int{more}")
    return frame.withColumn("event_ts", F.timestamp_seconds("event_ts"))


def test_late_rows_correct_closed_windows(spark, folder):
    day = 86400
    batches = [
        [event(10, 1), event(20, 2, 1)], [event(day + 10, 3), event(2 * day, 4)],
        [event(30, 5, 1), event(2 * day + 5, 6), (None, "7", 0)], [],
    ]
    for rows in batches:
        frame = events(spark, rows)
        frame.coalesce(1).write.mode("append").parquet(folder("in"))
        stream = file_stream(spark, folder("in"), frame.schema)
        rates.start_late_rates(
            stream, F.col("is_fraud") == 1, folder("out"), "late", folder("cp"), trigger=None, compact_every=1
        ).awaitTermination()
    found = by(rates.rates(spark, folder("out")), "window_start", "n", "frauds", "fraud_rate")
    assert found == {0: (3, 2, 2 / 3), day: (1, 0, 0.0), 2 * day: (2, 0, 0.0)}
    fixed = rates.corrections(spark, folder("out")).collect()
    assert [(r.epoch_id, r.window_start, r.n, r.frauds) for r in fixed] == [(2, 0, 3, 2)]


def test_rates_by_more_columns(spark, folder):
    rows = [event(i * 40000, i, i % 2) + (c,) for i in range(8) for c in ("x", None)]
    frame = events(spark, rows, ", kind string")
    frame = frame.withColumn("k", F.pmod(F.col("trans_num").cast("int") * 3, F.lit(4)))
    stream = quarters(spark, frame, folder("in"))
    rates.start_late_rates(
        stream, F.col("is_fraud") == 1, folder("out"), "by", folder("cp"), by=("kind",), late_seconds=0, trigger=None
    ).awaitTermination()
    want = monitor.fraud_rate_windows(frame, F.col("is_fraud") == 1, by=("kind",))
    same_rows(rates.rates(spark, folder("out")), want)
    assert rates.corrections(spark, folder("out")).where("kind IS NULL").count() > 0


# Velocity


class Value:
    def __init__(self):
        self.held = None

    def exists(self):
        return self.held is not None

    def get(self):
        return self.held

    def update(self, value):
        self.held = value


class Handle:
    def __init__(self):
        self.value, self.timers = Value(), set()

    def getValueState(self, *_):
        return self.value

    def listTimers(self):
        return iter(sorted(self.timers))

    def deleteTimer(self, t):
        self.timers.remove(t)

    def registerTimer(self, t):
        self.timers.add(t)


def played(batches):
    """Output rows of one card's batches [(second, id, cents)], and the handle."""
    processor, handle, out = keyed.Velocity(["trans_num"]), Handle(), []
    processor.init(handle)
    for rows in batches:
        frame = pd.DataFrame(rows, columns=["second", "trans_num", "cents"]).astype({"cents": "Int64"})
        half = len(frame) // 2
        out += [r for f in processor.handleInputRows(("c",), iter([frame[:half], frame[half:]]), None) for r in f.to_dict("records")]
    return out, handle, processor


def test_ring_is_bounded_by_a_day():
    draw = np.random.default_rng(5)
    batches, at = [], 0
    for _ in range(60):
        secs = at + np.sort(draw.integers(0, 9000, 30))
        at = int(secs[-1])
        batches.append([(int(s), f"{i:03}", 100) for i, s in enumerate(secs)])
    _, handle, processor = played(batches)
    ring = np.frombuffer(handle.value.held[0], dtype=np.int64).reshape(3, -1)
    assert ring[0].min() >= at - 86400 and ring[1].sum() < 60 * 30 and handle.timers == {(at + 86401) * 1000}
    list(processor.handleExpiredTimer(("c",), None, None))
    assert handle.value.held == (b"", at, 100)  # a silent card keeps its newest transaction only


def test_rolling_totals_and_gaps_by_hand():
    out, _, _ = played([
        [(0, "a", 100), (0, "b", 50), (3600, "c", None)], [(3601, "d", 0), (90001, "e", 300)], [(90001 + 86400 * 9, "f", 150)],
        [(90001 + 86400 * 8, "late", 10)],
    ])
    got = {r["trans_num"]: r for r in out}
    assert [got[k]["tx_count_1h"] for k in "abcdef"] == [2, 2, 3, 2, 1, 1]
    assert [got[k]["tx_count_24h"] for k in "abcdef"] == [2, 2, 3, 4, 2, 1]
    assert [got[k]["amt_sum_24h"] for k in "abcdef"] == [1.5, 1.5, 1.5, 1.5, 3.0, 1.5]
    assert [got[k]["secs_since_prev"] for k in "bcdef"] == [0, 3600, 1, 86400, 86400 * 9]
    assert pd.isna(got["a"]["secs_since_prev"]) and pd.isna(got["late"]["secs_since_prev"])
    assert got["b"]["amt_ratio_prev"] == 0.5 and got["f"]["amt_ratio_prev"] == 0.5
    assert all(pd.isna(got[k]["amt_ratio_prev"]) for k in "acde")


def test_stream_velocity_equals_batch_on_ordered_input(spark, folder):
    draw = np.random.default_rng(3)
    rows = [
        {"cc_num": None if i % 37 == 0 else f"c{draw.integers(0, 9)}", "trans_num": f"{i:05}", "amt": None if i % 11 == 0 else int(draw.integers(0, 50)),
         "unix_time": None if i % 41 == 0 else int(draw.integers(0, 300_000))}
        for i in range(600)
    ]
    tx = monitor.with_event_ts(tx_frame(spark, rows)).select("cc_num", "trans_num", "unix_time", "amt", "event_ts")
    stream = quarters(spark, tx.withColumn("k", F.coalesce(F.floor(F.col("unix_time").cast("int") / 75_000), F.lit(0)).cast("int")), folder("in"))
    runner.start_copy(keyed.stream_velocity(stream), folder("out"), "v", folder("cp"), trigger=None).awaitTermination()
    columns = ["trans_num", "secs_since_prev", "amt_ratio_prev", "tx_count_1h", "amt_sum_1h", "tx_count_24h", "amt_sum_24h"]
    same_rows(spark.read.parquet(folder("out")).select(columns), velocity.with_velocity(tx).select(columns))


def test_stream_velocity_needs_no_state_store_of_its_own(spark, folder):
    """Spark's default store has one column family; a ring is emptied by its timer, the newest transaction stays."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        rows = [{"cc_num": c, "trans_num": f"{c}{at}", "amt": 5, "unix_time": at} for c, at in
                [("a", 10), ("b", 20), ("b", 400_000), ("b", 800_000), ("a", 900_000), ("a", 900_001)]]
        tx = monitor.with_event_ts(tx_frame(spark, rows)).select("cc_num", "trans_num", "unix_time", "amt", "event_ts")
        k = F.when(F.col("unix_time") < 100, 0).when(F.col("unix_time") < 500_000, 1).when(F.col("unix_time") < 850_000, 2)
        stream = quarters(spark, tx.withColumn("k", F.coalesce(k, F.lit(3))), folder("in"))
        runner.start_copy(keyed.stream_velocity(stream), folder("out"), "d", folder("cp"), trigger=None).awaitTermination()
    finally:
        spark.conf.set(name, before)
    got = by(spark.read.parquet(folder("out")), "trans_num", "secs_since_prev", "tx_count_24h")
    assert got == {"a10": (None, 1), "b20": (None, 1), "b400000": (399_980, 1), "b800000": (400_000, 1),
                   "a900000": (899_990, 1), "a900001": (1, 2)}


def test_crowded_second_is_many_tasks(spark):
    """20,000 rows of one card in one second: ranges are far smaller than the second, and the order goes on across them."""
    rows = spark.range(20_000).select(
        F.lit("hot").alias("cc_num"), F.lpad(F.col("id").cast("string"), 6, "0").alias("trans_num"),
        F.lit("100").alias("unix_time"), (F.col("id") % 50 + 1).cast("decimal(9,2)").alias("amt"),
    ).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        got = velocity.with_velocity(rows, 1000)
        text = executed(got)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)
    assert "dense-seconds" in text
    ratios = [r.amt_ratio_prev for r in got.orderBy("trans_num").collect()]
    assert ratios[0] is None
    assert ratios[1:] == [(i % 50 + 1) / ((i - 1) % 50 + 1) for i in range(1, 20_000)]
    assert {(r.tx_count_1h, r.secs_since_prev) for r in got.select("tx_count_1h", "secs_since_prev").distinct().collect()} == {(20_000, None), (20_000, 0)}


# Repeats and reports


def test_duplicates_across_epochs_and_a_repeated_epoch(spark, folder):
    sinks = duplicates.duplicate_sinks(spark, folder("d"), compact_every=2)
    for epoch, ids in enumerate([["a", "b", None], ["b", "c"], ["c", "c", "d"], [None]]):
        for _ in range(2):  # each epoch twice
            frame = spark.createDataFrame([(i,) for i in ids], "trans_num string")
            for sink in sinks:
                sink(frame, epoch)
    assert by(duplicates.repeated(spark, folder("d")), "id", "copies") == {"b": 2, "c": 3, None: 2}
    report = duplicates.surplus_report(spark, folder("d")).first()
    assert (report.n, report.surplus_copies, report.surplus_estimate) == (9, 4, 4)


def test_cube_holds_the_reports(spark, sf):
    from txguard.plans.queries import _off_scored

    scored = _off_scored(spark, sf).persist()
    cube = analytics.report_cube(scored).persist()
    for columns in analytics.CUBE:
        want = analytics.fraud_by(scored, *columns)
        rounded = {"fraud_rate": F.round("fraud_rate", 9), "fraud_amount": F.round("fraud_amount", 2)}
        same_rows(analytics.report_of(cube, *columns).withColumns(rounded), want.withColumns(rounded))
    empty = analytics.report_cube(scored.where("false"))
    same_rows(analytics.add_cubes(cube.unionByName(empty)), cube)
    assert fx.table(spark, sf, "events").count() == cube.where("report = 'category'").agg(F.sum("n")).first()[0]


# Bucketed profiles


def test_bucketed_profile_reads_own_folders(spark, folder):
    from txguard.plans import profiles as store

    cards = spark.range(500).select(F.concat(F.lit("c"), "id").alias("cc_num"), F.col("id").cast("double").alias("avg_amount"))
    store.publish_profile(cards.unionByName(spark.sql("SELECT CAST(NULL AS string) AS cc_num, 1.0D AS avg_amount")), folder("p"), 1, 10)
    current = store.CurrentProfile(spark, folder("p"), max_age=0)
    batch = spark.createDataFrame([("c7",), ("c8",), ("c8",), (None,), ("unknown",)], "cc_num string")
    part, size = current.of(batch)
    assert size is None and current.buckets == 51 and set(part.columns) == {"cc_num", "avg_amount"}
    text = executed(part)
    assert "bucket#" in text.split("PartitionFilters: [")[1].split("]")[0]
    found = {r.cc_num for r in part.collect()}
    assert {"c7", "c8"} <= found and len(found) < 60  # three folders of 51
    assert current.of(batch.where("cc_num IS NULL"))[0].isEmpty()
    store.publish_profile(cards.limit(5), folder("p"), 2)  # a small version after a bucketed one is kept again
    whole, size = current.of(batch)
    assert size == 5 and current.buckets is None and whole.count() == 5
    current.release()


# Membership index


def test_filters_know_all_ids_and_few_others(spark):
    from txguard.streaming import membership as m

    ids = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    others = spark.range(20_000, 40_000).select(F.col("id").cast("string").alias("k"))
    slots = 20_000 // m.IDS_PER_SLOT + 1
    parts = [m.filter_of(ids.where(F.col("k").cast("int") % 3 == i), "k", slots) for i in range(3)]
    filters = m.add_filters(parts[0].unionByName(parts[1]).unionByName(parts[2])).persist()
    same_rows(filters, m.filter_of(ids.unionByName(spark.sql("SELECT CAST(NULL AS string) AS k")), "k", slots))
    assert m.maybe_known(ids, filters, "k", slots).count() == 20_000
    assert m.maybe_known(others, filters, "k", slots).count() < 0.05 * 20_000
    assert m.maybe_known(ids, filters.where("false"), "k", slots).isEmpty()


def test_new_ids_open_no_ids_and_repeats_few_folders(spark, folder, monkeypatch):
    from txguard.streaming import membership as m

    index = m.MembershipIndex(spark, folder("i"), "k", 200_000)
    ids = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("k"))
    for epoch in range(4):
        index.add(ids(epoch * 1000, epoch * 1000 + 1000), epoch)
    index.compact(before=4)
    asked = []
    real = m.MembershipIndex.candidates
    monkeypatch.setattr(m.MembershipIndex, "candidates", lambda self, b, before: asked.append(b) or real(self, b, before))
    assert index.unknown(ids(50_000, 50_100), 4).count() == 100 and not asked
    fresh = index.unknown(ids(3990, 4090), 4)
    assert sorted(int(r.k) for r in fresh.collect()) == list(range(4000, 4090))
    assert 1 <= len(asked[0]) <= 10
    read = real(index, asked[0], 4)
    text = executed(read)
    assert "PartitionFilters: [bucket#" in text and read.count() < 100  # a few of 1,024 buckets
    with pytest.raises(ValueError):
        index.unknown(ids(0, 10), 2)  # merged already
    assert m.MembershipIndex(spark, folder("empty"), "k", 10).unknown(ids(0, 10), 0).count() == 10


def test_indexed_stream_with_rows_without_id_and_a_repeated_epoch(spark, folder):
    from txguard.streaming import membership as m

    rows = [("a", 1, 0), ("b", 2, 0), ("a", 3, 1), (None, 4, 1), (None, 4, 1), ("c", 5, 2), ("c", 5, 2), ("b", 0, 3), (None, 4, 3)]
    stream = quarters(spark, spark.createDataFrame(rows, "trans_num string, v int, k int"), folder("in"))
    for _ in range(2):  # the second run finds nothing new
        m.start_unique_indexed(stream, folder("out"), "u", folder("cp"), 10, trigger=None, compact_every=1).awaitTermination()
    found = sorted(((r.trans_num, r.v) for r in EpochTable(spark, folder("out") + "/rows").read().collect()), key=str)
    assert found == sorted([("a", 1), ("b", 2), ("c", 5), (None, 4), (None, 4), (None, 4)], key=str)
