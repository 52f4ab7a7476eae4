import random
from statistics import stdev

import pytest
from helpers import by, same_rows, tx_frame
from pyspark.sql import functions as F

from txguard.operators import features, profiles, rules, velocity
from txguard.operators.skew import heavy_keys, lookup_join, lookup_plan


def card(cc, n, start=1000, step=10, amt=lambda i: 100 + i):
    return [
        {"cc_num": cc, "trans_num": f"{cc}-{i:04d}", "unix_time": start + step * i, "amt": amt(i)}
        for i in range(n)
    ]


def test_last_ten(spark):
    tx = tx_frame(spark, card("nine", 9) + card("ten", 10) + card("eleven", 11))
    kept = by(profiles.last_transactions(tx).groupBy("cc_num").count(), "cc_num", "count")
    assert kept == {"nine": 9, "ten": 10, "eleven": 10}
    means = by(profiles.last_average(tx), "cc_num", "avg_transaction_amt")
    assert means == {"nine": 104.0, "ten": 104.5, "eleven": 105.5}


def test_recency_is_numeric_and_ties_go_by_id(spark):
    rows = [
        {"cc_num": "a", "trans_num": "old", "unix_time": "999999999", "amt": 1},
        {"cc_num": "a", "trans_num": "new", "unix_time": "1000000001", "amt": 2},
        {"cc_num": "b", "trans_num": "1", "unix_time": "5", "amt": 3},
        {"cc_num": "b", "trans_num": "2", "unix_time": "5", "amt": 4},
        {"cc_num": "b", "trans_num": "3", "unix_time": "never", "amt": 5},
    ]
    newest = by(profiles.last_transactions(tx_frame(spark, rows), 1), "cc_num", "trans_num")
    assert newest == {"a": "new", "b": "2"}


def test_profile_and_deviation(spark):
    history = tx_frame(
        spark, card("one", 1) + card("same", 2, amt=lambda i: 50) + card("many", 5)
    ).withColumn("distance", F.lit(7.0))
    profile = profiles.card_profile(history)
    stats = by(profile, "cc_num", "avg_amount", "std_amount", "total_transactions", "avg_distance")
    assert stats["one"] == (100.0, None, 1, 7.0)
    assert stats["same"] == (50.0, 0.0, 2, 7.0)
    assert stats["many"][1] == pytest.approx(stdev([100, 101, 102, 103, 104]))

    arriving = tx_frame(
        spark, [{"cc_num": c, "trans_num": c, "amt": 110} for c in ("one", "same", "many", "new")]
    )
    got = by(
        features.with_behaviour(arriving, profile), "cc_num", "amount_deviation",
        "is_unusual_amount", "total_transactions",
    )
    assert got["one"] == (None, False, 1) and got["same"] == (None, False, 2)
    assert got["new"] == (None, False, None)
    assert got["many"][0] > 2 and got["many"][1] is True
    inner = features.with_behaviour(arriving, profile, "inner")
    assert set(by(inner, "cc_num", "amt")) == {"one", "same", "many"}


@pytest.fixture(scope="module")
def crowd(spark):
    """One card with a third of the rows, rows without card, wholly empty rows, small cards."""
    draw = random.Random(7)
    rows = []
    for i in range(900):
        cc = "hot" if i % 3 == 0 else None if i % 9 == 1 else f"c{draw.randrange(40)}"
        rows.append(
            {
                "cc_num": cc,
                "trans_num": f"{i:05d}" if i % 50 else None,
                "unix_time": None if i % 41 == 0 else 1_700_000_000 + draw.randrange(5 * 86400) // 40 * 40,
                "amt": None if i % 29 == 0 else draw.randrange(0, 50000) / 100,
                "ssn": cc,
            }
        )
    rows += [{} for _ in range(60)]
    return tx_frame(spark, rows)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_sliced_join_equals_plain_join(crowd, how):
    dim = profiles.last_average(crowd)
    heavy = heavy_keys(crowd, "cc_num", 100)
    assert [r.cc_num for r in heavy.collect()] == ["hot"]
    sliced = lookup_join(crowd, dim, "cc_num", how, heavy, spread="unix_time", rows_per_slice=20)
    same_rows(sliced, lookup_join(crowd, dim, "cc_num", how))


def test_sliced_join_spreads_hot_and_empty_keys(spark, crowd):
    """No shuffle partition of the sliced join may hold the whole hot card."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        dim = profiles.last_average(crowd)
        heavy = heavy_keys(crowd, "cc_num", 100)
        joined = lookup_join(
            crowd, dim, "cc_num", "left", heavy, spread="trans_num", rows_per_slice=10
        )
        sizes = joined.groupBy(
            F.col("cc_num").alias("k"), F.spark_partition_id().alias("p")
        ).count().where("k = 'hot' or k is null")
        hot = [r["count"] for r in sizes.collect() if r.k == "hot"]
        empty = [r["count"] for r in sizes.collect() if r.k is None]
        assert len(hot) >= 6 and max(hot) < sum(hot) / 2
        assert len(empty) >= 6 and max(empty) < sum(empty) / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_join_choice_by_counted_size(spark, crowd, folder):
    profiles.last_average(crowd).write.parquet(folder("dim"))
    dim = spark.read.parquet(folder("dim"))
    plain = lookup_join(crowd, dim, "cc_num")
    for limit, few in ((1000, False), (5, True), (5, False)):
        side, heavy = lookup_plan(crowd, dim, "cc_num", 100, limit, count_facts=few)
        assert (heavy is None) == (limit == 1000)
        same_rows(lookup_join(crowd, side, "cc_num", "left", heavy, "unix_time", 20), plain)
    small = crowd.limit(3)
    side, heavy = lookup_plan(small, dim, "cc_num", 100, 5, count_facts=True)
    assert heavy is None and side.count() <= 3


def brute_velocity(rows):
    out = {}
    for r in rows:
        if r.cc_num is None or r.unix_time is None:
            out[r.row] = (None,) * 6
            continue
        mine = [x for x in rows if x.cc_num == r.cc_num and x.unix_time is not None]
        rank = {
            x.row: (int(x.unix_time), x.trans_num or "", -1 if x.amt is None else x.amt) for x in mine
        }
        earlier = [x for x in mine if rank[x.row] < rank[r.row]]
        last = max(earlier, key=lambda x: rank[x.row], default=None)
        gap = None if last is None else int(r.unix_time) - int(last.unix_time)
        ratio = None
        if last is not None and r.amt is not None and last.amt:
            ratio = float(r.amt) / float(last.amt)
        result = [gap, ratio]
        for width in (3600, 86400):
            inside = [x for x in mine if 0 <= int(r.unix_time) - int(x.unix_time) <= width]
            result += [len(inside), float(sum(x.amt or 0 for x in inside))]
        out[r.row] = tuple(result)
    return out


@pytest.mark.parametrize("min_rows", [10**6, 100, 1])
def test_velocity_by_brute_force(crowd, min_rows):
    rows = crowd.withColumn("row", F.monotonically_increasing_id()).persist()
    want = brute_velocity(rows.collect())
    got = by(
        velocity.with_velocity(rows, min_rows), "row", "secs_since_prev", "amt_ratio_prev",
        "tx_count_1h", "amt_sum_1h", "tx_count_24h", "amt_sum_24h",
    )
    assert len(got) == len(want) == 960
    for row, values in want.items():
        assert got[row] == pytest.approx(values), (row, got[row], values)


@pytest.mark.parametrize("min_rows", [10**6, 100, 1])
def test_asof_profile_by_brute_force(crowd, min_rows):
    rows = crowd.withColumn("row", F.monotonically_increasing_id()).persist()
    known = [r for r in rows.collect()]
    got = by(
        profiles.asof_profile(rows, min_rows), "row", "prior_count", "prior_avg", "prior_std"
    )
    assert len(got) == len(known)
    for r in known:
        before = [
            float(x.amt) for x in known
            if r.cc_num is not None and x.cc_num == r.cc_num and r.unix_time and x.unix_time
            and int(x.unix_time) < int(r.unix_time) and x.amt is not None
        ]
        want = (
            len(before),
            sum(before) / len(before) if before else None,
            stdev(before) if len(before) > 1 else None,
        )
        assert got[r.row] == pytest.approx(want), r


def test_relative_rule_edges(spark):
    averages = spark.createDataFrame([("a", 100.0)], "cc_num string, avg_transaction_amt double")
    home = {"lat": 0, "long": 0, "merch_lat": 0}
    km = 6371.0 * 3.141592653589793 / 180
    rows = [
        {"trans_num": "both", "cc_num": "a", "amt": "600.01", "merch_long": 1600 / km, **home},
        {"trans_num": "limit", "cc_num": "a", "amt": "600.00", "merch_long": 1600 / km, **home},
        {"trans_num": "near", "cc_num": "a", "amt": "900", "merch_long": 1, **home},
        {"trans_num": "unseen", "cc_num": "b", "amt": "900", "merch_long": 1600 / km, **home},
        {"trans_num": "nowhere", "cc_num": "a", "amt": "900", "merch_long": None, **home},
    ]
    tx = tx_frame(spark, rows)

    def flag(**k):
        return by(rules.relative_rule(tx, averages, **k), "trans_num", "status")

    strict, either = flag(), flag(combine="or")
    assert {k for k, v in strict.items() if v == "fraud"} == {"both"}
    assert {k for k, v in either.items() if v == "fraud"} == {
        "both", "limit", "near", "unseen", "nowhere"
    }
    assert set(flag(how="inner")) == {"both", "limit", "near", "nowhere"}
    # Raising a limit never adds fraud, and "or" covers "and".
    assert {k for k, v in flag(distance_km=1700).items() if v == "fraud"} <= {"both"}
    with pytest.raises(ValueError):
        rules.relative_rule(tx, averages, combine="xor")


def test_final_status(spark):
    rows = [
        ("ml", 0.71, 0.5, 0.0, "1"), ("ml_limit", 0.7, 0.8, 0.0, "1"), ("anomaly", 0.5, 0.81, 0.0, "1"),
        ("rule", 0.5, 0.5, 1500.1, "500.01"), ("rule_limit", 0.5, 0.5, 1500.0, "900"),
        ("nulls", None, None, None, None), ("null_or_true", None, 0.9, None, None),
    ]
    df = spark.createDataFrame(
        rows, "id string, ml_fraud_score double, anomaly_score double, distance double, amt string"
    ).withColumn("amt", F.col("amt").cast("decimal(9,2)"))
    got = by(rules.final_status(df), "id", "final_fraud_status")
    assert {k for k, v in got.items() if v == "FRAUD"} == {"ml", "anomaly", "rule", "null_or_true"}


def test_state_adds_up(spark, crowd):
    """Any split of the rows gives the profile of all rows."""
    rows = crowd.withColumn("distance", F.col("amt").cast("double") / 7).withColumn(
        "n", F.monotonically_increasing_id() % 3
    )
    whole = by(profiles.card_profile(rows), "cc_num", *profiles.card_profile(rows).columns[1:])
    parts = [profiles.profile_state(rows.where(F.col("n") == i)) for i in range(3)]
    merged = profiles.merge_states(profiles.merge_states(parts[0], parts[1]), parts[2])
    assert merged.dtypes == parts[0].dtypes
    got = by(profiles.profile_of_state(merged), "cc_num", *profiles.card_profile(rows).columns[1:])
    assert got.keys() == whole.keys()
    for card_number, values in whole.items():
        assert [float(v) if v is not None else None for v in got[card_number]] == pytest.approx(
            [float(v) if v is not None else None for v in values]
        )


def test_newest_rows_add_up(spark, crowd):
    rows = crowd.where("cc_num is not null and trans_num is not null").withColumn(
        "n", F.monotonically_increasing_id() % 2
    )
    old = profiles.last_transactions(rows.where("n = 0")).drop("row_num")
    same_rows(
        profiles.last_transactions(old.unionByName(rows.where("n = 1"))).drop("n"),
        profiles.last_transactions(rows).drop("n"),
    )


def test_folders_of_a_large_profile_hold_many_cards(spark, folder):
    """A few rows per folder are for small profiles: folders do not grow in number with the cards from there on."""
    from txguard.plans import profiles as store

    cards = spark.range(6000).select(F.col("id").cast("string").alias("cc_num"))
    store.publish_profile(cards, folder("p"), 1, rows_per_bucket=10)
    store.publish_profile(cards.limit(45), folder("p"), 2, rows_per_bucket=10)
    buckets = by(spark.read.parquet(folder("p") + "/registry"), "version", "buckets")
    assert buckets == {1: store.FEW_BUCKETS, 2: 5}
    current = store.CurrentProfile(spark, folder("p"))
    assert current().count() == 45 and current.of(cards)[0].columns == ["cc_num"] and current.of(cards)[0].count() == 45
