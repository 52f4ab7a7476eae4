"""What the plans must and must not contain."""

import pytest
from helpers import executed, plan, result
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from txguard import fixtures as fx
from txguard.operators import features, profiles, velocity
from txguard.plans import applications
from txguard.plans.profiles import build_profile
from txguard.plans.workspace import stored

QUERIES = entry_point.queries()
SLOW = {n for n in QUERIES if n not in entry_point.oracle_sql()} | {"scaled_features"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_no_python_rows_and_no_products(spark, sf, name):
    text = plan(result(QUERIES, name, spark, sf))
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


@pytest.mark.parametrize("name", ["top_cards_by_fraud_amount", "top_merchants_by_fraud_amount"])
def test_top_k_is_no_global_sort(spark, sf, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf))


def test_scan_reads_and_filters_what_is_needed(spark, sf):
    text = plan(profiles.last_average(fx.history(spark, sf)))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in text
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts" in text


def test_last_n_is_cut_before_the_shuffle(spark, sf):
    text = plan(profiles.last_average(fx.history(spark, sf))).split("Physical Plan")[1]
    # Final limit, shuffle, partial limit; the mean needs no shuffle of its own.
    final, shuffle, partial = (
        text.index("WindowGroupLimit"), text.index("Exchange hashpartitioning"),
        text.rindex("WindowGroupLimit"),
    )
    assert final < shuffle < partial and text.count("Exchange hashpartitioning") == 1


def test_profile_aggregates_map_side(spark, sf):
    text = plan(build_profile(fx.history(spark, sf))).split("Physical Plan")[1]
    assert text.index("Exchange") < text.index("partial_stddev_samp")


def test_small_profile_is_broadcast_without_shuffling_rows(spark, sf):
    profile = stored(build_profile(fx.history(spark, sf)), "profile")
    text = plan(applications.score_batch(fx.arrivals(spark, sf), profile)).split("Physical Plan")[1]
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_heavy_branch_is_dropped_when_there_is_no_heavy_card(spark, sf):
    tx = fx.transactions(spark, sf).select("cc_num", "trans_num", "unix_time", "amt")
    text = executed(velocity.with_velocity(tx)).split("Initial Plan")[0]
    # The branch of heavy cards is gone: neither its aggregation nor the semi join is left.
    assert "max_by" not in text and "LeftSemi" not in text
    assert "max_by" in executed(velocity.with_velocity(tx, 5)).split("Initial Plan")[0]


def test_feature_chain_is_one_codegen_stage(spark, sf):
    tx = features.with_distance(features.with_amounts(features.with_calendar(fx.transactions(spark, sf))))
    text = tx._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "[codegen id : 1]" in text and "[codegen id : 2]" not in text


def test_quality_report_shuffles_only_ids(spark, sf):
    from txguard.operators import quality

    text = plan(quality.quality_report(fx.with_defects(fx.transactions(spark, sf))))
    scans = [part.split(">")[0] for part in text.split("ReadSchema: struct<")[1:]]
    assert "event_id:bigint" in scans  # the duplicate scan reads the id alone
    assert text.split("Physical Plan")[1].count("Exchange hashpartitioning") == 1


def test_one_sided_filter_reaches_the_scan(spark, sf, folder):
    profile = stored(build_profile(fx.history(spark, sf)), "profile")
    fx.transactions(spark, sf).write.parquet(folder("tx"))
    tx = spark.read.parquet(folder("tx")).where(F.col("category") == "view")
    text = plan(applications.score_batch(tx, profile).select("trans_num", "final_fraud_status"))
    assert "EqualTo(category,view)" in text and "first:string" not in text.split("Physical Plan")[1]


def test_deidentified_keeps_a_row_of_every_message(spark, sf):
    """Messages that cannot be decoded are flagged and written too, as rows of nulls."""
    from txguard import fixtures as fx
    from txguard.plans.queries import sink_scored_deidentified

    arrivals = fx.arrivals(spark, sf)
    broken = arrivals.where("CAST(trans_num AS BIGINT) % 97 = 0").count()
    got = sink_scored_deidentified(spark, sf)
    assert broken and got.count() == arrivals.count() and got.where("trans_num IS NULL").count() == broken


def test_quarters_are_dealt_before_rows_grow(spark, folder):
    """Wider rows are made after the shuffle, of the same rows; a quarter follows the other in files."""
    from txguard.plans.queries import _quarters

    rows = spark.range(100).select("id", (F.col("id") % 4).cast("int").alias("k"))
    made = lambda part: part.select("id", F.repeat(F.lit("x"), 1000).alias("wide"))
    assert _quarters(rows, folder("q"), made=made) == 1
    back = spark.read.parquet(folder("q"))
    assert back.columns == ["id", "wide"] and sorted(r.id for r in back.select("id").collect()) == list(range(100))
