"""Every operator as a query over the given tables: name -> (session, data folder) -> DataFrame.

Amounts come out as doubles and times as epoch seconds or text, so that another engine's result
can be compared value by value.
"""

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txguard import constants as C
from txguard import fixtures as fx
from txguard import schemas
from txguard.config import FraudConfig
from txguard.operators import (
    analytics, anomaly, drift, enrichment, features, metrics, monitor, privacy, profiles, quality, rules,
    velocity,
)
from txguard.operators.skew import heavy_keys, lookup_join
from txguard.plans import applications, models
from txguard.plans import profiles as profile_store
from txguard.plans.workspace import new_dir, stored
from txguard.sinks import catalog, publish, tables
from txguard.sinks.customers import write_customers
from txguard.sinks.epochs import EpochTable
from txguard.sources import customers as customer_source
from txguard.sources import evolution
from txguard.sources import history as history_source
from txguard.sources import payload
from txguard.sources.stream import file_stream
from txguard.streaming import dedup, duplicates, membership, rates, runner
from txguard.streaming import velocity as keyed_velocity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MASK_SALT = "demo-salt"
# Reference points for the two anomaly scores with given centres, in scaled feature space.
GIVEN_CENTRES = ((2.0, 0.0, 1.0), (5.0, 0.1, 2.5), (4.0, 3.0, 1.5))
GIVEN_SCALE = (1.0, 2000.0, 7.0)
GIVEN_TYPICAL = 1.25
# Rows of a file of a stream's input, elements of a JSON array: larger tables make more files, not larger ones.
FILE_ROWS, ARRAY_ROWS = 100_000, 10_000


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def num(column, digits: int | None = None):
    """Column as double under its own name, rounded if asked."""
    c = F.col(column) if isinstance(column, str) else column
    c = c.cast("double")
    c = F.round(c, digits) if digits is not None else c
    return c.alias(column) if isinstance(column, str) else c


def inline_profile(spark, sf_dir):
    return profile_store.build_profile(fx.history(spark, sf_dir))


# --- Sources ---------------------------------------------------------------------------------------


def _history_columns(df: DataFrame, *more) -> DataFrame:
    return df.select(
        "trans_num", "cc_num", "state", "unix_time", "category",
        num("zip"), num("lat"), num("long"), num("amt"), num("is_fraud"), num("merch_lat"),
        num("merch_long"), *more,
    )


@query
def src_history_typed(spark, sf_dir):
    path = new_dir(spark, "history-csv")
    fx.transactions(spark, sf_dir).drop("event_time").write.option("header", True).csv(path)
    return _history_columns(history_source.read_history(spark, path))


def _untyped_history(spark, sf_dir):
    path = new_dir(spark, "history-text")
    text = F.coalesce(F.col("amt").cast("string"), F.lit("n/a"))
    rows = fx.with_defects(fx.transactions(spark, sf_dir)).drop("event_time").withColumn("amt", text)
    rows.write.option("header", True).csv(path)
    return history_source.read_history_untyped(spark, path)


@query
def src_history_untyped(spark, sf_dir):
    typed = history_source.typed(_untyped_history(spark, sf_dir))
    return _history_columns(typed, "_c0", "cast_failures")


@query
def src_history_stored(spark, sf_dir):
    path = new_dir(spark, "history-table")
    history_source.store_history(fx.transactions(spark, sf_dir), path)
    return _history_columns(spark.read.parquet(path))


@query
def schema_check(spark, sf_dir):
    return quality.schema_report(_untyped_history(spark, sf_dir), schemas.TRANSACTION)


@query
def src_stream_files(spark, sf_dir):
    out, checkpoint = new_dir(spark, "stream-out"), new_dir(spark, "stream-checkpoint")
    stream = _history_columns(fx.as_transactions(fx.event_stream(spark, sf_dir)))
    runner.start_copy(stream, out, "src_stream_files", checkpoint, trigger=None).awaitTermination()
    return spark.read.parquet(out)


def _messages(tx: DataFrame) -> DataFrame:
    """Transactions as binary messages; one in 97 is cut short and so no JSON."""
    n = F.col("key").cast("bigint")
    encoded = payload.encode(tx.drop("event_time"), key="trans_num")
    broken = F.when(n % 97 == 0, F.substring("value", 1, 25)).otherwise(F.col("value"))
    return encoded.select(
        F.col("key").cast("binary").alias("key"), broken.cast("binary").alias("value")
    )


@query
def decode_json_payload(spark, sf_dir):
    messages = _messages(fx.transactions(spark, sf_dir))
    rows = payload.decode(messages, keep=("key",))
    return rows.select(
        F.col("key").cast("string").alias("key"), "trans_num", "cc_num", "unix_time", "category",
        num("zip"), num("lat"), num("amt"), num("is_fraud"),
        payload.is_corrupt().alias("is_corrupt"),
    )


@query
def src_customers(spark, sf_dir):
    path = new_dir(spark, "customers")
    fx.customers(spark, sf_dir).write.parquet(path)
    return customer_source.read_customers(spark, "parquet", path=path)


# --- Projections, filters ----------------------------------------------------------------------------


@query
def project_customer(spark, sf_dir):
    return privacy.customer_rows(fx.transactions(spark, sf_dir), "is_fraud")


@query
def filter_labelled(spark, sf_dir):
    """The label is kept where the card number survives, as if unknown cards were unlabelled."""
    tx = fx.with_defects(fx.transactions(spark, sf_dir))
    unlabelled = tx.withColumn("is_fraud", F.when(F.col("cc_num").isNotNull(), F.col("is_fraud")))
    return features.labelled(unlabelled).select("_c0", "cc_num", num("amt"), num("is_fraud"))


@query
def pii_masked(spark, sf_dir):
    masked = privacy.masked(fx.transactions(spark, sf_dir), MASK_SALT)
    return masked.select("trans_num", "ssn", "card_token", "cc_num", "acct_num", "first", "last")


# --- Features ------------------------------------------------------------------------------------------


@query
def haversine_distance(spark, sf_dir):
    return features.with_distance(fx.transactions(spark, sf_dir)).select(
        "trans_num", num("distance", 3)
    )


@query
def temporal_features(spark, sf_dir):
    tx = features.with_event_time(fx.transactions(spark, sf_dir).drop("event_time"))
    return features.with_calendar(tx).select(
        "trans_num", "year", "month", "day", "hour", "day_of_week", "quarter", "week_of_year",
        "is_weekend", "is_business_hours",
    )


@query
def transaction_features(spark, sf_dir):
    return features.with_amounts(fx.transactions(spark, sf_dir)).select(
        "trans_num", num("amount_log", 6), num("amount_squared"), "is_high_value", "is_low_value"
    )


@query
def behavior_features(spark, sf_dir):
    tx = fx.arrivals(spark, sf_dir)
    heavy = heavy_keys(tx, "cc_num")
    joined = features.with_behaviour(tx, inline_profile(spark, sf_dir), heavy=heavy)
    return joined.select(
        "trans_num", "cc_num", num("avg_amount", 8), num("std_amount", 4), "total_transactions",
        num("max_amount"), num("min_amount"), num("avg_distance", 4),
        num("amount_deviation", 4), "is_unusual_amount",
    )


@query
def prepare_features(spark, sf_dir):
    """Model inputs of rows that have no `amount_deviation` and some null amounts."""
    tx = fx.with_defects(fx.transactions(spark, sf_dir))
    rows = features.with_distance(features.with_amounts(features.with_calendar(tx)))
    return features.model_inputs(rows).select(
        "_c0", *[num(c, 3) for c in C.CLASSIFIER_FEATURES]
    )


@query
def velocity_features(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir).select("cc_num", "trans_num", "unix_time", "amt")
    rows = velocity.with_velocity(tx)
    return rows.select(
        "trans_num", "secs_since_prev", num("amt_ratio_prev", 8),
        "tx_count_1h", num("amt_sum_1h", 2), "tx_count_24h", num("amt_sum_24h", 2),
    )


@query
def velocity_features_heavy(spark, sf_dir):
    """The way of cards with many rows, here from 60 rows on."""
    tx = fx.transactions(spark, sf_dir).select("cc_num", "trans_num", "unix_time", "amt")
    return velocity.with_velocity(tx, min_rows=60).select(
        "trans_num", "secs_since_prev", num("amt_ratio_prev", 8),
        "tx_count_1h", num("amt_sum_1h", 2), "tx_count_24h", num("amt_sum_24h", 2),
    )


@query
def velocity_one_second(spark, sf_dir):
    """All transactions of a card in one second, each crowded one cut into ranges."""
    tx = fx.transactions(spark, sf_dir).select("cc_num", "trans_num", F.lit("1704067200").alias("unix_time"), "amt")
    return velocity.with_velocity(tx, min_rows=60).select(
        "trans_num", "secs_since_prev", num("amt_ratio_prev", 8),
        "tx_count_1h", num("amt_sum_1h", 2), "tx_count_24h", num("amt_sum_24h", 2),
    )


@query
def stream_velocity(spark, sf_dir):
    """Keyed state per card over four micro-batches in the order of time."""
    path, out, checkpoint = (new_dir(spark, n) for n in ("velocity-in", "velocity", "velocity-checkpoint"))
    tx = monitor.with_event_ts(fx.transactions(spark, sf_dir))
    week = F.least(F.lit(3), F.floor((F.col("unix_time").cast("bigint") - 1704067200) / 604800)).cast("int")
    rows = tx.select("cc_num", "trans_num", "unix_time", "amt", "event_ts", F.greatest(F.lit(0), week).alias("k"))
    files = _quarters(rows, path)
    stream = file_stream(spark, path, rows.drop("k").schema, files_per_trigger=files)
    made = keyed_velocity.stream_velocity(stream)
    runner.start_copy(made, out, "stream_velocity", checkpoint, trigger=None).awaitTermination()
    return spark.read.parquet(out).select(
        "trans_num", "secs_since_prev", num("amt_ratio_prev", 8),
        "tx_count_1h", num("amt_sum_1h", 2), "tx_count_24h", num("amt_sum_24h", 2),
    )


@query
def customer_enrichment(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir)
    joined = enrichment.with_customer(
        tx, fx.customers(spark, sf_dir), heavy=heavy_keys(tx, "ssn")
    )
    return joined.select(
        "trans_num", "ssn", "customer_first", "customer_city", "customer_state", "customer_status"
    )


# --- Profiles --------------------------------------------------------------------------------------------


@query
def card_profile(spark, sf_dir):
    return inline_profile(spark, sf_dir).select(
        "cc_num", num("avg_amount", 8), num("std_amount", 4), "total_transactions",
        num("max_amount"), num("min_amount"), num("avg_distance", 4),
    )


@query
def last_n_transactions(spark, sf_dir):
    rows = profiles.last_transactions(fx.history(spark, sf_dir))
    return rows.select("cc_num", "trans_num", num("amt"), "row_num")


@query
def last10_avg(spark, sf_dir):
    return profiles.last_average(fx.history(spark, sf_dir)).select(
        "cc_num", num("avg_transaction_amt", 8)
    )


def _history_parts(spark, sf_dir):
    """The history as it would arrive: what was there before, and what came since."""
    past = fx.history(spark, sf_dir)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return past.where(F.col("event_time") < cut), past.where(F.col("event_time") >= cut)


@query
def card_profile_refreshed(spark, sf_dir):
    """The profile from a stored state and the new part only."""
    old, new = (
        profiles.profile_state(features.with_distance(part)) for part in _history_parts(spark, sf_dir)
    )
    merged = profiles.merge_states(stored(old, "profile-state"), new)
    return profiles.profile_of_state(merged).select(
        "cc_num", num("avg_amount", 8), num("std_amount", 4), "total_transactions",
        num("max_amount"), num("min_amount"), num("avg_distance", 4),
    )


@query
def last10_avg_refreshed(spark, sf_dir):
    """The last amounts from the stored newest rows and the new part only."""
    columns = ("cc_num", "trans_num", "unix_time", "amt")
    old, new = (part.select(*columns) for part in _history_parts(spark, sf_dir))
    newest = stored(profiles.last_transactions(old).select(*columns), "newest")
    return profiles.last_average(newest.unionByName(new)).select(
        "cc_num", num("avg_transaction_amt", 8)
    )


@query
def asof_profile(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir).select("cc_num", "trans_num", "unix_time", "amt")
    return profiles.asof_profile(tx).select(
        "trans_num", "prior_count", num("prior_avg", 8), num("prior_std", 4)
    )


@query
def asof_profile_heavy(spark, sf_dir):
    tx = fx.transactions(spark, sf_dir).select("cc_num", "trans_num", "unix_time", "amt")
    return profiles.asof_profile(tx, min_rows=60).select(
        "trans_num", "prior_count", num("prior_avg", 8), num("prior_std", 4)
    )


# --- Quality -----------------------------------------------------------------------------------------------


@query
def quality_report(spark, sf_dir):
    report = quality.quality_report(fx.with_defects(fx.transactions(spark, sf_dir)))
    return report.withColumns(
        {c: F.round(c, 8) for c in ("data_quality_score", "valid_row_pct")}
    )


@query
def duplicate_transactions(spark, sf_dir):
    return quality.duplicates(fx.with_defects(fx.transactions(spark, sf_dir)))


# --- Rules ---------------------------------------------------------------------------------------------------


def _flags(df):
    return df.select(
        "trans_num", "cc_num", num("distance", 3), num("avg_transaction_amt", 8), "status"
    )


@query
def rule_flag_inner(spark, sf_dir):
    return _flags(applications.flag_batch(fx.arrivals(spark, sf_dir), fx.history(spark, sf_dir)))


@query
def rule_flag_sliced(spark, sf_dir):
    """The join with the rows of heavy cards in slices, here cards from 12 rows on, 5 rows a slice."""
    tx, history = fx.arrivals(spark, sf_dir), fx.history(spark, sf_dir)
    averages = profiles.last_average(history)
    heavy = heavy_keys(tx, "cc_num", 12)
    joined = lookup_join(tx, averages, "cc_num", "inner", heavy, spread="trans_num", rows_per_slice=5)
    return _flags(rules.relative_rule(joined.drop("avg_transaction_amt"), averages, "inner", heavy=heavy))


@query
def rule_flag_left(spark, sf_dir):
    return _flags(
        applications.flag_batch(fx.arrivals(spark, sf_dir), fx.history(spark, sf_dir), "left")
    )


@query
def rule_flag_cascade(spark, sf_dir):
    return _flags(
        applications.flag_batch(
            fx.arrivals(spark, sf_dir), fx.history(spark, sf_dir), "left", combine="or"
        )
    )


@query
def rule_tiers(spark, sf_dir):
    tx = features.with_distance(fx.transactions(spark, sf_dir))
    return rules.tier_rule(tx).select("trans_num", num("amt"), "rule_based_fraud")


def _amount_scored(tx):
    """A score that covers the whole scale, straight from the amount; missing amounts stay null."""
    return tx.withColumn("ml_fraud_score", F.col("amt").cast("double") / 1000)


@query
def alerts(spark, sf_dir):
    tx = _amount_scored(fx.with_defects(fx.transactions(spark, sf_dir)))
    return rules.with_alerts(tx).select("_c0", "risk_level", "alert_generated")


@query
def alert_sink(spark, sf_dir):
    path = new_dir(spark, "alerts")
    raised = rules.with_alerts(_amount_scored(fx.transactions(spark, sf_dir)))
    for _ in range(2):  # the second write stands for a replayed batch
        tables.write_alerts(raised, 0, path)
    return spark.read.parquet(path).select(
        "trans_num", "cc_num", num("ml_fraud_score", 6), "risk_level"
    )


@query
def final_status_models_off(spark, sf_dir):
    tx = rules.without_models(features.with_distance(fx.transactions(spark, sf_dir)))
    return rules.final_status(rules.with_alerts(tx, enabled=False)).select(
        "trans_num", "ml_fraud_score", "anomaly_score", "risk_level", "final_fraud_status"
    )


# --- Metrics ---------------------------------------------------------------------------------------------------


def _rule_predictions(spark, sf_dir):
    tx = rules.tier_rule(features.with_distance(fx.transactions(spark, sf_dir)))
    return tx.select(
        "cc_num",
        F.col("is_fraud").cast("int").alias("is_fraud"),
        (F.col("rule_based_fraud") != C.TIER_OTHERWISE).cast("int").alias("predicted_fraud"),
    )


@query
def classification_metrics(spark, sf_dir):
    rows = _rule_predictions(spark, sf_dir)
    scores = metrics.classification_metrics(rows, "is_fraud", "predicted_fraud")
    return scores.select(
        "n", "tp", "fp", "fn", "tn",
        *[num(c, 8) for c in ("accuracy", "precision", "detection_rate", "false_positive_rate")],
    )


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(
        _rule_predictions(spark, sf_dir), "is_fraud", "predicted_fraud"
    ).withColumnRenamed("rows", "n")


@query
def ab_rule_metrics(spark, sf_dir):
    """Two distance limits of the status rule tried on two halves of the cards."""
    tx = rules.without_models(features.with_distance(fx.transactions(spark, sf_dir)))
    scored = models.score_by_arm(
        tx, partial(rules.final_status, distance_km=1500), partial(rules.final_status, distance_km=1000)
    ).withColumn("flag", (F.col("final_fraud_status") == "FRAUD").cast("int"))
    per_arm = metrics.classification_metrics(scored, "is_fraud", "flag", ("arm",))
    return per_arm.select(
        "arm", "n", "tp", "fp", "fn", "tn", num("detection_rate", 8), num("false_positive_rate", 8)
    )


@query
def ab_decision(spark, sf_dir):
    """The two distance limits compared day by day on the frauds they find, with a p-value that holds at every look."""
    tx = rules.without_models(features.with_distance(fx.transactions(spark, sf_dir)))
    scored = models.score_by_arm(
        tx, partial(rules.final_status, distance_km=1500), partial(rules.final_status, distance_km=1000)
    )
    day = F.floor(F.col("unix_time").cast("bigint") / 86400).alias("day_number")
    looks = scored.where("is_fraud = 1").groupBy(day, "arm").agg(
        F.count("*").alias("n"), F.count_if(F.col("final_fraud_status") == "FRAUD").alias("found")
    )
    return metrics.sequential_test(looks, "day_number", "n", "found", effect=0.1).select(
        "day_number", "n_a", "hits_a", "n_b", "hits_b", num("p_value", 6), "decision"
    )


@query
def drift_by_day(spark, sf_dir):
    """Inputs of each arriving day against the history: exactly, and whether the sketches are within their error of that."""
    columns = ("amount_log", "distance")
    rows = features.with_distance(features.with_amounts(fx.transactions(spark, sf_dir)))
    rows = rows.select("event_time", *columns, F.to_date("event_time").cast("string").alias("day"))
    start = F.lit(fx.STREAM_START).cast("timestamp_ntz")
    past, live = rows.where(F.col("event_time") < start), rows.where(F.col("event_time") >= start)
    exact = drift.exact_drift(past, live, columns, ("day",)).select("day", "column", "n", "distance", "drifted")
    table = EpochTable(spark, new_dir(spark, "drift"), merge=drift.add_states)
    for epoch, odd in enumerate((0, 1)):
        half = live.where(F.dayofyear("event_time") % 2 == odd)
        table.write(drift.sketch_state(half, columns, ("day",)), epoch)
    report = drift.drift_report(drift.sketch_state(past, columns), table.read())
    guess = report.select("day", "column", F.col("distance").alias("guess"))
    error = 2 * drift.RANK_ERROR + 0.02 + 2 / F.col("n")
    return exact.join(guess, ["day", "column"]).select(
        "day", "column", "n", num("distance", 8), (F.abs(F.col("distance") - F.col("guess")) <= error).alias("estimate_is_close")
    )


# --- Monitoring ----------------------------------------------------------------------------------------------


def _daily_rates(spark, sf_dir):
    tx = monitor.with_event_ts(fx.transactions(spark, sf_dir))
    return monitor.fraud_rate_windows(tx, F.col("is_fraud") == 1)


@query
def fraud_rate_windows(spark, sf_dir):
    return _daily_rates(spark, sf_dir).withColumn("fraud_rate", F.round("fraud_rate", 8))


@query
def fraud_spikes(spark, sf_dir):
    spikes = monitor.fraud_spikes(_daily_rates(spark, sf_dir))
    return spikes.select(
        "window_start", num("fraud_rate", 8), num("previous_rate", 8), num("increase", 8), "is_spike"
    )


@query
def error_rate_windows(spark, sf_dir):
    """Share of undecodable messages per day; the arrival time is that of the event."""
    events = fx.table(spark, sf_dir, "events")
    rows = fx.as_transactions(events)
    n = F.col("trans_num").cast("bigint")
    value = F.to_json(F.struct("trans_num", "cc_num", "amt"))
    broken = F.when(n % 97 < 5, F.substring(value, 1, 12)).otherwise(value)
    messages = rows.select(
        F.timestamp_seconds(F.col("unix_time").cast("bigint")).alias("event_ts"),
        broken.alias("value"),
    )
    decoded = payload.decode(messages, keep=("event_ts",))
    return monitor.error_rate_windows(decoded, payload.is_corrupt()).withColumn(
        "error_rate", F.round("error_rate", 8)
    )


@query
def stream_rate_windows(spark, sf_dir):
    """Closed windows only: a day comes out once the newest event is two hours past its end."""
    out, checkpoint = new_dir(spark, "rates"), new_dir(spark, "rates-checkpoint")
    tx = monitor.with_event_ts(fx.as_transactions(fx.event_stream(spark, sf_dir)))
    rates = monitor.fraud_rate_windows(tx, F.col("is_fraud") == 1, late="2 hours")
    runner.start_copy(rates, out, "stream_rate_windows", checkpoint, trigger=None).awaitTermination()
    return spark.read.parquet(out).withColumn("fraud_rate", F.round("fraud_rate", 8))


def _mixed_stream(spark, sf_dir, tx, name):
    """Rows of any dates in four micro-batches, by transaction number: 2, 0, 3, 1 modulo 4."""
    path = new_dir(spark, name)
    files = _quarters(tx, path, (2, 0, 3, 1))
    return file_stream(spark, path, tx.drop("k").schema, files_per_trigger=files)


def _late_rates(spark, sf_dir, name):
    out, checkpoint = new_dir(spark, name), new_dir(spark, f"{name}-checkpoint")
    tx = monitor.with_event_ts(fx.transactions(spark, sf_dir)).select(
        "trans_num", "is_fraud", "event_ts", (F.col("trans_num").cast("bigint") % 4).alias("k")
    )
    rates.start_late_rates(
        _mixed_stream(spark, sf_dir, tx, f"{name}-in"), F.col("is_fraud") == 1, out, name, checkpoint, trigger=None, compact_every=2,
    ).awaitTermination()
    return out


@query
def stream_rate_windows_late(spark, sf_dir):
    """All dates mixed in each of four micro-batches: every row is in its window, closed or not."""
    found = rates.rates(spark, _late_rates(spark, sf_dir, "late-rates"))
    return found.withColumn("fraud_rate", F.round("fraud_rate", 8))


@query
def stream_rate_corrections(spark, sf_dir):
    """The closed windows that each of the later micro-batches corrected, as they were then."""
    found = rates.corrections(spark, _late_rates(spark, sf_dir, "corrected-rates"))
    return found.withColumn("fraud_rate", F.round("fraud_rate", 8))


def _stream_duplicates(spark, sf_dir, name):
    out, checkpoint = new_dir(spark, name), new_dir(spark, f"{name}-checkpoint")
    n = F.col("_c0").cast("bigint")
    tx = fx.with_defects(fx.transactions(spark, sf_dir)).select("trans_num", "cc_num", (n % 4).alias("k"))
    stream = _mixed_stream(spark, sf_dir, tx, f"{name}-in")
    runner.start_scoring(
        stream, lambda df: df, (), name, checkpoint, None, duplicates.duplicate_sinks(spark, out, compact_every=2)
    ).awaitTermination()
    return out


@query
def stream_duplicates(spark, sf_dir):
    """Ids that repeat within or across four micro-batches, exactly."""
    found = duplicates.repeated(spark, _stream_duplicates(spark, sf_dir, "stream-duplicates"))
    return found.select(F.col("id").alias("trans_num"), "copies")


@query
def stream_surplus(spark, sf_dir):
    """Surplus copies over four micro-batches, exact, and whether the sketch's number of ids is within 5 % of it."""
    report = duplicates.surplus_report(spark, _stream_duplicates(spark, sf_dir, "stream-surplus"))
    ids = F.col("n") - F.col("surplus_copies")
    return report.select("n", "surplus_copies", (F.abs(F.col("ids_estimate") - ids) <= 0.05 * ids).alias("estimate_is_close"))


@query
def stream_dedup(spark, sf_dir):
    """Every event arrives three times; one row of each is kept."""
    out, checkpoint = new_dir(spark, "dedup"), new_dir(spark, "dedup-checkpoint")
    tx = monitor.with_event_ts(fx.as_transactions(fx.event_stream(spark, sf_dir)))
    thrice = tx.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).drop("copy")
    once = dedup.drop_repeats(thrice).select("trans_num", "cc_num", num("amt"))
    runner.start_copy(once, out, "stream_dedup", checkpoint, trigger=None).awaitTermination()
    return spark.read.parquet(out)


# --- Sinks and applications --------------------------------------------------------------------------------------


def _scored(df):
    return df.select(
        "trans_num", "cc_num", "year", "month", "hour", "is_weekend", num("amount_log", 6),
        num("distance", 3), num("amount_deviation", 4), "is_unusual_amount", "ml_fraud_score",
        "anomaly_score", "risk_level", "alert_generated", "final_fraud_status",
    )


@query
def scored_batch(spark, sf_dir):
    profile = stored(inline_profile(spark, sf_dir), "profile")
    return _scored(applications.score_batch(fx.arrivals(spark, sf_dir), profile))


@query
def scored_batch_shuffled(spark, sf_dir):
    """Scoring with a profile that counts as too large to broadcast, and cards from 12 rows on as heavy."""
    profile = stored(inline_profile(spark, sf_dir), "profile")
    config = FraudConfig(broadcast_rows=0, heavy_rows=12)
    return _scored(applications.score_batch(fx.arrivals(spark, sf_dir), profile, config=config))


def _profile_root(spark, sf_dir, build=profile_store.build_profile):
    root = new_dir(spark, "profiles")
    profile_store.publish_profile(build(fx.history(spark, sf_dir)), root, 1)
    return root


@query
def scored_stream(spark, sf_dir):
    """The scoring application over the arriving part, every sink attached, read back."""
    out, checkpoint = new_dir(spark, "scored"), new_dir(spark, "scored-checkpoint")
    applications.start_scored_stream(
        spark, fx.arrival_stream(spark, sf_dir), _profile_root(spark, sf_dir), out,
        "scored_stream", checkpoint, available_now=True,
    ).awaitTermination()
    return _scored(spark.read.parquet(f"{out}/scored"))


@query
def scored_stream_large_profile(spark, sf_dir):
    """The stream with a profile that counts as large: a micro-batch cuts it down to its own cards."""
    out, checkpoint = new_dir(spark, "scored"), new_dir(spark, "scored-checkpoint")
    applications.start_scored_stream(
        spark, fx.arrival_stream(spark, sf_dir), _profile_root(spark, sf_dir), out,
        "scored_stream_large_profile", checkpoint, config=FraudConfig(broadcast_rows=10), available_now=True,
    ).awaitTermination()
    return _scored(spark.read.parquet(f"{out}/scored"))


@query
def scored_stream_bucketed(spark, sf_dir):
    """The stream with a bucketed profile: each micro-batch, of a day's cards or so, reads the folders of its own cards."""
    out, checkpoint, root = (new_dir(spark, n) for n in ("scored", "scored-checkpoint", "profiles"))
    profile_store.publish_profile(inline_profile(spark, sf_dir), root, 3, rows_per_bucket=10)
    applications.start_scored_stream(
        spark, fx.arrival_stream(spark, sf_dir), root, out, "scored_stream_bucketed", checkpoint,
        config=FraudConfig(broadcast_rows=10), available_now=True,
    ).awaitTermination()
    rows = spark.read.parquet(f"{out}/scored")
    return _scored(rows.where("profile_version = 3 AND model_version IS NULL"))


def _files_of(rows, most):
    """How many files of at most about `most` rows hold a table."""
    return max(1, -(-rows // most))


def _quarters(rows, path, order=(0, 1, 2, 3), made=lambda part: part):
    """Writes the quarters `k` of the rows one after another, each in the same number of files, and returns that: a stream
    that takes so many files at a time reads a quarter per micro-batch. The rows are dealt to the files before `made` makes
    wider ones of them."""
    files = _files_of(rows.count(), 4 * FILE_ROWS)
    for k in order:
        made(rows.where(F.col("k") == k).drop("k").repartition(files)).write.mode("append").parquet(path)
    return files


def _message_stream(spark, sf_dir, name):
    """Encoded messages of all transactions, one in 97 cut short, as a stream of a quarter per micro-batch."""
    path = new_dir(spark, name)
    key = F.col("event_id").cast("string").cast("binary")
    events = fx.table(spark, sf_dir, "events").withColumn("k", F.pmod(F.xxhash64(key), F.lit(4)))
    files = _quarters(events, path, made=lambda part: _messages(fx.as_transactions(part)))
    return file_stream(spark, path, "key binary, value binary", files_per_trigger=files)


def _run_messages(spark, sf_dir, name, **more):
    out, checkpoint = new_dir(spark, name), new_dir(spark, f"{name}-checkpoint")
    applications.start_scored_stream(
        spark, payload.decode(_message_stream(spark, sf_dir, f"{name}-in")), _profile_root(spark, sf_dir), out,
        name, checkpoint, available_now=True, **more,
    ).awaitTermination()
    return out


@query
def stream_bad_messages(spark, sf_dir):
    """Messages that cannot be decoded end in a table of their own, the others are scored: no message is lost."""
    out = _run_messages(spark, sf_dir, "stream_bad_messages")
    scored = spark.read.parquet(f"{out}/scored").select(F.lit("scored").alias("table"), F.col("trans_num").alias("what"))
    bad = spark.read.parquet(f"{out}/bad_messages").select(F.lit("bad").alias("table"), F.col("message").alias("what"))
    return scored.union(bad)


@query
def stream_quality(spark, sf_dir):
    """The quality reports of the micro-batches, added up."""
    out = _run_messages(spark, sf_dir, "stream_quality")
    reports = spark.read.parquet(f"{out}/quality")
    return reports.agg(
        F.count(F.lit(1)).alias("batches"),
        *[F.sum(c).alias(c) for c in ("total_records", "null_ssn_count", "null_amount_count", "invalid_amount_count")],
    )


@query
def scored_stream_enriched(spark, sf_dir):
    """Scored rows of the stream with the columns of their customer."""
    customers = stored(fx.customers(spark, sf_dir), "customers")
    out = _run_messages(spark, sf_dir, "scored_stream_enriched", enrich=lambda: customers)
    return spark.read.parquet(f"{out}/scored").select("trans_num", "customer_city", "customer_status", "final_fraud_status")


@query
def stream_dedup_late(spark, sf_dir):
    """Every event comes twice, in four micro-batches that mix all dates: late rows are kept, repeats are not."""
    path, out, checkpoint = (new_dir(spark, n) for n in ("late-in", "late-out", "late-checkpoint"))
    tx = monitor.with_event_ts(fx.transactions(spark, sf_dir)).select("trans_num", "cc_num", num("amt"), "event_ts")
    copies = tx.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    copies = copies.withColumn("k", F.pmod(F.xxhash64("trans_num") + F.col("copy") * 2, F.lit(4))).drop("copy")
    files = _quarters(copies, path, (2, 0, 3, 1))
    stream = file_stream(
        spark, path, "trans_num string, cc_num string, amt double, event_ts timestamp", files_per_trigger=files
    )
    dedup.start_unique(stream, out, "stream_dedup_late", checkpoint, trigger=None).awaitTermination()
    return spark.read.parquet(out).select("trans_num", "cc_num", "amt")


@query
def stream_dedup_indexed(spark, sf_dir):
    """As `stream_dedup_late`, through filters and buckets of ids, with small filters so that chance hits occur."""
    path, out, checkpoint = (new_dir(spark, n) for n in ("indexed-in", "indexed-out", "indexed-checkpoint"))
    tx = fx.transactions(spark, sf_dir).select("trans_num", "cc_num", num("amt"))
    copies = tx.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    copies = copies.withColumn("k", F.pmod(F.xxhash64("trans_num") + F.col("copy") * 2, F.lit(4))).drop("copy")
    files = _quarters(copies, path, (2, 0, 3, 1))
    stream = file_stream(spark, path, "trans_num string, cc_num string, amt double", files_per_trigger=files)
    membership.start_unique_indexed(
        stream, out, "stream_dedup_indexed", checkpoint, expected_ids=tx.count() // 2, trigger=None, compact_every=2
    ).awaitTermination()
    return EpochTable(spark, f"{out}/rows").read().select("trans_num", "cc_num", "amt")


@query
def flagged_stream(spark, sf_dir):
    """The rule-only application over encoded messages of the arriving part, read back."""
    out, checkpoint = new_dir(spark, "flagged"), new_dir(spark, "flagged-checkpoint")
    averages = _profile_root(spark, sf_dir, profile_store.build_averages)
    arriving = payload.encode(fx.arrival_stream(spark, sf_dir).drop("event_time"))
    applications.start_flagged_stream(
        spark, payload.decode(arriving).drop(schemas.CORRUPT_COLUMN), averages, out,
        "flagged_stream", checkpoint, how="inner", available_now=True,
    ).awaitTermination()
    return _flags(spark.read.parquet(f"{out}/flagged"))


@query
def flagged_stream_bad_messages(spark, sf_dir):
    """The rule-only application over messages of which one in 97 is cut short: flagged and bad ones are all there are."""
    out, checkpoint = new_dir(spark, "flagged"), new_dir(spark, "flagged-checkpoint")
    averages = _profile_root(spark, sf_dir, profile_store.build_averages)
    messages = _message_stream(spark, sf_dir, "flagged-in")
    applications.start_flagged_stream(
        spark, payload.decode(messages), averages, out, "flagged_stream_bad_messages", checkpoint, available_now=True,
    ).awaitTermination()
    flagged = spark.read.parquet(f"{out}/flagged").select(
        F.lit("flagged").alias("table"), F.col("trans_num").alias("what"), "status"
    )
    bad = spark.read.parquet(f"{out}/bad_messages")
    return flagged.union(bad.select(F.lit("bad"), "message", F.lit(None).cast("string")))


def _off_scored(spark, sf_dir):
    """All transactions with a status; no models."""
    tx = features.with_calendar(features.with_distance(fx.transactions(spark, sf_dir)))
    return rules.final_status(rules.with_alerts(rules.without_models(tx)))


def _epochs(df):
    """The frame in two epochs, by event time."""
    cut = F.lit("2024-01-28 00:00:00").cast("timestamp_ntz")
    return [(0, df.where(F.col("event_time") < cut)), (1, df.where(F.col("event_time") >= cut))]


@query
def sink_scored_partitioned(spark, sf_dir):
    path = new_dir(spark, "sink-scored")
    (_, first), (_, second) = _epochs(_off_scored(spark, sf_dir))
    # Epoch 0 is written, then replayed; an empty epoch writes nothing.
    for epoch, rows in ((0, first), (0, first), (1, second), (2, first.where("false"))):
        tables.write_scored(rows, epoch, path)
    return spark.read.parquet(path).select(
        "trans_num", "epoch_id", "year", "month", "final_fraud_status", num("amt"),
        F.col("processing_timestamp").isNotNull().alias("is_stamped"),
    )


@query
def sink_compacted(spark, sf_dir):
    path, merged = new_dir(spark, "sink-many"), new_dir(spark, "sink-few")
    for epoch, rows in _epochs(_off_scored(spark, sf_dir)):
        tables.write_scored(rows, epoch, path)
    tables.compact(spark, path, merged)
    return spark.read.parquet(merged).select(
        "trans_num", "epoch_id", "year", "month", "final_fraud_status", num("amt")
    )


def _merged_epochs(spark, sf_dir, purpose):
    """Six epochs, each tried with a part of its rows before, merged as they come, two generations to one."""
    table = EpochTable(spark, new_dir(spark, purpose), C.SCORED_PARTITIONS, fan=2)
    scored = stored(_off_scored(spark, sf_dir).drop("event_time"), f"{purpose}-rows")
    n = F.col("trans_num").cast("bigint")
    for epoch in range(6):
        rows = scored.where(n % 6 == epoch)
        table.write(rows.where(n % 7 == 0), epoch)
        table.write(rows, epoch)
        if epoch in (1, 2, 4):
            table.compact(before=epoch)
    return table


@query
def sink_compacted_incremental(spark, sf_dir):
    """Epochs under a commit log: some merged, some not, each row once."""
    return _merged_epochs(spark, sf_dir, "sink-merged").read().select(
        "trans_num", "epoch_id", "year", "month", "final_fraud_status", num("amt")
    )


@query
def catalog_compacted_view(spark, sf_dir):
    """Ad-hoc SQL over the merged epochs by name; the epochs that are not merged yet are not in the view."""
    table = _merged_epochs(spark, sf_dir, "catalog-merged")
    name = "merged_" + table.path.rsplit("-", 1)[1]
    table.register(name)
    return spark.sql(
        f"""
        SELECT epoch_id, category, final_fraud_status, count(*) AS n, CAST(sum(amt) AS DOUBLE) AS amount
        FROM {name} WHERE year = 2024 AND month = 1
        GROUP BY epoch_id, category, final_fraud_status
        """
    )


@query
def scored_stream_compacted(spark, sf_dir):
    """The scoring stream into a table of epochs that merges itself."""
    out = _run_messages(spark, sf_dir, "scored_stream_compacted", compact_every=2)
    rows = EpochTable(spark, f"{out}/scored", C.SCORED_PARTITIONS).read()
    return rows.select("trans_num", "year", "month", num("distance", 3), "final_fraud_status")


@query
def sink_customers(spark, sf_dir):
    path = new_dir(spark, "sink-customers")
    for epoch, rows in _epochs(_off_scored(spark, sf_dir)):
        for _ in range(2):
            write_customers(rows, epoch, fmt="parquet", path=path)
    newest = customer_source.newest_customers(spark.read.parquet(path))
    return newest.select("ssn", "cc_num", "first", "city", "dob", "status", "epoch_id")


@query
def sink_scored_deidentified(spark, sf_dir):
    path = new_dir(spark, "sink-deidentified")
    messages = stored(_messages(fx.arrivals(spark, sf_dir)), "messages")
    decoded = stored(payload.decode(messages, keep=("key",)), "decoded")
    flagged = applications.flag_batch(decoded, fx.history(spark, sf_dir), "left")
    tables.write_deidentified(flagged, 0, path)
    back = spark.read.parquet(path)
    left_over = [c for c in (*C.DROPPED_PII, schemas.CORRUPT_COLUMN) if c in back.columns]
    return back.select(
        "trans_num", "ssn", "city", num("amt"), "status", F.lit(len(left_over)).alias("pii_columns")
    )


@query
def publish_json_array(spark, sf_dir):
    """Elements of JSON arrays go out as they are: numbers, booleans and nested values keep their type."""
    source, topic = new_dir(spark, "arrays"), new_dir(spark, "topic")
    tx = fx.transactions(spark, sf_dir)
    n = F.col("trans_num").cast("bigint")
    element = F.concat(
        F.lit('{"trans_num":"'), "trans_num", F.lit('","n":'), n.cast("string"), F.lit(',"even":'), (n % 2 == 0).cast("string"),
        F.when(n % 3 == 0, F.concat(F.lit(',"at":{"card":"'), "cc_num", F.lit('"}'))).otherwise(""), F.lit("}"),
    )
    file = F.pmod(F.xxhash64(*tx.columns), F.lit(_files_of(tx.count(), ARRAY_ROWS)))
    arrays = tx.select(file.alias("file"), element.alias("e")).groupBy("file").agg(F.collect_list("e").alias("e"))
    value = F.concat(F.lit("["), F.array_join("e", ",\n"), F.lit("]")).alias("value")
    arrays.select("file", value).write.partitionBy("file").text(source)  # a file per array
    publish.publish(publish.messages_from_arrays(spark, source), "parquet", topic)
    return spark.read.parquet(topic).select("value", F.length("key").alias("key_length"))


@query
def alert_sink_replayed(spark, sf_dir):
    """An epoch whose replay raises fewer alerts, and one whose replay raises none, leave nothing of the first try."""
    path = new_dir(spark, "alerts")
    raised = rules.with_alerts(_amount_scored(fx.transactions(spark, sf_dir)))
    even = F.col("trans_num").cast("bigint") % 2 == 0
    tables.write_alerts(raised, 0, path)
    tables.write_alerts(raised.where(even), 0, path)
    tables.write_alerts(raised.where(~even), 1, path)
    tables.write_alerts(raised.where("false"), 1, path)
    return spark.read.parquet(path).select("trans_num", "risk_level", F.col("epoch_id").cast("int").alias("epoch_id"))


@query
def publish_json_records(spark, sf_dir):
    source, topic = new_dir(spark, "records"), new_dir(spark, "topic")
    tx = fx.transactions(spark, sf_dir)
    n = F.col("trans_num").cast("bigint")
    tx.select(
        F.when(n % 4 == 0, F.concat(F.lit("k"), "trans_num")).alias("key"),
        "trans_num", "cc_num", "category", F.col("amt").cast("string").alias("amt"),
    ).write.json(source)
    publish.publish(publish.messages_from_lines(spark, source), "parquet", topic)
    sent = spark.read.parquet(topic)
    own = F.get_json_object("value", "$.key").isNotNull()
    return sent.select(
        "value",
        F.when(own, F.col("key")).alias("own_key"),
        F.length(F.when(~own, F.col("key"))).alias("made_key_length"),
    )


@query
def catalog_adhoc_table(spark, sf_dir):
    path = new_dir(spark, "catalog")
    for epoch, rows in _epochs(_off_scored(spark, sf_dir)):
        tables.write_scored(rows, epoch, path)
    name = "scored_" + path.rsplit("-", 1)[1]
    catalog.register(spark, name, path)
    catalog.refresh(spark, name)
    return spark.sql(
        f"""
        SELECT category, final_fraud_status, count(*) AS n, CAST(sum(amt) AS DOUBLE) AS amount
        FROM {name} WHERE year = 2024 AND month = 1
        GROUP BY category, final_fraud_status
        """
    )


@query
def schema_merge_read(spark, sf_dir):
    """An old part without the column `channel` and a newer part with it, read as one table."""
    path = new_dir(spark, "merge")
    (_, old), (_, new) = _epochs(fx.transactions(spark, sf_dir).select("trans_num", "amt", "event_time"))
    old.drop("event_time").write.parquet(f"{path}/part=0")
    new.drop("event_time").withColumn(
        "channel", F.when(F.col("amt") > 500, "branch").otherwise("online")
    ).write.parquet(f"{path}/part=1")
    return spark.read.option("mergeSchema", True).parquet(path).select(
        "trans_num", num("amt"), "channel", "part"
    )


@query
def schema_evolved(spark, sf_dir):
    """Three generations as one table: an amount that grew from int to long, a renamed field, a new one, and messages with a
    field that no layout knows, kept as a variant."""
    paths = [new_dir(spark, f"generation-{i}") for i in range(3)]
    n, amt = F.col("trans_num").cast("bigint"), F.floor("amt")
    rows = fx.transactions(spark, sf_dir).withColumn("channel", F.when(F.col("amt") > 500, "branch").otherwise("online"))
    rows.where(n % 3 == 0).select("trans_num", amt.cast("int").alias("amt"), "merchant").write.parquet(paths[0])
    large = (amt * 10_000_000_000).cast("bigint").alias("amt")
    rows.where(n % 3 == 1).select("trans_num", large, "merchant", "channel").write.parquet(paths[1])
    device = F.struct(F.concat(F.lit("os"), n % 4).alias("os"), n.alias("n")).alias("device")
    newest = rows.where(n % 3 == 2)
    messages = payload.encode(newest.where(n % 2 == 0).select("trans_num", large, F.col("merchant").alias("shop"), "channel", device))
    older = payload.encode(newest.where(n % 2 == 1).select("trans_num", large, "merchant", "channel"))
    ddl, renames = "trans_num string, amt bigint, shop string, channel string", {"merchant": "shop"}
    opened = evolution.decode_open(messages.unionAll(older), ddl, renames=renames)
    opened.drop(schemas.CORRUPT_COLUMN).write.parquet(paths[2])
    found = evolution.read_generations(spark, paths, renames=renames)
    return found.select(
        "trans_num", "amt", "shop", "channel",
        F.try_variant_get(F.col("other_fields")["device"], "$.os", "string").alias("device_os"),
        F.try_variant_get(F.col("other_fields")["device"], "$.n", "bigint").alias("device_n"),
    )


# --- Reports -------------------------------------------------------------------------------------------------------


def _report(df):
    return df.withColumns(
        {"fraud_rate": F.round("fraud_rate", 8), "fraud_amount": F.round("fraud_amount", 2)}
    )


@query
def report_cube_refreshed(spark, sf_dir):
    """Five reports kept up to date epoch by epoch from the new rows alone."""
    cube = EpochTable(spark, new_dir(spark, "cube"), merge=analytics.add_cubes, fan=2)
    n = F.col("trans_num").cast("bigint")
    for epoch in range(4):
        cube.write(analytics.report_cube(_off_scored(spark, sf_dir).where(n % 4 == epoch)), epoch)
        cube.compact(before=epoch)
    return cube.read()


@query
def fraud_by_category_maintained(spark, sf_dir):
    """A report taken from the cube."""
    cube = stored(analytics.report_cube(_off_scored(spark, sf_dir)), "cube")
    return _report(analytics.report_of(cube, "category"))


@query
def fraud_by_category(spark, sf_dir):
    return _report(analytics.fraud_by(_off_scored(spark, sf_dir), "category"))


@query
def fraud_by_hour(spark, sf_dir):
    return _report(analytics.fraud_by(_off_scored(spark, sf_dir), "hour"))


@query
def fraud_by_state(spark, sf_dir):
    return _report(analytics.fraud_by(_off_scored(spark, sf_dir), "state"))


@query
def fraud_by_month(spark, sf_dir):
    return _report(analytics.fraud_by(_off_scored(spark, sf_dir), "year", "month", "day"))


@query
def top_cards_by_fraud_amount(spark, sf_dir):
    return analytics.top_by_fraud_amount(_off_scored(spark, sf_dir), "cc_num")


@query
def top_merchants_by_fraud_amount(spark, sf_dir):
    return analytics.top_by_fraud_amount(_off_scored(spark, sf_dir), "merchant")


# --- Models --------------------------------------------------------------------------------------------------------


_fitted: dict = {}


def _trained(spark, sf_dir):
    """(models, profile) trained once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _fitted:
        profile = stored(inline_profile(spark, sf_dir), "profile")
        _fitted[key] = (applications.train(fx.history(spark, sf_dir), profile), profile)
    return _fitted[key]


def _arrival_features(spark, sf_dir):
    fitted, profile = _trained(spark, sf_dir)
    return fitted, applications.features_of(fx.arrivals(spark, sf_dir), profile)


@query
def scaled_features(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    columns = C.CLUSTER_FEATURES
    tx = features.with_distance(
        features.with_amounts(features.with_calendar(fx.transactions(spark, sf_dir)))
    )
    inputs = models.with_inputs(tx, columns).select("trans_num", *[models.INPUT + c for c in columns])
    scaled = models.scaled_pipeline(columns, "scaled").fit(inputs).transform(inputs)
    values = vector_to_array("scaled")
    return scaled.select(
        "trans_num", *[num(values[i], 4).alias(f"scaled_{c}") for i, c in enumerate(columns)]
    )


def _counted(measured, *more):
    """What must hold of measures whatever the model says: rows, positives, and that the counts add up."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return measured.select(
        *more, "n", (tp + fn).alias("positives"), (tp + fp + fn + tn == F.col("n")).alias("counts_add_up")
    )


@query
def rf_score(spark, sf_dir):
    fitted, rows = _arrival_features(spark, sf_dir)
    p, confidence = F.col("ml_fraud_score"), F.col("prediction_confidence")
    return models.classify(rows, fitted.classifier).select(
        "trans_num", num("is_fraud"), p.between(0, 1).alias("score_in_range"),
        (F.abs(confidence - F.greatest(p, 1 - p)) < 1e-9).alias("confidence_is_the_larger"),
        ((p > 0.5) == (F.col("prediction") == 1)).alias("class_agrees"),
    )


@query
def rf_holdout_metrics(spark, sf_dir):
    """Quality on the hold-out split of the history, which training does not see."""
    fitted, profile = _trained(spark, sf_dir)
    rows = applications.features_of(fx.history(spark, sf_dir), profile)
    _, holdout = models.split_holdout(rows)
    return _counted(models.evaluate(models.classify(holdout, fitted.classifier)))


@query
def model_quality(spark, sf_dir):
    """Bounds that a model which has learned nothing does not meet: frauds found and false alarms of the classifier on the
    hold-out rows, its order of frauds before others, and the part of the spread that the clusters explain."""
    fitted, profile = _trained(spark, sf_dir)
    rows = applications.features_of(fx.history(spark, sf_dir), profile)
    holdout = models.classify(models.split_holdout(rows)[1], fitted.classifier)
    flagged = holdout.withColumn("flag", F.col("prediction").cast("int"))
    found = metrics.classification_metrics(flagged, "is_fraud", "flag")
    means = holdout.agg(
        F.avg(F.when(F.col("is_fraud") == 1, F.col("ml_fraud_score"))).alias("of_frauds"),
        F.avg(F.when(F.col("is_fraud") == 0, F.col("ml_fraud_score"))).alias("of_others"),
    )
    near = models.with_inputs(rows, C.CLUSTER_FEATURES)
    scaled = [F.col(models.INPUT + c) / s for c, s in zip(C.CLUSTER_FEATURES, fitted.clusters.scale)]
    distances = [sum(((v - x) * (v - x) for v, x in zip(scaled, centre)), F.lit(0.0)) for centre in fitted.clusters.centres]
    spread = near.agg(F.avg(F.least(*distances)).alias("inside"), sum((F.var_pop(v) for v in scaled), F.lit(0.0)).alias("whole"))
    checks = [
        (found, "finds_frauds", F.col("detection_rate") >= 0.5), (found, "few_false_alarms", F.col("false_positive_rate") <= 0.05),
        (means, "frauds_score_higher", F.col("of_frauds") - F.col("of_others") >= 0.5),
        (spread, "clusters_explain", F.col("inside") <= 0.7 * F.col("whole")),
    ]
    parts = [df.select(F.lit(name).alias("check"), c.alias("holds")) for df, name, c in checks]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query
def kmeans_assign(spark, sf_dir):
    fitted, rows = _arrival_features(spark, sf_dir)
    centres, scale = fitted.clusters.centres, fitted.clusters.scale
    near = anomaly.nearest_centre(rows, centres, scale)
    inputs = models.with_inputs(near, C.CLUSTER_FEATURES)
    distances = [
        F.sqrt(sum((F.col(models.INPUT + c) / F.lit(s) - F.lit(x)) ** 2 for c, s, x in zip(C.CLUSTER_FEATURES, scale, centre)))
        for centre in centres
    ]
    return inputs.select(
        "trans_num", F.col("cluster").between(0, len(centres) - 1).alias("cluster_exists"),
        (F.abs(F.col("centre_distance") - F.least(*distances)) < 1e-6).alias("is_nearest"),
    )


def _near_given(spark, sf_dir):
    tx = features.with_distance(
        features.with_amounts(features.with_calendar(fx.transactions(spark, sf_dir)))
    )
    return anomaly.nearest_centre(tx, GIVEN_CENTRES, GIVEN_SCALE)


@query
def anomaly_by_cluster(spark, sf_dir):
    return anomaly.score_by_cluster(_near_given(spark, sf_dir)).select(
        "trans_num", "cluster", "anomaly_score"
    )


@query
def anomaly_by_distance(spark, sf_dir):
    return anomaly.score_by_distance(_near_given(spark, sf_dir), GIVEN_TYPICAL).select(
        "trans_num", "cluster", num("centre_distance", 4), num("anomaly_score", 4)
    )


@query
def final_status_models_on(spark, sf_dir):
    fitted, rows = _arrival_features(spark, sf_dir)
    by_rule = (F.col("distance") > 1500) & (F.col("amt") > 500)
    said = (F.col("ml_fraud_score") > 0.7) | (F.col("anomaly_score") > 0.8) | by_rule
    level = F.col("risk_level")
    return models.score(rows, fitted).select(
        "trans_num", by_rule.alias("by_rule"),
        (F.col("final_fraud_status") == F.when(said, "FRAUD").otherwise("GENUINE")).alias("status_follows_scores"),
        (~by_rule | (F.col("final_fraud_status") == "FRAUD")).alias("rule_is_kept"),
        (F.col("alert_generated") == level.isin("HIGH_RISK", "MEDIUM_RISK")).alias("alert_follows_level"),
    )


@query
def model_roundtrip(spark, sf_dir):
    """Scores of the stored and re-read models next to those of the models in memory."""
    fitted, rows = _arrival_features(spark, sf_dir)
    root = new_dir(spark, "models")
    models.save_models(spark, fitted, root, 1)
    again = models.load_models(spark, root)
    both = models.score(rows, fitted).select(
        "trans_num", F.col("ml_fraud_score").alias("m"), F.col("anomaly_score").alias("a")
    ).join(
        models.score(rows, again).select("trans_num", "ml_fraud_score", "anomaly_score"), "trans_num"
    )
    same = (F.col("m") == F.col("ml_fraud_score")) & (F.col("a") == F.col("anomaly_score"))
    return both.groupBy(same.alias("same")).agg(F.count(F.lit(1)).alias("n"))


@query
def retrain_compare(spark, sf_dir):
    fitted, profile = _trained(spark, sf_dir)
    rows = applications.features_of(fx.history(spark, sf_dir), profile)
    _, compared = models.retrain(rows, fitted.classifier, days=14)
    one = F.sum(F.col("promoted").cast("int")).over(Window.partitionBy()) == 1
    return _counted(compared.withColumn("one_promoted", one), "model", "one_promoted")


@query
def retrain_promote(spark, sf_dir):
    """The registry after two rounds of retraining: three versions, the newest promoted one is what streams load."""
    fitted, profile = _trained(spark, sf_dir)
    rows = stored(applications.features_of(fx.history(spark, sf_dir), profile), "features")
    root = new_dir(spark, "promoted")
    models.save_models(spark, fitted, root, 1)
    for days in (14, 21):
        models.retrain_and_promote(spark, rows, root, days)
    newest = models.newest_version(spark, root)
    loaded = models.load_models(spark, root)
    return models.registry(spark, root).select(
        "version", F.array_join("parts", ",").alias("parts"),
        ((F.col("version") != newest) | F.col("promoted")).alias("newest_is_promoted"),
        F.lit(loaded.classifier is not None and loaded.clusters == fitted.clusters).alias("loads"),
    )


@query
def ab_metrics(spark, sf_dir):
    """Arm A scored by the classifier with alerts as flags, arm B by the fixed rule."""
    fitted, rows = _arrival_features(spark, sf_dir)
    scored = models.score_by_arm(
        rows,
        lambda df: models.score(df, fitted).select("arm", "is_fraud", "final_fraud_status"),
        lambda df: models.score(df).select("arm", "is_fraud", "final_fraud_status"),
    ).withColumn("flag", (F.col("final_fraud_status") == "FRAUD").cast("int"))
    return _counted(metrics.classification_metrics(scored, "is_fraud", "flag", ("arm",)), "arm")
