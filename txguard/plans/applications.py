"""The two applications end to end, as batch jobs and as streams."""

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from txguard.config import FraudConfig
from txguard.operators import rules
from txguard.operators.enrichment import with_customer
from txguard.operators.features import score_features, with_event_time
from txguard.operators.profiles import last_average
from txguard.operators.skew import heavy_keys, lookup_plan
from txguard.plans import profiles
from txguard.plans.models import FraudModels, score, split_holdout, train_or_fall_back
from txguard.schemas import CORRUPT_COLUMN
from txguard.sinks.customers import write_customers
from txguard.sinks.tables import (
    scored_sink, write_alerts, write_bad_messages, write_deidentified, write_quality, write_scored,
)
from txguard.sources.payload import is_corrupt
from txguard.streaming.runner import start_scoring


def score_batch(
    tx: DataFrame,
    profile: DataFrame,
    models: FraudModels = FraudModels(),
    config: FraudConfig = FraudConfig(),
    ts: str = "event_time",
) -> DataFrame:
    """Features, scores, alerts and status of a bounded frame, however its cards are distributed.

    `profile` should be stored (`plans.profiles`): it is counted to choose the join.
    """
    return score(features_of(tx, profile, config, ts), models, config)


def features_of(
    tx: DataFrame,
    profile: DataFrame,
    config: FraudConfig = FraudConfig(),
    ts: str = "event_time",
    count_rows: bool = False,
    profile_rows: int | None = None,
) -> DataFrame:
    """`count_rows` and `profile_rows` are for micro-batches, see `operators.skew.lookup_plan`."""
    if ts not in tx.columns:
        tx = with_event_time(tx, out=ts)
    profile, heavy = lookup_plan(
        tx, profile, "cc_num", config.heavy_rows, config.broadcast_rows, count_rows, profile_rows
    )
    return score_features(tx, profile, heavy, ts)


def flag_batch(
    tx: DataFrame, history: DataFrame, how: str = "inner", combine: str = "and", **limits
) -> DataFrame:
    """The rule-only application: mean of the last amounts, distance, status."""
    heavy = heavy_keys(tx, "cc_num")
    return rules.relative_rule(tx, last_average(history), how, combine, heavy=heavy, **limits)


def train(history: DataFrame, profile: DataFrame, config: FraudConfig = FraudConfig()) -> FraudModels:
    """Models from the training split of the history, through the same features as scoring, so
    that the hold-out split (`plans.models.split_holdout`) stays fair for measuring and comparing.

    The profile contains the training rows themselves; `operators.profiles.asof_profile` gives
    statistics without them.
    """
    training, _ = split_holdout(features_of(history, profile, config))
    return train_or_fall_back(training, config)


def start_scored_stream(
    spark: SparkSession,
    stream: DataFrame,
    profile_root: str,
    tables: str,
    name: str,
    checkpoint: str,
    models: Callable[[], FraudModels] = FraudModels,
    config: FraudConfig = FraudConfig(),
    fmt: str = "parquet",
    customers: dict | None = None,
    available_now: bool = False,
    enrich: Callable[[], DataFrame] | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Scored transactions to `tables`/scored, alerts to `tables`/alerts and customers to
    `customers` (arguments of `write_customers`; files under `tables`/customers by default).
    A quality report per micro-batch goes to `tables`/quality. Of a stream from `payload.decode`, messages that
    could not be decoded go to `tables`/bad_messages and are not scored. With `enrich`, looked up in every micro-batch,
    scored rows carry the columns of their customer, prefixed `customer_`. With `compact_every` the scored rows are an
    `EpochTable`, whose epochs are merged into partitioned files every so many; otherwise a partitioned folder per epoch.

    New versions of the profile take effect in the running query, and so do new models if
    `models` looks them up; it is called in every micro-batch. Scored rows name the versions that made them
    (`profile_version`, `model_version`), as the replay of an epoch may use newer ones.
    """
    customers = customers or {"fmt": fmt, "path": f"{tables}/customers"}

    current = profiles.CurrentProfile(spark, profile_root)

    decoded = CORRUPT_COLUMN in stream.columns

    def good(batch: DataFrame) -> DataFrame:
        return batch.where(~is_corrupt()).drop(CORRUPT_COLUMN) if decoded else batch

    def score_one(batch: DataFrame) -> DataFrame:
        batch = good(batch)
        profile, size = current.of(batch)
        rows = features_of(batch, profile, config, count_rows=True, profile_rows=size)
        chosen = models()
        scored = score(rows, chosen, config).withColumns(
            {
                "profile_version": F.lit(current.version).cast("bigint"),
                "model_version": F.lit(chosen.version).cast("bigint"),
            }
        )
        return with_customer(scored, enrich()) if enrich else scored

    def check(batch: DataFrame, epoch_id: int) -> None:
        write_quality(good(batch), epoch_id, f"{tables}/quality", fmt)
        if decoded:
            write_bad_messages(batch, epoch_id, f"{tables}/bad_messages", fmt)

    if compact_every:
        write_all = scored_sink(spark, f"{tables}/scored", compact_every)
    else:
        write_all = partial(write_scored, path=f"{tables}/scored", fmt=fmt)
    sinks = [
        write_all,
        partial(write_alerts, path=f"{tables}/alerts", fmt=fmt),
        partial(write_customers, **customers),
    ]
    trigger = None if available_now else config.trigger
    return start_scoring(stream, score_one, sinks, name, checkpoint, trigger, [check])


def start_flagged_stream(
    spark: SparkSession,
    stream: DataFrame,
    averages_root: str,
    tables: str,
    name: str,
    checkpoint: str,
    how: str = "left",
    combine: str = "and",
    config: FraudConfig = FraudConfig(),
    fmt: str = "parquet",
    available_now: bool = False,
) -> StreamingQuery:
    """The rule-only stream: flagged rows without personal columns to `tables`/flagged, and the
    customers of all rows with their label to `tables`/customers. With `how="inner"` rows of cards
    that have no mean are not flagged at all. Of a stream from `payload.decode`, messages that could not be decoded go to
    `tables`/bad_messages and are not flagged."""

    current = profiles.CurrentProfile(spark, averages_root)
    decoded = CORRUPT_COLUMN in stream.columns

    def flag_one(batch: DataFrame) -> DataFrame:
        batch = batch.where(~is_corrupt()).drop(CORRUPT_COLUMN) if decoded else batch
        averages, size = current.of(batch)
        averages, heavy = lookup_plan(
            batch, averages, "cc_num", config.heavy_rows, config.broadcast_rows, count_facts=True, dim_rows=size,
        )
        return rules.relative_rule(
            batch, averages, "left", combine, config.distance_km, config.amount, heavy
        )

    def write_flagged(batch: DataFrame, epoch_id: int) -> None:
        if how == "inner":
            batch = batch.where(F.col("avg_transaction_amt").isNotNull())
        write_deidentified(batch, epoch_id, f"{tables}/flagged", fmt)

    sinks = [
        write_flagged,
        partial(write_customers, status="is_fraud", fmt=fmt, path=f"{tables}/customers"),
    ]
    raw = [partial(write_bad_messages, path=f"{tables}/bad_messages", fmt=fmt)] if decoded else []
    trigger = None if available_now else config.trigger
    return start_scoring(stream, flag_one, sinks, name, checkpoint, trigger, raw)
