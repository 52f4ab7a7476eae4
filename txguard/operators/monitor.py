"""Rates over event-time windows, and what stands out. Works on batch and streaming frames.

The frames need `event_ts`, a TIMESTAMP (watermarks accept no other type). Window bounds come
out as epoch seconds, so results do not depend on the session time zone.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.constants import ERROR_RATE_LIMIT, SPIKE_INCREASE


def with_event_ts(df: DataFrame, unix_time: str = "unix_time") -> DataFrame:
    return df.withColumn("event_ts", F.timestamp_seconds(F.col(unix_time).try_cast("bigint")))


def _rate_windows(df, condition, width, late, by, names):
    if late is not None:
        df = df.withWatermark("event_ts", late)
    hits, rate = names
    counted = df.groupBy(F.window("event_ts", width), *by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(condition).alias(hits)
    )
    return counted.select(
        F.unix_seconds("window.start").alias("window_start"),
        F.unix_seconds("window.end").alias("window_end"),
        *by, "n", hits, (F.col(hits) / F.col("n")).alias(rate),
    )


def fraud_rate_windows(df: DataFrame, fraud, width="1 day", late=None, by=()) -> DataFrame:
    return _rate_windows(df, fraud, width, late, by, ("frauds", "fraud_rate"))


def error_rate_windows(df: DataFrame, bad, width="1 day", late=None, by=()) -> DataFrame:
    rates = _rate_windows(df, bad, width, late, by, ("errors", "error_rate"))
    return rates.withColumn("over_limit", F.col("error_rate") > ERROR_RATE_LIMIT)


def fraud_spikes(rates: DataFrame, by=(), increase: float = SPIKE_INCREASE) -> DataFrame:
    """Windows whose fraud rate is more than `increase` above that of the window just before.

    Each rate row is sent to its own window and to the next one and the two are grouped, so no
    task has to see all windows in order. The increase is relative to the earlier rate.
    """
    width = F.col("window_end") - F.col("window_start")
    both = rates.withColumn(
        "_side",
        F.explode(
            F.array(
                F.struct(F.col("window_start").alias("at"), F.lit(True).alias("own")),
                F.struct((F.col("window_start") + width).alias("at"), F.lit(False).alias("own")),
            )
        ),
    )
    own = F.col("_side.own")
    paired = both.groupBy(F.col("_side.at").alias("window_start"), *by).agg(
        F.max(F.when(own, F.col("fraud_rate"))).alias("fraud_rate"),
        F.max(F.when(~own, F.col("fraud_rate"))).alias("previous_rate"),
    )
    rise = F.try_divide(F.col("fraud_rate") - F.col("previous_rate"), F.col("previous_rate"))
    return (
        paired.where(F.col("fraud_rate").isNotNull())
        .withColumn("increase", rise)
        .withColumn("is_spike", F.coalesce(F.col("increase") > increase, F.lit(False)))
    )
