"""Per-row features. Every function takes and returns a DataFrame, batch or streaming."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import constants as C
from txguard.functions import geo
from txguard.functions import time as T
from txguard.operators.skew import lookup_join


def with_event_time(
    df: DataFrame, unix_time: str = "unix_time", out: str = "event_time"
) -> DataFrame:
    return df.withColumn(out, T.event_time(unix_time))


def with_calendar(df: DataFrame, ts: str = "event_time") -> DataFrame:
    return df.withColumns(T.calendar_parts(ts))


def with_amounts(df: DataFrame) -> DataFrame:
    amt = F.col("amt")
    return df.withColumns(
        {
            "amount_log": F.log1p(amt.cast("double")),
            "amount_squared": amt * amt,
            "is_high_value": F.coalesce(amt > C.HIGH_VALUE, F.lit(False)),
            "is_low_value": F.coalesce(amt < C.LOW_VALUE, F.lit(False)),
        }
    )


def with_distance(df: DataFrame) -> DataFrame:
    return df.withColumn("distance", geo.haversine_km("lat", "long", "merch_lat", "merch_long"))


def with_behaviour(
    df: DataFrame, profile: DataFrame, how: str = "left", heavy: DataFrame | None = None
) -> DataFrame:
    """Joins the card profile and adds the deviation of the amount in standard deviations.

    Cards not in the profile keep nulls; so do cards whose deviation is undefined (one row,
    or no spread). Neither counts as unusual.
    """
    joined = lookup_join(df, profile, "cc_num", how, heavy, spread="trans_num")
    deviation = F.try_divide(F.col("amt").cast("double") - F.col("avg_amount"), F.col("std_amount"))
    return joined.withColumn("amount_deviation", deviation).withColumn(
        "is_unusual_amount",
        F.coalesce(F.abs("amount_deviation") > C.UNUSUAL_DEVIATION, F.lit(False)),
    )


def score_features(
    df: DataFrame, profile: DataFrame, heavy: DataFrame | None = None, ts: str = "event_time"
) -> DataFrame:
    """All features of one transaction frame: the same chain for training and for scoring."""
    return with_behaviour(with_distance(with_amounts(with_calendar(df, ts))), profile, heavy=heavy)


def model_inputs(df: DataFrame, columns=C.CLASSIFIER_FEATURES, prefix: str = "") -> DataFrame:
    """Makes every model input a non-null double: absent columns and nulls become 0.0.

    Without `prefix` the columns are replaced, with it they are added next to the features.
    """
    present = set(df.columns)
    return df.withColumns(
        {
            prefix + c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
            if c in present
            else F.lit(0.0)
            for c in columns
        }
    )


def labelled(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_fraud").isNotNull())
