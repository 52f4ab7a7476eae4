"""Per-card statistics over history."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txguard.constants import HEAVY_ROWS, LAST_N
from txguard.functions import time as T
from txguard.operators.skew import own_group, split_heavy


def card_profile(history: DataFrame) -> DataFrame:
    """Six statistics per card. `history` needs `distance`. Partial aggregation keeps hot cards cheap."""
    amt = F.col("amt").cast("double")
    return history.groupBy("cc_num").agg(
        F.avg(amt).alias("avg_amount"),
        F.stddev_samp(amt).alias("std_amount"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.max("amt").alias("max_amount"),
        F.min("amt").alias("min_amount"),
        F.avg("distance").alias("avg_distance"),
    )


def profile_state(history: DataFrame) -> DataFrame:
    """What `card_profile` is made of, in a form that adds up: one row per card.

    With a stored state a refresh reads only the new transactions (`merge_states`), never the
    whole history again. Money is summed as exact decimals.
    """
    amt = F.col("amt")
    return history.groupBy("cc_num").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(amt).alias("amounts"),
        F.sum(amt.cast("decimal(18,2)")).cast("decimal(38,2)").alias("sum_amount"),
        F.sum((amt * amt).cast("decimal(28,4)")).cast("decimal(38,4)").alias("sum_square"),
        F.max(amt).alias("max_amount"),
        F.min(amt).alias("min_amount"),
        F.count("distance").alias("distances"),
        F.sum("distance").alias("sum_distance"),
    )


def merge_states(old: DataFrame, new: DataFrame) -> DataFrame:
    """State of both parts together. The parts must not share transactions."""
    kinds = dict(old.dtypes)
    pick = {"max_amount": F.max, "min_amount": F.min}
    return (
        old.unionByName(new)
        .groupBy("cc_num")
        .agg(
            *[
                pick.get(c, F.sum)(c).cast(kinds[c]).alias(c)
                for c in old.columns
                if c != "cc_num"
            ]
        )
    )


def profile_of_state(state: DataFrame) -> DataFrame:
    """The six statistics of `card_profile` from a state."""
    return state.select(
        "cc_num",
        F.try_divide(F.col("sum_amount").cast("double"), F.col("amounts")).alias("avg_amount"),
        _deviation("amounts", "sum_amount", "sum_square").alias("std_amount"),
        F.col("rows").alias("total_transactions"),
        "max_amount",
        "min_amount",
        F.try_divide(F.col("sum_distance"), F.col("distances")).alias("avg_distance"),
    )


def _deviation(n: str, s: str, q: str):
    """Sample deviation from count, sum and sum of squares. n*q - s*s is taken on exact
    decimals, so equal amounts give exactly zero."""
    count = F.col(n).cast("double")
    spread = (F.col(n) * F.col(q) - F.col(s) * F.col(s)).cast("double")
    return F.sqrt(F.try_divide(spread, count * (count - 1)))


def last_transactions(history: DataFrame, n: int = LAST_N) -> DataFrame:
    """The newest `n` rows per card, newest first in `row_num`.

    Recency compares times as numbers, then transaction ids, then amounts. Spark cuts each card to `n` rows
    per input partition before the shuffle (WindowGroupLimit), so a hot card costs no more
    than n rows per map task. The newest n of (stored newest n and new rows) are the newest n of
    all, so a refresh needs no old history.
    """
    newest = Window.partitionBy("cc_num").orderBy(
        T.epoch_seconds().desc_nulls_last(), F.col("trans_num").desc_nulls_last(), F.col("amt").desc_nulls_last()
    )
    return history.withColumn("row_num", F.row_number().over(newest)).where(F.col("row_num") <= n)


def last_average(history: DataFrame, n: int = LAST_N) -> DataFrame:
    recent = last_transactions(history.select("cc_num", "trans_num", "unix_time", "amt"), n)
    return recent.groupBy("cc_num").agg(
        F.avg(F.col("amt").cast("double")).alias("avg_transaction_amt")
    )


def asof_profile(df: DataFrame, min_rows: int = HEAVY_ROWS) -> DataFrame:
    """Per row: count, mean and deviation of the card's amounts at strictly earlier seconds.

    Unlike `card_profile` the row never sees itself or its future, so training rows carry no
    leak. Sums are kept as exact decimals, which makes the split for heavy cards exact:

    * ordinary cards: one running window per card;
    * heavy cards: aggregated to one row per second, running sums inside each day plus the
      total of earlier days, joined back. No window group holds more than 86,400 rows.
    """
    rows = df.withColumn("_sec", T.epoch_seconds()).withColumn(
        "_card", F.when(F.col("_sec").isNotNull(), F.col("cc_num"))
    )
    amt = F.col("amt")
    parts = {
        "_n": F.count(amt),
        "_s": F.sum(amt.cast("decimal(18,2)")),
        "_q": F.sum((amt * amt).cast("decimal(28,4)")),
    }
    names = list(parts)
    to_here = (Window.unboundedPreceding, -1)
    ordinary, heavy = split_heavy(rows, "_card", min_rows)

    # Rows of no card are a group each, so they are spread and have nothing before them.
    ordinary = ordinary.withColumn("_group", F.when(F.col("_card").isNull(), own_group()))
    earlier = Window.partitionBy("_card", "_group").orderBy("_sec").rangeBetween(*to_here)
    ordinary = ordinary.withColumns(
        {name: part.over(earlier) for name, part in parts.items()}
    ).drop("_group")

    per_second = heavy.groupBy("_card", "_sec").agg(
        *[part.alias(name) for name, part in parts.items()]
    ).withColumn("_day", F.floor(F.col("_sec") / T.DAY))
    before_today = Window.partitionBy("_card").orderBy("_day").rangeBetween(*to_here)
    per_day = (
        per_second.groupBy("_card", "_day")
        .agg(*[F.sum(n).alias(n) for n in names])
        .select("_card", "_day", *[F.sum(n).over(before_today).alias(f"{n}_days") for n in names])
    )
    today = Window.partitionBy("_card", "_day").orderBy("_sec").rangeBetween(*to_here)
    zero = F.lit(0)
    running = (
        per_second.withColumns({f"{n}_today": F.sum(n).over(today) for n in names})
        .join(per_day, ["_card", "_day"])
        .select(
            "_card", "_sec",
            *[
                (F.coalesce(f"{n}_today", zero) + F.coalesce(f"{n}_days", zero)).alias(n)
                for n in names
            ],
        )
    )
    joined = ordinary.unionByName(heavy.join(running, ["_card", "_sec"]))

    # A window frame over a null time holds the row itself, so rows of no card are masked.
    known = F.col("_card").isNotNull()
    count = F.when(known, F.col("_n").cast("bigint"))
    mean = F.try_divide(F.col("_s").cast("double"), F.col("_n").cast("double"))
    return joined.withColumns(
        {
            "prior_count": F.coalesce(count, F.lit(0).cast("bigint")),
            "prior_avg": F.when(known, mean),
            "prior_std": F.when(known, _deviation("_n", "_s", "_q")),
        }
    ).drop("_card", "_sec", *names)
