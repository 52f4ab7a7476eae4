"""How fast and how unlike before a card is used: gap, ratio and rolling totals."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txguard.constants import HEAVY_ROWS
from txguard.functions import time as T
from txguard.operators.skew import heavy_keys, own_group, split_heavy
from txguard.plans.workspace import stored

ROLLING = {"1h": T.HOUR, "24h": T.DAY}


def with_velocity(df: DataFrame, min_rows: int = HEAVY_ROWS) -> DataFrame:
    """Adds, per transaction in the order (second, trans_num, amt) of its card:

    * `secs_since_prev`, `amt_ratio_prev`: against the card's previous transaction;
    * `tx_count_1h`, `amt_sum_1h`, `tx_count_24h`, `amt_sum_24h`: number and known amounts of the
      seconds up to and including this one, back to exactly that long ago.

    Rows without card or time get nulls. Cards with `min_rows` rows or more go another way with
    the same result, see `_heavy`; whether there are any is counted first, and their rows are
    written once. All columns of `df` are shuffled once; select those needed first.
    """
    card = F.col("cc_num")
    rows = df.withColumn("_sec", T.epoch_seconds()).withColumn(
        "_card", F.when(F.col("_sec").isNotNull(), card)
    )
    if heavy_keys(rows, "_card", min_rows).isEmpty():
        joined = _ordinary(rows)
    else:
        ordinary, heavy = split_heavy(rows, "_card", min_rows)
        joined = _ordinary(ordinary).unionByName(_heavy(stored(heavy, "heavy-cards"), min_rows))
    known = F.col("_card").isNotNull()
    made = ["secs_since_prev", *[f"{t}_{k}" for k in ROLLING for t in ("tx_count", "amt_sum")]]
    return joined.withColumns(
        {
            "amt_ratio_prev": F.try_divide(
                F.col("amt").cast("double"), F.col("_prev_amt").cast("double")
            ),
            **{c: F.when(known, F.col(c)) for c in made},
        }
    ).drop("_card", "_sec", "_prev_amt")


def _rolling(rows: DataFrame, group: list[str], n, amount) -> DataFrame:
    """Adds the rolling totals of `n` and `amount` within `group`.

    Every row enters at its second and leaves each span one second after the span's end; a
    running total over these events is the rolling total. This is linear in the rows. A sliding
    window frame would add up all rows of the span again for each row, which is quadratic for
    cards used very often. Leaving events carry no row, so they are small; `amount` is in cents,
    so adding and taking away is exact.
    """
    kept = [c for c in rows.columns if c not in group]
    row = F.struct(*kept)
    zero = amount * 0

    def event(at, into, sign, payload):
        deltas = []
        for k in ROLLING:
            deltas.append((n * sign if k in into else n * 0).alias(f"_n_{k}"))
            deltas.append((amount * sign if k in into else zero).alias(f"_s_{k}"))
        return F.struct(at.alias("_at"), *deltas, payload.alias("_row"))

    events = [event(F.col("_sec"), ROLLING, 1, row)]
    nothing = F.when(F.lit(False), row)
    for k, width in ROLLING.items():
        events.append(event(F.col("_sec") + width + 1, (k,), -1, nothing))
    so_far = (
        Window.partitionBy(*group).orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    )
    totals = {}
    for k in ROLLING:
        totals[f"tx_count_{k}"] = F.sum(f"_n_{k}").over(so_far)
        totals[f"amt_sum_{k}"] = F.sum(f"_s_{k}").over(so_far) / F.lit(100.0)
    return (
        rows.select(*group, F.explode(F.array(*events)).alias("_event"))
        .select(*group, "_event.*")
        .withColumns(totals)
        .where(F.col("_row").isNotNull())
        .select(*group, "_row.*", *totals)
    )


def _ordinary(rows: DataFrame) -> DataFrame:
    # Rows of no card are a group each, so they are spread and find no previous row.
    rows = rows.withColumn("_group", F.when(F.col("_card").isNull(), own_group()))
    in_order = Window.partitionBy("_card", "_group").orderBy("_sec", "trans_num", "amt")
    rows = rows.withColumns(
        {
            "secs_since_prev": F.col("_sec") - F.lag("_sec").over(in_order),
            "_prev_amt": F.lag("amt").over(in_order),
        }
    )
    return _rolling(rows, ["_card", "_group"], F.lit(1).cast("bigint"), _amount()).drop("_group")


def _amount():
    """Amount in cents, 0 where unknown. Long sums are exact and much faster than wide decimals."""
    return F.coalesce((F.col("amt").cast("decimal(14,2)") * 100).cast("bigint"), F.lit(0).cast("bigint"))


def _within_second(rows: DataFrame, min_rows: int) -> DataFrame:
    """Adds `_same`: the amount of the row before in the same card and second, null for the first one.

    Seconds of fewer than `min_rows` rows are windows. The rows of others are dealt into ranges in their order,
    each range is a window of its own, and the first row of a second in a range gets the last one of the range before: a
    frame with a row per card, second and range.
    """
    in_second = Window.partitionBy("_card", "_sec").orderBy("trans_num", "amt")
    crowded = rows.groupBy("_card", "_sec").count().where(F.col("count") >= min_rows).select("_card", "_sec")
    previous = F.lag(F.struct("amt"))
    if crowded.isEmpty():
        return rows.withColumn("_same", previous.over(in_second))
    crowded = F.broadcast(crowded)  # rows / min_rows of them at most
    usual = rows.join(crowded, ["_card", "_sec"], "left_anti").withColumn("_same", previous.over(in_second))

    order = ["_card", "_sec", "trans_num", "amt"]
    dense = rows.join(crowded, ["_card", "_sec"], "left_semi").withColumn("_from", F.spark_partition_id())
    dense = dense.repartitionByRange(*order, "_from").sortWithinPartitions(*order, "_from").drop("_from")
    dense = stored(dense.withColumn("_at", F.monotonically_increasing_id()), "dense-seconds")
    dense = dense.withColumn("_range", F.shiftright("_at", 33))
    in_range = Window.partitionBy("_range", "_card", "_sec").orderBy("_at")
    ends = dense.groupBy("_card", "_sec", "_range").agg(F.max_by(F.struct("amt"), "_at").alias("_end"))
    ranges = Window.partitionBy("_card", "_sec").orderBy("_range")
    ends = ends.select("_card", "_sec", "_range", F.lag("_end").over(ranges).alias("_carried"))
    dense = dense.withColumn("_same", previous.over(in_range)).join(ends, ["_card", "_sec", "_range"])
    dense = dense.withColumn("_same", F.coalesce("_same", "_carried"))
    return usual.unionByName(dense.drop("_at", "_range", "_carried"))


def _heavy(rows: DataFrame, min_rows: int) -> DataFrame:
    """Heavy cards are first aggregated to one row per card and second.

    Rolling totals run over those rows in day blocks, each with the day before as context: at
    most 172,800 rows a group, whatever the volume. The previous transaction is either in the
    same second (see `_within_second`), in the block, or the last of an earlier day,
    taken from a frame with one row per card and day.
    """
    widest = max(ROLLING.values())
    # max_by skips null keys; a null id sorts first in the windows, and so does empty text here.
    latest = F.struct(F.coalesce("trans_num", F.lit("")), "amt")
    per_second = (
        rows.groupBy("_card", "_sec")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum(_amount()).alias("_s"),
            F.max_by(F.struct("amt"), latest).alias("_last"),
        )
        .withColumn("_block", F.floor(F.col("_sec") / widest))
    )
    last_of_day = per_second.groupBy("_card", "_block").agg(
        F.max_by(F.struct("_sec", "_last"), "_sec").alias("_end")
    )
    days = Window.partitionBy("_card").orderBy("_block")
    carried = last_of_day.select("_card", "_block", F.lag("_end").over(days).alias("_carried"))

    blocks = per_second.withColumn("_own", F.col("_block")).withColumn(
        "_block", F.explode(F.array(F.col("_own"), F.col("_own") + 1))
    )
    in_block = Window.partitionBy("_card", "_block").orderBy("_sec")
    blocks = blocks.withColumn("_before", F.lag(F.struct("_sec", "_last")).over(in_block))
    seconds = (
        _rolling(blocks, ["_card", "_block"], F.col("_n"), F.col("_s"))
        .where(F.col("_block") == F.col("_own"))
        .join(carried, ["_card", "_block"])
        .select(
            "_card", "_sec",
            F.coalesce("_before", "_carried").alias("_before"),
            *[f"{kind}_{k}" for k in ROLLING for kind in ("tx_count", "amt_sum")],
        )
    )
    first = F.col("_same").isNull()
    return (
        _within_second(rows, min_rows)
        .join(seconds, ["_card", "_sec"])
        .withColumns(
            {
                "secs_since_prev": F.when(first, F.col("_sec") - F.col("_before._sec")).otherwise(
                    F.lit(0).cast("bigint")
                ),
                "_prev_amt": F.when(first, F.col("_before._last.amt")).otherwise(
                    F.col("_same.amt")
                ),
            }
        )
        .drop("_same", "_before")
    )
