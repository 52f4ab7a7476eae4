"""Joins and splits that stay balanced when one key holds a large share of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.constants import BROADCAST_ROWS, HEAVY_ROWS, ROWS_PER_SLICE

# Rows with a null key can match nothing, so they may go anywhere; spread them this wide.
NULL_SLICES = 65536


def heavy_keys(df: DataFrame, key: str, min_rows: int = HEAVY_ROWS) -> DataFrame:
    """Keys with at least `min_rows` rows, with that count: at most rows/min_rows of them.

    Reads only the key column and counts map-side before the shuffle.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("heavy_rows"))
        .where(F.col("heavy_rows") >= min_rows)
    )


def split_heavy(df: DataFrame, key: str, min_rows: int = HEAVY_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys and of no key, rows of heavy keys).

    The heavy-key list is broadcast, its length being bounded. Where it turns out empty adaptive
    execution drops the heavy branch before it reads anything.
    """
    heavy = F.broadcast(heavy_keys(df, key, min_rows).select(key))
    return df.join(heavy, key, "left_anti"), df.join(heavy, key, "left_semi")


def own_group():
    """A value of its own for every row: spreads rows that have no key, even if wholly null."""
    return F.monotonically_increasing_id()


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    heavy: DataFrame | None = None,
    spread: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Equi join of many facts with a dimension that has one row per key.

    There is no broadcast hint on `dim`: Spark broadcasts it where its size, known from the
    files or measured at run time, is under `spark.sql.autoBroadcastJoinThreshold`, and
    shuffles both sides otherwise.

    With `heavy` (see `heavy_keys`) the facts of a heavy key are cut into slices by a hash of
    `spread` and only that key's single dimension row is repeated once per slice, so no task
    of the shuffled join gets more than about `rows_per_slice` rows of one key. Null keys are
    spread the same way. Streaming facts take no `heavy`; each micro-batch is bounded.
    """
    if heavy is None:
        return facts.join(dim, key, how)

    slices = F.ceil(F.col("heavy_rows") / rows_per_slice).cast("int")
    heavy = F.broadcast(heavy)
    salted_facts = facts.join(heavy, key, "left").withColumn(
        "_slice",
        F.when(F.col(key).isNull(), F.pmod(own_group(), F.lit(NULL_SLICES)).cast("int"))
        .when(slices.isNotNull(), F.pmod(F.xxhash64(F.col(spread)), slices).cast("int"))
        .otherwise(0),
    ).drop("heavy_rows")
    salted_dim = (
        dim.join(heavy, key, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce(slices, F.lit(1)) - 1)))
        .drop("heavy_rows")
    )
    return salted_facts.join(salted_dim, [key, "_slice"], how).drop("_slice")


def lookup_plan(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    min_rows: int = HEAVY_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
    count_facts: bool = False,
    dim_rows: int | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """(`dim`, `heavy`) to hand to `lookup_join`, decided by counted sizes.

    * A stored `dim` of up to `broadcast_rows` rows is broadcast; the facts are not shuffled.
    * With `count_facts` (a micro-batch) few facts cut a large `dim` down to their own
      keys, by a scan of `dim` without a shuffle; what is left has no more rows than the facts
      and is broadcast.
    * Otherwise the join shuffles, with the heavy keys of `facts` cut into slices.

    The count of a Parquet table reads file footers only; `dim_rows` saves it where it is known.
    """
    if (dim.count() if dim_rows is None else dim_rows) <= broadcast_rows:
        return F.broadcast(dim), None
    if count_facts and facts.count() <= broadcast_rows:
        own = facts.select(key).distinct()
        return F.broadcast(dim.join(F.broadcast(own), key, "left_semi")), None
    return dim, heavy_keys(facts, key, min_rows)
