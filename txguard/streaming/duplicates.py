"""Repeated ids across all micro-batches of a stream: exact counts and a small estimate.

Each epoch adds (id, copies) to an additive table, for exact answers by one aggregation over the ids, and one row with the number
of rows and an HLL sketch of the ids to another, for an estimate at any time from a few kilobytes.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.sinks.epochs import EpochTable, into

BITS = 14  # of the sketch: a standard error of about 1.04 / sqrt(2^14), 0.8 %


def copies_of(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).cast("string").alias("id")).agg(F.count(F.lit(1)).alias("copies"))


def add_copies(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id").agg(F.sum("copies").alias("copies"))


def sketch_of(df: DataFrame, key: str) -> DataFrame:
    """One row. Rows without an id repeat each other, as in `quality.duplicates`: they count as one more id."""
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("without_id"),
        F.hll_sketch_agg(F.col(key).cast("string"), BITS).alias("sketch"),
    )


def add_sketches(rows: DataFrame) -> DataFrame:
    return rows.agg(F.sum("n").alias("n"), F.sum("without_id").alias("without_id"), F.hll_union_agg("sketch").alias("sketch"))


def tables_of(spark: SparkSession, path: str) -> tuple[EpochTable, EpochTable]:
    return EpochTable(spark, f"{path}/ids", merge=add_copies), EpochTable(spark, f"{path}/sketches", merge=add_sketches)


def duplicate_sinks(spark: SparkSession, path: str, key: str = "trans_num", compact_every: int | None = 100) -> list:
    """Sinks for `streaming.runner` (as `raw_sinks` they see the rows as they came)."""
    ids, sketches = tables_of(spark, path)
    return [into(ids, lambda df: copies_of(df, key), compact_every), into(sketches, lambda df: sketch_of(df, key), compact_every)]


def repeated(spark: SparkSession, path: str) -> DataFrame:
    """Ids of more than one row, over all epochs, with their number of rows. Null ids are one group."""
    return tables_of(spark, path)[0].read().where("copies > 1")


def surplus_report(spark: SparkSession, path: str) -> DataFrame:
    """One row: rows so far, surplus copies exactly and as estimated from the sketch."""
    ids, sketches = tables_of(spark, path)
    exact = ids.read().agg(F.sum(F.col("copies") - 1).alias("surplus_copies"))
    none = F.when(F.col("without_id") > 0, 1).otherwise(0)
    known = sketches.read().select("n", (F.hll_sketch_estimate("sketch") + none).alias("ids_estimate"))
    both = known.unionByName(exact, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return both.withColumn("surplus_estimate", F.greatest(F.col("n") - F.col("ids_estimate"), F.lit(0)))
