"""Windowed rates of a stream that lose no row, however late it comes.

A micro-batch adds its counts per window to an additive table of epochs. Late rows are counts like all others; if they change
a window that was closed before, the window comes out again as a correction. There is no state to expire: what is kept
is a row per window, merged from time to time.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from txguard.constants import TRIGGER
from txguard.sinks.epochs import EpochTable

COUNTS = ("n", "frauds", "newest")


def window_counts(df: DataFrame, fraud: Column, width: str = "1 day", by: tuple = ()) -> DataFrame:
    """window_start, window_end, `by`, n, frauds, and the second of the newest event. Rows without a time are in no window."""
    counted = df.groupBy(F.window("event_ts", width), *by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(fraud).alias("frauds"), F.max(F.unix_seconds("event_ts")).alias("newest")
    )
    return counted.select(
        F.unix_seconds("window.start").alias("window_start"), F.unix_seconds("window.end").alias("window_end"),
        *by, *COUNTS,
    )


def add_counts(rows: DataFrame) -> DataFrame:
    keys = [c for c in rows.columns if c not in COUNTS]
    return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("frauds").alias("frauds"), F.max("newest").alias("newest"))


def rates_table(spark: SparkSession, path: str) -> EpochTable:
    return EpochTable(spark, f"{path}/windows", merge=add_counts)


def rates(spark: SparkSession, path: str) -> DataFrame:
    """All windows as counted so far, open ones too."""
    rows = rates_table(spark, path).read().drop("newest")
    return rows.withColumn("fraud_rate", F.col("frauds") / F.col("n"))


def corrections(spark: SparkSession, path: str) -> DataFrame:
    """Closed windows that late rows have changed, as they were after each such epoch (`epoch_id`)."""
    return EpochTable(spark, f"{path}/corrections").read()


def start_late_rates(
    stream: DataFrame,
    fraud: Column,
    path: str,
    name: str,
    checkpoint: str,
    width: str = "1 day",
    late_seconds: int = 7200,
    by: tuple = (),
    trigger: str | None = TRIGGER,
    compact_every: int | None = 100,
) -> StreamingQuery:
    """Keeps `rates` and `corrections` below `path`. A window is closed once an event `late_seconds` past its end was seen in an
    earlier epoch. The frame needs `event_ts`. A repeated epoch replaces itself, and sees earlier epochs only."""
    spark = stream.sparkSession
    windows, changed = rates_table(spark, path), EpochTable(spark, f"{path}/corrections")

    def handle(batch: DataFrame, epoch_id: int) -> None:
        counts = window_counts(batch, fraud, width, by).persist()  # a row per window
        try:
            windows.write(counts, epoch_id)
            earlier = windows.read(before=epoch_id)
            if earlier is None:
                corrected = counts.where("false")
            else:
                newest = earlier.agg(F.max("newest")).first()[0]
                closed = counts.where(F.col("window_end") + late_seconds <= (newest if newest is not None else -1))
                keys = ["window_start", "window_end", *by]
                same = [F.col(f"e.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
                corrected = add_counts(
                    closed.unionByName(
                        earlier.alias("e").join(F.broadcast(closed.select(keys).alias("c")), same, "left_semi")
                    )
                )
            changed.write(corrected.withColumn("fraud_rate", F.col("frauds") / F.col("n")).drop("newest"), epoch_id)
        finally:
            counts.unpersist()
        if compact_every and epoch_id and epoch_id % compact_every == 0:
            windows.compact(before=epoch_id)
            changed.compact(before=epoch_id)

    writer = stream.writeStream.foreachBatch(handle).outputMode("append").queryName(name)
    when = {"processingTime": trigger} if trigger else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**when).start()
