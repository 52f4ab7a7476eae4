"""Repeats in a stream: bounded state with a watermark, or exact against what is stored."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from txguard.constants import TRIGGER


def drop_repeats(stream: DataFrame, key: str = "trans_num", late: str = "1 hour") -> DataFrame:
    """Keeps the first row of each key; repeats must come within `late` of event time.

    Rows later than the watermark are dropped by the engine, also those that repeat nothing: use
    `start_unique` where none may be lost. Rows without a key are no repeats of each other. State holds one entry per
    row kept in that span, whatever the number of copies. The frame needs `event_ts`. For large spans
    set the RocksDB state store in the session.
    """
    identified = stream.withColumn("_id", F.coalesce(F.col(key).cast("string"), F.uuid()))
    return identified.withWatermark("event_ts", late).dropDuplicatesWithinWatermark(["_id"]).drop("_id")


def start_unique(
    stream: DataFrame,
    path: str,
    name: str,
    checkpoint: str,
    key: str = "trans_num",
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Writes the first row of each key to `path`, however late rows come; no row is lost.

    A micro-batch is compared with the stored rows of the same event dates (`event_date`, the partitions that are read) from
    earlier epochs, so a key must keep its event time. Rows without a key are no repeats and all stay. Which of
    several copies within one micro-batch stays follows from their values. An epoch that is repeated replaces itself.
    The frame needs `event_ts`.
    """
    spark = stream.sparkSession

    def handle(batch: DataFrame, epoch_id: int) -> None:
        dated = batch.withColumn("event_date", F.coalesce(F.to_date("event_ts"), F.lit("1970-01-01").cast("date")))
        rest = [c for c in dated.columns if c != key]
        identified = dated.where(F.col(key).isNotNull())
        once = identified.groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*")
        once = once.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if epoch_id > 0:
                dates = once.select("event_date").distinct()
                stored = spark.read.schema(
                    f"{key} {dict(batch.dtypes)[key]}, epoch_id bigint, event_date date"
                ).parquet(path)
                earlier = stored.where(F.col("epoch_id") < epoch_id).join(dates, "event_date", "left_semi")
                fresh = once.join(earlier.select(key), key, "left_anti")
            else:
                fresh = once
            whole = fresh.unionByName(dated.where(F.col(key).isNull()))
            whole.write.mode("overwrite").partitionBy("event_date").parquet(f"{path}/epoch_id={epoch_id}")
        finally:
            once.unpersist()

    writer = stream.writeStream.foreachBatch(handle).outputMode("append").queryName(name)
    when = {"processingTime": trigger} if trigger else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**when).start()
