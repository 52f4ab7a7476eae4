"""Tables written by micro-batches. Writing an epoch twice leaves it there once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.constants import SCORED_PARTITIONS
from txguard.operators.privacy import deidentified
from txguard.operators.quality import quality_report
from txguard.operators.rules import alerts_only
from txguard.schemas import CORRUPT_COLUMN
from txguard.sinks.epochs import EpochTable, into
from txguard.sources.payload import is_corrupt


def write_epoch(
    df: DataFrame,
    epoch_id: int,
    path: str,
    partitions: tuple[str, ...] = (),
    fmt: str = "parquet",
    writer_id: str = "txguard",
) -> None:
    """Puts the rows of one epoch into a table, once however often it is called.

    File formats get a folder per epoch that a replay overwrites, so rows that a replay
    classifies differently leave nothing behind. While it does, and after a crash until the retry, readers
    miss that epoch. The folder name is the column `epoch_id` when
    the root is read. Delta gets its transaction id and version, which make an append idempotent.

    Rows are written where they are, without a shuffle by partition column: nearly all of them
    share one partition value, and would otherwise end in one task. `compact` merges the files.
    """
    writer = df.write.format(fmt).partitionBy(*partitions) if partitions else df.write.format(fmt)
    if fmt == "delta":
        writer.mode("append").option("txnAppId", writer_id).option("txnVersion", epoch_id).save(path)
    else:
        writer.mode("overwrite").save(f"{path}/epoch_id={epoch_id}")


def clear_epoch(spark: SparkSession, epoch_id: int, path: str, fmt: str = "parquet") -> None:
    """Takes back what an earlier try of an epoch has written, if its replay has nothing to write.

    Delta keeps the first try: its transaction id makes the replay a no-op.
    """
    if fmt == "delta":
        return
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/epoch_id={epoch_id}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_scored(df: DataFrame, epoch_id: int, path: str, fmt: str = "parquet") -> None:
    """Scored rows with the time of processing, partitioned for reports. Empty batches write nothing."""
    if df.isEmpty():
        clear_epoch(df.sparkSession, epoch_id, path, fmt)
        return
    stamped = df.withColumn("processing_timestamp", F.current_timestamp())
    if fmt == "delta":
        stamped = stamped.withColumn("epoch_id", F.lit(epoch_id).cast("bigint"))
    write_epoch(stamped, epoch_id, path, SCORED_PARTITIONS, fmt, "txguard-scored")


def scored_sink(spark: SparkSession, path: str, compact_every: int):
    """As `write_scored`, into an `EpochTable`: no folder per epoch and value, replays swap at once, merged every so many epochs."""
    table = EpochTable(spark, path, SCORED_PARTITIONS)
    return into(table, lambda df: df.withColumn("processing_timestamp", F.current_timestamp()), compact_every)


def write_deidentified(df: DataFrame, epoch_id: int, path: str, fmt: str = "parquet") -> None:
    if df.isEmpty():
        clear_epoch(df.sparkSession, epoch_id, path, fmt)
    else:
        write_epoch(deidentified(df), epoch_id, path, (), fmt, "txguard-deidentified")


def write_alerts(df: DataFrame, epoch_id: int, path: str, fmt: str = "parquet") -> None:
    raised = alerts_only(df)
    if raised.isEmpty():
        clear_epoch(df.sparkSession, epoch_id, path, fmt)
    else:
        write_epoch(raised, epoch_id, path, (), fmt, "txguard-alerts")


def write_bad_messages(df: DataFrame, epoch_id: int, path: str, fmt: str = "parquet") -> None:
    """Messages that could not be decoded, as they came: a table that holds raw personal data."""
    bad = df.where(is_corrupt()).select(F.col(CORRUPT_COLUMN).alias("message"))
    if bad.isEmpty():
        clear_epoch(df.sparkSession, epoch_id, path, fmt)
    else:
        write_epoch(bad, epoch_id, path, (), fmt, "txguard-bad-messages")


def write_quality(df: DataFrame, epoch_id: int, path: str, fmt: str = "parquet") -> None:
    """The quality report of one micro-batch, a row per epoch. Empty batches report nothing."""
    if df.isEmpty():
        clear_epoch(df.sparkSession, epoch_id, path, fmt)
    else:
        write_epoch(quality_report(df), epoch_id, path, (), fmt, "txguard-quality")


def compact(
    spark: SparkSession, source: str, target: str, partitions: tuple[str, ...] = SCORED_PARTITIONS
) -> None:
    """Copies a table of many small epoch files into few large ones.

    REBALANCE groups rows by partition value and lets adaptive execution cut the large values
    into several files of the advisory size, so one value never becomes one task.
    """
    rows = spark.read.parquet(source)
    rows.hint("rebalance", *[F.col(c) for c in partitions]).write.mode("overwrite").partitionBy(
        *partitions
    ).parquet(target)
