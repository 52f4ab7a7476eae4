"""Stored, versioned card profiles: computed by a job, read by every batch."""

import time

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard.operators.features import with_distance
from txguard.operators.profiles import card_profile, last_average

REGISTRY = "version bigint, buckets int"
#: Folders of a bucketed version at most: what a micro-batch collects is at most so many numbers.
MOST_BUCKETS = 1 << 16
ROWS_PER_BUCKET = 20_000
#: Beyond so many folders each holds at least so many cards, as a folder costs a file and a listing however little it holds.
FEW_BUCKETS, LEAST_ROWS = 256, 2_000


def build_profile(history: DataFrame) -> DataFrame:
    return card_profile(with_distance(history))


def build_averages(history: DataFrame) -> DataFrame:
    return last_average(history)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def publish_profile(
    profile: DataFrame, root: str, version: int, rows_per_bucket: int | None = None, key: str = "cc_num"
) -> None:
    """Writes one version, then lists it: readers keep the old one until the new one is whole.

    With `rows_per_bucket` (about ROWS_PER_BUCKET, for profiles too large to be kept on the executors) cards are dealt into
    folders by a hash and sorted in their files, so that a micro-batch reads the folders of its own cards only. Fewer rows than
    LEAST_ROWS are taken for a small profile only, of FEW_BUCKETS folders at most.
    """
    path, buckets = f"{root}/version={version}", None
    if rows_per_bucket:
        rows = profile.count()
        buckets = min(MOST_BUCKETS, max(1, -(-rows // rows_per_bucket)), max(FEW_BUCKETS, rows // LEAST_ROWS))
        dealt = profile.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket")
        dealt.sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(path)
    else:
        profile.write.mode("overwrite").parquet(path)
    line = profile.sparkSession.createDataFrame([(version, buckets)], REGISTRY).coalesce(1)
    line.write.mode("append").parquet(f"{root}/registry")


def read_profile(spark: SparkSession, root: str, version: int) -> DataFrame:
    """One version. Being files, its size is known and Spark can choose the join by it."""
    return spark.read.parquet(f"{root}/version={version}")


def newest_version(spark: SparkSession, root: str) -> int:
    return spark.read.schema(REGISTRY).parquet(f"{root}/registry").agg(F.max("version")).first()[0]


class CurrentProfile:
    """The newest version, kept on the executors until a newer one is published.

    For a running stream, which asks in every micro-batch: the registry is read again once the
    last look is `max_age` seconds old, the files once per version. Lost executors cost a
    re-read of their part. `rows` is the size of the current version.

    A bucketed version is not kept; `of` gives the folders of the cards of a micro-batch.
    """

    def __init__(self, spark: SparkSession, root: str, max_age: float = 60.0):
        self.spark, self.root, self.max_age = spark, root, max_age
        self.version, self.frame, self.rows, self.looked, self.buckets = None, None, None, None, None

    def of(self, batch: DataFrame, key: str = "cc_num") -> tuple[DataFrame, int | None]:
        """What a micro-batch may need of the profile, and its number of rows where that is known."""
        frame = self()
        if not self.buckets:
            return frame, self.rows
        own = batch.where(F.col(key).isNotNull()).select(bucket_of(key, self.buckets).alias("b")).distinct()
        own = sorted(r.b for r in own.collect())  # MOST_BUCKETS numbers at most
        if len(own) == self.buckets:
            return frame.drop("bucket"), None
        return frame.where(F.col("bucket").isin(own) if own else F.lit(False)).drop("bucket"), None

    def __call__(self) -> DataFrame:
        now = time.monotonic()
        if self.looked is None or now - self.looked >= self.max_age:
            version = newest_version(self.spark, self.root)
            if version != self.version:
                self.release()
                frame = read_profile(self.spark, self.root, version)
                listed = self.spark.read.schema(REGISTRY).parquet(f"{self.root}/registry")
                self.buckets = listed.where(F.col("version") == version).agg(F.max("buckets")).first()[0]
                self.frame = frame if self.buckets else frame.persist(StorageLevel.MEMORY_AND_DISK)
                self.version, self.rows = version, None if self.buckets else self.frame.count()
            self.looked = now
        return self.frame

    def release(self) -> None:
        if self.frame is not None and not self.buckets:
            self.frame.unpersist()
        self.version, self.frame, self.rows, self.looked, self.buckets = None, None, None, None, None
