"""Repeats in a stream against all that was ever stored, through an index that opens few files.

Beside the rows, every epoch adds its ids twice: to blocked Bloom filters (a bitmap of 4 KB per slot, ten bits or so an id), which
add up by OR, and to a table of ids in buckets. A micro-batch reads the filters of its own slots; ids that no filter knows are
new, and no other file is opened for them. The few others (repeats, and about 2 % by chance at ten bits) are looked up in the
buckets they fall into, which decides exactly.
"""

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from txguard.constants import TRIGGER
from txguard.sinks.epochs import EpochTable

BITS, PROBES = 1 << 15, 4
IDS_PER_SLOT = BITS // 10
BUCKETS = 1024  # of ids: what a micro-batch collects is at most so many numbers


def _slot(key: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("bigint")


def _places(key: str) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(BITS)).cast("bigint") for i in range(PROBES)])


def filter_of(ids: DataFrame, key: str, slots: int) -> DataFrame:
    """slot, bits: the filters of a frame's ids, combined map-side."""
    rows = ids.where(F.col(key).isNotNull()).select(_slot(key, slots).alias("slot"), F.explode(_places(key)).alias("place"))
    return rows.groupBy("slot").agg(F.bitmap_construct_agg("place").alias("bits"))


def add_filters(rows: DataFrame) -> DataFrame:
    return rows.groupBy("slot").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_known(ids: DataFrame, filters: DataFrame, key: str, slots: int) -> DataFrame:
    """The rows of `ids` whose bits are all set: all that were added, and a few others."""
    asked = ids.withColumns({"_slot": _slot(key, slots), "_places": _places(key)})
    own = filters.join(F.broadcast(asked.select(F.col("_slot").alias("slot")).distinct()), "slot", "left_semi")
    held = asked.join(own.withColumnRenamed("slot", "_slot"), "_slot")
    bits = [
        F.expr(f"shiftright(CAST(conv(hex(substring(bits, CAST(_places[{i}] DIV 8 AS INT) + 1, 1)), 16, 10) AS INT), "
               f"CAST(_places[{i}] % 8 AS INT)) & 1 = 1")
        for i in range(PROBES)
    ]
    every = bits[0]
    for bit in bits[1:]:
        every &= bit
    return held.where(every).drop("_slot", "_places", "bits")


class MembershipIndex:
    """Filters and ids of all epochs below `path`. slots: from the number of ids to come, it cannot change later."""

    def __init__(self, spark: SparkSession, path: str, key: str, expected_ids: int):
        self.key = key
        self.slots = max(1, -(-expected_ids // IDS_PER_SLOT))
        self.filters = EpochTable(spark, f"{path}/filters", merge=add_filters)
        self.ids = EpochTable(spark, f"{path}/ids", ("bucket",))

    def add(self, ids: DataFrame, epoch_id: int) -> None:
        own = ids.where(F.col(self.key).isNotNull()).select(self.key)
        self.filters.write(filter_of(own, self.key, self.slots), epoch_id)
        self.ids.write(own.withColumn("bucket", self._bucket()), epoch_id)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.lit("bucket"), F.col(self.key)), F.lit(BUCKETS)).cast("int")

    def candidates(self, buckets: list[int], before: int) -> DataFrame:
        """Stored ids in those buckets: of merged epochs only their folders are read."""
        return self.ids.read(before).where(F.col("bucket").isin(buckets)).select(self.key)

    def unknown(self, ids: DataFrame, epoch_id: int) -> DataFrame:
        """The rows of `ids` (one per id) whose id is in no epoch before `epoch_id`."""
        filters = self.filters.read(before=epoch_id)
        if filters is None:
            return ids
        maybe = maybe_known(ids.select(self.key), filters, self.key, self.slots).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            buckets = sorted(r.b for r in maybe.select(self._bucket().alias("b")).distinct().collect())  # BUCKETS numbers at most
            if not buckets:
                return ids
            known = maybe.join(self.candidates(buckets, epoch_id).distinct(), self.key, "left_semi")
            return ids.join(known, self.key, "left_anti")
        finally:
            maybe.unpersist()  # a small frame: it may be computed again

    def compact(self, before: int) -> None:
        self.filters.compact(before)
        self.ids.compact(before)


def start_unique_indexed(
    stream: DataFrame,
    path: str,
    name: str,
    checkpoint: str,
    expected_ids: int,
    key: str = "trans_num",
    trigger: str | None = TRIGGER,
    compact_every: int | None = 100,
) -> StreamingQuery:
    """Keeps the first row of each key in the table of epochs `path`/rows, however late rows come and whatever their dates are.

    Rows without a key are no repeats and all stay. Which of several copies within a micro-batch stays follows from
    their values. A repeated epoch replaces itself, and compares with earlier epochs only.
    """
    spark = stream.sparkSession
    rows, index = EpochTable(spark, f"{path}/rows"), MembershipIndex(spark, f"{path}/index", key, expected_ids)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        rest = [c for c in batch.columns if c != key]
        once = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*")
        once = once.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fresh = index.unknown(once, epoch_id).persist(StorageLevel.MEMORY_AND_DISK)
            rows.write(fresh.unionByName(batch.where(F.col(key).isNull()).select(key, *rest)), epoch_id)
            index.add(fresh, epoch_id)
            fresh.unpersist()
        finally:
            once.unpersist()
        if compact_every and epoch_id and epoch_id % compact_every == 0:
            rows.compact(before=epoch_id)
            index.compact(before=epoch_id)

    writer = stream.writeStream.foreachBatch(handle).outputMode("append").queryName(name)
    when = {"processingTime": trigger} if trigger else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**when).start()
