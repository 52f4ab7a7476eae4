"""One streaming query: decode, score once, write to many sinks."""

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from txguard.constants import TRIGGER

Sink = Callable[[DataFrame, int], None]


def start_scoring(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    sinks: Sequence[Sink],
    name: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    raw_sinks: Sequence[Sink] = (),
) -> StreamingQuery:
    """Starts the query. `trigger=None` handles what is there and stops.

    The batch is kept before anything counts or joins it, so its source is read and decoded once; `raw_sinks` get it as
    it came.

    `score` runs inside each micro-batch, so tables it reads (profile, models) may be replaced
    between batches. The scored rows are kept while the sinks write: rows are scored once and
    every sink gets the same. A failing sink fails the batch, which is then
    repeated; sinks must accept an epoch twice. Name and checkpoint are required, a restart with
    both goes on where it stopped.
    """

    def handle(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in raw_sinks:
                sink(batch, epoch_id)
            scored = score(batch).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                for sink in sinks:
                    sink(scored, epoch_id)
            finally:
                scored.unpersist()
        finally:
            batch.unpersist()

    writer = (
        stream.writeStream.foreachBatch(handle)
        .outputMode("append")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
    )
    when = {"processingTime": trigger} if trigger else {"availableNow": True}
    return writer.trigger(**when).start()


def start_copy(
    stream: DataFrame,
    path: str,
    name: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Appends a streaming frame to files, exactly once through the sink's own log."""
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
    )
    when = {"processingTime": trigger} if trigger else {"availableNow": True}
    return writer.trigger(**when).start(path)
