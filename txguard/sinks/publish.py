"""JSON files to messages."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _key_or_uuid(key: Column) -> Column:
    return F.coalesce(key, F.uuid()).alias("key")


def messages_from_lines(spark: SparkSession, path: str) -> DataFrame:
    """One message per line of JSON-lines files: the line as it is, keyed by its field `key` or a
    new UUID. Files are split, nothing is parsed into columns."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(_key_or_uuid(F.get_json_object("value", "$.key")), "value")


def messages_from_arrays(spark: SparkSession, path: str) -> DataFrame:
    """One message per element of JSON-array files: the element with its types, nesting and absent fields as they
    are. A file is read whole by one task, so keep files modest; JSON lines have no such limit."""
    files = spark.read.text(path, wholetext=True)
    records = files.select(F.explode(F.from_json("value", "array<string>")).alias("value"))
    return records.select(_key_or_uuid(F.get_json_object("value", "$.key")), "value")


def publish(messages: DataFrame, fmt: str = "kafka", path: str | None = None, **options) -> None:
    """Sends messages to a topic (`kafka.bootstrap.servers`, `topic`) or writes them to files."""
    writer = messages.write.format(fmt).options(**options)
    if path:
        writer.mode("overwrite").save(path)
    else:
        writer.save()
