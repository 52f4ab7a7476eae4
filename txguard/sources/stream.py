"""Unbounded transactions: a message topic, or a folder that receives files."""

from pyspark.sql import DataFrame, SparkSession

from txguard.constants import MAX_OFFSETS_PER_TRIGGER


def topic_options(
    servers: str,
    topic: str,
    max_offsets: int = MAX_OFFSETS_PER_TRIGGER,
    jaas: str | None = None,
    min_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options of a Kafka topic. With `jaas` the connection is SASL_SSL with PLAIN login.

    `min_partitions` lets Spark cut a topic partition that holds most of the records into
    several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "maxOffsetsPerTrigger": str(max_offsets),
    }
    if jaas:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": jaas,
        }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options | (extra or {})


def topic_stream(spark: SparkSession, **settings) -> DataFrame:
    """Messages of a topic (key, value, timestamp, ...). Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**topic_options(**settings)).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)
