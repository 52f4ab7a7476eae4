"""Session settings the engine is meant to run with. Library functions only ever take a session."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}

DELTA = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def build_session(
    app: str, master: str | None = None, delta: bool = False, **settings
) -> SparkSession:
    """For applications and tests. `settings` use `__` for the dots of Spark's names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    chosen = SETTINGS | (DELTA if delta else {})
    chosen |= {k.replace("__", "."): v for k, v in settings.items()}
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
