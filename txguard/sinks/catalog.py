"""Written tables under a name, for ad-hoc SQL."""

from pyspark.sql import SparkSession


def register(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """External table over `path`. Columns and partition columns are found in the files."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")


def refresh(spark: SparkSession, name: str) -> None:
    """Makes partitions written since the last call visible under the name."""
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
