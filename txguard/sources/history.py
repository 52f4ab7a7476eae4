"""Bounded transaction history."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txguard import schemas


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header and the declared types. The schema goes by position, names are not read.

    Text that does not fit its type becomes null. For repeated use store it as Parquet once
    (`store_history`): CSV has neither column pruning nor filter pushdown.
    """
    return spark.read.schema(schemas.TRANSACTION).option("header", True).csv(path)


def read_history_untyped(spark: SparkSession, path: str) -> DataFrame:
    """CSV with the names of its header and every field as text; no inference pass."""
    return spark.read.option("header", True).csv(path)


def typed(df: DataFrame, ddl: str = schemas.TRANSACTION) -> DataFrame:
    """Casts the columns named in `ddl`; text that does not fit becomes null, never an error.

    `cast_failures` counts the fields of the row that were lost that way. Absent fields are null.
    """
    columns, lost = [], F.lit(0)
    for name, kind in schemas.field_types(ddl).items():
        if name not in df.columns:
            columns.append(F.lit(None).cast(kind).alias(name))
            continue
        value = F.col(name).try_cast(kind)
        columns.append(value.alias(name))
        if kind != "string":
            lost = lost + (F.col(name).isNotNull() & value.isNull()).cast("int")
    return df.select(*columns, lost.alias("cast_failures"))


def store_history(df: DataFrame, path: str) -> None:
    """Columnar copy of the history, in the order and split it was read (no shuffle)."""
    df.write.mode("overwrite").parquet(path)
