"""JSON messages to transaction rows and back."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import schemas


def decode(messages: DataFrame, ddl: str = schemas.TRANSACTION, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows from the binary or text column `value`, one flat column per field.

    A message that is no JSON object gives a row of nulls, not an error, with the message in
    `_corrupt_record`. `keep` names message columns to carry along (key, timestamp, offset).
    """
    with_corrupt = f"{ddl.strip()}, {schemas.CORRUPT_COLUMN} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT_COLUMN}
    data = F.from_json(F.col("value").cast("string"), with_corrupt, options).alias("data")
    return messages.select(*keep, data).select(*keep, "data.*")


def is_corrupt():
    return F.col(schemas.CORRUPT_COLUMN).isNotNull()


def encode(df: DataFrame, key: str | None = None) -> DataFrame:
    """The whole row as one JSON text in `value`; nulls are written, not left out."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)
