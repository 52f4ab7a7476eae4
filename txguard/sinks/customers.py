from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard.operators.privacy import customer_rows
from txguard.sinks.tables import clear_epoch, write_epoch


def write_customers(
    df: DataFrame,
    epoch_id: int,
    status: str = "final_fraud_status",
    fmt: str = "jdbc",
    path: str | None = None,
    connections: int = 16,
    **options,
) -> None:
    """Appends one customer row per transaction of the batch, with the epoch it came from.

    A database append cannot be taken back when the batch is retried, so readers take the newest
    epoch per customer (`sources.customers.newest_customers`), which a repeat does not change.
    `connections` bounds how many tasks write to the database at once.
    """
    if df.isEmpty():
        if fmt != "jdbc":
            clear_epoch(df.sparkSession, epoch_id, path, fmt)
        return
    rows = customer_rows(df, status)
    if fmt != "jdbc":
        write_epoch(rows, epoch_id, path, (), fmt, "txguard-customers")
        return
    (
        rows.withColumn("epoch_id", F.lit(epoch_id).cast("bigint"))
        .write.format("jdbc")
        .options(numPartitions=connections, **options)
        .mode("append")
        .save()
    )
