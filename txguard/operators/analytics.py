"""Reports over the scored table. Filters on its partition columns prune directories."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fraud_by(scored: DataFrame, *columns: str) -> DataFrame:
    """Volume, frauds and fraud amount per combination of `columns`."""
    is_fraud = F.col("final_fraud_status") == F.lit("FRAUD")
    return scored.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_fraud).alias("frauds"),
        F.coalesce(F.sum(F.when(is_fraud, F.col("amt"))), F.lit(0)).cast("double").alias("fraud_amount"),
    ).withColumn("fraud_rate", F.col("frauds") / F.col("n"))


def top_by_fraud_amount(scored: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The `k` values of `column` with the highest fraud amount; ties go to the smaller value."""
    return (
        scored.where(F.col("final_fraud_status") == F.lit("FRAUD"))
        .groupBy(column)
        .agg(F.sum("amt").cast("double").alias("fraud_amount"), F.count(F.lit(1)).alias("frauds"))
        .orderBy(F.col("fraud_amount").desc(), F.col(column).asc())
        .limit(k)
    )


CUBE = (("category",), ("state",), ("hour",), ("year", "month", "day"), ("category", "state"))


def report_cube(scored: DataFrame, sets: tuple[tuple[str, ...], ...] = CUBE) -> DataFrame:
    """The counts of `fraud_by` for several reports in one aggregation: a row per report (`report`, its columns joined by comma)
    and combination of its columns; columns that a report does not have are null. Amounts are in cents, so that sums of sums
    are exact. Cubes of parts add up to the cube of the whole, see `add_cubes`."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    is_fraud = F.col("final_fraud_status") == F.lit("FRAUD")
    cents = (F.col("amt").cast("decimal(14,2)") * 100).cast("bigint")
    rows = scored.select(*columns, is_fraud.alias("_fraud"), cents.alias("_cents"))
    counted = rows.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("n"),
        F.count_if("_fraud").alias("frauds"),
        F.coalesce(F.sum(F.when(F.col("_fraud"), F.col("_cents"))), F.lit(0)).alias("fraud_cents"),
    )
    width = len(columns)
    number = {sum(1 << (width - 1 - i) for i, c in enumerate(columns) if c not in s): ",".join(s) for s in sets}
    name = F.create_map(*[F.lit(x).cast("bigint" if isinstance(x, int) else "string") for kv in number.items() for x in kv])
    return counted.select(name[F.col("_set")].alias("report"), *columns, "n", "frauds", "fraud_cents")


def add_cubes(rows: DataFrame) -> DataFrame:
    counts = ("n", "frauds", "fraud_cents")
    return rows.groupBy(*[c for c in rows.columns if c not in counts]).agg(*[F.sum(c).alias(c) for c in counts])


def report_of(cube: DataFrame, *columns: str) -> DataFrame:
    """One report out of a cube, as `fraud_by` gives it."""
    own = cube.where(F.col("report") == ",".join(columns))
    return own.select(
        *columns, "n", "frauds", (F.col("fraud_cents") / 100).alias("fraud_amount"),
        (F.col("frauds") / F.col("n")).alias("fraud_rate"),
    )
