"""Data-quality report, duplicates, schema check."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txguard import schemas


def _row_checks() -> dict:
    no_place = F.col("lat").isNull() | F.col("long").isNull()
    return {
        "null_ssn_count": F.col("ssn").isNull(),
        "null_cc_num_count": F.col("cc_num").isNull(),
        "null_amount_count": F.col("amt").isNull(),
        "invalid_amount_count": F.col("amt") <= 0,
        "invalid_coordinates_count": no_place,
    }


def _row_counts() -> list:
    checks = _row_checks()
    failed = F.coalesce(F.greatest(*[F.coalesce(c, F.lit(False)) for c in checks.values()]), F.lit(False))
    return [
        F.count(F.lit(1)).alias("total_records"),
        *[F.count_if(c).alias(name) for name, c in checks.items()],
        F.count_if(failed).alias("failed_rows"),
    ]


def duplicates(df: DataFrame) -> DataFrame:
    """Transaction ids that occur more than once, with their row count. Null ids form one group."""
    return (
        df.groupBy("trans_num")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def quality_report(df: DataFrame) -> DataFrame:
    """One row of counts and scores.

    Two scans with disjoint columns: the row checks need no shuffle beyond one row per task,
    only the id column is shuffled for duplicates. `data_quality_score` subtracts overlapping
    counts (a row failing twice is subtracted twice); `valid_row_pct` counts a failing row once.
    """
    counts = df.agg(*_row_counts())
    copies = duplicates(df).agg(
        F.count(F.lit(1)).alias("duplicate_transactions"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_copies"),
    )
    merged = counts.unionByName(copies, allowMissingColumns=True)
    report = merged.agg(*[F.max(c).alias(c) for c in merged.columns])
    total = F.col("total_records")
    subtracted = sum(
        (
            F.col(c)
            for c in (
                "null_ssn_count", "null_cc_num_count", "null_amount_count",
                "invalid_amount_count", "duplicate_transactions",
            )
        ),
        F.lit(0),
    )

    def percent(part):
        return F.coalesce(F.try_divide(part.cast("double"), total.cast("double")) * 100, F.lit(0.0))

    return report.withColumns(
        {
            "data_quality_score": percent(total - subtracted),
            "valid_row_pct": percent(total - F.col("failed_rows")),
        }
    )


def observe_quality(df: DataFrame, observation: Observation | str) -> DataFrame:
    """Counts the row checks while the frame is written, without a pass of its own."""
    return df.observe(observation, *_row_counts())


def schema_matches(df: DataFrame, expected: StructType | str) -> bool:
    """Whether names, types, nullability and order are exactly those of `expected`."""
    return df.schema == (schemas.struct(expected) if isinstance(expected, str) else expected)


def schema_report(df: DataFrame, expected: StructType | str) -> DataFrame:
    """One row per field of either side: place, type wanted and found, how many values do not
    fit the wanted type, and whether the field is exactly as wanted. One aggregation pass."""
    if isinstance(expected, str):
        expected = schemas.struct(expected)
    wanted = {f.name: (i, f) for i, f in enumerate(expected)}
    found = {f.name: (i, f) for i, f in enumerate(df.schema)}
    names = [*wanted, *[n for n in found if n not in wanted]]

    def misfits(name):
        if name not in wanted or name not in found:
            return F.lit(0).cast("bigint")
        value = F.col(f"`{name}`")
        return F.count_if(value.isNotNull() & value.try_cast(wanted[name][1].dataType).isNull())

    def line(i, name):
        w, f = wanted.get(name), found.get(name)
        return F.struct(
            F.lit(name).alias("field"),
            F.lit(w[0] if w else None).cast("int").alias("expected_place"),
            F.lit(f[0] if f else None).cast("int").alias("actual_place"),
            F.lit(w[1].dataType.simpleString() if w else None).cast("string").alias("expected"),
            F.lit(f[1].dataType.simpleString() if f else None).cast("string").alias("actual"),
            F.col(f"_{i}").alias("misfits"),
            F.lit(w == f).alias("matches"),
        )

    counted = df.agg(*[misfits(name).alias(f"_{i}") for i, name in enumerate(names)])
    return counted.select(
        F.explode(F.array(*[line(i, name) for i, name in enumerate(names)])).alias("r")
    ).select("r.*")
