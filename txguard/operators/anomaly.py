"""Distance of a transaction to the nearest of a few cluster centres, as column expressions."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import constants as C

# A row this many root-mean-square distances from its centre has anomaly score 1.
FULL_SCORE_AT = 5.0


def nearest_centre(
    df: DataFrame,
    centres: Sequence[Sequence[float]],
    scale: Sequence[float],
    columns: Sequence[str] = C.CLUSTER_FEATURES,
) -> DataFrame:
    """Adds `cluster` (index of the nearest centre, lowest on ties) and `centre_distance`.

    `centres` lie in the space of `column / scale`; a scale of 0 takes the column out.
    Null inputs count as 0.
    """
    values = [
        F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * (1.0 / s if s else 0.0)
        for c, s in zip(columns, scale, strict=True)
    ]
    squares = F.array(
        *[
            sum((F.pow(v - float(m), 2) for v, m in zip(values, centre, strict=True)), F.lit(0.0))
            for centre in centres
        ]
    )
    return (
        df.withColumn("_squares", squares)
        .withColumns(
            {
                "cluster": (F.array_position("_squares", F.array_min("_squares")) - 1).cast("int"),
                "centre_distance": F.sqrt(F.array_min("_squares")),
            }
        )
        .drop("_squares")
    )


def score_by_cluster(df: DataFrame) -> DataFrame:
    """A constant per cluster id. Ids are arbitrary, so this is only for comparison."""
    low, middle, high = C.CLUSTER_SCORES
    return df.withColumn(
        "anomaly_score",
        F.when(F.col("cluster") == 0, low).when(F.col("cluster") == 1, middle).otherwise(high),
    )


def score_by_distance(df: DataFrame, typical: float) -> DataFrame:
    """Distance to the own centre against the `typical` (root mean square) one of training, 0 to 1."""
    share = F.try_divide(F.col("centre_distance"), F.lit(FULL_SCORE_AT * typical))
    return df.withColumn(
        "anomaly_score", F.when(share > 1.0, 1.0).otherwise(F.coalesce(share, F.lit(0.0)))
    )
