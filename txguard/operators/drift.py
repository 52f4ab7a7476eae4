"""Drift of scores and inputs, from mergeable quantile sketches per day.

A day's state is one KLL sketch per column, a few kilobytes whatever the rows, and adds up over days, files and epochs. The report
compares each period with a reference at the reference's deciles: the largest difference of ranks (a Kolmogorov-Smirnov distance
at those points) and the population stability index over the ten bins. Ranks of a sketch are off by about 1.65 % at K = 200
with 99 % confidence, 0.5 % at K = 800; twice that is the error of a distance.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 800
RANK_ERROR = 0.005
DECILES = tuple(i / 10 for i in range(1, 10))
LEAST_SHARE = 0.0001  # of a bin, so that an empty one has a finite index
LIMIT = 0.2  # a distance that starts a retraining


def sketch_state(df: DataFrame, columns: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """`by`, column, n, sketch. Nulls and NaN are not in the sketch."""
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    rows = df.select(*by, F.explode(values).alias("x")).select(*by, "x.*")
    rows = rows.where("value IS NOT NULL AND NOT isnan(value)")
    return rows.groupBy(*by, "column").agg(F.count("*").alias("n"), F.kll_sketch_agg_double("value", F.lit(K)).alias("sketch"))


def add_states(states: DataFrame) -> DataFrame:
    keys = [c for c in states.columns if c not in ("n", "sketch")]
    return states.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def drift_report(reference: DataFrame, current: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Keys of `current`, n, distance, stability_index and `drifted` for each of its states against the state of that column in
    `reference` (column, n, sketch: one row a column)."""
    deciles = F.array(*[F.lit(d) for d in DECILES])
    points = reference.select("column", F.kll_sketch_get_quantile_double("sketch", deciles).alias("p")).collect()  # a row a column
    rank = F.lit(None).cast("array<double>")
    for r in points:  # ranks are taken at constants only
        at = F.array(*[F.lit(float(x)) for x in r.p])
        rank = F.when(F.col("column") == r.column, F.kll_sketch_get_rank_double("sketch", at)).otherwise(rank)
    wanted = reference.select("column", rank.alias("wanted"))
    both = current.withColumn("found", rank).join(F.broadcast(wanted), "column")  # a row per column
    return _measured(both, limit).drop("sketch", "wanted", "found")


def _measured(both: DataFrame, limit: float) -> DataFrame:
    """Distance and index from `wanted` and `found`, the shares of rows up to each of the points."""
    gaps = F.zip_with("wanted", "found", lambda a, b: F.abs(a - b))
    edges = {c: F.concat(F.array(F.lit(0.0)), F.col(c), F.array(F.lit(1.0))) for c in ("wanted", "found")}

    def share(c):
        at = F.sequence(F.lit(1), F.size(edges[c]) - 1)
        return F.transform(at, lambda i: F.greatest(edges[c][i] - edges[c][i - 1], F.lit(LEAST_SHARE)))

    terms = F.zip_with(share("wanted"), share("found"), lambda a, b: (b - a) * F.log(b / a))
    index = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    measured = both.withColumn("distance", F.array_max(gaps)).withColumn("stability_index", index)
    return measured.withColumn("drifted", F.col("distance") > limit)


def exact_drift(reference: DataFrame, current: DataFrame, columns: tuple[str, ...], by: tuple[str, ...], limit: float = LIMIT) -> DataFrame:
    """The same from the rows themselves: exact deciles of the reference, exact shares. For audits of the sketches."""
    points = reference.agg(*[
        F.expr(f"percentile_disc(0.{i}) WITHIN GROUP (ORDER BY CAST(`{c}` AS DOUBLE))").alias(f"{c}_{i}") for c in columns for i in range(1, 10)
    ]).first()  # nine numbers a column

    def shares(df, keys):
        whole = df.groupBy(*keys).agg(*[
            F.struct(
                F.lit(c).alias("column"), F.count(c).alias("n"),
                F.array(*[F.count_if(F.col(c) <= points[f"{c}_{i}"]) / F.count(c) for i in range(1, 10)]).alias("shares"),
            ).alias(c) for c in columns
        ])
        return whole.select(*keys, F.explode(F.array(*columns)).alias("x")).select(*keys, "x.*")

    wanted = shares(reference, []).select("column", F.col("shares").alias("wanted"))
    both = shares(current, list(by)).withColumnRenamed("shares", "found").join(F.broadcast(wanted), "column")
    return _measured(both, limit).drop("wanted", "found")
