"""How well a prediction column agrees with the label."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion_matrix(df: DataFrame, label: str, predicted: str, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def classification_metrics(
    df: DataFrame, label: str, predicted: str, by: tuple[str, ...] = ()
) -> DataFrame:
    """Counts and rates in one aggregation; `label` and `predicted` are 0/1 columns."""
    hit, said = F.col(label) == 1, F.col(predicted) == 1
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(hit & said).alias("tp"),
        F.count_if(~hit & said).alias("fp"),
        F.count_if(hit & ~said).alias("fn"),
        F.count_if(~hit & ~said).alias("tn"),
    )

    def rate(part, whole):
        return F.try_divide(part.cast("double"), whole.cast("double"))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counted.withColumns(
        {
            "accuracy": rate(tp + tn, F.col("n")),
            "precision": rate(tp, tp + fp),
            "detection_rate": rate(tp, tp + fn),
            "false_positive_rate": rate(fp, fp + tn),
        }
    )


def sequential_test(
    looks: DataFrame, look: str, trials: str, hits: str, arms: tuple[str, str] = ("A", "B"), by: tuple[str, ...] = (),
    effect: float = 0.01, level: float = 0.05,
) -> DataFrame:
    """An always-valid comparison of two arms' rates, from counts alone: it may be looked at after every `look` and stopped at any.

    `looks`: `look`, arm, and the trials and hits of that look alone. Per look, over all so far: n and rate of either arm,
    and the p-value of a mixture sequential probability ratio test, whose mixture of effects is normal with deviation
    `effect`. It never rises again; `decision` is the arm with the higher rate once the p-value is at most `level`.
    """
    a, b = arms
    counted = looks.groupBy(*by, look).agg(*[
        F.sum(F.when(F.col("arm") == arm, F.col(c))).alias(f"{name}_{arm.lower()}")
        for arm in arms for c, name in ((trials, "n"), (hits, "hits"))
    ])
    so_far = Window.partitionBy(*by).orderBy(look).rowsBetween(Window.unboundedPreceding, 0)  # a row per look
    names = [f"{name}_{arm.lower()}" for arm in arms for name in ("n", "hits")]
    counted = counted.withColumns({c: F.coalesce(F.sum(c).over(so_far), F.lit(0)) for c in names})
    n_a, n_b = (F.col(f"n_{x.lower()}").cast("double") for x in arms)
    rate_a, rate_b = (F.try_divide(F.col(f"hits_{x.lower()}").cast("double"), F.col(f"n_{x.lower()}").cast("double")) for x in arms)
    pooled = F.try_divide((F.col(f"hits_{a.lower()}") + F.col(f"hits_{b.lower()}")).cast("double"), n_a + n_b)
    spread = pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n_a) + F.try_divide(F.lit(1.0), n_b))  # of the difference
    counted = counted.withColumns({"rate_a": rate_a, "rate_b": rate_b, "_v": spread})
    v, t = F.col("_v"), F.lit(float(effect) ** 2)
    gain = F.col("rate_b") - F.col("rate_a")
    odds = F.sqrt(v / (v + t)) * F.exp(F.least(F.try_divide(gain * gain * t, 2 * v * (v + t)), F.lit(700.0)))
    alone = F.when(v > 0, F.least(F.lit(1.0), F.try_divide(F.lit(1.0), odds))).otherwise(1.0)
    tested = counted.withColumn("p_value", F.min(F.coalesce(alone, F.lit(1.0))).over(so_far))
    better = F.when(gain > 0, b).when(gain < 0, a)
    return tested.withColumn("decision", F.when(F.col("p_value") <= level, better)).drop("_v")
