"""Fraud rules, scores to status, alerts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import constants as C
from txguard.functions import labels
from txguard.operators.features import with_distance
from txguard.operators.skew import lookup_join


def relative_rule(
    tx: DataFrame,
    averages: DataFrame,
    how: str = "left",
    combine: str = "and",
    distance_km: float = C.RULE_DISTANCE_KM,
    over_average: float = C.RULE_AMOUNT,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """`status` = fraud where the card is far from home and/or spends well above its recent mean.

    `combine="and"` wants both conditions, `"or"` is the cascade in which either one decides.
    `how="inner"` drops cards without a mean, `"left"` keeps them (their amount condition is null).
    """
    joined = with_distance(
        lookup_join(tx, averages, "cc_num", how, heavy, spread="trans_num")
    )
    far = F.col("distance") > distance_km
    costly = F.col("amt").cast("double") > F.col("avg_transaction_amt") + over_average
    if combine == "and":
        steps = [(far & costly, "fraud")]
    elif combine == "or":
        steps = [(far, "fraud"), (costly, "fraud")]
    else:
        raise ValueError(f"combine must be 'and' or 'or', not {combine!r}")
    return joined.withColumn("status", labels.first_match(steps, "genuine"))


def tier_rule(df: DataFrame) -> DataFrame:
    return df.withColumn("rule_based_fraud", labels.tier(F.col("distance"), F.col("amt")))


def without_models(df: DataFrame) -> DataFrame:
    """Scores of a run that has no trained models."""
    return df.withColumns(
        {
            "ml_fraud_score": F.lit(C.SCORE_WITHOUT_MODEL),
            "anomaly_score": F.lit(C.SCORE_WITHOUT_MODEL),
        }
    )


def with_alerts(df: DataFrame, enabled: bool = True) -> DataFrame:
    if not enabled:
        return df.withColumns(
            {"risk_level": F.lit(C.RISK_UNKNOWN), "alert_generated": F.lit(False)}
        )
    level = labels.risk_level(F.col("ml_fraud_score"))
    return df.withColumns({"risk_level": level, "alert_generated": labels.is_alert(level)})


def alerts_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("alert_generated"))


def final_status(
    df: DataFrame, distance_km: float = C.RULE_DISTANCE_KM, amount: float = C.RULE_AMOUNT
) -> DataFrame:
    suspicious = (
        (F.col("ml_fraud_score") > C.FINAL_ML_SCORE)
        | (F.col("anomaly_score") > C.FINAL_ANOMALY_SCORE)
        | ((F.col("distance") > distance_km) & (F.col("amt") > amount))
    )
    return df.withColumn(
        "final_fraud_status", labels.first_match([(suspicious, "FRAUD")], "GENUINE")
    )
