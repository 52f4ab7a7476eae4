"""Decision ladders as column expressions. A null condition falls through to the next step."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from txguard import constants as C


def first_match(steps, otherwise) -> Column:
    """`steps` is a sequence of (condition, label); the first true condition decides."""
    ladder = F
    for condition, label in steps:
        ladder = ladder.when(condition, F.lit(label))
    return ladder.otherwise(F.lit(otherwise))


def tier(distance: Column, amt: Column) -> Column:
    steps = [((distance > km) & (amt > usd), label) for label, km, usd in C.TIERS]
    return first_match(steps, C.TIER_OTHERWISE)


def risk_level(score: Column) -> Column:
    return first_match([(score >= low, label) for label, low in C.RISK_LEVELS], C.RISK_OTHERWISE)


def is_alert(level: Column) -> Column:
    return F.coalesce(level.isin(*C.ALERT_LEVELS), F.lit(False))
