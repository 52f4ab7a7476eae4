"""Event time as UTC wall clock (TIMESTAMP_NTZ), so results do not follow the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from txguard.constants import BUSINESS_HOURS, WEEKEND_DAYS

HOUR = 3600
DAY = 86400


def epoch_seconds(unix_time="unix_time") -> Column:
    """Epoch second from the text field; null where the text is not a number."""
    return F.col(unix_time).try_cast("bigint")


def event_time(unix_time="unix_time") -> Column:
    return F.expr(
        f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, try_cast({unix_time} AS BIGINT))"
    )


def seconds_of(ts: str) -> Column:
    """Epoch second of a TIMESTAMP_NTZ column read as UTC, whatever the session time zone."""
    t = F.col(ts)
    days = F.date_diff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * DAY + F.hour(t) * HOUR + F.minute(t) * 60 + F.second(t)


def calendar_parts(ts: str) -> dict[str, Column]:
    t = F.col(ts)
    weekday, hour = F.dayofweek(t), F.hour(t)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": hour,
        "day_of_week": weekday,
        "quarter": F.quarter(t),
        "week_of_year": F.weekofyear(t),
        "is_weekend": F.coalesce(weekday.isin(*WEEKEND_DAYS), F.lit(False)),
        "is_business_hours": F.coalesce(hour.between(*BUSINESS_HOURS), F.lit(False)),
    }
