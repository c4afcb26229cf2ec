"""Scalar measures of a day's traffic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dropwatch.config import RECENT_LAGS, WEEKDAY_LAGS, Thresholds


# The hours since 1970 of the years 1 to 9999.
CALENDAR_HOURS = (-17259888, 70389527)


def lag_name(days: int) -> str:
    return f"prev_clicks_{days}days"


def mean_of_lags(lags: tuple[int, ...]) -> Column:
    """Mean of earlier values; NULL if one of them is."""
    total = F.lit(0)
    for days in lags:
        total = total + F.col(lag_name(days))
    return total / F.lit(float(len(lags)))


def recent_average() -> Column:
    return mean_of_lags(RECENT_LAGS)


def weekday_estimate() -> Column:
    """Expected clicks: mean of the same weekday in the weeks before."""
    return mean_of_lags(WEEKDAY_LAGS)


def drop_ratio(clicks: Column, estimate: Column) -> Column:
    return F.when(estimate > 0, clicks / estimate)


def share(part: Column, total: Column) -> Column:
    """Part of a total; NULL for an empty total, which a fully silent day has."""
    return part * F.lit(1.0) / F.nullif(total, F.lit(0))


def has_fallen(thresholds: Thresholds) -> Column:
    """Enough clicks expected and nearly none there. NULL in any operand means no."""
    return (F.col("estimate") > thresholds.min_clicks) & (F.col("ratio") < thresholds.ratio)


def is_used(thresholds: Thresholds) -> Column:
    """The group normally has enough users and domains. NULL in any operand means no."""
    return (F.col("median_count_ip_address_user_agent") > thresholds.min_ipua) & (
        F.col("median_count_domain_name") > thresholds.min_domain
    )


def event_hour(epoch_ms: str) -> Column:
    """Hour (UTC) of an epoch-milliseconds string, whatever the session's time zone; NULL if it is
    malformed or beyond the calendar of ISO years."""
    time = F.col(epoch_ms).try_cast("double")
    first, last = (3_600_000 * h for h in CALENDAR_HOURS)
    hours = F.when(time.between(first, last), F.floor(time / 3_600_000).cast("int"))
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.substring((start + F.make_dt_interval(hours=hours)).cast("string"), 1, 16)
