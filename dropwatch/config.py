"""Granularity levels, thresholds and windows; every constant is a parameter somewhere."""

from __future__ import annotations

from dataclasses import dataclass

# The nested grouping columns, coarsest first.
LEVEL_COLS = ("country", "website_name", "action", "zone")

# Identifiers whose daily distinct counts describe a group's audience.
ID_COLS = (
    "master_user_group_id",
    "ip_address_user_agent",
    "city_code",
    "company_name",
    "domain_name",
)

COUNT_COLS = tuple(f"count_{c}" for c in ID_COLS)
MEDIAN_COLS = tuple(f"median_{c}" for c in COUNT_COLS)

# Level name -> grouping columns; level numbers in stacked tables are their lengths, 1 to 4.
LEVELS = {
    "country": LEVEL_COLS[:1],
    "website": LEVEL_COLS[:2],
    "action": LEVEL_COLS[:3],
    "zone": LEVEL_COLS,
}

# Keys of a table that stacks all levels; columns below a row's level are NULL.
STACKED_KEYS = ("level", *LEVEL_COLS)

SENTINEL_COUNTRY = "***"

LOOKBACK_DAYS = 21
HISTORY_DAYS = 7
USAGE_MONTHS = 12
RECENT_LAGS = (1, 2, 3)
WEEKDAY_LAGS = (7, 14, 21)
LAGS = RECENT_LAGS + WEEKDAY_LAGS

CLICK_LIST = "clicksList_day0_to_day7_before"


@dataclass(frozen=True)
class Thresholds:
    """When a day counts as a drop; all bounds are strict."""

    min_clicks: float = 50
    min_ipua: float = 50
    min_domain: float = 10
    ratio: float = 0.01


HOURLY_THRESHOLD = 100
