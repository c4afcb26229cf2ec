"""Daily drop alerts in two modes.

observed   a series has its active days only, so an earlier value is that many active days ago.
           Only a group active on every day of the lookback has an estimate, and a group
           without clicks on the run date cannot alert. Groups with a NULL key are left out.
calendar   missing days count 0, earlier values are calendar days ago, a silent group alerts,
           and NULL keys are kept (but not a NULL country).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropwatch.config import COUNT_COLS, STACKED_KEYS, Thresholds
from dropwatch.operators.baseline import baseline
from dropwatch.operators.counts import (
    daily_clicks_all_levels,
    daily_counts,
    keys_present,
)
from dropwatch.operators.grid import clicks_per_day, densify
from dropwatch.operators.history import (
    alert_keys,
    click_list,
    click_totals,
    fallen_history,
    of_groups,
    of_used_groups,
    with_usage,
)
from dropwatch.operators.ranking import with_ranking
from dropwatch.plans.usage import (
    ALERT_IDS,
    usage_reference,
    usage_reference_all_levels,
)
from dropwatch.session import staged
from dropwatch.sources.readers import clicks_only, in_lookback, known_country

OBSERVED, CALENDAR = "observed", "calendar"


def _check(mode: str) -> None:
    if mode not in (OBSERVED, CALENDAR):
        raise ValueError(f"mode must be {OBSERVED!r} or {CALENDAR!r}, not {mode!r}")


def lookback_rows(traffic: DataFrame, run_date: str) -> DataFrame:
    """The rows a daily run looks at, clicks or not."""
    return known_country(in_lookback(traffic, run_date))


def daily_series(
    traffic: DataFrame,
    keys: Sequence[str],
    run_date: str,
    mode: str = OBSERVED,
    counts: Sequence[str] = COUNT_COLS,
) -> DataFrame:
    """Clicks and the wanted audience counts per group and day of the lookback."""
    _check(mode)
    clicks = clicks_only(lookback_rows(traffic, run_date))
    if mode == OBSERVED:
        clicks = clicks.filter(keys_present(keys))
    daily = daily_counts(clicks, keys).select(*keys, "date", "clicks", *counts)
    if mode == OBSERVED:
        return daily
    return densify(daily, keys, run_date, measures=("clicks", *counts))


def daily_baseline(
    traffic: DataFrame,
    keys: Sequence[str],
    run_date: str,
    mode: str = OBSERVED,
    counts: Sequence[str] = COUNT_COLS,
) -> DataFrame:
    """daily_series with earlier values, estimate and ratio."""
    return baseline(daily_series(traffic, keys, run_date, mode, counts), keys)


def daily_ranking(
    traffic: DataFrame, keys: Sequence[str], run_date: str, mode: str = OBSERVED
) -> DataFrame:
    """daily_baseline with each day's total, shares and ranks."""
    return with_ranking(staged(daily_baseline(traffic, keys, run_date, mode), "daily"))


def dense_clicks(traffic: DataFrame, keys: Sequence[str], run_date: str) -> DataFrame:
    """Clicks for every group of the lookback, also groups with no click at all, on every
    date."""
    rows = lookback_rows(traffic, run_date)
    return densify(clicks_per_day(rows, keys), keys, run_date)


def baseline_with_usage(
    traffic: DataFrame, keys: Sequence[str], run_date: str, mode: str = OBSERVED
) -> DataFrame:
    """daily_baseline, clicks only, with the usage reference of the run date's month."""
    usage = usage_reference(traffic, keys, run_date[:7])
    rows = daily_baseline(traffic, keys, run_date, mode, counts=())
    return with_usage(rows, usage, keys, null_safe=mode == CALENDAR)


def daily_alert_keys(traffic, keys, run_date, thresholds=Thresholds(), mode=OBSERVED):
    """Groups that drop on the run date at one level."""
    return alert_keys(baseline_with_usage(traffic, keys, run_date, mode), keys, run_date, thresholds)


def alert_rows(traffic, keys, run_date, thresholds=Thresholds(), mode=OBSERVED):
    """History rows of the groups that drop on the run date at one level, in no order."""
    rows = daily_baseline(traffic, keys, run_date, mode, counts=())
    history = staged(fallen_history(rows, keys, run_date, thresholds), "fallen")
    year = of_groups(traffic, history.select(*keys).distinct(), keys)
    usage = usage_reference(year, keys, run_date[:7])
    return of_used_groups(history, usage, keys, thresholds, null_safe=mode == CALENDAR)


def daily_alerts(traffic, keys, run_date, thresholds=Thresholds(), mode=OBSERVED):
    """Eight-day history of the groups that drop on the run date at one level, latest first."""
    rows = alert_rows(traffic, keys, run_date, thresholds, mode)
    return rows.orderBy(F.desc("date"), *keys)


def daily_click_lists(traffic, keys, run_date, thresholds=Thresholds(), mode=OBSERVED):
    """One row per group that drops on the run date at one level, with its click list."""
    return click_list(alert_rows(traffic, keys, run_date, thresholds, mode), keys, run_date)


def alerts_all_levels(
    traffic: DataFrame,
    run_date: str,
    thresholds: Thresholds = Thresholds(),
    mode: str = OBSERVED,
    usage: DataFrame | None = None,
) -> DataFrame:
    """Click lists (with their sums) of all levels, stacked: one pass over the lookback finds the
    groups that have fallen, one over the year takes the usage of these alone, or it is given."""
    _check(mode)
    clicks = clicks_only(lookback_rows(traffic, run_date))
    daily = daily_clicks_all_levels(clicks)
    if mode == OBSERVED:
        daily = daily.filter(keys_present(STACKED_KEYS))
    else:
        daily = densify(daily, STACKED_KEYS, run_date)
    rows = baseline(daily, STACKED_KEYS)
    history = staged(fallen_history(rows, STACKED_KEYS, run_date, thresholds), "fallen")
    if usage is None:
        groups = history.select(*STACKED_KEYS).distinct()
        year = of_groups(traffic, groups, STACKED_KEYS)
        usage = usage_reference_all_levels(year, run_date[:7], ALERT_IDS)
    # Columns below the level are NULL on both sides, so the join has to be null-safe.
    used = of_used_groups(history, usage, STACKED_KEYS, thresholds, null_safe=True)
    return click_totals(used, STACKED_KEYS, run_date)

