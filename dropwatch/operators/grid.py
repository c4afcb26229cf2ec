"""Groups, their calendar grid, and series without missing days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropwatch.config import LOOKBACK_DAYS
from dropwatch.functions.calendar import dates_between


def distinct_groups(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.select(*keys).distinct()


def _window_dates(run_date: str, days: int):
    first = (date.fromisoformat(run_date) - timedelta(days=days)).isoformat()
    return dates_between(F.lit(first), F.lit(run_date))


def group_date_grid(
    rows: DataFrame, keys: Sequence[str], run_date: str, days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Every group with every date of the lookback. The dates are generated per group, which
    needs no join."""
    dates = F.explode(_window_dates(run_date, days)).alias("date")
    return distinct_groups(rows, keys).select(*keys, dates)


def densify(
    daily: DataFrame,
    keys: Sequence[str],
    run_date: str,
    days: int = LOOKBACK_DAYS,
    measures: Sequence[str] = ("clicks",),
) -> DataFrame:
    """Daily rows with the missing days of the lookback filled with 0.

    Instead of joining the grid to the data, each group's days (never more than the lookback)
    are gathered into a map and looked up per date. A NULL key is a group like any other.
    """
    values = F.struct(*measures)
    by_date = daily.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("date", values))).alias("days")
    )
    dense = by_date.select(*keys, "days", F.explode(_window_dates(run_date, days)).alias("date"))
    found = F.try_element_at("days", F.col("date"))
    return dense.select(*keys, "date", found.alias("found")).select(
        *keys, "date", *[F.col("found")[m].alias(m) for m in measures]
    ).na.fill(0, list(measures))


def clicks_per_day(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Clicks per group and day from all rows: a day without clicks counts 0, so that every
    group of the input is kept."""
    clicks = F.sum(F.when(F.col("clicks") == 1, 1).otherwise(0)).cast("long")
    return rows.groupBy(*keys, "date").agg(clicks.alias("clicks"))
