"""Many runs in one job: every run date, run hour or run month at once.

Nothing loops over runs. Work is multiplied only after the daily or hourly aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropwatch.config import (
    CLICK_LIST,
    HISTORY_DAYS,
    HOURLY_THRESHOLD,
    LOOKBACK_DAYS,
    WEEKDAY_LAGS,
    Thresholds,
)
from dropwatch.functions.calendar import month_of, shift_date
from dropwatch.functions.measures import (
    drop_ratio,
    has_fallen,
    is_used,
    lag_name,
    weekday_estimate,
)
from dropwatch.operators.counts import keys_present
from dropwatch.operators.history import with_usage
from dropwatch.plans.daily import CALENDAR, OBSERVED
from dropwatch.plans.hourly import (
    low_traffic,
    low_traffic_event_time_runs,
    missing_among,
    observed_hours,
)


def observed_runs(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Baseline and click list of every group for every run date on which it has an estimate.

    A group has one only if it was active on all days of the lookback, that is, if its 21st
    earlier row is 21 days old. So one window over the whole series serves all run dates.
    """
    series = Window.partitionBy(*keys).orderBy("date")
    recent = F.collect_list("clicks").over(series.rowsBetween(-HISTORY_DAYS, 0))
    oldest = F.lag("date", LOOKBACK_DAYS).over(series)
    rows = daily.filter(keys_present(keys)).withColumns(
        {
            **{lag_name(k): F.lag("clicks", k).over(series) for k in WEEKDAY_LAGS},
            "recent": recent,
            "oldest": oldest,
        }
    )
    unbroken = rows.filter(F.col("oldest") == shift_date("date", -LOOKBACK_DAYS))
    return _estimated(
        unbroken.withColumnRenamed("date", "run_date").withColumn(
            CLICK_LIST, _joined(F.reverse("recent"))
        ),
        keys,
    )


def calendar_runs(daily: DataFrame, keys: Sequence[str], run_dates: DataFrame) -> DataFrame:
    """The same by calendar days. Each day's row is handed to the run dates that look back at
    it, ten of them, and one aggregation puts a run's values side by side; silent days need no
    rows. run_dates has one row per date of the calendar, which bounds the broadcast."""
    shifts = sorted({*range(HISTORY_DAYS + 1), *WEEKDAY_LAGS})
    handed = daily.select(
        *keys, "date", "clicks", F.explode(F.array(*[F.lit(s) for s in shifts])).alias("shift")
    ).withColumn("run_date", shift_date("date", F.col("shift")))
    wanted = handed.join(F.broadcast(run_dates.select("run_date")), "run_date", "left_semi")
    value = {
        s: F.sum(F.when(F.col("shift") == s, F.col("clicks")).otherwise(0)).cast("long")
        for s in shifts
    }
    runs = wanted.groupBy(*keys, "run_date").agg(
        *[value[s].alias(f"day_{s}") for s in shifts]
    )
    named = runs.withColumn("clicks", F.col("day_0")).withColumns(
        {lag_name(k): F.col(f"day_{k}") for k in WEEKDAY_LAGS}
    )
    recent = F.array(*[F.col(f"day_{s}") for s in range(HISTORY_DAYS + 1)])
    return _estimated(named.withColumn(CLICK_LIST, _joined(recent)), keys)


def _joined(values):
    return F.concat_ws(", ", F.transform(values, lambda v: v.cast("string")))


def _estimated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        rows.withColumn("estimate", weekday_estimate())
        .withColumn("ratio", drop_ratio(F.col("clicks"), F.col("estimate")))
        .select(*keys, "run_date", "clicks", "estimate", "ratio", CLICK_LIST)
    )


def daily_alerts_backfill(
    daily: DataFrame,
    usage: DataFrame,
    keys: Sequence[str],
    thresholds: Thresholds = Thresholds(),
    mode: str = OBSERVED,
    run_dates: DataFrame | None = None,
) -> DataFrame:
    """Alerts of every run date, each judged by the usage reference of its own month.

    daily holds clicks per group and date without the sentinel country; usage holds medians
    per run_month and group.
    """
    if mode == CALENDAR:
        runs = calendar_runs(daily, keys, run_dates)
    else:
        runs = observed_runs(daily, keys)
        if run_dates is not None:
            runs = runs.join(F.broadcast(run_dates.select("run_date")), "run_date", "left_semi")
    # Checked first: what the estimate alone rules out need not meet the usage reference.
    likely = runs.filter(has_fallen(thresholds)).withColumn("run_month", month_of("run_date"))
    judged = with_usage(likely, usage, ["run_month", *keys], null_safe=True, how="inner")
    alerts = judged.filter(is_used(thresholds))
    return alerts.select("run_date", *keys, "clicks", "estimate", "ratio", CLICK_LIST)


def hourly_backfill(
    traffic: DataFrame,
    run_hours: DataFrame,
    threshold: int = HOURLY_THRESHOLD,
    hours: DataFrame | None = None,
    event_time: bool = False,
) -> DataFrame:
    """What the hourly run of every hour asked for reports: a missing hour, or servers with low
    traffic (directory mode, or by event time within the run's two directories). Expects
    hourly_traffic by directory, staged if it is costly; hours are those that have data."""
    hours = observed_hours(traffic) if hours is None else hours
    if event_time:
        low = low_traffic_event_time_runs(traffic, hours, run_hours, threshold)
    else:
        low = low_traffic(traffic, threshold, run_hours, hours)
    gaps = missing_among(hours, run_hours).withColumn("report", F.lit("missing hour"))
    return low.withColumn("report", F.lit("low traffic")).unionByName(gaps, allowMissingColumns=True)
