"""The registered queries: every operator of the engine over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropwatch.config import LEVEL_COLS, LEVELS, MEDIAN_COLS, STACKED_KEYS, Thresholds
from dropwatch.functions import calendar
from dropwatch.operators import counts, grid
from dropwatch.operators.baseline import baseline, with_lags
from dropwatch.operators.history import ordered_history
from dropwatch.operators.ranking import with_daily_share
from dropwatch.plans import backfill, daily, digest, hourly
from dropwatch.plans.daily import CALENDAR, OBSERVED
from dropwatch.plans.usage import ALERT_IDS, usage_backfill, usage_of_folders, usage_reference
from dropwatch.session import fresh_path, staged
from dropwatch.sources import fixtures, readers, sinks

# Thresholds under which the test tables give alerts at every scale.
ALERT = Thresholds(min_clicks=1, min_ipua=1, min_domain=1, ratio=0.7)
HOURLY_MIN = 3
RUN_DATE, RUN_MONTH = fixtures.RUN_DATE, fixtures.RUN_MONTH
LONG_RUN_MONTH = "2000-01"
# The days that a run's lookback and a run month's usage reference look at; ends are excluded.
LOOKBACK = ("2024-01-18", "2024-02-09")
YEAR, LONG_YEAR = ("2023-02-01", "2024-02-01"), ("1999-01-01", "2000-01-01")

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def query(fn: Query) -> Query:
    return _add(fn.__name__, fn)


def _add(name: str, fn: Query) -> Query:
    _QUERIES[name] = fn
    return fn


def _rounded(df: DataFrame) -> DataFrame:
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, 6) for c in doubles})


def _clicks(spark, sf_dir):
    return readers.clicks_only(fixtures.traffic(spark, sf_dir))


# --- sources and sinks --------------------------------------------------------------------


@query
def scan_trailing_year(spark, sf_dir):
    path = fresh_path(spark, "click-layer")
    sinks.save_by_month(fixtures.traffic_long(spark, sf_dir), path)
    months = readers.months_before(LONG_RUN_MONTH)
    return readers.read_click_layer(spark, path, months, partitioned=True)


@query
def scan_lookback_window(spark, sf_dir):
    path = fresh_path(spark, "click-layer")
    sinks.save_by_month(fixtures.traffic(spark, sf_dir), path)
    months = readers.months_of_window(RUN_DATE)
    clicks = readers.read_click_layer(spark, path, months, partitioned=True)
    return readers.in_lookback(clicks, RUN_DATE)


@query
def tsv_hourly_log(spark, sf_dir):
    path = fresh_path(spark, "hourly-log")
    log = fixtures.hourly_log(spark, sf_dir)
    log.write.csv(f"{path}/data", sep="\t")
    log.limit(0).write.csv(f"{path}/_logs", sep="\t", header=True)
    return readers.read_tsv(spark, f"{path}/_logs/*", f"{path}/data/p*")


@query
def usage_reference_roundtrip(spark, sf_dir):
    base = fresh_path(spark, "results")
    usage = usage_reference(fixtures.traffic(spark, sf_dir), LEVELS["website"], RUN_MONTH)
    sinks.save_usage(usage, base, RUN_MONTH, "website")
    return readers.read_usage(spark, base, RUN_MONTH, "website")


@query
def alert_csv_roundtrip(spark, sf_dir):
    base = fresh_path(spark, "results")
    sinks.save_alerts(_alerts(spark, sf_dir), base, RUN_DATE)
    return digest.digest(readers.read_alerts(spark, sinks.alert_dir(base, RUN_DATE)), "source")


@query
def date_spine(spark, sf_dir):
    spine = calendar.date_spine(fixtures.traffic(spark, sf_dir))
    return spine.withColumn("lookback_start", calendar.shift_date("date", -21))


@query
def month_spine(spark, sf_dir):
    spine = calendar.month_spine(fixtures.traffic_long(spark, sf_dir))
    months = calendar.trailing_months("month", 12)
    return spine.select(
        "month",
        F.element_at(months, 1).alias("reference_start"),
        F.element_at(months, -1).alias("reference_end"),
    )


# --- filters ------------------------------------------------------------------------------


@query
def filter_clicks(spark, sf_dir):
    return _clicks(spark, sf_dir)


@query
def filter_sentinel(spark, sf_dir):
    return readers.known_country(fixtures.masked_traffic(spark, sf_dir))


# --- daily series -------------------------------------------------------------------------


@query
def distinct_groups(spark, sf_dir):
    rows = daily.lookback_rows(fixtures.traffic(spark, sf_dir), RUN_DATE)
    return grid.distinct_groups(rows, LEVEL_COLS)


@query
def group_date_grid(spark, sf_dir):
    rows = daily.lookback_rows(fixtures.traffic(spark, sf_dir), RUN_DATE)
    return grid.group_date_grid(rows, LEVEL_COLS, RUN_DATE)


@query
def densified_clicks(spark, sf_dir):
    return daily.dense_clicks(fixtures.traffic(spark, sf_dir), LEVEL_COLS, RUN_DATE)


@query
def daily_usage(spark, sf_dir):
    return counts.daily_usage(_clicks(spark, sf_dir), LEVEL_COLS)


@query
def daily_clicks(spark, sf_dir):
    return counts.daily_counts(_clicks(spark, sf_dir), LEVELS["website"])


@query
def multi_granularity_clicks(spark, sf_dir):
    return counts.daily_counts_all_levels(_clicks(spark, sf_dir))


def _observed(spark, sf_dir, level):
    traffic = fixtures.traffic(spark, sf_dir, *LOOKBACK)
    return daily.daily_series(traffic, LEVELS[level], RUN_DATE, counts=())


@query
def daily_total(spark, sf_dir):
    return counts.daily_total(_observed(spark, sf_dir, "website"))


@query
def daily_share(spark, sf_dir):
    return _rounded(with_daily_share(_observed(spark, sf_dir, "action")))


@query
def daily_ranking(spark, sf_dir):
    traffic = fixtures.traffic(spark, sf_dir, *LOOKBACK)
    return _rounded(daily.daily_ranking(traffic, LEVELS["website"], RUN_DATE))


@query
def daily_ranking_calendar(spark, sf_dir):
    traffic = fixtures.traffic(spark, sf_dir)
    return _rounded(daily.daily_ranking(traffic, LEVELS["zone"], RUN_DATE, CALENDAR))


@query
def clicks_lag(spark, sf_dir):
    return with_lags(_observed(spark, sf_dir, "website"), LEVELS["website"])


@query
def clicks_lag_calendar(spark, sf_dir):
    keys = LEVELS["action"]
    return with_lags(daily.dense_clicks(fixtures.traffic(spark, sf_dir), keys, RUN_DATE), keys)


@query
def clicks_estimate(spark, sf_dir):
    keys = LEVELS["website"]
    rows = baseline(_observed(spark, sf_dir, "website"), keys)
    return _rounded(rows.select(*keys, "date", "clicks", "avg_prev_3days", "estimate", "ratio"))


@query
def clicks_estimate_zone(spark, sf_dir):
    keys = LEVELS["zone"]
    rows = baseline(_observed(spark, sf_dir, "zone"), keys)
    return _rounded(rows.select(*keys, "date", "clicks", "avg_prev_3days", "estimate", "ratio"))


# --- usage reference ----------------------------------------------------------------------


def _usage_query(level):
    def run(spark, sf_dir):
        return usage_reference(fixtures.traffic(spark, sf_dir, *YEAR), LEVELS[level], RUN_MONTH)

    return run


for _level in LEVELS:
    _add(f"usage_reference_{_level}", _usage_query(_level))


@query
def usage_reference_long(spark, sf_dir):
    traffic = fixtures.traffic_long(spark, sf_dir, *LONG_YEAR)
    return usage_reference(traffic, LEVELS["zone"], LONG_RUN_MONTH)


@query
def usage_reference_backfill(spark, sf_dir):
    clicks = readers.clicks_only(fixtures.traffic_long(spark, sf_dir))
    rows = staged(counts.daily_counts_all_levels(clicks), "daily")
    return usage_backfill(rows, STACKED_KEYS, _next_months(rows))


def _next_months(rows, column="date"):
    spine = calendar.month_spine(rows, column)
    return spine.select(calendar.shift_month("month", 1).alias("run_month"))


# --- daily alerts -------------------------------------------------------------------------


@query
def clicks_with_usage(spark, sf_dir):
    keys = LEVELS["website"]
    rows = daily.baseline_with_usage(fixtures.traffic(spark, sf_dir), keys, RUN_DATE)
    return _rounded(rows.select(*keys, "date", "clicks", "estimate", "ratio", *MEDIAN_COLS))


@query
def daily_alert_keys(spark, sf_dir):
    traffic = fixtures.traffic(spark, sf_dir)
    return daily.daily_alert_keys(traffic, LEVELS["website"], RUN_DATE, ALERT)


@query
def alert_history(spark, sf_dir):
    return _history(spark, sf_dir, "website", CALENDAR)


def _history(spark, sf_dir, level, mode):
    traffic = fixtures.traffic(spark, sf_dir)
    return daily.daily_alerts(traffic, LEVELS[level], RUN_DATE, ALERT, mode)


@query
def alert_history_ordered(spark, sf_dir):
    traffic, keys = fixtures.traffic(spark, sf_dir), LEVELS["action"]
    rows = daily.alert_rows(traffic, keys, RUN_DATE, ALERT, CALENDAR)
    return ordered_history(rows, keys, RUN_DATE, keep_rank=True)


@query
def alert_click_list(spark, sf_dir):
    traffic = fixtures.traffic(spark, sf_dir)
    return daily.daily_click_lists(traffic, LEVELS["zone"], RUN_DATE, ALERT, CALENDAR)


def _alert_query(level, mode):
    return lambda spark, sf_dir: _history(spark, sf_dir, level, mode)


@query
def daily_alerts_observed_fuller(spark, sf_dir):
    """Zone alerts in observed mode over few, full groups, which alert at every scale."""
    traffic = fixtures.fuller_traffic(spark, sf_dir)
    return daily.daily_alerts(traffic, LEVELS["zone"], RUN_DATE, ALERT, OBSERVED)


for _mode in (OBSERVED, CALENDAR):
    for _level in LEVELS:
        _add(f"daily_alerts_{_mode}_{_level}", _alert_query(_level, _mode))


def _alerts(spark, sf_dir):
    return daily.alerts_all_levels(fixtures.traffic(spark, sf_dir), RUN_DATE, ALERT, CALENDAR)


@query
def daily_digest(spark, sf_dir):
    return digest.digest(_alerts(spark, sf_dir))


@query
def daily_digest_observed(spark, sf_dir):
    traffic = fixtures.traffic(spark, sf_dir)
    return digest.digest(daily.alerts_all_levels(traffic, RUN_DATE, ALERT, OBSERVED))


@query
def alert_counts(spark, sf_dir):
    return digest.alert_counts(_alerts(spark, sf_dir))


@query
def alert_message(spark, sf_dir):
    return digest.daily_message(_alerts(spark, sf_dir), ALERT)


def _backfill_query(mode):
    def run(spark, sf_dir):
        clicks = _clicks(spark, sf_dir)
        rows = staged(counts.daily_counts_all_levels(clicks, ALERT_IDS), "daily")
        usage = usage_backfill(rows, STACKED_KEYS, _next_months(rows))
        series = readers.known_country(rows).select(*STACKED_KEYS, "date", "clicks")
        runs = calendar.date_spine(rows).withColumnRenamed("date", "run_date")
        return _rounded(
            backfill.daily_alerts_backfill(series, usage, STACKED_KEYS, ALERT, mode, runs)
        )

    return run


_add("daily_alerts_backfill", _backfill_query(OBSERVED))
_add("daily_alerts_backfill_calendar", _backfill_query(CALENDAR))


# --- hourly -------------------------------------------------------------------------------


@query
def hourly_traffic(spark, sf_dir):
    return hourly.hourly_traffic(fixtures.hourly_log(spark, sf_dir))


def _hourly(spark, sf_dir):
    return staged(hourly.hourly_traffic(fixtures.hourly_log(spark, sf_dir)), "hourly")


@query
def hourly_compare(spark, sf_dir):
    return hourly.hourly_compare(_hourly(spark, sf_dir))


@query
def hourly_low_traffic(spark, sf_dir):
    return hourly.in_order(hourly.low_traffic(_hourly(spark, sf_dir), HOURLY_MIN))


@query
def hourly_low_traffic_event_time(spark, sf_dir):
    log = fixtures.hourly_log(spark, sf_dir)
    traffic = staged(hourly.hourly_traffic(log, by_directory=False), "hourly")
    return hourly.in_order(hourly.low_traffic_event_time(traffic, HOURLY_MIN))


def _missing(hours):
    """hours is used three times, and staged for that."""
    asked = fixtures.run_hours(hours.withColumnRenamed("hour", "dir_hour"))
    return hourly.missing_among(hours, asked)


def _observed_hours(spark, sf_dir):
    return staged(hourly.observed_hours(fixtures.hourly_log(spark, sf_dir)), "hours")


@query
def missing_hours(spark, sf_dir):
    return _missing(_observed_hours(spark, sf_dir))


@query
def missing_hours_listed(spark, sf_dir):
    """The same from the listing of stored logs, none of which is opened."""
    base = fresh_path(spark, "hourly-log")
    sinks.save_hours(fixtures.hourly_log(spark, sf_dir), base)
    return _missing(staged(readers.stored_hours(spark, f"{base}/year=*/*/*/*/p*"), "hours"))


@query
def missing_hour_message(spark, sf_dir):
    return digest.missing_message(_missing(_observed_hours(spark, sf_dir)))


@query
def hourly_alert_message(spark, sf_dir):
    low = hourly.low_traffic(_hourly(spark, sf_dir), HOURLY_MIN)
    return digest.hourly_message(low, HOURLY_MIN)


@query
def hourly_low_traffic_backfill(spark, sf_dir):
    traffic = _hourly(spark, sf_dir)
    return backfill.hourly_backfill(traffic, fixtures.run_hours(traffic), HOURLY_MIN)


@query
def hourly_backfill_stored(spark, sf_dir):
    """The same from logs stored in one directory per hour, of two versions: the columns of odd
    hours stand in another order."""
    base, log = fresh_path(spark, "hourly-log"), fixtures.hourly_log(spark, sf_dir)
    odd = F.substring("dir_hour", 12, 2).cast("int") % 2 == 1
    sinks.save_hours(log.filter(~odd), base)
    sinks.save_hours(log.filter(odd).select("ct_datetime", "ct_flume_host", "dir_hour"), base, "append")
    stored = readers.read_hours(spark, f"{base}/_logs/*/*/*/*/p*", f"{base}/year=*/*/*/*/p*")
    traffic = staged(hourly.hourly_traffic(stored), "hourly")
    return backfill.hourly_backfill(traffic, fixtures.run_hours(traffic), HOURLY_MIN)


@query
def usage_reference_folders(spark, sf_dir):
    """References of all run months from stored month folders and the counts kept of each. Rows of
    a month's first two days lie in the folder of the month before as well, at every fifth key."""
    base, clicks = fresh_path(spark, "folders"), fixtures.folder_traffic(spark, sf_dir)
    sinks.save_by_folder(clicks, f"{base}/clicks")
    months = [(y, m) for y in range(1994, 2002) for m in range(1, 13)]
    rows = readers.clicks_only(readers.month_folders(spark, f"{base}/clicks", months, partitioned=True))
    stored = staged(counts.daily_counts_all_levels(rows, scope=("folder",)), "daily")
    return usage_of_folders(stored, rows, _next_months(stored, "folder"))
