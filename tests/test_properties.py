"""Relations between results on the test tables."""

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from dropwatch.config import CLICK_LIST, LEVEL_COLS, STACKED_KEYS, Thresholds
from dropwatch.operators.counts import daily_counts_all_levels
from dropwatch.plans import backfill, daily, hourly
from dropwatch.plans.daily import CALENDAR, OBSERVED
from dropwatch.plans.usage import usage_backfill, usage_reference_all_levels
from dropwatch.queries import ALERT
from dropwatch.sources import fixtures
from dropwatch.sources.readers import clicks_only, known_country

SF = "/root/testdata/sf0.01"
LIMITS = Thresholds(min_clicks=0, min_ipua=0, min_domain=0, ratio=0.7)


@pytest.fixture(scope="module")
def traffic(spark):
    return fixtures.traffic(spark, SF).cache()


@pytest.fixture(scope="module")
def counted(traffic):
    return daily_counts_all_levels(clicks_only(traffic)).cache()


def test_observed_alerts_are_calendar_alerts(traffic):
    lists = {
        mode: daily.alerts_all_levels(traffic, fixtures.RUN_DATE, LIMITS, mode)
        for mode in (OBSERVED, CALENDAR)
    }
    shown = (*STACKED_KEYS, CLICK_LIST)
    observed = set(rows_of(lists[OBSERVED], *shown))
    assert observed and observed < set(rows_of(lists[CALENDAR], *shown))


@pytest.mark.parametrize("mode", [OBSERVED, CALENDAR])
def test_backfill_equals_single_runs(spark, traffic, counted, mode):
    dates = ["2024-02-01", "2024-02-05", fixtures.RUN_DATE]
    runs = spark.createDataFrame([(d,) for d in dates], "run_date string")
    months = spark.createDataFrame([("2024-02",)], "run_month string")
    usage = usage_backfill(counted, STACKED_KEYS, months)
    series = known_country(counted).select(*STACKED_KEYS, "date", "clicks")
    every = backfill.daily_alerts_backfill(series, usage, STACKED_KEYS, LIMITS, mode, runs)
    shown = (*STACKED_KEYS, CLICK_LIST)
    for run_date in dates:
        single = daily.alerts_all_levels(traffic, run_date, LIMITS, mode)
        assert rows_of(every.filter(F.col("run_date") == run_date), *shown) == rows_of(
            single, *shown
        )


def test_usage_backfill_equals_the_sketch_of_a_single_month(spark, traffic, counted):
    months = spark.createDataFrame([("2024-02",)], "run_month string")
    every = usage_backfill(counted, STACKED_KEYS, months).drop("run_month")
    single = usage_reference_all_levels(traffic, "2024-02")
    assert rows_of(every, *single.columns) == rows_of(single, *single.columns)


def test_median_is_one_of_the_daily_counts(traffic, counted):
    usage = usage_reference_all_levels(traffic, "2024-02")
    name = "count_domain_name"
    seen = counted.filter("date < '2024-02-01'").select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in LEVEL_COLS], "level", name
    )
    medians = usage.select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in LEVEL_COLS],
        "level",
        F.col(f"median_{name}").alias(name),
    )
    assert medians.count() > 0
    assert medians.join(seen, list(medians.columns), "left_anti").count() == 0


def test_event_time_alerts_do_not_depend_on_the_arrival_hour(spark):
    log = fixtures.hourly_log(spark, SF)
    late = log.withColumn("dir_hour", F.lit("2024-01-01 00:00"))
    found = [
        rows_of(
            hourly.low_traffic_event_time(hourly.hourly_traffic(x, by_directory=False), 2),
            *hourly.ALERT_COLUMNS,
        )
        for x in (log, late)
    ]
    assert found[0] == found[1] and len(found[0]) == 657


@pytest.mark.parametrize("mode,expected", [(OBSERVED, [1, 7, 4, 0]), (CALENDAR, [1, 9, 33, 19])])
def test_number_of_alerts(traffic, mode, expected):
    alerts = daily.alerts_all_levels(traffic, fixtures.RUN_DATE, ALERT, mode)
    found = {r.level: r["count"] for r in alerts.groupBy("level").count().collect()}
    assert [found.get(n, 0) for n in (1, 2, 3, 4)] == expected
