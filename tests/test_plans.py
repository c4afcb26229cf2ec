"""What the plans of the queries must show."""

import re

import pytest
from helpers import plan_of

from dropwatch import queries
from dropwatch.config import LEVELS, Thresholds
from dropwatch.operators import history
from dropwatch.plans import daily, hourly
from dropwatch.plans.usage import usage_reference_all_levels
from dropwatch.sources import fixtures

SF = "/root/testdata/sf0.001"
ANY = Thresholds(0, 0, 0, 0.5)


@pytest.mark.parametrize("name", ["usage_reference_zone", "clicks_lag", "daily_total"])
def test_dates_reach_the_scan(spark, name):
    plan = plan_of(queries.registered()[name](spark, SF))
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_long_table_dates_reach_the_scan(spark):
    assert "GreaterThanOrEqual(l_shipdate" in plan_of(queries.registered()["usage_reference_long"](spark, SF))


def test_only_fallen_groups_are_counted(spark):
    traffic = fixtures.traffic(spark, SF)
    one = plan_of(daily.alert_rows(traffic, LEVELS["website"], fixtures.RUN_DATE, ANY))
    # Children follow their parents: rows are semi-joined before the distinct counts expand them.
    assert 0 < one.index("Expand") < one.index("LeftSemi")


def test_all_levels_explode_a_row_once(spark):
    traffic = fixtures.traffic(spark, SF)
    usage = plan_of(usage_reference_all_levels(traffic, fixtures.RUN_MONTH))
    stacked = plan_of(daily.alerts_all_levels(traffic, fixtures.RUN_DATE, ANY, daily.CALENDAR))
    for plan in (usage, stacked):
        # One explode of the identifiers; the other hands the sums of a zone to its levels.
        assert len(re.findall(r"Generate explode\(.*value", plan)) == 1
        assert len(re.findall("Generate explode", plan)) == 2
        assert len(re.findall(r"Window \[", plan)) == 1


def test_a_day_without_fallen_groups_scans_no_year(spark):
    traffic = fixtures.traffic(spark, SF)
    plan = plan_of(daily.alerts_all_levels(traffic, fixtures.RUN_DATE, Thresholds(10**9, 0, 0, 0.5)))
    assert "parquet" not in plan


def test_no_rows_are_dealt_by_country_alone(spark):
    traffic = fixtures.traffic(spark, SF)
    plan = plan_of(daily.alerts_all_levels(traffic, fixtures.RUN_DATE, ANY, daily.CALENDAR))
    assert plan.count("BroadcastHashJoin") >= 4
    for keys in re.findall(r"hashpartitioning\(([^\n]*), \d+\)", plan):
        assert not re.fullmatch(r"(coalesce\()?country#\d+(, ?\), isnull\(country#\d+\))?", keys)


def test_rows_of_many_fallen_groups_are_dealt_by_whole_groups(spark, monkeypatch):
    traffic = fixtures.traffic(spark, SF)
    few = daily.alerts_all_levels(traffic, fixtures.RUN_DATE, ANY, daily.CALENDAR).collect()
    monkeypatch.setattr(history, "BROADCAST_GROUPS", 4)
    many = daily.alerts_all_levels(traffic, fixtures.RUN_DATE, ANY, daily.CALENDAR)
    assert sorted(map(str, many.collect())) == sorted(map(str, few)) and few


@pytest.mark.parametrize("name", ["alert_history_ordered", "alert_history", "hourly_low_traffic"])
def test_at_most_one_global_sort(spark, name):
    assert plan_of(queries.registered()[name](spark, SF)).count("rangepartitioning") <= 1


def test_event_time_hours_are_not_broadcast_by_hint(spark):
    traffic = hourly.hourly_traffic(fixtures.hourly_log(spark, SF), by_directory=False)
    frame = hourly.low_traffic_event_time(traffic)
    assert "ResolvedHint" not in frame._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("name", ["hourly_low_traffic_backfill", "hourly_compare", "daily_ranking"])
def test_a_query_stages_one_table(spark, monkeypatch, name):
    from dropwatch import session

    seen = []
    real = session.staged

    def counted(df, label):
        seen.append(label)
        return real(df, label)

    for module in (queries, daily):
        monkeypatch.setattr(module, "staged", counted)
    queries.registered()[name](spark, SF)
    assert len(seen) == 1
