"""Hand-built cases for the daily series, usage references and alerts."""

import pytest
from helpers import click, clicks_on, days, layer, rows_of
from pyspark.sql import functions as F

from dropwatch.config import COUNT_COLS, LEVEL_COLS, LEVELS, STACKED_KEYS, Thresholds
from dropwatch.functions.calendar import (
    date_spine,
    dates_between,
    month_spine,
    shift_date,
    shift_hour,
    shift_month,
    trailing_months,
)
from dropwatch.operators import counts
from dropwatch.operators.baseline import baseline, with_lags
from dropwatch.operators.grid import densify, distinct_groups, group_date_grid
from dropwatch.operators.history import click_list, ordered_history
from dropwatch.operators.ranking import with_daily_share, with_ranking
from dropwatch.plans import daily, digest
from dropwatch.plans.daily import CALENDAR, OBSERVED
from dropwatch.plans.usage import medians_of_days, usage_backfill, usage_reference
from dropwatch.sources.readers import clicks_only, known_country

RUN = "2024-02-08"
ANY = Thresholds(min_clicks=0, min_ipua=0, min_domain=0, ratio=0.5)
COUNTRY = LEVELS["country"]
WINDOW = days(RUN, 22)


def year_before(country, **more):
    """A few days in the month before the run month give the group a usage reference."""
    return clicks_on(country, {d: 3 for d in days("2024-01-10", 3)}, **more)


def steady(country, on_run, per_day=10, **more):
    series = {d: per_day for d in WINDOW}
    series[RUN] = on_run
    return year_before(country, **more) + clicks_on(country, series, **more)


def test_filters_drop_non_clicks_sentinel_and_null_country(spark):
    rows = [click("US", RUN), click("US", RUN, clicks=0), click("***", RUN), click(None, RUN)]
    df = layer(spark, rows)
    assert clicks_only(df).count() == 3
    assert rows_of(known_country(df), "country") == [("US",), ("US",)]


def test_daily_counts_ignore_null_ids(spark):
    rows = clicks_on("US", {RUN: 3}) + [("US", "w", "a", "z", RUN, 1, None, None, "x", None, None)]
    out = counts.daily_counts(layer(spark, rows), COUNTRY)
    assert rows_of(out, "clicks", *COUNT_COLS) == [(4, 3, 3, 2, 3, 3)]


def test_observed_lag_counts_rows_and_calendar_lag_counts_days(spark):
    df = layer(spark, clicks_on("US", {"2024-01-01": 5, "2024-01-03": 7}))
    per_day = counts.daily_counts(df, COUNTRY).select("country", "date", "clicks")
    observed = with_lags(per_day, COUNTRY, [1]).filter("date = '2024-01-03'")
    assert rows_of(observed, "prev_clicks_1days") == [(5,)]
    dense = densify(per_day, COUNTRY, "2024-01-03", days=2)
    calendar = with_lags(dense, COUNTRY, [1]).filter("date = '2024-01-03'")
    assert rows_of(calendar, "prev_clicks_1days") == [(0,)]


def test_null_keys_vanish_in_observed_and_stay_in_calendar_and_usage(spark):
    rows = []
    for site in (None, "w"):
        rows += year_before("US", website=site) + clicks_on("US", {d: 2 for d in WINDOW}, website=site)
    df, keys = layer(spark, rows), LEVELS["website"]
    seen = distinct_groups(daily.daily_series(df, keys, RUN), keys)
    assert rows_of(seen, "website_name") == [("w",)]
    seen = distinct_groups(daily.daily_series(df, keys, RUN, CALENDAR), keys)
    assert rows_of(seen, "website_name") == [("w",), (None,)]
    assert usage_reference(df, keys, "2024-02").count() == 2


def test_calendar_alert_for_a_null_key_finds_its_usage(spark):
    df, keys = layer(spark, steady("US", 1, website=None)), LEVELS["website"]
    alerts = daily.daily_alert_keys(df, keys, RUN, ANY, CALENDAR)
    assert rows_of(alerts, *keys, "date_7_days_ahead", "alert_date") == [
        ("US", None, "2024-02-01", RUN)
    ]
    stacked = daily.alerts_all_levels(df, RUN, ANY, CALENDAR)
    assert rows_of(stacked, "level") == [(1,), (2,), (3,), (4,)]
    assert rows_of(daily.alerts_all_levels(df, RUN, ANY, OBSERVED), "level") == [(1,)]


def test_sentinel_country_is_absent_from_daily_and_present_in_usage(spark):
    df = layer(spark, steady("***", 0))
    assert daily.daily_series(df, COUNTRY, RUN).count() == 0
    assert rows_of(usage_reference(df, COUNTRY, "2024-02"), "country") == [("***",)]


def test_full_outage_alerts_in_calendar_mode_only(spark):
    df = layer(spark, steady("US", 0))
    assert daily.daily_alerts(df, COUNTRY, RUN, ANY, OBSERVED).count() == 0
    alerts = daily.daily_alerts(df, COUNTRY, RUN, ANY, CALENDAR)
    got = [tuple(r) for r in alerts.collect()]
    assert got == [("US", d, 0 if d == RUN else 10) for d in reversed(days(RUN, 8))]


def test_partial_drop_alerts_in_both_modes_with_its_list(spark):
    df = layer(spark, steady("US", 2))
    for mode in (OBSERVED, CALENDAR):
        lists = daily.daily_click_lists(df, COUNTRY, RUN, ANY, mode)
        assert rows_of(lists, "country", "run_date", "clicksList_day0_to_day7_before") == [
            ("US", RUN, "2, 10, 10, 10, 10, 10, 10, 10")
        ]


def test_a_gap_in_the_lookback_leaves_observed_mode_without_estimate(spark):
    series = {d: 10 for d in WINDOW if d != WINDOW[3]}
    series[RUN] = 1
    df = layer(spark, year_before("US") + clicks_on("US", series))
    last = daily.daily_baseline(df, COUNTRY, RUN).filter(F.col("date") == RUN)
    assert rows_of(last, "estimate", "ratio") == [(None, None)]
    assert daily.daily_alert_keys(df, COUNTRY, RUN, ANY, CALENDAR).count() == 1


def test_thresholds_are_strict(spark):
    df = layer(spark, steady("US", 5))
    for limits, found in [
        (Thresholds(0, 0, 0, 0.5), 0),
        (Thresholds(0, 0, 0, 0.51), 1),
        (Thresholds(10, 0, 0, 0.9), 0),
        (Thresholds(9, 9, 9, 0.9), 1),
        (Thresholds(9, 10, 9, 0.9), 0),
        (Thresholds(9, 9, 10, 0.9), 0),
    ]:
        assert daily.daily_alert_keys(df, COUNTRY, RUN, limits).count() == found, limits


def test_group_without_usage_reference_never_alerts(spark):
    def drop_on(run_date):
        return layer(spark, clicks_on("US", {d: 10 for d in days(run_date, 22)} | {run_date: 1}))

    # The January days of a February run's lookback are part of the year before its month ...
    assert daily.daily_alert_keys(drop_on(RUN), COUNTRY, RUN, ANY).count() == 1
    # ... but all days of this run's lookback are in its own month.
    assert daily.daily_alert_keys(drop_on("2024-01-25"), COUNTRY, "2024-01-25", ANY).count() == 0


def test_median_of_an_even_number_is_the_lower_one(spark):
    daily_rows = spark.createDataFrame(
        [("US", f"2024-01-0{n}", n) for n in (1, 2, 3, 4)],
        "country string, date string, count_domain_name bigint",
    )
    out = medians_of_days(daily_rows, COUNTRY)
    assert rows_of(out, "median_count_domain_name") == [(2,)]
    months = spark.createDataFrame([("2024-02",), ("2025-01",), ("2025-02",)], "run_month string")
    out = usage_backfill(daily_rows, COUNTRY, months)
    assert rows_of(out, "run_month", "median_count_domain_name") == [
        ("2024-02", 2),
        ("2025-01", 2),
    ]


def test_rank_ties_share_rank_and_cumulative_share(spark):
    rows = [("a", RUN, 5), ("b", RUN, 5), ("c", RUN, 3), ("d", RUN, 0)]
    df = spark.createDataFrame(rows, "country string, date string, clicks bigint")
    out = with_ranking(df)
    got = rows_of(out, "country", "daily_rank", "daily_cumulative_percentage")
    assert got == [("a", 1, 10 / 13), ("b", 1, 10 / 13), ("c", 3, 1.0), ("d", 4, 1.0)]
    silent = spark.createDataFrame([("a", RUN, 0)], "country string, date string, clicks bigint")
    assert rows_of(with_ranking(silent), "daily_traffic_percentage") == [(None,)]
    assert rows_of(with_daily_share(silent), "daily_traffic_percentage") == [(None,)]


def test_rank_over_many_equal_groups(spark):
    n = 5000
    df = spark.range(n).select(
        F.concat(F.lit("g"), "id").alias("country"),
        F.lit(RUN).alias("date"),
        F.when(F.col("id") < 10, F.col("id") + 2).otherwise(1).cast("long").alias("clicks"),
    )
    out = with_ranking(df)
    assert out.count() == n
    total = sum(range(2, 12)) + n - 10
    top = out.filter("daily_rank <= 2").orderBy("daily_rank")
    assert [r.daily_cumulative_percentage for r in top.collect()] == [11 / total, 21 / total]
    assert rows_of(out.filter("clicks = 1").select("daily_rank").distinct(), "daily_rank") == [(11,)]


def test_all_levels_in_one_pass_equal_one_level_at_a_time(spark):
    rows = []
    for n in range(600):
        country = [None, "US", "DE"][n % 3]
        rows.append(
            (country, ["w1", None][n % 2], f"a{n % 5 % 3}", f"z{n % 7 % 2}", f"2024-01-0{1 + n % 2}",
             1, n % 11 if n % 13 else None, f"p{n % 17}", None, f"c{n % 4}", f"d{n % 29}")
        )
    df = layer(spark, rows)
    stacked = counts.daily_counts_all_levels(df)
    sums = counts.daily_clicks_all_levels(df)
    for depth, keys in enumerate(LEVELS.values(), start=1):
        one = counts.daily_counts(df, keys)
        shown = [*keys, "date", "clicks", *COUNT_COLS]
        level = stacked.filter(F.col("level") == depth)
        assert rows_of(level, *shown) == rows_of(one, *shown)
        deeper = [c for c in LEVEL_COLS if c not in keys]
        assert level.filter(" OR ".join(f"{c} IS NOT NULL" for c in deeper) or "false").count() == 0
        shown = [*keys, "date", "clicks"]
        assert rows_of(sums.filter(F.col("level") == depth), *shown) == rows_of(one, *shown)


def test_grid_and_densify_cover_every_date_once(spark):
    df = layer(spark, clicks_on("US", {RUN: 2}) + [click("DE", RUN, clicks=0)])
    grid = group_date_grid(df, COUNTRY, RUN)
    assert grid.count() == 44 and grid.distinct().count() == 44
    dense = daily.dense_clicks(df, COUNTRY, RUN)
    assert dense.count() == 44
    assert rows_of(dense.filter("clicks > 0"), "country", "date", "clicks") == [("US", RUN, 2)]


def test_history_order_and_rank(spark):
    rows = [("a", RUN, 1), ("a", "2024-02-07", 5), ("b", RUN, 9), ("b", "2024-02-06", 3), ("c", RUN, 1)]
    history = spark.createDataFrame(rows, "country string, date string, clicks bigint")
    out = ordered_history(history, COUNTRY, RUN, keep_rank=True)
    assert [tuple(r) for r in out.collect()] == [
        ("a", RUN, 1, 1),
        ("a", "2024-02-07", 5, 2),
        ("b", RUN, 9, 1),
        ("b", "2024-02-06", 3, 2),
    ]
    assert ordered_history(history, COUNTRY, RUN).columns == ["country", "date", "clicks"]
    lists = click_list(history, COUNTRY, RUN)
    assert [r.country for r in lists.collect()] == ["b", "a", "c"]


def test_baseline_averages(spark):
    df = spark.createDataFrame(
        [("US", d, n) for n, d in enumerate(WINDOW, start=1)],
        "country string, date string, clicks bigint",
    )
    last = baseline(df, COUNTRY).filter(F.col("date") == RUN).first()
    assert (last.avg_prev_3days, last.estimate) == (20.0, 8.0)
    assert last.ratio == pytest.approx(22 / 8)


@pytest.mark.parametrize("run_date", ["2024-01-14", "2024-02-01", "2024-03-01", "2024-05-01"])
def test_lookback_crosses_years_months_and_the_leap_day(spark, run_date):
    window = days(run_date, 22)
    df = layer(spark, clicks_on("US", {d: 1 for d in days(run_date, 30)}))
    dates = [r.date for r in daily.lookback_rows(df, run_date).select("date").distinct().collect()]
    assert sorted(dates) == window
    spine = spark.range(1).select(
        F.explode(dates_between(shift_date(F.lit(run_date), -21), F.lit(run_date))).alias("d")
    )
    assert [r.d for r in spine.collect()] == window


def test_spines_and_shifts(spark):
    df = spark.createDataFrame([("2023-12-30",), ("2024-03-01",)], "date string")
    assert date_spine(df).count() == 63
    assert rows_of(month_spine(df), "month") == [("2023-12",), ("2024-01",), ("2024-02",), ("2024-03",)]
    assert date_spine(df.limit(0)).count() == 0
    one = spark.range(1).select(
        shift_month(F.lit("2024-01"), -1),
        shift_hour(F.lit("2024-03-01 00:00"), -1),
        trailing_months(F.lit("2024-02"), 12),
    ).first()
    assert one[0] == "2023-12" and one[1] == "2024-02-29 23:00"
    assert one[2][0] == "2023-02" and one[2][-1] == "2024-01" and len(one[2]) == 12


def test_digest_orders_missing_columns_first(spark):
    df = layer(spark, steady("US", 1) + steady("DE", 1))
    table = digest.digest(daily.alerts_all_levels(df, RUN, ANY)).collect()
    assert [(r.country, r.website_name, r.action, r.zone) for r in table] == [
        (c, *rest)
        for c in ("DE", "US")
        for rest in [(None,) * 3, ("w", None, None), ("w", "a", None), ("w", "a", "z")]
    ]


def test_message_continues_in_parts_without_losing_lines(spark):
    rows = [(4, f"c{n % 3}", f"w{n % 5}", "a", f"z{n:03d}", RUN, "1, 2") for n in range(95)]
    alerts = spark.createDataFrame(
        rows,
        "level int, country string, website_name string, action string, zone string, "
        "run_date string, clicksList_day0_to_day7_before string",
    )
    parts = digest.daily_message(alerts, ANY, lines_per_part=10).orderBy("part").collect()
    assert [p.part for p in parts] == list(range(1, 11))
    lines = [x for p in parts for x in p.body.split("\n") if x.startswith(RUN)]
    assert lines == [
        " | ".join([RUN, *r[1:5], "1, 2"]) for r in sorted(rows, key=lambda r: r[1:5])
    ]


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        daily.daily_series(layer(spark, []), COUNTRY, RUN, "lunar")


def test_stacked_alerts_equal_single_level_alerts(spark):
    rows = steady("US", 1) + steady("US", 0, website="v") + steady("DE", 10) + steady("DE", 1, zone="y")
    df = layer(spark, rows)
    for mode in (OBSERVED, CALENDAR):
        stacked = daily.alerts_all_levels(df, RUN, ANY, mode)
        for depth, keys in enumerate(LEVELS.values(), start=1):
            shown = [*keys, "run_date", "clicksList_day0_to_day7_before"]
            one = daily.daily_click_lists(df, keys, RUN, ANY, mode)
            assert rows_of(stacked.filter(F.col("level") == depth), *shown) == rows_of(one, *shown)
        assert set(STACKED_KEYS) < set(stacked.columns)
