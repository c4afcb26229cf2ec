"""Hand-built cases for the hourly reports."""

from datetime import datetime, timezone

from helpers import rows_of

from dropwatch.plans import digest, hourly
from dropwatch.plans.backfill import hourly_backfill

H5, H6, H7 = "2024-02-14 05:00", "2024-02-14 06:00", "2024-02-14 07:00"
SHOWN = ("run_hour", "server", "date_hour", "traffic", "traffic_prev1h")


def epoch(hour):
    at = datetime.strptime(hour, "%Y-%m-%d %H:%M").replace(tzinfo=timezone.utc)
    return str(int(at.timestamp()) * 1000 + 59_999)


def log_of(spark, groups):
    """groups: (server, event hour, directory hour, number of records)"""
    rows = [(s, epoch(e), d) for s, e, d, n in groups for _ in range(n)]
    return spark.createDataFrame(rows, "ct_flume_host string, ct_datetime string, dir_hour string")


def runs(spark, *hours):
    return spark.createDataFrame([(h,) for h in hours], "run_hour string")


def directory(spark, groups, threshold):
    return hourly.low_traffic(hourly.hourly_traffic(log_of(spark, groups)), threshold)


def event_time(spark, groups, threshold):
    traffic = hourly.hourly_traffic(log_of(spark, groups), by_directory=False)
    return hourly.low_traffic_event_time(traffic, threshold)


def test_drop_and_silence_alert_in_both_modes(spark):
    groups = [
        ("quiet", H5, H5, 20), ("quiet", H6, H6, 2),
        ("gone", H5, H5, 30),
        ("fine", H5, H5, 20), ("fine", H6, H6, 20),
        ("small", H5, H5, 9), ("new", H6, H6, 1),
    ]
    expected = [(H6, "gone", H6, 0, 30), (H6, "quiet", H6, 2, 20)]
    assert rows_of(directory(spark, groups, 10), *SHOWN) == expected
    assert rows_of(event_time(spark, groups, 10), *SHOWN) == expected
    ordered = hourly.in_order(directory(spark, groups, 10)).collect()
    assert [r.server for r in ordered] == ["gone", "quiet"]


def test_threshold_is_strict_now_and_inclusive_before(spark):
    groups = [("a", H5, H5, 10), ("a", H6, H6, 10), ("b", H5, H5, 10), ("b", H6, H6, 9)]
    assert rows_of(directory(spark, groups, 10), "server") == [("b",)]


def test_straggler_makes_a_false_alert_by_directory_only(spark):
    groups = [("a", H5, H5, 40), ("a", H6, H6, 50), ("a", H5, H6, 3)]
    assert rows_of(directory(spark, groups, 10), *SHOWN) == [(H6, "a", H5, 3, 40)]
    assert event_time(spark, groups, 10).count() == 0
    compared = hourly.hourly_compare(hourly.hourly_traffic(log_of(spark, groups)))
    assert rows_of(compared, *SHOWN) == [(H6, "a", H5, 3, 40), (H6, "a", H6, 50, 40)]


def test_null_server_alerts_falsely_by_directory_only(spark):
    groups = [(None, H5, H5, 40), (None, H6, H6, 50)]
    assert rows_of(directory(spark, groups, 10), *SHOWN) == [(H6, None, H6, 0, 40)]
    assert event_time(spark, groups, 10).count() == 0


def test_event_time_does_not_depend_on_directories(spark):
    groups = [("a", H5, H5, 40), ("a", H6, H6, 3), ("b", H5, H5, 12), ("b", H6, H6, 30)]
    moved = [(s, e, H7, n) for s, e, _, n in groups]
    assert rows_of(event_time(spark, groups, 10), *SHOWN) == rows_of(
        event_time(spark, moved, 10), *SHOWN
    )


def test_malformed_times_give_a_null_hour(spark):
    times = ["abc", "", None, "1.5e400", "NaN", "1e30", "-1e30"]
    rows = [("a", t, H5) for t in times]
    log = spark.createDataFrame(rows, "ct_flume_host string, ct_datetime string, dir_hour string")
    out = hourly.hourly_traffic(log)
    assert rows_of(out, "server", "date_hour", "traffic") == [("a", None, 7)]


def test_missing_hours_report_the_run_hour_first(spark):
    hours = ["2024-02-28 22:00", "2024-02-28 23:00", "2024-02-29 02:00"]
    log = log_of(spark, [("a", h, h, 1) for h in hours])
    asked = runs(spark, *[f"2024-02-29 {h:02d}:00" for h in range(5)])
    found = hourly.missing_hours(log, asked)
    assert rows_of(found, "run_hour", "missing_hour") == [
        ("2024-02-29 00:00", "2024-02-29 00:00"),
        ("2024-02-29 01:00", "2024-02-29 01:00"),
        ("2024-02-29 02:00", "2024-02-29 01:00"),
        ("2024-02-29 03:00", "2024-02-29 03:00"),
        ("2024-02-29 04:00", "2024-02-29 04:00"),
    ]
    assert digest.missing_message(found).count() == 5


def test_missing_hours_at_both_ends_of_the_log(spark):
    log = log_of(spark, [("a", h, h, 1) for h in (H5, H6)])
    found = hourly.missing_hours(log, runs(spark, "2024-02-14 04:00", H5, H6, H7, "2024-02-14 08:00"))
    assert rows_of(found, "run_hour", "missing_hour") == [
        ("2024-02-14 04:00", "2024-02-14 04:00"),
        (H5, "2024-02-14 04:00"),
        (H7, H7),
        ("2024-02-14 08:00", "2024-02-14 08:00"),
    ]


def test_only_run_hours_asked_for_report_low_traffic(spark):
    groups = [("a", H5, H5, 40), ("a", H6, H6, 1), ("b", H6, H6, 40), ("b", H7, H7, 1)]
    traffic = hourly.hourly_traffic(log_of(spark, groups))
    assert rows_of(hourly.low_traffic(traffic, 10, runs(spark, H7)), "run_hour") == [(H7,)]


def test_runs_next_to_a_missing_hour_report_no_low_traffic(spark):
    groups = [("a", H5, H5, 40), ("a", H7, H7, 1)]
    assert directory(spark, groups, 10).count() == 0
    traffic = hourly.hourly_traffic(log_of(spark, groups))
    out = hourly_backfill(traffic, runs(spark, H6, H7), 10)
    assert rows_of(out, "run_hour", "report", "missing_hour") == [
        (H6, "missing hour", H6),
        (H7, "missing hour", H6),
    ]


def test_event_hours_do_not_depend_on_the_session_zone(spark):
    log = log_of(spark, [("a", H5, H5, 1)])
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert rows_of(hourly.hourly_traffic(log), "date_hour") == [(H5,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lines_of_a_total_outage_are_numbered_in_order(spark):
    rows = [(H6, f"s{n:04d}", H6, 0, 100 + n % 7) for n in range(3000)]
    alerts = spark.createDataFrame(rows, "run_hour string, server string, date_hour string, traffic long, traffic_prev1h long")
    parts = digest.hourly_message(alerts, 10, lines_per_part=250).orderBy("part").collect()
    lines = [x for p in parts for x in p.body.split("\n")[2:]]
    wanted = sorted(rows, key=lambda r: (-r[4], r[1]))
    assert lines == [f"{r[1]} | {H6} | 0 | {r[4]}" for r in wanted]


def test_message_lists_servers_by_traffic(spark):
    groups = [("a", H5, H5, 20), ("a", H6, H6, 2), ("b", H5, H5, 30), ("c", H5, H5, 40)]
    body = digest.hourly_message(directory(spark, groups, 10), 10).first().body
    assert body.split("\n")[2:] == [
        f"c | {H6} | 0 | 40", f"b | {H6} | 0 | 30", f"a | {H6} | 2 | 20"
    ]
