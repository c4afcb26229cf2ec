"""Readers, sinks and jobs over directories in the stored layouts."""

import re
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from helpers import click, clicks_on, days, layer, plan_of, rows_of
from test_daily import ANY, RUN, steady
from test_hourly import H5, H6, epoch

from dropwatch import jobs, session
from dropwatch.plans.daily import CALENDAR
from dropwatch.sources import readers, sinks


def store_plain(spark, rows, base):
    """Month directories with bare numbers."""
    for month in sorted({r[4][:7] for r in rows}):
        part = [r for r in rows if r[4].startswith(month)]
        layer(spark, part).write.parquet(f"{base}/{month.replace('-', '/')}")


def store_log(base, hour, lines):
    folder = Path(readers.hour_directory(base, hour))
    (folder / "_logs").mkdir(parents=True)
    (folder / "_logs" / "header.tsv").write_text("ct_flume_host\tct_datetime\tother\n")
    for n, line in enumerate(lines):
        (folder / f"part-{n:05d}").write_text("".join("\t".join(x) + "\n" for x in line))


def test_months_of_windows():
    assert readers.months_before("2024-02")[0] == (2023, 2)
    assert readers.months_before("2024-02")[-1] == (2024, 1)
    assert len(readers.months_before("2024-02")) == 12
    assert readers.months_of_window("2024-01-14") == [(2023, 12), (2024, 1)]
    assert readers.months_of_window("2024-01-31") == [(2024, 1)]
    assert readers.previous_hour("2024-03-01 00:00") == "2024-02-29 23:00"


def test_both_layouts_give_the_same_rows(spark, tmp_path):
    rows = [click("US", d) for d in days("2024-02-10", 60)]
    store_plain(spark, rows, tmp_path / "plain")
    sinks.save_by_month(layer(spark, rows), str(tmp_path / "parts"))
    months = readers.months_of_window(RUN)
    plain = readers.read_click_layer(spark, str(tmp_path / "plain"), months)
    parts = readers.read_click_layer(spark, str(tmp_path / "parts"), months, partitioned=True)
    assert rows_of(plain, *plain.columns) == rows_of(parts, *plain.columns)
    assert readers.in_lookback(parts, RUN).count() == 22


def test_filters_reach_the_scan(spark, tmp_path):
    rows = [click("US", d) for d in days("2024-02-10", 60)]
    sinks.save_by_month(layer(spark, rows), str(tmp_path))
    months = readers.months_of_window(RUN)
    clicks = readers.read_click_layer(spark, str(tmp_path), months, partitioned=True)
    kept = readers.clicks_only(readers.known_country(readers.in_lookback(clicks, RUN)))
    plan = plan_of(kept.groupBy("country").count())
    pushed = plan[plan.index("PushedFilters") :]
    assert "GreaterThanOrEqual(date,2024-01-18)" in pushed and "EqualTo(clicks,1)" in pushed
    assert re.search(r"PartitionFilters: \[[^\]]*year[^\]]*month", plan)
    schema = plan[plan.index("ReadSchema") :]
    assert "domain_name" not in schema and "zone" not in schema


def test_alert_plan_shuffles_each_series_once(spark, tmp_path):
    from dropwatch.plans import daily
    from test_daily import COUNTRY

    layer(spark, steady("US", 2)).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    series = daily.daily_baseline(df, COUNTRY, RUN, counts=())
    plan = plan_of(series)
    assert plan.count("Window [") == 1 and plan.count("Exchange hash") == 2
    assert "user_group" not in plan[plan.index("ReadSchema") :]


@pytest.mark.parametrize("kind", ["csv", "CSV", "parquet", "Parquet"])
def test_sink_replaces_and_ignores_case(spark, tmp_path, kind):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    sinks.save(df, path, kind)
    sinks.save(df.limit(1), path, kind)
    if kind.lower() == "csv":
        assert rows_of(spark.read.csv(f"{path}_csv", header=True), "k", "v") == [("a", "1")]
        assert len(list(Path(f"{path}_csv").glob("part-*"))) == 1
    else:
        assert rows_of(spark.read.parquet(path), "k", "v") == [("a", 1)]


@pytest.mark.parametrize("kind", ["avro", "anything"])
def test_avro_without_its_package_is_a_clear_error(spark, tmp_path, kind):
    with pytest.raises(Exception, match="(?i)avro"):
        sinks.save(spark.range(1), str(tmp_path / "out"), kind)


def test_unknown_type_leaves_the_csv(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)avro"):
        sinks.save(spark.createDataFrame([("a", 1)], "k string, v int"), str(tmp_path / "out"), "anything")
    assert rows_of(spark.read.csv(str(tmp_path / "out_csv"), header=True), "k") == [("a",)]


def test_data_without_a_header_is_an_error(spark, tmp_path):
    store_log(str(tmp_path), H6, [[("a", epoch(H6), "x")]])
    header = next((Path(readers.hour_directory(str(tmp_path), H6)) / "_logs").iterdir())
    header.unlink()
    with pytest.raises(FileNotFoundError, match="_logs"):
        readers.read_hour(spark, str(tmp_path), H6)


def test_run_labels():
    assert sinks.run_label("2024-02-08") == "2024_02_08"
    assert sinks.run_label("2024-02-14 06:00") == "2024_02_14_06"


def test_hour_logs_take_their_columns_from_the_header_file(spark, tmp_path):
    base = str(tmp_path)
    store_log(base, H6, [[("a", epoch(H6), "x")], [("b", epoch(H6), "y")]])
    log = readers.read_hour(spark, base, H6)
    assert set(log.dtypes) >= {("ct_flume_host", "string"), ("ct_datetime", "string")}
    assert rows_of(log, "ct_flume_host", "other", "dir_hour") == [("a", "x", H6), ("b", "y", H6)]
    assert readers.read_hour(spark, base, H5) is None
    store_log(base, H5, [[("c", epoch(H5), "z")]])
    both = readers.read_hours(spark, f"{base}/*/*/*/*/_logs/*.tsv", f"{base}/*/*/*/*/p*")
    assert rows_of(both, "ct_flume_host", "dir_hour") == [("a", H6), ("b", H6), ("c", H5)]


def test_usage_and_daily_jobs(spark, tmp_path):
    source, out = str(tmp_path / "clicks"), str(tmp_path / "out")
    months = clicks_on("US", {f"2023-{m:02d}-05": 1 for m in range(2, 13)})
    store_plain(spark, steady("US", 1) + months, source)
    jobs.run_usage(spark, source, out, "2024-02")
    usage = readers.read_usage(spark, out, "2024-02", "country")
    assert rows_of(usage, "country", "median_count_domain_name") == [("US", 3)]
    table = jobs.run_daily(spark, source, out, RUN, ANY, CALENDAR)
    assert [r.zone for r in table.collect()] == [None, None, None, "z"]
    stored = readers.read_alerts(spark, sinks.alert_dir(out, RUN))
    shown = ("run_date", "country", "website_name", "action", "zone")
    assert rows_of(stored, *shown) == rows_of(table, *shown)
    assert rows_of(stored, "source")[0] == ("country",)
    message = spark.read.parquet(f"{sinks.alert_dir(out, RUN)}/message")
    assert message.count() == 1

    # A later run that finds nothing leaves nothing behind.
    jobs.run_daily(spark, source, out, RUN)
    assert readers.read_alerts(spark, sinks.alert_dir(out, RUN)).count() == 0
    assert readers.read_alerts(spark, f"{out}/alert/2024_02_09") is None


def test_usage_job_counts_each_month_once(spark, tmp_path):
    source, store = str(tmp_path / "clicks"), str(tmp_path / "counts")
    rows = [c for m in range(1, 13) for c in clicks_on("US", {f"2023-{m:02d}-05": m})]
    rows += clicks_on("US", {"2024-01-05": 30}) + clicks_on("DE", {"2024-01-06": 2})
    store_plain(spark, rows, source)
    found = {}
    for run_month in ("2024-01", "2024-02"):
        for name, counts in (("direct", None), ("stored", store)):
            out = str(tmp_path / name)
            jobs.run_usage(spark, source, out, run_month, counts=counts)
            usage = readers.read_usage(spark, out, run_month, "website")
            found[run_month, name] = rows_of(usage, *usage.columns)
    assert found["2024-01", "direct"] == found["2024-01", "stored"]
    assert found["2024-02", "direct"] == found["2024-02", "stored"]
    assert len(found["2024-02", "direct"]) == 2
    assert len(readers.finished_folders(spark, f"{store}/manifest")) == 13


def both_ways(spark, tmp_path, source, run_month, store):
    found = []
    for name, counts in (("direct", None), ("stored", store)):
        out = str(tmp_path / name)
        jobs.run_usage(spark, source, out, run_month, counts=counts)
        usage = readers.read_usage(spark, out, run_month, "country")
        found.append(rows_of(usage, *usage.columns))
    return found


def test_late_rows_do_not_replace_a_stored_month(spark, tmp_path):
    source, store = str(tmp_path / "clicks"), str(tmp_path / "counts")
    store_plain(spark, [c for m in range(1, 12) for c in clicks_on("US", {f"2023-{m:02d}-05": 1})], source)
    december = clicks_on("US", {d: 4 for d in days("2023-12-20", 20)})
    layer(spark, december).write.parquet(f"{source}/2023/12")
    direct, stored = both_ways(spark, tmp_path, source, "2024-01", store)
    assert direct == stored
    # January's folder has a row of December, February's has no click at all.
    layer(spark, [click("US", "2023-12-31"), click("US", "2024-01-03")]).write.parquet(f"{source}/2024/01")
    layer(spark, [click("US", "2024-02-03", clicks=0)]).write.parquet(f"{source}/2024/02")
    for run_month in ("2024-02", "2024-03"):
        direct, stored = both_ways(spark, tmp_path, source, run_month, store)
        assert direct == stored
    assert len(readers.finished_folders(spark, f"{store}/manifest")) == 14


def test_kept_counts_follow_the_folders_of_the_run(spark, tmp_path):
    source, store = str(tmp_path / "clicks"), str(tmp_path / "counts")
    rows = [c for m in range(1, 13) for c in clicks_on("US", {f"2023-{m:02d}-05": 1})]
    for month in range(1, 13):
        mine = [r for r in rows if r[4].startswith(f"2023-{month:02d}")]
        # January's folder has five more users of a day that February's folder has as well.
        mine += [click("US", "2023-02-05", user=n) for n in range(5)] if month == 1 else []
        layer(spark, mine).write.parquet(f"{source}/2023/{month:02d}")
    for month in (1, 2):
        store_plain(spark, clicks_on("US", {f"2024-{month:02d}-05": 2}), source)
    found = {m: both_ways(spark, tmp_path, source, m, store) for m in ("2024-01", "2024-02")}
    # The folder has left the year, and then the store.
    Path(f"{source}/2023/01").rename(tmp_path / "expired")
    Path(f"{source}/2023/02").rename(tmp_path / "expired too")
    found["2024-03"] = both_ways(spark, tmp_path, source, "2024-03", store)
    for direct, stored in found.values():
        assert direct == stored
    # A folder of the year that is gone ends both ways.
    Path(f"{source}/2023/07").rename(tmp_path / "lost")
    for counts in (None, store):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            jobs.run_usage(spark, source, str(tmp_path / "x"), "2024-03", counts=counts)


def test_a_folder_written_again_is_counted_again(spark, tmp_path):
    source, store = str(tmp_path / "clicks"), str(tmp_path / "counts")
    store_plain(spark, [c for m in range(1, 13) for c in clicks_on("US", {f"2023-{m:02d}-05": 3})], source)
    first, _ = both_ways(spark, tmp_path, source, "2024-01", store)
    for month in range(1, 13):
        again = clicks_on("US", {f"2023-{month:02d}-05": 1 if month < 12 else 0})
        layer(spark, again).write.mode("overwrite").parquet(f"{source}/2023/{month:02d}")
    direct, stored = both_ways(spark, tmp_path, source, "2024-01", store)
    assert direct == stored != first


def test_malformed_dates_stop_nothing_and_are_reported(spark, tmp_path):
    source, store, bad = str(tmp_path / "clicks"), str(tmp_path / "counts"), ["unknown", "2023-02-30", "2023-2-5", "", None]
    store_plain(spark, [c for m in range(1, 13) for c in clicks_on("US", {f"2023-{m:02d}-05": 3})], source)
    layer(spark, [click("US", d) for d in bad * 2]).write.mode("append").parquet(f"{source}/2023/12")
    direct, stored = both_ways(spark, tmp_path, source, "2024-01", store)
    assert direct == stored and direct[0][0] == "US"
    for name in ("direct", "stored"):
        report = spark.read.parquet(f"{tmp_path}/{name}/rejected/usage/2024_01")
        assert rows_of(report, "date", "folder", "rows") == sorted(((d, "2023-12", 2) for d in bad), key=repr)
    jobs.run_usage_many(spark, source, str(tmp_path / "many"), "2024-01", "2024-01")
    assert spark.read.parquet(f"{tmp_path}/many/rejected/usage/2024_01").count() == len(bad)
    sound = readers.dated(layer(spark, [click("US", d) for d in (*bad, "2024-02-29")]))
    assert rows_of(sound, "date") == [("2024-02-29",)]


def test_an_unfinished_write_of_counts_is_done_again(spark, tmp_path, monkeypatch):
    source, store = str(tmp_path / "clicks"), str(tmp_path / "counts")
    store_plain(spark, [c for m in range(1, 13) for c in clicks_on("US", {f"2023-{m:02d}-05": m})], source)
    write = sinks.save_folders

    def breaks_off(rows, path):
        write(rows.where("date < '2023-03-01'"), path)
        raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "save_folders", breaks_off)
    with pytest.raises(RuntimeError):
        jobs.run_usage(spark, source, str(tmp_path / "x"), "2024-01", counts=store)
    monkeypatch.undo()
    direct, stored = both_ways(spark, tmp_path, source, "2024-01", store)
    assert direct == stored


def test_hourly_job(spark, tmp_path):
    source, out = str(tmp_path / "logs"), str(tmp_path / "out")
    store_log(source, H6, [[("a", epoch(H6), "x")]])
    message = jobs.run_hourly(spark, source, out, "2024-02-14", "06", threshold=2)
    assert message.first().body == f"No data for hour {H5}"
    store_log(source, H5, [[("a", epoch(H5), "x")] * 5, [("b", epoch(H5), "x")] * 3])
    for mode in ("directory", "event_time"):
        message = jobs.run_hourly(spark, source, out, "2024-02-14", "6", 2, mode)
        assert message.count() == 1
        stored = spark.read.csv(f"{sinks.alert_dir(out, H6)}/server_csv", header=True)
        assert [tuple(r) for r in stored.collect()] == [("b", H6, "0", "3"), ("a", H6, "1", "5")]

    # A rerun that finds a gap leaves no servers of the run before.
    readers_hour = Path(readers.hour_directory(source, H5))
    readers_hour.rename(tmp_path / "gone")
    jobs.run_hourly(spark, source, out, "2024-02-14", "6", 2)
    assert spark.read.csv(f"{sinks.alert_dir(out, H6)}/server_csv", header=True).count() == 0


def stored_hours(spark, out, hours):
    found = []
    for hour in hours:
        target = sinks.alert_dir(out, hour)
        servers = spark.read.csv(f"{target}/server_csv", header=True).collect()
        message = spark.read.parquet(f"{target}/message").select("part", "subject", "body").collect()
        found.append((hour, [tuple(r) for r in servers], [tuple(r) for r in message]))
    return found


def test_many_hours_equal_single_hours(spark, tmp_path):
    source = str(tmp_path / "logs")
    hours = [f"2024-02-14 {h:02d}:00" for h in range(4, 10)]
    for hour, n in ((hours[1], 5), (hours[2], 1), (hours[4], 3)):
        store_log(source, hour, [[("a", epoch(hour), "x")] * n, [("b", epoch(hour), "x")] * 3])
    # An hour whose directory holds no data file is missing.
    (Path(readers.hour_directory(source, hours[3])) / "_logs").mkdir(parents=True)
    for mode in ("directory", "event_time"):
        jobs.run_hourly_many(spark, source, str(tmp_path / "many"), hours[0], hours[-1], 2, mode)
        for hour in hours:
            jobs.run_hourly(spark, source, str(tmp_path / "one"), hour[:10], hour[11:13], 2, mode)
        many, one = (stored_hours(spark, str(tmp_path / k), hours) for k in ("many", "one"))
        assert many == one
        assert [len(servers) for _, servers, _ in many] == [0, 0, 1, 0, 0, 0]


def test_many_event_time_hours_equal_single_ones_with_stragglers(spark, tmp_path):
    source = str(tmp_path / "logs")
    hours = [f"2024-02-14 {h:02d}:00" for h in range(4, 9)]
    for k, hour in enumerate(hours):
        late = [("a", epoch(hours[max(0, k - 1)]), "x")] * 4 + [("b", epoch(hours[max(0, k - 2)]), "x")] * 3
        store_log(source, hour, [late, [("a", epoch(hour), "x")] * (k % 2 * 3), [("c", epoch(hour), "x")]])
    jobs.run_hourly_many(spark, source, str(tmp_path / "many"), hours[1], hours[-1], 3, "event_time")
    for hour in hours[1:]:
        jobs.run_hourly(spark, source, str(tmp_path / "one"), hour[:10], hour[11:13], 3, "event_time")
    many, one = (stored_hours(spark, str(tmp_path / k), hours[1:]) for k in ("many", "one"))
    assert many == one and any(servers for _, servers, _ in many)


def test_many_hours_are_read_each_under_its_own_header(spark, tmp_path):
    source, hours = str(tmp_path / "logs"), [H5, H6]
    store_log(source, H5, [[("s1", epoch(H5), "x")] * 20, [("s2", epoch(H5), "x")] * 20])
    store_log(source, H6, [[(epoch(H6), "s1")] * 20, [(epoch(H6), "s2")]])
    header = Path(readers.hour_directory(source, H6)) / "_logs" / "header.tsv"
    header.write_text("ct_datetime\tct_flume_host\n")
    for mode in ("directory", "event_time"):
        jobs.run_hourly_many(spark, source, str(tmp_path / "many"), H6, H6, 10, mode)
        jobs.run_hourly(spark, source, str(tmp_path / "one"), H6[:10], H6[11:13], 10, mode)
        many, one = (stored_hours(spark, str(tmp_path / k), [H6]) for k in ("many", "one"))
        assert many == one and [s[0] for s in many[0][1]] == ["s2"]
    header.unlink()
    for run in (
        lambda: jobs.run_hourly(spark, source, str(tmp_path / "x"), H6[:10], H6[11:13], 10),
        lambda: jobs.run_hourly_many(spark, source, str(tmp_path / "x"), H6, H6, 10),
    ):
        with pytest.raises(FileNotFoundError, match=hours[1]):
            run()


def test_hours_are_listed_without_opening_a_file(spark, tmp_path):
    source = str(tmp_path / "logs")
    store_log(source, H5, [[("a", epoch(H5), "x")]])
    log = Path(readers.hour_directory(source, H5)) / "part-00000"
    log.chmod(0)
    hours = readers.stored_hours(spark, f"{source}/*/*/*/*/p*")
    assert rows_of(hours, "hour") == [(H5,)]
    assert re.search(r"ReadSchema: struct<path:string>", plan_of(hours).replace("modificationTime:timestamp,", ""))
    assert readers.stored_hours(spark, f"{source}/*/*/*/*/q*").count() == 0


def test_many_months_and_dates_equal_single_runs(spark, tmp_path):
    source = str(tmp_path / "clicks")
    months = clicks_on("US", {f"2023-{m:02d}-05": 1 for m in range(1, 13)})
    store_plain(spark, steady("US", 1) + steady("DE", 10) + months, source)
    many, one = str(tmp_path / "many"), str(tmp_path / "one")
    # A late row of a day that another folder has too, counted once where both are looked at.
    late = [click("US", "2023-02-05", user=n) for n in range(3)]
    layer(spark, late).write.mode("append").parquet(f"{source}/2023/01")
    store = str(tmp_path / "counts")
    for run_month, counts in (("2024-01", None), ("2024-02", None), ("2024-01", store), ("2024-02", store)):
        if run_month == "2024-01":
            jobs.run_usage_many(spark, source, many, "2024-01", "2024-02", counts=counts)
        jobs.run_usage(spark, source, one, run_month)
        for level in ("country", "zone"):
            a, b = (readers.read_usage(spark, x, run_month, level) for x in (many, one))
            assert rows_of(a, *b.columns) == rows_of(b, *b.columns)
    dates = [days(RUN, 2)[0], RUN]
    jobs.run_daily_many(spark, source, many, dates[0], dates[1], ANY, CALENDAR)
    shown = ("run_date", "country", "website_name", "action", "zone", "clicksList_day0_to_day7_before")
    for run_date in dates:
        jobs.run_daily(spark, source, one, run_date, ANY, CALENDAR)
        a, b = (readers.read_alerts(spark, sinks.alert_dir(x, run_date)) for x in (many, one))
        assert rows_of(a, *shown) == rows_of(b, *shown)
        a, b = (spark.read.parquet(f"{sinks.alert_dir(x, run_date)}/message") for x in (many, one))
        assert rows_of(a, "body") == rows_of(b, "body")


def test_a_job_deletes_its_own_intermediate_tables(spark, tmp_path):
    source, out = str(tmp_path / "logs"), str(tmp_path / "out")
    for hour, n in ((H5, 5), (H6, 1)):
        store_log(source, hour, [[("a", epoch(hour), "x")] * n])
    left = Path(session.fresh_path(spark, "x").removeprefix("file:")).parent
    session.delete_staged(spark)
    before = set(left.glob("*")) if left.exists() else set()
    shown = ["--input", source, "--output", out, "--threshold", "2", "--mode", "event_time"]
    jobs.main(["hourly", *shown, "--from", H6, "--to", H6])
    jobs.main(["hourly", *shown, "--run-date", H6[:10], "--run-hour", "06"])
    assert left.exists() and set(left.glob("*")) == before
    assert spark.read.csv(f"{sinks.alert_dir(out, H6)}/server_csv", header=True).count() == 1
