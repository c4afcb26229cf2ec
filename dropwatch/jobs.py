"""The three jobs, from stored input to stored results.

    python -m dropwatch.jobs usage  --input CLICKS --output OUT --run-month 2024-02
    python -m dropwatch.jobs daily  --input CLICKS --output OUT --run-date 2024-02-14
    python -m dropwatch.jobs hourly --input LOGS   --output OUT --run-date 2024-02-14 --run-hour 06
    python -m dropwatch.jobs hourly --input LOGS   --output OUT --from "2024-02-13 00:00" --to "2024-02-14 23:00"

Results lie under OUT/usage/yyyy/MM/<columns> and OUT/alert/<run>/..., where the daily job finds
the usage reference of its month. Messages are stored as tables next to the alerts.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropwatch.config import (
    CLICK_LIST,
    COUNT_COLS,
    HOURLY_THRESHOLD,
    LEVEL_COLS,
    LEVELS,
    STACKED_KEYS,
    Thresholds,
)
from dropwatch.functions.calendar import dates_between, hours_between, months_between
from dropwatch.operators.counts import daily_clicks_all_levels, daily_counts_all_levels
from dropwatch.plans import daily, digest, hourly
from dropwatch.plans.backfill import daily_alerts_backfill, hourly_backfill
from dropwatch.plans.usage import usage_of_clicks, usage_of_folders
from dropwatch.session import configure, delete_staged, staged
from dropwatch.sources import readers, sinks


def run_usage(
    spark: SparkSession,
    source: str,
    output: str,
    run_month: str,
    partitioned: bool = False,
    counts: str | None = None,
) -> None:
    """Compute all levels' usage references in one pass and store each.

    The year is what the twelve month directories before the run month hold, late rows of other days
    included. Rows whose date is no date are left out and reported. With a counts folder, daily
    counts are kept there: the next run month scans the clicks of one new month instead of twelve.
    """
    months = readers.months_before(run_month)
    clicks = _folder_clicks(spark, source, months, partitioned)
    if counts is None:
        rejected, medians = readers.undated(clicks), usage_of_clicks(readers.dated(clicks))
    else:
        stored, rejected = keep_counts(spark, source, counts, months, partitioned)
        runs = spark.createDataFrame([(run_month,)], "run_month string")
        medians = usage_of_folders(stored, readers.dated(clicks), runs).drop("run_month")
    _save_usage(staged(medians, "usage"), output, run_month)
    sinks.save_rejected(rejected, output, "usage", run_month)


def _folder_clicks(spark, source, months, partitioned):
    return readers.clicks_only(readers.month_folders(spark, source, months, partitioned))


def _save_usage(usage: DataFrame, output: str, run_month: str) -> None:
    shown = [c for c in usage.columns if c not in (*STACKED_KEYS, "run_month")]
    for depth, (level, columns) in enumerate(LEVELS.items(), start=1):
        rows = usage.filter(F.col("level") == depth).select(*columns, *shown)
        sinks.save_usage(rows, output, run_month, level)


KEPT = ", ".join(
    ["level int", *[f"{c} string" for c in (*LEVEL_COLS, "date")], *[f"{c} long" for c in ("clicks", *COUNT_COLS)]]
)


def keep_counts(
    spark: SparkSession, source: str, counts: str, months: readers.Months, partitioned: bool
) -> tuple[DataFrame, DataFrame]:
    """The daily counts of each source month's directory by itself, and its rows without a date,
    both brought up to date.

    They are stored by directory and by the state of its files, so a directory that has changed is
    counted again and one that the run does not look at takes no part. The manifest, written last,
    lists what is done; a run that breaks off before leaves nothing that is read.
    """
    manifest = f"{counts}/manifest"
    states = readers.folder_states(spark, source, months, partitioned)
    new = set(states.items()) - readers.finished_folders(spark, manifest)
    if new:
        todo = [m for m in months if readers.month_label(m) in dict(new)]
        clicks = _folder_clicks(spark, source, todo, partitioned)
        state = F.create_map(*[F.lit(x) for pair in sorted(new) for x in pair])[F.col("folder")]
        rows = daily_counts_all_levels(readers.dated(clicks), scope=("folder",))
        rows = rows.withColumns({"date": F.col("date").cast("string"), "state": state})
        sinks.save_folders(rows, f"{counts}/days")
        sinks.save_folders(readers.undated(clicks).withColumn("state", state), f"{counts}/rejected")
        done = spark.createDataFrame(sorted(new), "folder string, state string")
        done.coalesce(1).write.mode("append").parquet(manifest)
    days = readers.kept(spark, f"{counts}/days", states, KEPT)
    return days, readers.kept(spark, f"{counts}/rejected", states, "date string, rows long")


def stored_usage(spark: SparkSession, output: str, run_month: str) -> DataFrame:
    """All levels' stored references, stacked."""
    return readers.combine(
        [
            readers.read_usage(spark, output, run_month, level).withColumn("level", F.lit(depth))
            for depth, level in enumerate(LEVELS, start=1)
        ]
    )


def run_daily(
    spark: SparkSession,
    source: str,
    output: str,
    run_date: str,
    thresholds: Thresholds = Thresholds(),
    mode: str = daily.OBSERVED,
    partitioned: bool = False,
) -> DataFrame:
    """Store the alerts of all levels and their message; return the digest."""
    months = readers.months_of_window(run_date)
    folders = readers.month_folders(spark, source, months, partitioned)
    traffic = readers.dated(folders).drop("folder")
    usage = stored_usage(spark, output, run_date[:7])
    alerts = staged(daily.alerts_all_levels(traffic, run_date, thresholds, mode, usage), "alerts")
    sinks.save_alerts(alerts, output, run_date)
    _save_daily_message(alerts, thresholds, output, run_date)
    sinks.save_rejected(readers.undated(folders), output, "daily", run_date)
    return digest.digest(alerts)


def _save_daily_message(alerts, thresholds, output, run_date):
    message = digest.daily_message(alerts, thresholds)
    sinks.save(message, f"{sinks.alert_dir(output, run_date)}/message")


def run_hourly(
    spark: SparkSession,
    source: str,
    output: str,
    run_date: str,
    run_hour: str,
    threshold: int = HOURLY_THRESHOLD,
    mode: str = "directory",
) -> DataFrame:
    """Store a run's low-traffic servers and their message, or the message that an hour has no
    data; return the message."""
    hour = f"{run_date} {int(run_hour):02d}:00"
    before = readers.previous_hour(hour)
    logs = {h: readers.read_hour(spark, source, h) for h in (hour, before)}
    gap = next((h for h, log in logs.items() if log is None), None)
    if gap is not None:
        alerts = spark.createDataFrame([], ALERTS)
        message = digest.missing_message(spark.createDataFrame([(hour, gap)], GAPS))
    else:
        both = logs[hour].unionByName(logs[before], allowMissingColumns=True)
        traffic = staged(hourly.hourly_traffic(both, by_directory=mode == "directory"), "hourly")
        low = hourly.low_traffic if mode == "directory" else hourly.low_traffic_event_time
        # By event time the two directories can tell of further hours.
        alerts = low(traffic, threshold).filter(F.col("run_hour") == hour)
        message = digest.hourly_message(alerts, threshold)
    _save_hour(alerts, message, output, hour)
    return message


ALERTS = "run_hour string, server string, date_hour string, traffic long, traffic_prev1h long"
GAPS = "run_hour string, missing_hour string"


def _save_hour(alerts: DataFrame, message: DataFrame, output: str, hour: str) -> None:
    """An hour's server table and message; an hour without data leaves the table's header only."""
    target = sinks.alert_dir(output, hour)
    servers = hourly.in_order(alerts).drop("run_hour")
    sinks.save(servers, f"{target}/server", "csv", ordered=True)
    sinks.save(message, f"{target}/message")


# --- many runs ----------------------------------------------------------------------------


def run_usage_many(
    spark: SparkSession,
    source: str,
    output: str,
    first: str,
    last: str,
    partitioned: bool = False,
    counts: str | None = None,
) -> None:
    """Store what run_usage stores for each run month from first to last, from one pass; rows
    without a date are reported once, for the first run month."""
    run_months = spark.range(1).select(
        F.explode(months_between(F.lit(first), F.lit(last))).alias("run_month")
    )
    months = sorted({m for r in run_months.collect() for m in readers.months_before(r.run_month)})
    clicks = _folder_clicks(spark, source, months, partitioned)
    if counts is None:
        rows = daily_counts_all_levels(readers.dated(clicks), scope=("folder",))
        stored, rejected = staged(rows, "daily"), readers.undated(clicks)
    else:
        stored, rejected = keep_counts(spark, source, counts, months, partitioned)
    usage = staged(usage_of_folders(stored, readers.dated(clicks), run_months), "usage")
    for row in run_months.collect():
        _save_usage(usage.filter(F.col("run_month") == row.run_month), output, row.run_month)
    sinks.save_rejected(rejected, output, "usage", first)


def run_daily_many(
    spark: SparkSession,
    source: str,
    output: str,
    first: str,
    last: str,
    thresholds: Thresholds = Thresholds(),
    mode: str = daily.OBSERVED,
    partitioned: bool = False,
) -> None:
    """Store what run_daily stores for each run date from first to last, from one pass over their
    lookbacks and the usage references stored before; rows without a date are reported once, for
    the first run date."""
    runs = spark.range(1).select(
        F.explode(dates_between(F.lit(first), F.lit(last))).alias("run_date")
    )
    dates = [r.run_date for r in runs.collect()]
    months = sorted({m for d in dates for m in readers.months_of_window(d)})
    folders = readers.month_folders(spark, source, months, partitioned)
    clicks = readers.known_country(readers.clicks_only(readers.dated(folders)))
    series = staged(daily_clicks_all_levels(clicks), "daily")
    usage = readers.combine(
        [
            stored_usage(spark, output, m).withColumn("run_month", F.lit(m))
            for m in sorted({d[:7] for d in dates})
        ]
    )
    found = daily_alerts_backfill(series, usage, STACKED_KEYS, thresholds, mode, runs)
    values = F.transform(F.split(CLICK_LIST, ", "), lambda v: v.cast("long"))
    total = F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v)
    alerts = staged(found.withColumn("total_clicks", total), "alerts")
    for run_date in dates:
        of_run = alerts.filter(F.col("run_date") == run_date)
        sinks.save_alerts(of_run, output, run_date)
        _save_daily_message(of_run, thresholds, output, run_date)
    sinks.save_rejected(readers.undated(folders), output, "daily", first)


def run_hourly_many(
    spark: SparkSession,
    source: str,
    output: str,
    first: str,
    last: str,
    threshold: int = HOURLY_THRESHOLD,
    mode: str = "directory",
) -> None:
    """Store what run_hourly stores for each hour from first to last. Which hours have data is read
    from the listing of their directories."""
    runs = spark.range(1).select(
        F.explode(hours_between(F.lit(first), F.lit(last))).alias("run_hour")
    )
    days = readers.days_pattern(source, readers.previous_hour(first), last)
    hours = staged(readers.stored_hours(spark, f"{days}/p*"), "hours")
    log = readers.read_hours(spark, f"{days}/_logs/*.tsv", f"{days}/p*")
    traffic = staged(hourly.hourly_traffic(log), "hourly")
    event_time = mode == "event_time"
    report = staged(hourly_backfill(traffic, runs, threshold, hours, event_time), "report")
    alerts = report.filter(F.col("report") == "low traffic").select(*hourly.ALERT_COLUMNS)
    gaps = report.filter(F.col("report") == "missing hour").select("run_hour", "missing_hour")
    messages = digest.hourly_message(alerts, threshold).unionByName(digest.missing_message(gaps))
    messages = staged(messages, "messages")
    for row in runs.collect():
        mine = F.col("run_hour") == row.run_hour
        _save_hour(alerts.filter(mine), messages.filter(mine), output, row.run_hour)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="dropwatch.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("usage", "daily", "hourly"):
        job = jobs.add_parser(name)
        job.add_argument("--input", required=True)
        job.add_argument("--output", required=True)
        job.add_argument("--from", dest="first", help="first of many runs: a month, date or hour")
        job.add_argument("--to", dest="last", help="last of many runs")
        if name == "usage":
            job.add_argument("--run-month")
            job.add_argument("--counts", help="folder that keeps daily counts between runs")
        else:
            job.add_argument("--run-date")
        if name == "hourly":
            job.add_argument("--run-hour")
            job.add_argument("--threshold", type=int, default=HOURLY_THRESHOLD)
            job.add_argument("--mode", choices=("directory", "event_time"), default="directory")
        else:
            job.add_argument("--partitioned", action="store_true")
        if name == "daily":
            job.add_argument("--mode", choices=(daily.OBSERVED, daily.CALENDAR), default=daily.OBSERVED)
            for field, default in vars(Thresholds()).items():
                job.add_argument(f"--{field.replace('_', '-')}", type=float, default=default)
    args = parser.parse_args(argv)
    many = args.first is not None
    if many == any(vars(args).get(k) for k in ("run_month", "run_date")) or many != (args.last is not None):
        parser.error("give one run, or --from and --to")

    spark = configure(SparkSession.builder.appName(f"dropwatch-{args.job}").getOrCreate())
    try:
        _run(spark, args, many)
    finally:
        delete_staged(spark)


def _run(spark: SparkSession, args: argparse.Namespace, many: bool) -> None:
    span = (spark, args.input, args.output, args.first, args.last)
    if args.job == "usage":
        if many:
            run_usage_many(*span, args.partitioned, args.counts)
        else:
            run_usage(
                spark, args.input, args.output, args.run_month, args.partitioned, args.counts
            )
    elif args.job == "daily":
        limits = Thresholds(args.min_clicks, args.min_ipua, args.min_domain, args.ratio)
        if many:
            run_daily_many(*span, limits, args.mode, args.partitioned)
        else:
            run_daily(
                spark, args.input, args.output, args.run_date, limits, args.mode, args.partitioned
            )
    elif many:
        run_hourly_many(*span, args.threshold, args.mode)
    else:
        run_hourly(
            spark, args.input, args.output, args.run_date, args.run_hour, args.threshold, args.mode
        )


if __name__ == "__main__":
    main()
