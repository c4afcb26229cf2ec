"""One table of all levels' alerts, and the message made of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropwatch.config import CLICK_LIST, LEVEL_COLS, LEVELS, Thresholds
from dropwatch.session import staged

LINES_PER_PART = 1000


def digest(alerts: DataFrame, *extra: str) -> DataFrame:
    """Run date first, click list last (but for extra columns), ordered by the grouping columns
    with NULL (the coarser levels) first."""
    columns = ["run_date", *LEVEL_COLS, CLICK_LIST, *extra]
    return alerts.select(*columns).orderBy(*[F.asc_nulls_first(c) for c in LEVEL_COLS])


def alert_counts(alerts: DataFrame) -> DataFrame:
    """Number of alerts per run date and level."""
    return alerts.groupBy("run_date", "level").agg(F.count("*").alias("alerts"))


def _line_numbers(lines: DataFrame, run: str, order: list[Column]) -> DataFrame:
    """Number each run's lines in order. Lines are sorted by ranges of the whole sort key, so that
    no value of one column, and no run, is one task; a line's number is its place within its range
    and run, after the lines that the ranges before have of the run.

    Staged, because a range sort done again may cut its ranges elsewhere."""
    ranged = lines.orderBy(F.col(run), *order).withColumn("at", F.monotonically_increasing_id())
    ranged = staged(ranged.withColumn("range", F.shiftright("at", 33)), "lines")
    earlier = Window.partitionBy(run).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    blocks = ranged.groupBy(run, "range").agg(F.min("at").alias("start"), F.count("*").alias("size"))
    before = F.coalesce(F.sum("size").over(earlier), F.lit(0))
    blocks = blocks.select(run, "range", (before - F.col("start") + 1).alias("shift"))
    joined = ranged.join(blocks, [run, "range"])
    return joined.withColumn("line_no", (F.col("at") + F.col("shift")).cast("long"))


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def _message(lines, run, title, head, lines_per_part):
    """One message per run; a table longer than lines_per_part continues in further parts, so
    that no row grows with the data."""
    part = (F.floor((F.col("line_no") - 1) / lines_per_part) + 1).cast("int")
    parts = (
        lines.withColumn("part", part)
        .groupBy(run, "part")
        .agg(F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("table"))
    )
    body = F.concat_ws("\n", *head, F.transform("table", lambda r: r["line"]))
    return parts.select(run, "part", title.alias("subject"), body.alias("body"))


def daily_message(
    alerts: DataFrame,
    thresholds: Thresholds,
    lines_per_part: int = LINES_PER_PART,
) -> DataFrame:
    """Subject and body of a daily run's message, from digest rows."""
    line = F.concat_ws(" | ", *[_text(c) for c in ("run_date", *LEVEL_COLS, CLICK_LIST)])
    order = [F.asc_nulls_first(c) for c in (*LEVEL_COLS, "line")]
    lines = _line_numbers(alerts.withColumn("line", line), "run_date", order)
    title = F.concat(F.lit("Daily traffic alert "), F.col("run_date"))
    head = [
        F.lit("Groups whose clicks fell far below the same weekday of the three weeks before."),
        F.lit(f"Listed if more than {thresholds.min_clicks:g} clicks were expected, less than"),
        F.lit(f"{thresholds.ratio:g} of them came, and a usual day has more than"),
        F.lit(f"{thresholds.min_ipua:g} visitors and {thresholds.min_domain:g} domains."),
        *[F.lit(f"One line per {' / '.join(columns)}") for columns in LEVELS.values()],
        F.lit(" | ".join(["run_date", *LEVEL_COLS, CLICK_LIST])),
    ]
    return _message(lines, "run_date", title, head, lines_per_part)


def hourly_message(
    alerts: DataFrame, threshold: int, lines_per_part: int = LINES_PER_PART
) -> DataFrame:
    """Subject and body of each hourly run's message, from low-traffic alerts."""
    columns = ["server", "date_hour", "traffic", "traffic_prev1h"]
    line = F.concat_ws(" | ", *[_text(c) for c in columns])
    order = [
        F.asc("traffic"),
        F.desc("traffic_prev1h"),
        F.asc_nulls_first("server"),
        F.asc_nulls_first("date_hour"),
    ]
    lines = _line_numbers(alerts.withColumn("line", line), "run_hour", order)
    title = F.concat(F.lit("Hourly traffic alert "), F.col("run_hour"), F.lit(": low traffic"))
    head = [
        F.lit(f"Servers with less than {threshold} records this hour and more the hour before."),
        F.lit(" | ".join(columns)),
    ]
    return _message(lines, "run_hour", title, head, lines_per_part)


def missing_message(missing: DataFrame) -> DataFrame:
    """Subject and body of the message of each run whose hour, or the hour before, has no
    data."""
    title = F.concat(F.lit("Hourly traffic alert "), F.col("run_hour"), F.lit(": missing hour"))
    body = F.concat(F.lit("No data for hour "), F.col("missing_hour"))
    return missing.select("run_hour", F.lit(1).alias("part"), title.alias("subject"), body.alias("body"))
