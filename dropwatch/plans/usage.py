"""Usage reference: what a group's audience normally is, from the year before a run month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropwatch.config import COUNT_COLS, ID_COLS, STACKED_KEYS, USAGE_MONTHS
from dropwatch.functions.calendar import month_number
from dropwatch.operators.counts import daily_counts_all_levels, daily_usage
from dropwatch.session import staged
from dropwatch.sources.readers import clicks_only, in_trailing_year

# Fixed value: far more than the days of a year, so that the median is exact.
MEDIAN_ACCURACY = 10000

MOST_LITERALS = 400  # days that are named in a filter; more are joined

# The identifiers whose medians the alert thresholds use.
ALERT_IDS = ("ip_address_user_agent", "domain_name")


def _medians(columns: Sequence[str]) -> list[Column]:
    return [F.percentile_approx(c, 0.5, MEDIAN_ACCURACY).alias(f"median_{c}") for c in columns]


def medians_of_days(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lower median over a group's active days of each daily count that daily has."""
    columns = [c for c in COUNT_COLS if c in daily.columns]
    return daily.groupBy(*keys).agg(*_medians(columns))


def usage_reference(traffic: DataFrame, keys: Sequence[str], run_month: str) -> DataFrame:
    """One level's reference for a run month. Counts whose median is not used downstream are
    pruned."""
    clicks = clicks_only(in_trailing_year(traffic, run_month))
    return medians_of_days(daily_usage(clicks, keys), keys)


def usage_reference_all_levels(
    traffic: DataFrame, run_month: str, ids: Sequence[str] = ID_COLS
) -> DataFrame:
    """All levels' references for a run month in one pass over the year."""
    return usage_of_clicks(clicks_only(in_trailing_year(traffic, run_month)), ids)


def usage_of_clicks(clicks: DataFrame, ids: Sequence[str] = ID_COLS) -> DataFrame:
    """All levels' references from all click rows given, whatever days they carry."""
    return medians_of_days(daily_counts_all_levels(clicks, ids), STACKED_KEYS)


def usage_of_folders(
    counts: DataFrame, clicks: DataFrame, run_months: DataFrame, months: int = USAGE_MONTHS
) -> DataFrame:
    """All levels' references of run months, each from all rows of the month folders before it.

    counts holds daily counts of each folder by itself. A folder can hold late rows of days that
    other folders hold too, and distinct counts of parts do not add up: only the clicks of such days
    are counted again. A run month sees a day's folders from a first to a last one; clicks are
    counted once for each such span, however many run months see it, and a span of one folder has
    its counts already. Days, folders and run months are the calendar's, so broadcasts of them are
    bounded; clicks has the folder of each row.
    """
    held = counts.filter(F.col("level") == 1).select("date", "folder").distinct()
    top = held.groupBy("date").agg(F.count("*").alias("n"))
    shared = staged(top.filter("n > 1").select("date"), "shared-days")
    own = counts.join(F.broadcast(shared), "date", "left_anti")
    days = [r.date for r in shared.limit(MOST_LITERALS + 1).collect()]
    if not days:
        return usage_backfill(own, STACKED_KEYS, run_months, months, "folder")
    at = month_number("folder")
    looking = F.explode(F.sequence(at + 1, at + months)).alias("run_at")
    seen = held.join(F.broadcast(shared), "date").select("date", "folder", looking)
    wanted = run_months.select("run_month", month_number("run_month").alias("run_at")).distinct()
    span = (F.min("folder").alias("first"), F.max("folder").alias("last"))
    seen = seen.join(F.broadcast(wanted), "run_at").groupBy("date", "run_month").agg(*span)
    seen = staged(seen, "shared-spans")
    spans = seen.filter("first < last").select("date", "first", "last").distinct()
    again = clicks.filter(F.col("date").isin(days)) if len(days) <= MOST_LITERALS else clicks  # reaches the scan
    again = again.join(F.broadcast(spans), "date")
    # As texts, which compare in time order: a condition on numbers would reach folders without a month.
    again = again.filter(F.col("folder").between(F.col("first"), F.col("last")))
    recounted = daily_counts_all_levels(again, scope=("first", "last"))
    single = counts.withColumns({"first": F.col("folder"), "last": F.col("folder")}).select(recounted.columns)
    single = single.join(F.broadcast(shared), "date", "left_semi")
    more = single.unionByName(recounted).join(F.broadcast(seen), ["date", "first", "last"])
    return usage_backfill(own, STACKED_KEYS, run_months, months, "folder", more)


def usage_backfill(
    daily: DataFrame,
    keys: Sequence[str],
    run_months: DataFrame,
    months: int = USAGE_MONTHS,
    month: str | None = None,
    more: DataFrame | None = None,
) -> DataFrame:
    """References for many run months in one job.

    Distinct counts hold per day, so each day's counts are computed once. Of every group and month
    only the histogram of each count's daily values is kept (31 entries at most, few where counts
    are small). A value's months are merged in a sliding year, which gives every run month its
    histogram; there the lower median is the least value that half the days do not exceed, a running
    sum over the entries in the order of their values. No list of days is made anywhere.

    run_months has one row per month of the calendar, which bounds the broadcast. A day belongs to
    the month of its date, or of the column month; more has days whose run_month is known already.
    """
    columns = [c for c in COUNT_COLS if c in daily.columns]
    entry = ("kind", "value")
    pairs = [x for k, c in enumerate(columns) for x in (F.lit(k), F.col(c))]
    entries = F.stack(F.lit(len(columns)), *pairs).alias(*entry)
    at = month_number("date" if month is None else month).alias("at")
    by_month = daily.select(*keys, at, entries).groupBy(*keys, *entry, "at").agg(F.count("*").alias("days"))
    # A month's days come in at the run month after it and go out a year later; in between, the sum
    # of what has come and gone is what the run months look at.
    change = F.explode(
        F.array(
            F.struct((F.col("at") + 1).alias("at"), F.col("days")),
            F.struct((F.col("at") + 1 + months).alias("at"), (-F.col("days")).alias("days")),
        )
    )
    changes = by_month.select(*keys, *entry, change.alias("change")).select(*keys, *entry, "change.*")
    time = Window.partitionBy(*keys, *entry).orderBy("at")
    running = changes.withColumns({"days": F.sum("days").over(time), "until": F.lead("at").over(time) - 1})
    running = running.filter("days > 0 AND until >= at")
    served = running.withColumn("at", F.explode(F.sequence("at", "until"))).select("at", *keys, *entry, "days")
    wanted = run_months.select("run_month", month_number("run_month").alias("at"))
    served = served.join(F.broadcast(wanted), "at").select("run_month", *keys, *entry, "days")
    if more is not None:
        days = more.select("run_month", *keys, entries)
        served = served.unionByName(days.withColumn("days", F.lit(1).cast("long")))
    group = Window.partitionBy("run_month", *keys, "kind")
    # Entries of equal value have equal sums: the frame of an ordered window ends behind them.
    reached = F.sum("days").over(group.orderBy("value")) * 2 >= F.sum("days").over(group)
    medians = [
        F.min(F.when((F.col("kind") == k) & F.col("reached"), F.col("value"))).alias(f"median_{c}")
        for k, c in enumerate(columns)
    ]
    # Dealt by group, which serves the window and the aggregation.
    dealt = served.repartition("run_month", *keys).withColumn("reached", reached)
    return dealt.groupBy("run_month", *keys).agg(*medians)
