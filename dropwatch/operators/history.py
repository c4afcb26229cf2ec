"""Alerting groups, their recent history and the click list of each."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropwatch.config import CLICK_LIST, HISTORY_DAYS, Thresholds
from dropwatch.functions.calendar import shift_date
from dropwatch.functions.measures import has_fallen, is_used

BROADCAST_GROUPS = 100_000  # of a level, each of four short names at most


def with_usage(
    rows: DataFrame, usage: DataFrame, keys: Sequence[str], null_safe: bool, how: str = "left"
) -> DataFrame:
    """Join of the usage reference. Null-safe keys keep groups with a NULL key."""
    if not null_safe:
        return rows.join(usage, list(keys), how)
    renamed = usage.withColumnsRenamed({k: f"usage_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"usage_{k}"))
    return rows.join(renamed, same, how).drop(*[f"usage_{k}" for k in keys])


def of_groups(clicks: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Click rows that belong to one of the groups, at one level or (with a column level among the
    keys) at any group's own level; groups are distinct. Planned before any count, so that counts see
    these rows only.

    Rows meet the groups of a level by all columns of that level. Groups are counted first, so a
    caller stages them: a level without any has no join, up to BROADCAST_GROUPS are broadcast, and
    more are joined by whole groups, where adaptive execution splits a large one.
    """
    if "level" not in keys:
        renamed = groups.withColumnsRenamed({k: f"group_{k}" for k in keys})
        return clicks.join(renamed, _same(keys), "left_semi")
    columns, marked, wanted = [k for k in keys if k != "level"], clicks, F.lit(False)
    sizes = {r["level"]: r["count"] for r in groups.groupBy("level").count().collect()}  # one per level
    for depth, size in sorted(sizes.items()):
        prefix, mark = columns[:depth], f"in_level_{depth}"
        at_level = groups.filter(F.col("level") == depth).select(
            *[F.col(k).alias(f"group_{k}") for k in prefix], F.lit(True).alias(mark)
        )
        at_level = F.broadcast(at_level) if size <= BROADCAST_GROUPS else at_level
        marked = marked.join(at_level, _same(prefix), "left").drop(*[f"group_{k}" for k in prefix])
        wanted = wanted | F.col(mark).isNotNull()
    return marked.filter(wanted).select(*clicks.columns)


def _same(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"group_{k}"))
    return same


def alert_keys(
    baseline: DataFrame, keys: Sequence[str], run_date: str, thresholds: Thresholds
) -> DataFrame:
    """Groups that drop on the run date, with the start of the history to show. Expects the
    baseline with the usage reference."""
    hits = baseline.filter(
        (F.col("date") == run_date) & has_fallen(thresholds) & is_used(thresholds)
    )
    return hits.withColumnRenamed("date", "alert_date").select(
        *keys,
        shift_date("alert_date", -HISTORY_DAYS).alias("date_7_days_ahead"),
        "alert_date",
    )


def fallen_history(
    baseline: DataFrame, keys: Sequence[str], run_date: str, thresholds: Thresholds
) -> DataFrame:
    """Clicks of the groups that have fallen on the run date, whatever their usage (few of all),
    from seven days before it up to it.

    The run date's row marks its whole series through a window over the group, whose rows the
    baseline has brought together already, in place of a join of the table with itself. A
    series has at most one row per day of the lookback.
    """
    first = (date.fromisoformat(run_date) - timedelta(days=HISTORY_DAYS)).isoformat()
    hit = (F.col("date") == run_date) & has_fallen(thresholds)
    marked = baseline.withColumn("fallen", F.max(hit).over(Window.partitionBy(*keys)))
    recent = marked.filter(F.col("fallen") & F.col("date").between(first, run_date))
    return recent.select(*keys, "date", "clicks")


def of_used_groups(
    history: DataFrame,
    usage: DataFrame,
    keys: Sequence[str],
    thresholds: Thresholds,
    null_safe: bool,
) -> DataFrame:
    """The history rows of groups whose usage is large enough. The reference is the same for all
    days of a group."""
    judged = with_usage(history, usage, keys, null_safe, "inner")
    return judged.filter(is_used(thresholds)).select(*keys, "date", "clicks")


def click_totals(history: DataFrame, keys: Sequence[str], run_date: str) -> DataFrame:
    """One row per alerting group: its clicks from the run date backwards, and their sum. A list
    has at most eight values."""
    days = F.sort_array(F.collect_list(F.struct("date", "clicks")), asc=False)
    return (
        history.withColumn("run_date", F.lit(run_date))
        .groupBy(*keys, "run_date")
        .agg(
            F.concat_ws(", ", F.transform(days, lambda d: d["clicks"].cast("string"))).alias(
                CLICK_LIST
            ),
            F.sum("clicks").alias("total_clicks"),
        )
    )


def click_list(history: DataFrame, keys: Sequence[str], run_date: str) -> DataFrame:
    """One row per alerting group with its click list, largest group first."""
    lists = click_totals(history, keys, run_date)
    return lists.orderBy(F.desc("total_clicks"), *keys).drop("total_clicks")


def ordered_history(
    history: DataFrame, keys: Sequence[str], run_date: str, keep_rank: bool = False
) -> DataFrame:
    """History rows with the groups of most clicks before the run date first, latest day first.
    Groups without a day before the run date are left out."""
    group = Window.partitionBy(*keys)
    before = F.sum(F.when(F.col("date") != run_date, F.col("clicks"))).over(group)
    ranked = (
        history.withColumn("total_clicks", before)
        .filter(F.col("total_clicks").isNotNull())
        .withColumn(
            "rank", F.row_number().over(group.orderBy(F.desc("total_clicks"), F.desc("date")))
        )
    )
    ranked = ranked.orderBy(F.desc("total_clicks"), F.desc("date"), *keys)
    return ranked.drop("total_clicks") if keep_rank else ranked.drop("total_clicks", "rank")
