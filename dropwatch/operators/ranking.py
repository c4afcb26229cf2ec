"""Share, cumulative share and rank of groups within a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropwatch.functions.measures import share
from dropwatch.operators.counts import daily_total

def with_daily_share(daily: DataFrame, scope: Sequence[str] = ("date",)) -> DataFrame:
    """Clicks as part of the day's total. The totals have one row per day (and level), which
    bounds the broadcast."""
    joined = daily.join(F.broadcast(daily_total(daily, scope)), list(scope), "left")
    return joined.withColumn(
        "daily_traffic_percentage", share(F.col("clicks"), F.col("daily_total_clicks"))
    )


def with_ranking(daily: DataFrame, scope: Sequence[str] = ("date",)) -> DataFrame:
    """Day total, share, cumulative share and rank by descending clicks; ties share both.

    A window over all groups of a day would put the day into one task. Rank and cumulative
    share depend on the clicks alone, so the window runs over each day's distinct click values:
    at most sqrt(2 x total clicks) of them. Each group then looks its value up. Many small
    groups have the same few clicks; that join is left to adaptive execution, which splits the
    groups of a frequent value, however many they are.
    """
    by_value = Window.partitionBy(*scope).orderBy(F.desc("clicks"))
    above = by_value.rowsBetween(Window.unboundedPreceding, -1)
    so_far = by_value.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole_day = Window.partitionBy(*scope)
    volume = F.col("clicks") * F.col("n")
    values = (
        daily.groupBy(*scope, "clicks")
        .agg(F.count("*").alias("n"))
        .withColumns(
            {
                "daily_total_clicks": F.sum(volume).over(whole_day),
                "cumulative": F.sum(volume).over(so_far),
                "daily_rank": (F.coalesce(F.sum("n").over(above), F.lit(0)) + 1).cast("int"),
            }
        )
        .drop("n")
    )
    total = F.col("daily_total_clicks")
    return (
        daily.join(values, [*scope, "clicks"])
        .withColumn("daily_traffic_percentage", share(F.col("clicks"), total))
        .withColumn("daily_cumulative_percentage", share(F.col("cumulative"), total))
        .drop("cumulative")
    )
