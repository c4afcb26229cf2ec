"""Earlier values of a series, the expected clicks, and the ratio to them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropwatch.config import LAGS
from dropwatch.functions.measures import (
    drop_ratio,
    lag_name,
    recent_average,
    weekday_estimate,
)


def with_lags(daily: DataFrame, keys: Sequence[str], lags: Sequence[int] = LAGS) -> DataFrame:
    """Clicks of earlier rows of the same group: earlier active days in sparse data, earlier
    calendar days in densified data."""
    series = Window.partitionBy(*keys).orderBy("date")
    return daily.withColumns({lag_name(k): F.lag("clicks", k).over(series) for k in lags})


def with_estimates(lagged: DataFrame) -> DataFrame:
    return (
        lagged.withColumn("avg_prev_3days", recent_average())
        .withColumn("estimate", weekday_estimate())
        .withColumn("ratio", drop_ratio(F.col("clicks"), F.col("estimate")))
    )


def baseline(daily: DataFrame, keys: Sequence[str]) -> DataFrame:
    return with_estimates(with_lags(daily, keys))
