"""Date, month and hour arithmetic on ISO strings, and the spines built from it.

Dates are yyyy-MM-dd, months yyyy-MM and hours "yyyy-MM-dd HH:00" strings at the edges, which
compare in time order. Arithmetic uses DATE and TIMESTAMP_NTZ, so no time zone is involved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def shift_date(date: str | Column, days: int | Column) -> Column:
    """ISO date `days` later (earlier if negative)."""
    return F.date_add(F.to_date(_col(date)), days).cast("string")


def month_of(date: str | Column) -> Column:
    return F.substring(_col(date), 1, 7)


def month_number(date: str | Column) -> Column:
    """Months since year 0 of an ISO date or month."""
    year, month = (F.substring(_col(date), *at).cast("int") for at in ((1, 4), (6, 2)))
    return year * 12 + month - 1


def shift_month(month: str | Column, months: int) -> Column:
    """yyyy-MM month `months` later (earlier if negative)."""
    first = F.to_date(F.concat(_col(month), F.lit("-01")))
    return F.substring(F.add_months(first, months).cast("string"), 1, 7)


def shift_hour(hour: str | Column, hours: int) -> Column:
    """Hour string `hours` later (earlier if negative)."""
    return _hour_string(_hour_ntz(hour) + F.make_dt_interval(hours=F.lit(hours)))


def hour_label(run_date: str | Column, run_hour: str | Column) -> Column:
    """'2024-02-14', '06' -> '2024-02-14 06:00'."""
    return F.concat(_col(run_date), F.lit(" "), F.lpad(_col(run_hour), 2, "0"), F.lit(":00"))


def _hour_ntz(hour: str | Column) -> Column:
    return F.to_timestamp_ntz(_col(hour), F.lit("yyyy-MM-dd HH:mm"))


def _hour_string(ts: Column) -> Column:
    return F.substring(ts.cast("string"), 1, 16)


def dates_between(start: Column, end: Column) -> Column:
    """Array of all ISO dates from start to end, both included."""
    days = F.sequence(F.to_date(start), F.to_date(end), F.expr("interval 1 day"))
    return F.transform(days, lambda d: d.cast("string"))


def months_between(start: Column, end: Column) -> Column:
    """Array of all yyyy-MM months from start to end, both included."""
    first = F.to_date(F.concat(start, F.lit("-01")))
    last = F.to_date(F.concat(end, F.lit("-01")))
    months = F.sequence(first, last, F.expr("interval 1 month"))
    return F.transform(months, lambda m: F.substring(m.cast("string"), 1, 7))


def hours_between(start: Column, end: Column) -> Column:
    """Array of all hour strings from start to end, both included."""
    hours = F.sequence(_hour_ntz(start), _hour_ntz(end), F.expr("interval 1 hour"))
    return F.transform(hours, _hour_string)


def trailing_months(run_month: str | Column, months: int) -> Column:
    """Array of the months before run_month, which is itself excluded."""
    return months_between(shift_month(run_month, -months), shift_month(run_month, -1))


def date_spine(df: DataFrame, column: str = "date") -> DataFrame:
    """Every calendar date from the first to the last one in df."""
    return _spine(df, column, dates_between, "date")


def month_spine(df: DataFrame, column: str = "date") -> DataFrame:
    """Every month from the first to the last one in df."""
    return _spine(df.select(month_of(column).alias("month")), "month", months_between, "month")


def hour_spine(df: DataFrame, column: str) -> DataFrame:
    """Every hour from the first to the last one in df."""
    return _spine(df, column, hours_between, "hour")


def _spine(df, column, between, name):
    bounds = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    bounds = bounds.filter(F.col("first").isNotNull())
    return bounds.select(F.explode(between(F.col("first"), F.col("last"))).alias(name))
