"""Hourly server alerts in two modes.

directory    an hour is what its directory holds. Records of other hours found there form rows
             of their own per server, and each meets every row of the server in the other hour.
             A NULL server never meets itself.
event_time   an hour is what its records say, wherever they lie. A NULL server is a server.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropwatch.config import HOURLY_THRESHOLD
from dropwatch.functions.calendar import shift_hour
from dropwatch.functions.measures import event_hour

ALERT_COLUMNS = ("run_hour", "server", "date_hour", "traffic", "traffic_prev1h")


def hourly_traffic(log: DataFrame, by_directory: bool = True) -> DataFrame:
    """Records per server and event hour, for each directory hour or over all of them."""
    keys = ["server", "date_hour"]
    if by_directory:
        keys = ["dir_hour", *keys]
    named = log.withColumnRenamed("ct_flume_host", "server")
    hours = named.withColumn("date_hour", event_hour("ct_datetime"))
    return hours.groupBy(*keys).agg(F.count("*").alias("traffic"))


def observed_hours(log: DataFrame, column: str = "dir_hour") -> DataFrame:
    return log.select(F.col(column).alias("hour")).distinct()


def missing_hours(log: DataFrame, run_hours: DataFrame) -> DataFrame:
    """missing_among the hours of a log's directories."""
    return missing_among(observed_hours(log), run_hours)


def missing_among(hours: DataFrame, run_hours: DataFrame) -> DataFrame:
    """Of the run hours asked for, those whose own hour, or else the hour before, is not among the
    hours that have data; only the run hour itself is reported if both are missing."""
    hours = hours.select("hour", F.lit(True).alias("there"))
    before = hours.select(shift_hour("hour", 1).alias("hour"), F.col("there").alias("there_before"))
    asked = run_hours.select("run_hour", F.col("run_hour").alias("hour"))
    known = asked.join(hours, "hour", "left").join(before, "hour", "left")
    missing = F.when(F.col("there").isNull(), F.col("run_hour")).when(
        F.col("there_before").isNull(), shift_hour("run_hour", -1)
    )
    return known.select("run_hour", missing.alias("missing_hour")).filter("missing_hour IS NOT NULL")


def complete_hours(hours: DataFrame, run_hours: DataFrame | None = None) -> DataFrame:
    """Run hours (all, or those asked for) that have data, as does the hour before."""
    after = hours.select(shift_hour("hour", 1).alias("hour"))
    complete = hours.join(after, "hour", "left_semi").withColumnRenamed("hour", "run_hour")
    return complete if run_hours is None else complete.join(run_hours, "run_hour", "left_semi")


def _sides(traffic: DataFrame):
    """Directory traffic as the current and as the previous hour of a run."""
    current = traffic.withColumnRenamed("dir_hour", "run_hour")
    previous = traffic.select(
        shift_hour("dir_hour", 1).alias("run_hour"),
        "server",
        F.col("traffic").alias("traffic_prev1h"),
    )
    return current, previous


def _filled(joined: DataFrame) -> DataFrame:
    return joined.select(
        "run_hour",
        "server",
        F.coalesce("date_hour", "run_hour").alias("date_hour"),
        F.coalesce("traffic", F.lit(0)).alias("traffic"),
        F.coalesce("traffic_prev1h", F.lit(0)).alias("traffic_prev1h"),
    )


def _by_run(rows: DataFrame, hours: DataFrame, run_hours: DataFrame | None) -> DataFrame:
    return rows.join(complete_hours(hours, run_hours), "run_hour", "left_semi")


def hourly_compare(traffic: DataFrame, run_hours: DataFrame | None = None) -> DataFrame:
    """Every server's traffic in each run hour next to the hour before (directory mode). The table
    is used several times; a caller for whom it is costly stages it."""
    current, previous = _sides(traffic)
    joined = previous.join(current, ["run_hour", "server"], "full_outer")
    return _by_run(_filled(joined), observed_hours(traffic), run_hours)


def low_traffic(
    traffic: DataFrame,
    threshold: int = HOURLY_THRESHOLD,
    run_hours: DataFrame | None = None,
    hours: DataFrame | None = None,
) -> DataFrame:
    """Servers nearly silent in a run hour that were not in the hour before (directory mode). hours
    are those that have data, if not just those with records.

    The hour before must reach the threshold, so it is filtered first and leads a left join.
    """
    current, previous = _sides(traffic)
    joined = previous.filter(F.col("traffic_prev1h") >= threshold).join(
        current, ["run_hour", "server"], "left"
    )
    low = _filled(joined).filter(F.col("traffic") < threshold)
    return _by_run(low, observed_hours(traffic) if hours is None else hours, run_hours)


def low_traffic_event_time_runs(
    traffic: DataFrame, hours: DataFrame, run_hours: DataFrame, threshold: int = HOURLY_THRESHOLD
) -> DataFrame:
    """low_traffic_event_time of many runs, each of which looks at two directories only: its own
    hour's and the one before. traffic is by directory, and each of its rows serves two runs."""
    run = F.when(F.col("shift") == 0, F.col("dir_hour")).otherwise(shift_hour("dir_hour", 1))
    looked = traffic.withColumn("shift", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("run_hour", run)
    now = F.when(F.col("date_hour") == F.col("run_hour"), F.col("traffic")).otherwise(0)
    before = F.when(F.col("date_hour") == shift_hour("run_hour", -1), F.col("traffic")).otherwise(0)
    looked = looked.select("run_hour", "server", now.alias("now"), before.alias("before"))
    paired = looked.groupBy("run_hour", "server").agg(
        F.sum("now").cast("long").alias("traffic"), F.sum("before").cast("long").alias("traffic_prev1h")
    )
    seen = looked.groupBy("run_hour").agg(F.max("now").alias("now")).filter("now > 0")
    low = paired.filter((F.col("traffic") < threshold) & (F.col("traffic_prev1h") >= threshold))
    low = low.join(seen.select("run_hour"), "run_hour", "left_semi")
    named = low.withColumn("date_hour", F.col("run_hour")).select(*ALERT_COLUMNS)
    return _by_run(named, hours, run_hours)


def low_traffic_event_time(
    traffic: DataFrame, threshold: int = HOURLY_THRESHOLD, run_hours: DataFrame | None = None
) -> DataFrame:
    """The same by event time. Each count serves its own hour and the next as the one before,
    so one aggregation pairs them, without a join of the counts with themselves. Hours come from
    the records, where a corrupt time can name any hour; nothing here is broadcast."""
    known = traffic.filter(F.col("date_hour").isNotNull())
    roles = F.explode(
        F.array(
            F.struct(
                F.col("date_hour").alias("run_hour"),
                F.col("traffic"),
                F.lit(0).cast("long").alias("traffic_prev1h"),
            ),
            F.struct(
                shift_hour("date_hour", 1).alias("run_hour"),
                F.lit(0).cast("long").alias("traffic"),
                F.col("traffic").alias("traffic_prev1h"),
            ),
        )
    )
    paired = (
        known.select("server", roles.alias("role"))
        .select("server", "role.*")
        .groupBy("run_hour", "server")
        .agg(F.sum("traffic").alias("traffic"), F.sum("traffic_prev1h").alias("traffic_prev1h"))
    )
    low = paired.filter((F.col("traffic") < threshold) & (F.col("traffic_prev1h") >= threshold))
    named = low.withColumn("date_hour", F.col("run_hour")).select(*ALERT_COLUMNS)
    return _by_run(named, observed_hours(known, "date_hour"), run_hours)


def in_order(alerts: DataFrame) -> DataFrame:
    """Alerts as a reader wants them: by run, the most silent server first."""
    return alerts.orderBy(
        "run_hour", F.asc("traffic"), F.desc("traffic_prev1h"), "server", "date_hour"
    )
