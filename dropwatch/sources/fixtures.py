"""Views over the driver's tables in the shape of the engine's inputs (see FIXTURES.md)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dropwatch.functions.calendar import hours_between, shift_hour
from dropwatch.session import tasks_for

# The run the views are made for, and the outage injected on its day.
RUN_DATE = "2024-02-08"
RUN_MONTH = "2024-02"
OUTAGE_COUNTRY = "ASIA"
OUTAGE_KEEPS_BELOW = 5


# The columns used of each table. Stating them saves a job per read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """rows dealt by key, if their files ask for more tasks than the session gives to a join."""
    tasks = tasks_for(rows)
    few = tasks <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows if few else rows.repartition(tasks, key)


def _with_places(rows: DataFrame, sf_dir: str, key: str) -> DataFrame:
    """Join each row's customer, nation and region. The last two have 25 and 5 rows by
    definition, whatever the scale, so they are broadcast."""
    spark = rows.sparkSession
    customer, nation, region = (
        table(spark, sf_dir, name) for name in ("customer", "nation", "region")
    )
    nations = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    known = rows.join(customer, rows[key] == customer.c_custkey)
    return known.join(F.broadcast(nations), known.c_nationkey == nations.n_nationkey)


def _between(rows: DataFrame, column: str, first: str | None, end: str | None, shift: int) -> DataFrame:
    """Rows whose date, `shift` days after the timestamp column, is from first up to before end.
    The bounds are set on the column itself, so they reach the scan."""
    for bound, keeps in ((first, F.col(column).__ge__), (end, F.col(column).__lt__)):
        if bound is not None:
            day = date.fromisoformat(bound) - timedelta(days=shift)
            rows = rows.filter(keeps(F.lit(f"{day} 00:00:00").cast("timestamp_ntz")))
    return rows


def traffic(
    spark: SparkSession, sf_dir: str, first: str | None = None, end: str | None = None
) -> DataFrame:
    """Click layer: one row per event, with an outage in one country on the run date.

    Every event stays a row. During the outage most rows of that country are no clicks. first and
    end (excluded) bound the dates.
    """
    events = _between(table(spark, sf_dir, "events"), "ts", first, end, shift=10).select(
        "event_id",
        "user_id",
        "event_type",
        F.date_add(F.to_date("ts"), 10).cast("string").alias("date"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )
    outage = (
        (F.col("r_name") == OUTAGE_COUNTRY)
        & (F.col("date") == RUN_DATE)
        & (F.col("k") >= OUTAGE_KEEPS_BELOW)
    )
    return _with_places(events, sf_dir, "user_id").select(
        "event_id",
        F.col("r_name").alias("country"),
        F.col("c_mktsegment").alias("website_name"),
        F.col("event_type").alias("action"),
        F.concat(F.lit("zone_"), F.col("k") % 3).alias("zone"),
        "date",
        F.when((F.col("event_type") == "error") | outage, 0).otherwise(1).alias("clicks"),
        (F.col("user_id") % 40).alias("master_user_group_id"),
        F.concat_ws("|", "user_id", "k").alias("ip_address_user_agent"),
        F.col("n_name").alias("city_code"),
        F.col("c_name").alias("company_name"),
        F.concat(F.lit("d"), F.col("k")).alias("domain_name"),
    )


def masked_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click layer in which views hide their country behind the sentinel and sign-ups have
    none at all."""
    hidden = F.when(F.col("action") == "view", "***").when(
        F.col("action") != "signup", F.col("country")
    )
    return traffic(spark, sf_dir).withColumn("country", hidden)


def fuller_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events in few groups, each active on every day at any scale: one website per
    country, one action and two zones. A third of the groups falls silent but for a few clicks."""
    rows = traffic(spark, sf_dir)
    zone = F.concat(F.lit("zone_"), F.pmod("event_id", F.lit(2)))
    quiet = (F.col("date") == RUN_DATE) & (F.pmod("event_id", F.lit(20)) != 0)
    quiet = quiet & F.col("country").isin("EUROPE", "AFRICA")
    return rows.withColumns(
        {
            "website_name": F.lit("SITE"),
            "action": F.lit("visit"),
            "zone": zone,
            "clicks": F.when(quiet, 0).otherwise(1),
        }
    )


def traffic_long(
    spark: SparkSession, sf_dir: str, first: str | None = None, end: str | None = None
) -> DataFrame:
    """Click layer over seven years: one row per order line; first and end (excluded) bound the
    dates."""
    lines = _between(table(spark, sf_dir, "lineitem"), "l_shipdate", first, end, shift=0)
    orders = table(spark, sf_dir, "orders")
    bought = _dealt(lines, "l_orderkey").join(orders, lines.l_orderkey == orders.o_orderkey)
    return _with_places(_dealt(bought, "o_custkey"), sf_dir, "o_custkey").select(
        F.col("r_name").alias("country"),
        F.col("c_mktsegment").alias("website_name"),
        F.col("l_returnflag").alias("action"),
        F.col("l_linestatus").alias("zone"),
        F.to_date("l_shipdate").cast("string").alias("date"),
        F.when(F.col("l_linenumber") == 1, 0).otherwise(1).alias("clicks"),
        F.col("o_custkey").alias("master_user_group_id"),
        F.col("l_suppkey").alias("ip_address_user_agent"),
        F.col("n_name").alias("city_code"),
        F.col("c_name").alias("company_name"),
        F.col("l_partkey").alias("domain_name"),
    )


def folder_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """traffic_long by the folder (yyyy-MM) a row lies in: the one of its date, but that rows of a
    month's first two days lie in the month before where the company's number ends in 0 or 5."""
    rows = traffic_long(spark, sf_dir)
    early = (F.substring("date", 9, 2).cast("int") <= 2) & (F.col("master_user_group_id") % 5 == 0)
    before = F.substring(F.add_months(F.to_date("date"), -1).cast("string"), 1, 7)
    return rows.withColumn("folder", F.when(early, before).otherwise(F.substring("date", 1, 7)))


def hourly_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log of five servers; the records of an hour's last minutes arrive in the next."""
    events = table(spark, sf_dir, "events")
    epoch_ms = F.timestamp_diff(
        "MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), "ts"
    )
    arrival = (F.col("ts") + F.expr("interval 5 minutes")).cast("string")
    return events.select(
        F.concat(F.lit("srv-"), F.col("user_id") % 5).alias("ct_flume_host"),
        epoch_ms.cast("string").alias("ct_datetime"),
        F.concat(F.substring(arrival, 1, 13), F.lit(":00")).alias("dir_hour"),
    )


def run_hours(log: DataFrame, beyond: int = 2) -> DataFrame:
    """Run hours from some hours before the log's first one to as many after its last."""
    bounds = log.agg(F.min("dir_hour").alias("first"), F.max("dir_hour").alias("last"))
    bounds = bounds.filter(F.col("first").isNotNull())
    hours = hours_between(shift_hour("first", -beyond), shift_hour("last", beyond))
    return bounds.select(F.explode(hours).alias("run_hour"))
