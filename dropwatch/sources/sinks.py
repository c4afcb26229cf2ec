"""Writers. Every write replaces what an earlier run left at its path, also with nothing.

File counts follow the data: a rebalance step before the write gives one file for a small
result and files of the advisory size for a large one, never one task for everything. A
sorted result is not rebalanced; adaptive execution already merges its small partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dropwatch.config import CLICK_LIST, LEVELS
from dropwatch.sources.readers import level_label

FORMATS = ("parquet", "csv", "avro")
FALLBACK_FORMATS = ("csv", "avro")  # the one that needs no package first


def save(df: DataFrame, path: str, file_type: str = "parquet", ordered: bool = False) -> None:
    """Write df as parquet, csv (to path_csv, with header) or avro (needs the spark-avro
    package); the type's case does not matter. Any other type writes both csv and avro."""
    kind = file_type.lower()
    for name in (kind,) if kind in FORMATS else FALLBACK_FORMATS:
        target = f"{path}_csv" if name == "csv" else path
        writer = (df if ordered else df.hint("rebalance")).write.mode("overwrite")
        if name == "csv":
            writer = writer.option("header", True)
        writer.format(name).save(target)


def save_by_month(rows: DataFrame, path: str) -> None:
    """Write dated rows under year=/month= directories, replacing all of them."""
    save_by_folder(rows.withColumn("folder", F.substring("date", 1, 7)), path)


def save_by_folder(rows: DataFrame, path: str) -> None:
    """Write rows under the year=/month= directories that their column folder (yyyy-MM) names."""
    year, month = F.substring("folder", 1, 4), F.substring("folder", 6, 2)
    placed = rows.withColumns({"year": year, "month": month}).drop("folder")
    placed.hint("rebalance", "year", "month").write.mode("overwrite").partitionBy("year", "month").parquet(path)


def save_folders(rows: DataFrame, path: str) -> None:
    """Write rows under folder= and state= directories, replacing those they have rows of."""
    (
        rows.hint("rebalance", "folder", "state")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("folder", "state")
        .parquet(path)
    )


HOUR_PARTS = {"year": (1, 4), "month": (6, 2), "day": (9, 2), "hour": (12, 2)}


def save_hours(log: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a log under year=/month=/day=/hour= directories of its dir_hour, as tab-separated
    files without header, and each hour's header under _logs in directories alike. Hours with other
    columns, or the same in another order, can be appended."""
    parts = {k: F.substring("dir_hour", *at) for k, at in HOUR_PARTS.items()}
    placed = log.withColumns(parts).drop("dir_hour").hint("rebalance", *parts)
    placed.write.mode(mode).partitionBy(*parts).csv(path, sep="\t")
    header = F.lit("\t".join(c for c in log.columns if c != "dir_hour")).alias("value")
    heads = log.select("dir_hour").distinct().select(header, *[c.alias(k) for k, c in parts.items()])
    heads.hint("rebalance").write.mode(mode).partitionBy(*parts).text(f"{path}/_logs")


def run_label(run: str) -> str:
    """Path part of a run date or hour: 2024-02-08 -> 2024_02_08, '2024-02-14 06:00' ->
    2024_02_14_06."""
    return run.replace("-", "_").replace(" ", "_").removesuffix(":00")


def save_usage(usage: DataFrame, base: str, run_month: str, level: str) -> None:
    """A level's usage reference under base/usage/yyyy/MM/<columns>."""
    save(usage, f"{base}/usage/{run_month.replace('-', '/')}/{level_label(level)}")


def save_rejected(rows: DataFrame, base: str, job: str, run: str) -> None:
    """The rows that a run left out for their dates, under base/rejected/<job>/<run>."""
    save(rows, f"{base}/rejected/{job}/{run_label(run)}")


def alert_dir(base: str, run: str) -> str:
    return f"{base}/alert/{run_label(run)}"


def save_alerts(alerts: DataFrame, base: str, run_date: str) -> None:
    """Stacked alerts as one CSV table per level under base/alert/yyyy_MM_dd. A level without
    alerts leaves a header only, so that an earlier run's files cannot survive. Alerts are read once
    per level, so a caller stages them."""
    for depth, (level, columns) in enumerate(LEVELS.items(), start=1):
        rows = alerts.filter(F.col("level") == depth).orderBy(F.desc("total_clicks"), *columns)
        table = rows.select(*columns, "run_date", CLICK_LIST)
        save(table, f"{alert_dir(base, run_date)}/{level_label(level)}", "csv", ordered=True)
