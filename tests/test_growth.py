"""Work and memory that must not grow faster than the input."""

import re

from helpers import click, layer, plan_of, rows_of
from pyspark.sql import functions as F

from dropwatch import session
from dropwatch.config import ID_COLS, MEDIAN_COLS, STACKED_KEYS
from dropwatch.operators import counts
from dropwatch.plans import usage
from dropwatch.sources import readers, sinks


def _clicks(spark):
    """Days of three months, each row in a folder: early days lie in the month before as well."""
    rows = []
    for n in range(240):
        day = f"2024-{1 + n % 3:02d}-{1 + n % 4:02d}"
        rows.append((*click(["US", None][n % 2], day, website=f"w{n % 3}", user=n % 7), ["own", "before"][n // 12 % 4 == 0]))
    names = [f.name for f in layer(spark, []).schema]
    df = spark.createDataFrame(rows, f"{', '.join(f'{k} {t}' for k, t in layer(spark, []).dtypes)}, lies string")
    early = (F.col("lies") == "before") & (F.substring("date", 9, 2) <= "02")
    before = F.substring(F.add_months(F.to_date("date"), -1).cast("string"), 1, 7)
    return df.select(*names, F.when(early, before).otherwise(F.substring("date", 1, 7)).alias("folder"))


def test_tasks_of_the_counts_follow_the_files(spark, tmp_path, monkeypatch):
    _clicks(spark).write.parquet(str(tmp_path / "a b"))
    clicks = spark.read.parquet(str(tmp_path / "a b"))
    monkeypatch.setattr(session, "BYTES_PER_TASK", 100)
    tasks = session.tasks_for(clicks)
    assert tasks > 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = counts.daily_counts_all_levels(clicks)
    # Before rows are multiplied, and where a value's rows are sorted.
    assert len(re.findall(rf"hashpartitioning\([^\n]*, {tasks}\)", plan_of(df))) == 2
    monkeypatch.undo()
    assert rows_of(df, *df.columns) == rows_of(counts.daily_counts_all_levels(clicks), *df.columns)


def test_tables_of_identifiers_can_be_merged(spark):
    clicks = _clicks(spark).drop("folder")
    first = F.col("website_name") == "w0"
    merged = counts.identifiers(clicks).unionByName(counts.identifiers(clicks.filter(first)))
    both = clicks.unionByName(clicks.filter(first))
    got = counts.counts_of(merged)
    assert rows_of(got, *got.columns) == rows_of(counts.daily_counts_all_levels(both), *got.columns)


def test_clicks_of_shared_days_are_counted_once_a_span(spark, monkeypatch):
    clicks = _clicks(spark)
    months = [f"2024-{m:02d}" for m in range(1, 7)]
    runs = spark.createDataFrame([(m,) for m in months], "run_month string")
    stored = counts.daily_counts_all_levels(clicks, scope=("folder",))
    seen = []
    real = usage.daily_counts_all_levels

    def counted(rows, ids=ID_COLS, scope=()):
        seen.append(rows.count())
        return real(rows, ids, scope)

    monkeypatch.setattr(usage, "daily_counts_all_levels", counted)
    got = usage.usage_of_folders(stored, clicks, runs, months=2)
    shared = clicks.filter("substring(date, 9, 2) <= '02'").count()
    assert len(seen) == 1 and 0 < seen[0] <= shared
    for run_month in months:
        year = [m for m in ["2023-12", *months] if m < run_month][-2:]
        plain = usage.usage_of_clicks(clicks.filter(F.col("folder").isin(year)))
        shown = (*STACKED_KEYS, *MEDIAN_COLS)
        assert rows_of(got.filter(F.col("run_month") == run_month), *shown) == rows_of(plain, *shown)


def test_stored_rows_without_a_folder_stay_out(spark, tmp_path):
    clicks = _clicks(spark)
    lost = clicks.limit(5).withColumns({"date": F.lit(None).cast("string"), "folder": F.lit(None).cast("string")})
    months = [(2023, 12), (2024, 1), (2024, 2), (2024, 3)]
    runs = spark.createDataFrame([("2024-03",), ("2024-04",)], "run_month string")
    found = []
    for name, rows in (("all", clicks.unionByName(lost)), ("known", clicks)):
        sinks.save_by_folder(rows, str(tmp_path / name))
        stored = readers.month_folders(spark, str(tmp_path / name), months, partitioned=True)
        kept = session.staged(counts.daily_counts_all_levels(stored, scope=("folder",)), "daily")
        got = usage.usage_of_folders(kept, stored, runs, months=2)
        found.append(rows_of(got, *got.columns))
    assert found[0] == found[1] and found[0]
