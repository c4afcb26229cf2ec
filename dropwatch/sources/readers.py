"""Readers for the click layer, the hourly log, usage references and alert files.

Two directory layouts are read: partition columns in the path (year=2024/month=02), which Spark
prunes by filters, and bare numbers (2024/02), where the paths of the window are named.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dropwatch.config import LEVEL_COLS, LEVELS, LOOKBACK_DAYS, SENTINEL_COUNTRY, USAGE_MONTHS

Months = list[tuple[int, int]]


def months_before(run_month: str, months: int = USAGE_MONTHS) -> Months:
    """(year, month) of the months before run_month, oldest first."""
    last = _month_number(run_month)
    return [_from_number(n) for n in range(last - months, last)]


def months_of_window(run_date: str, days: int = LOOKBACK_DAYS) -> Months:
    """(year, month) pairs that the days up to run_date touch."""
    first = date.fromisoformat(run_date) - timedelta(days=days)
    span = range(_month_number(first.isoformat()), _month_number(run_date) + 1)
    return [_from_number(n) for n in span]


def _month_number(iso: str) -> int:
    return int(iso[:4]) * 12 + int(iso[5:7]) - 1


def _from_number(number: int) -> tuple[int, int]:
    return number // 12, number % 12 + 1


def read_click_layer(
    spark: SparkSession, base: str, months: Months, partitioned: bool = False
) -> DataFrame:
    """The click layer's month directories."""
    if not partitioned:
        return spark.read.parquet(*[f"{base}/{y}/{m:02d}" for y, m in months])
    return _of_months(spark.read.parquet(base), months).drop("year", "month")


def _of_months(clicks: DataFrame, months: Months) -> DataFrame:
    wanted = F.lit(False)
    for year, month in months:
        wanted = wanted | ((F.col("year") == year) & (F.col("month") == month))
    return clicks.filter(wanted)


def path_exists(spark: SparkSession, glob: str) -> bool:
    """Whether a path or pattern names any file; asked through Spark, so any store will do."""
    try:
        spark.read.text(glob)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def month_folders(spark: SparkSession, base: str, months: Months, partitioned: bool = False) -> DataFrame:
    """The click layer's month directories, each row with its folder (yyyy-MM)."""
    if partitioned:
        folder = F.concat_ws("-", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"))
        clicks = _of_months(spark.read.parquet(base), months)
        return clicks.withColumn("folder", folder).drop("year", "month")
    clicks = spark.read.parquet(*[f"{base}/{y}/{m:02d}" for y, m in months])
    return clicks.withColumn("folder", _folder_of(F.col("_metadata.file_path")))


def month_label(month: tuple[int, int]) -> str:
    return f"{month[0]:04d}-{month[1]:02d}"


def _folder_of(path: Column) -> Column:
    parts = r"/(?:year=)?(\d{4})/(?:month=)?(\d{1,2})/[^/]*$"
    return F.concat_ws("-", F.regexp_extract(path, parts, 1), F.lpad(F.regexp_extract(path, parts, 2), 2, "0"))


def folder_states(spark: SparkSession, base: str, months: Months, partitioned: bool = False) -> dict[str, str]:
    """What the files of each month directory look like: their number, size and latest change, from
    the listing alone. A directory that is written again has another state."""
    paths = [base] if partitioned else [f"{base}/{y}/{m:02d}" for y, m in months]
    files = listed(spark, paths).withColumn("folder", _folder_of(F.col("path")))
    state = F.concat_ws("-", F.count("*"), F.sum("length"), F.unix_millis(F.max("modificationTime")))
    wanted = files.filter(F.col("folder").isin([month_label(m) for m in months]))
    return {r.folder: r.state for r in wanted.groupBy("folder").agg(state.alias("state")).collect()}


def listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, length and modificationTime of the data files under the paths or patterns. Only the
    listing is used; no file is opened."""
    return spark.read.format("binaryFile").load(paths).select("path", "length", "modificationTime")


def finished_folders(spark: SparkSession, manifest: str) -> set[tuple[str, str]]:
    """(folder, state) of the month directories that are in the stored counts: one small row each."""
    if not path_exists(spark, manifest):
        return set()
    return {(r.folder, r.state) for r in spark.read.parquet(manifest).distinct().collect()}


def kept(spark: SparkSession, path: str, states: dict[str, str], schema: str) -> DataFrame:
    """The rows stored for these folders in these states. The schema is given, because folders are
    months, which would be read as dates, and because there may be no rows yet."""
    wanted = F.lit(False)
    for folder, state in sorted(states.items()):
        wanted = wanted | ((F.col("folder") == folder) & (F.col("state") == state))
    stored = spark.read.schema(f"{schema}, folder string, state string").parquet(path)
    return stored.filter(wanted).drop("state")


def is_dated() -> Column:
    """The date is a day of the calendar, written yyyy-MM-dd."""
    shown = F.col("date").cast("string")
    sound = shown.rlike(r"^\d{4}-\d{2}-\d{2}$") & shown.try_cast("date").isNotNull()
    return F.coalesce(sound, F.lit(False))


def dated(clicks: DataFrame) -> DataFrame:
    return clicks.filter(is_dated())


def undated(clicks: DataFrame) -> DataFrame:
    """How many rows of each folder have a date that is none, by what stands there."""
    bad = clicks.filter(~is_dated()).groupBy("folder", F.col("date").cast("string").alias("date"))
    return bad.agg(F.count("*").alias("rows"))


def in_lookback(clicks: DataFrame, run_date: str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows dated within the lookback that ends with run_date. The bounds are literals, so
    they reach the parquet scan."""
    first = (date.fromisoformat(run_date) - timedelta(days=days)).isoformat()
    return clicks.filter(F.col("date").between(first, run_date))


def in_trailing_year(
    clicks: DataFrame, run_month: str, months: int = USAGE_MONTHS
) -> DataFrame:
    """Rows dated within the whole months before run_month."""
    year, month = months_before(run_month, months)[0]
    first, end = f"{year}-{month:02d}-01", f"{run_month}-01"
    return clicks.filter((F.col("date") >= first) & (F.col("date") < end))


def clicks_only(clicks: DataFrame) -> DataFrame:
    return clicks.filter(F.col("clicks") == 1)


def known_country(clicks: DataFrame) -> DataFrame:
    """Without the sentinel country; a NULL country goes as well."""
    return clicks.filter(F.col("country") != SENTINEL_COUNTRY)


# --- hourly log -------------------------------------------------------------------------


def hour_directory(base: str, hour: str) -> str:
    """'2024-02-14 06:00' -> base/2024/02/14/06."""
    return f"{base}/{hour[:10].replace('-', '/')}/{hour[11:13]}"


def previous_hour(hour: str) -> str:
    before = datetime.strptime(hour, "%Y-%m-%d %H:%M") - timedelta(hours=1)
    return before.strftime("%Y-%m-%d %H:%M")


def read_tsv(spark: SparkSession, header_path: str, data_path: str | list[str]) -> DataFrame:
    """Headerless tab-separated files whose column names stand in a separate header file.
    All columns are strings."""
    schema = spark.read.csv(header_path, sep="\t", header=True).schema
    return spark.read.schema(schema).csv(data_path, sep="\t", header=False)


def read_hour(spark: SparkSession, base: str, hour: str) -> DataFrame | None:
    """One hour's log with its dir_hour, or None when the hour has no data. Data without a header
    file is an error: its columns are unknown."""
    folder = hour_directory(base, hour)
    if not path_exists(spark, f"{folder}/p*"):
        return None
    header = f"{folder}/_logs/*.tsv"
    if not path_exists(spark, header):
        raise FileNotFoundError(f"hour {hour} has data but no header file {header}")
    return read_tsv(spark, header, f"{folder}/p*").withColumn("dir_hour", F.lit(hour))


def days_pattern(base: str, first_hour: str, last_hour: str) -> str:
    """Pattern of the hour directories of the days in between."""
    first, last = date.fromisoformat(first_hour[:10]), date.fromisoformat(last_hour[:10])
    days = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    return f"{base}/{{{','.join(d.isoformat().replace('-', '/') for d in days)}}}/*"


# Directories are bare numbers or year=, month=, day= and hour=; headers may lie in _logs below.
HOUR_PATH = r"/(?:year=)?(\d{4})/(?:month=)?(\d{2})/(?:day=)?(\d{2})/(?:hour=)?(\d{2})/(?:_logs/)?[^/]*$"


def _hour_of(path: Column) -> Column:
    piece = [F.regexp_extract(path, HOUR_PATH, i) for i in range(1, 5)]
    return F.concat(F.concat_ws("-", *piece[:3]), F.lit(" "), piece[3], F.lit(":00"))


def stored_hours(spark: SparkSession, data_path: str) -> DataFrame:
    """hour and folder of the hour directories that hold data files, from the listing alone. A
    directory without data files is not there."""
    if not path_exists(spark, data_path):
        return spark.createDataFrame([], "hour string, folder string")
    files = listed(spark, [data_path])
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return files.groupBy(_hour_of(F.col("path")).alias("hour")).agg(F.min(folder).alias("folder"))


def hour_headers(spark: SparkSession, header_path: str) -> dict[str, tuple[str, str]]:
    """For each hour the path and the first line of its header file (the first one by name)."""
    if not path_exists(spark, header_path):
        return {}
    lines = spark.read.text(header_path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at")
    )
    first = lines.groupBy("path").agg(F.min_by("value", "at").alias("line"))
    by_hour = first.groupBy(_hour_of(F.col("path")).alias("hour")).agg(
        F.min(F.struct("path", "line")).alias("header")
    )
    return {r.hour: (r.header.path, r.header.line) for r in by_hour.collect()}  # one per hour


def read_hours(spark: SparkSession, header_path: str, data_path: str) -> DataFrame:
    """Many hours' logs with their dir_hour, each read under its own hour's header. Hours of equal
    headers are one scan, and columns are put together by name, so there are as many scans as
    versions of the header. An hour with data but without a header is an error."""
    headers, by_header = hour_headers(spark, header_path), {}
    for hour, folder in sorted(stored_hours(spark, data_path).collect()):  # one per hour
        if hour not in headers:
            raise FileNotFoundError(f"hour {hour} has data but no header file")
        path, line = headers[hour]
        by_header.setdefault(line, (path, []))[1].append(f"{folder}/{data_path.rsplit('/', 1)[1]}")
    result = spark.createDataFrame([], "ct_flume_host string, ct_datetime string, dir_hour string")
    for path, folders in by_header.values():
        log = read_tsv(spark, path, folders)
        log = log.withColumn("dir_hour", _hour_of(F.col("_metadata.file_path")))
        result = result.unionByName(log, allowMissingColumns=True)
    return result


# --- results ----------------------------------------------------------------------------


def read_usage(spark: SparkSession, base: str, run_month: str, level: str) -> DataFrame:
    """A level's usage reference of a run month."""
    return spark.read.parquet(f"{base}/usage/{run_month.replace('-', '/')}/{level_label(level)}")


def level_label(level: str) -> str:
    return "_".join(LEVELS[level])


def read_alerts(spark: SparkSession, alert_dir: str, levels=tuple(LEVELS)) -> DataFrame | None:
    """All levels' alert files of a run, as strings, under the union of their columns, with
    the name of the directory each row comes from. None when the run left no files."""
    source = F.regexp_extract(F.col("_metadata.file_path"), "/([^/]+)_csv/[^/]*$", 1)
    found = []
    for level in levels:
        path = f"{alert_dir}/{level_label(level)}_csv"
        try:
            found.append(spark.read.csv(path, header=True).withColumn("source", source))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return combine(found) if found else None


def combine(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are NULL."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    missing = [c for c in LEVEL_COLS if c not in result.columns]
    return result.withColumns({c: F.lit(None).cast("string") for c in missing})
