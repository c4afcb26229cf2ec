"""Daily clicks and audience sizes per group, at one level or at all levels in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropwatch.config import COUNT_COLS, ID_COLS, LEVEL_COLS
from dropwatch.session import tasks_for

# Fixed value: parts of a country's day. A hot one is spread over so many tasks, and a task has few
# days, whose counts it adds up.
PARTS = 32


def daily_usage(clicks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct identifiers per group and day. Expects click rows only."""
    return clicks.groupBy(*keys, "date").agg(*_distinct_counts())


def daily_counts(clicks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Clicks and distinct identifiers per group and day. Expects click rows only."""
    total = F.sum("clicks").cast("long").alias("clicks")
    return clicks.groupBy(*keys, "date").agg(total, *_distinct_counts())


def _distinct_counts() -> list[Column]:
    return [F.count_distinct(c).alias(n) for c, n in zip(ID_COLS, COUNT_COLS)]


def _part(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(PARTS))


def identifiers(
    clicks: DataFrame, ids: Sequence[str] = ID_COLS, scope: Sequence[str] = (), tasks: int | None = None
) -> DataFrame:
    """Each identifier value once per finest group, day and part of it (and scope), with its number
    of rows n.

    A missing identifier counts nothing and goes at once, but for the first kind, whose rows also
    count the clicks. Tables of this kind can be merged: distinct counts of their union are those
    of all rows together.

    The rows are dealt to bounded tasks before they are multiplied, and combined where they lie.
    """
    keys = [*scope, *LEVEL_COLS, "date"]
    rows = clicks.select(*keys, *ids, _part(*ids).alias("dealt"))
    rows = rows.repartition(tasks or tasks_for(clicks), *scope, "country", "date", "dealt")
    pairs = [x for kind, c in enumerate(ids) for x in (F.lit(kind), F.col(c).cast("string"))]
    seen = rows.select(*keys, "dealt", F.stack(F.lit(len(ids)), *pairs).alias("kind", "value"))
    seen = seen.filter((F.col("kind") == 0) | F.col("value").isNotNull())
    return seen.groupBy(*keys, "dealt", "kind", "value").agg(F.count("*").alias("n")).drop("dealt")


def counts_of(
    seen: DataFrame, ids: Sequence[str] = ID_COLS, scope: Sequence[str] = (), tasks: int | None = None
) -> DataFrame:
    """Clicks and distinct identifiers at all four levels, stacked, from the table identifiers.

    Distinct counts do not add up over the groups of a finer level, but the places where a value
    comes first do: of a country's rows of a value and day, in the order of their groups, the first
    one counts for the country, the first of each website for that website, and so on down; the
    first of each zone for that zone, and further ones for none. So one sort tells each row the
    coarsest level it counts for, rows are added up per zone and that level, and the small result is
    handed to all four levels.

    A value of a country and day has one row per group and part at most, and these are read one by
    one. The sort begins with numbers of the part and the value, which settle most comparisons; rows
    are of one value only if all its columns are equal.
    """
    day, place = [*scope, "date"], [*scope, "country", "date"]
    number = F.xxhash64(*place, "kind", "value")
    seen = seen.withColumns({"number": number, "part": F.xxhash64(*place, _part("kind", "value"))})
    seen = seen.repartition(tasks or tasks_for(seen), "part")
    one = [*place, "kind", "value"]
    window = Window.partitionBy("part").orderBy("number", *one, *LEVEL_COLS[1:])
    same = F.lag("number").over(window).isNotNull()
    for column in one:
        same = same & F.col(column).eqNullSafe(F.lag(column).over(window))
    # The coarsest level at which the row before, if of the same value, is of another group.
    level = F.lit(len(LEVEL_COLS) + 1)
    for depth in range(len(LEVEL_COLS), 1, -1):
        column = LEVEL_COLS[depth - 1]
        level = F.when(F.col(column).eqNullSafe(F.lag(column).over(window)), level).otherwise(depth)
    level = F.when(same, level).otherwise(1)
    known = F.col("value").isNotNull()
    per_zone = seen.select("*", level.alias("since")).groupBy(*day, *LEVEL_COLS, "since").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("clicks"),
        *[
            F.count_if((F.col("kind") == kind) & known).alias(f"count_{c}")
            for kind, c in enumerate(ids)
        ],
    )
    levels = F.explode(F.array(*[F.lit(n) for n in range(1, len(LEVEL_COLS) + 1)]))
    handed = per_zone.select("*", levels.alias("level"))
    shown = [
        F.when(F.col("level") >= depth, F.col(c)).alias(c)
        for depth, c in enumerate(LEVEL_COLS, start=1)
    ]
    totals = handed.select("*", *[c.alias(f"shown_{n}") for c, n in zip(shown, LEVEL_COLS)])
    grouped = totals.groupBy(*scope, "level", *[f"shown_{n}" for n in LEVEL_COLS], "date").agg(
        F.sum("clicks").cast("long").alias("clicks"),
        *[
            F.sum(F.when(F.col("since") <= F.col("level"), F.col(f"count_{c}")).otherwise(0))
            .cast("long")
            .alias(f"count_{c}")
            for c in ids
        ],
    )
    return grouped.withColumnsRenamed({f"shown_{n}": n for n in LEVEL_COLS})


def daily_counts_all_levels(
    clicks: DataFrame, ids: Sequence[str] = ID_COLS, scope: Sequence[str] = ()
) -> DataFrame:
    """daily_counts at all four nested levels, stacked, with the level number. Only the
    identifiers asked for are counted; scope are columns to count apart.

    Every row becomes one row per identifier, which is combined before the only shuffle of that
    size; the deduplicated rows are sorted once for all levels together.
    """
    tasks = tasks_for(clicks)
    return counts_of(identifiers(clicks, ids, scope, tasks), ids, scope, tasks)


def daily_clicks_all_levels(clicks: DataFrame) -> DataFrame:
    """Only the clicks of daily_counts_all_levels: sums do add up, so the finest level is
    aggregated first and the rest is rolled up from it."""
    zones = clicks.groupBy(*LEVEL_COLS, "date").agg(F.sum("clicks").alias("clicks"))
    sets = [["date", *LEVEL_COLS[:n]] for n in range(1, len(LEVEL_COLS) + 1)]
    rolled = zones.groupingSets(sets, "date", *LEVEL_COLS).agg(
        F.grouping_id().alias("masked"), F.sum("clicks").cast("long").alias("clicks")
    )
    level = F.lit(len(LEVEL_COLS)) - F.bit_count("masked")
    return rolled.select(level.cast("int").alias("level"), *LEVEL_COLS, "date", "clicks")


def daily_total(daily: DataFrame, scope: Sequence[str] = ("date",)) -> DataFrame:
    """Total clicks per day."""
    total = F.sum("clicks").cast("long").alias("daily_total_clicks")
    return daily.groupBy(*scope).agg(total)


def keys_present(keys: Sequence[str]) -> Column:
    """No grouping column of the row's level is NULL. In a stacked table the columns below the
    level are NULL by design."""
    present = F.lit(True)
    for depth, column in enumerate((k for k in keys if k != "level"), start=1):
        known = F.col(column).isNotNull()
        if "level" in keys:
            known = known | (F.col("level") < depth)
        present = present & known
    return present
