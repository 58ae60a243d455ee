"""Running totals over a long ordered table without one task seeing all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Keys that cut a table into ranges, about; and the rows that a range has at least, about.
CUTS = 1_024
RANGE_ROWS = 32

_STEPS = [1 << k for k in range(13, -1, -1)]


def _same(*columns: str) -> list[Column]:
    # A missing value is a group of its own.
    return [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in columns]


def _cuts(keys: DataFrame, day: str, key: str, within: tuple[str, ...]) -> DataFrame:
    """Per group and day, the sorted keys at which it is cut: those of the smallest hashes, about ``CUTS`` of the whole table.

    A day with a third of all rows has a third of the cuts, and they lie where its keys lie, whatever the keys look like. How
    many rows there are is a scalar subquery, so the share is found as the query runs.
    """
    share = F.least(F.lit(1 / RANGE_ROWS), F.lit(float(CUTS)) / F.greatest(F.count("*"), F.lit(1)))
    limit = keys.agg((share * float(1 << 64) - float(1 << 63)).cast("long").alias("limit")).scalar()
    chosen = keys.where(F.xxhash64(key) < limit).groupBy(*within, day).agg(F.array_sort(F.collect_set(key)).alias("_cuts"))
    return chosen.select(*[F.col(c).alias(f"_of_{c}") for c in (*within, day)], "_cuts")


def key_ranges(rows: DataFrame, day: str, key: str, within: tuple[str, ...] = (), keys: DataFrame | None = None) -> DataFrame:
    """``rows`` plus ``_range``, the number of cuts of their group and day up to their key; see ``running_total`` for ``keys``."""
    cuts = _cuts((rows if keys is None else keys).select(*within, day, key), day, key, within)

    def step(at: Column, size: Column) -> Column:
        ahead = F.get("_cuts", at + size - 1)
        return F.when(ahead <= F.col(key), at + size).otherwise(at)

    place = F.aggregate(F.array(*map(F.lit, _STEPS)), F.lit(0), step)
    # There are about CUTS cuts whatever the input.
    joined = rows.join(F.broadcast(cuts), _same(*within, day), "left")
    return joined.withColumn("_range", F.when(F.col("_cuts").isNull() | F.col(key).isNull(), 0).otherwise(place)).select(*rows.columns, "_range")


def running_total(
    rows: DataFrame,
    value: Column,
    day: str,
    key: str,
    within: tuple[str, ...] = (),
    name: str = "running_total",
    keys: DataFrame | None = None,
) -> DataFrame:
    """``rows`` plus the total of ``value`` up to and including each row, in the order
    of ``day`` and the text ``key``; ``within`` columns restart the total.

    Rows are totalled within a day and a range of keys. The totals of earlier ranges of that day, and of earlier days, come
    from aggregates, so even a day that holds most rows is split. Ranges are cut at keys of the table itself (or of ``keys``, another
    table with the same columns that is cheaper to read); any cuts give the same totals.
    """
    prepared = key_ranges(rows.withColumn("_value", value), day, key, within, keys)
    earlier = (Window.unboundedPreceding, -1)
    per_range = prepared.groupBy(*within, day, "_range").agg(F.sum("_value").alias("_total"))
    days = per_range.groupBy(*within, day).agg(F.sum("_total").alias("_total"))
    days = days.select(
        *[F.col(c).alias(f"_of_{c}") for c in (*within, day)],
        F.coalesce(F.sum("_total").over(Window.partitionBy(*within).orderBy(day).rowsBetween(*earlier)), F.lit(0)).alias("_days"),
    )
    in_day = Window.partitionBy(*within, day).orderBy("_range").rowsBetween(*earlier)
    ranges = per_range.withColumn("_ranges", F.coalesce(F.sum("_total").over(in_day), F.lit(0)))
    offsets = ranges.join(days, _same(*within, day)).select(
        *[F.col(c).alias(f"_of_{c}") for c in (*within, day, "_range")], (F.col("_days") + F.col("_ranges")).alias("_offset")
    )
    inside = Window.partitionBy(*within, day, "_range").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        prepared.withColumn("_inside", F.sum("_value").over(inside))
        .join(offsets, _same(*within, day, "_range"))
        .select(*rows.columns, (F.col("_offset") + F.col("_inside")).alias(name))
    )
