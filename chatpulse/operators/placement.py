"""Window bounds of results that only print London wall-clock times, the doubled autumn hour included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatpulse.functions.clock import london_text

HOUR = "INTERVAL 1 HOUR"
SUMMER, WINTER = 0, 1


def later_reading(instant: Column) -> Column:
    """The instant an hour later if it is printed alike, else null."""
    later = instant + F.expr(HOUR)
    return F.when(london_text(later) == london_text(instant), later)


def _end_after(start: Column) -> Column:
    """The first reading of the printed end that lies after ``start``; null if none does."""
    end, later = F.col("win_end"), F.col("_later_end")
    return F.when(end > start, end).when(later > start, later)


def place_results(
    results: DataFrame,
    log: Sequence[str] = ("topic", "partition"),
    position: str = "offset",
    arrival: str = "arrival",
    length: str | None = None,
) -> DataFrame:
    """Results of topics (``read_results``) with the bounds their order in the log allows.

    The hour that is printed twice each autumn has two readings. A window is settled by itself if only
    one of them has an end after its start, spans ``length`` (if given), or had ended by the time
    the result arrived. For the others the log decides: each partition holds the results of
    one kind in the order of their windows, so printed times rise through the summer hour, fall
    back once, and rise again; what follows the fall is the winter hour. Without a fall, what comes
    before a settled summer window is summer, what comes after a settled winter window is winter. More than one fall, or
    a settled window on the wrong side, shows that results were sent again; the order then proves
    nothing. What stays open gets no bounds, so that it is among ``unplaced_results`` instead
    of passing for another window's result.

    Only results of the doubled hours are moved, to their partition's night; all others are placed row by row.
    ``log`` columns that the results lack are left out, ``position`` must rise within a partition.
    Null positions are undecided.
    """
    log = [name for name in log if name in results.columns]
    start, end = F.col("win_start"), F.col("win_end")
    read = results.withColumn("_later_end", later_reading(end)).withColumn("_later", later_reading(start))

    plain = read.where(F.col("_later").isNull()).withColumn("win_end", F.coalesce(_end_after(start), end))

    summer_end, winter_end = _end_after(start), _end_after(F.col("_later"))
    can_summer, can_winter = summer_end.isNotNull(), winter_end.isNotNull()
    if length:
        span = F.expr(f"INTERVAL '{length}'")
        can_summer = can_summer & (summer_end == start + span)
        can_winter = can_winter & (winter_end == F.col("_later") + span)
    if arrival in results.columns:
        can_winter = can_winter & F.coalesce(F.col(arrival) >= winter_end, F.lit(True))
    doubled = (
        read.where(F.col("_later").isNotNull())
        .withColumn("_summer_end", summer_end)
        .withColumn("_winter_end", winter_end)
        .withColumn("_settled", F.when(can_summer & ~can_winter, SUMMER).when(can_winter & ~can_summer, WINTER))
        .withColumn("_never", ~can_summer & ~can_winter)
        .withColumn("_night", F.to_date("win_start"))
        .withColumn("_known_place", F.col(position).isNotNull())
    )
    night = Window.partitionBy("kind", *log, "_night", "_known_place")
    by_place = night.orderBy(position)
    before = by_place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = by_place.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # Two windows with one printed start but not one printed end are an hour apart as well.
    start_before, end_before = F.lag("win_start").over(by_place), F.lag("win_end").over(by_place)
    fell = (start < start_before) | ((start == start_before) & (end != end_before))
    counted = (
        doubled.withColumn("_fell", F.coalesce(fell.cast("int"), F.lit(0)))
        .withColumn("_falls", F.sum("_fell").over(before))
        .withColumn("_all_falls", F.sum("_fell").over(night))
        .withColumn("_winter_before", F.coalesce(F.max(F.col("_settled") == WINTER).over(before), F.lit(False)))
        .withColumn("_summer_after", F.coalesce(F.max(F.col("_settled") == SUMMER).over(after), F.lit(False)))
    )
    by_fall = F.when(F.col("_all_falls") == 1, F.col("_falls").cast("int"))
    by_neighbour = F.when(
        (F.col("_all_falls") == 0) & (F.col("_winter_before") != F.col("_summer_after")), F.col("_winter_before").cast("int")
    )
    told = counted.withColumn("_told", F.coalesce(by_fall, by_neighbour))
    # One settled window that the order tells wrongly shows that the order can't be trusted that night.
    wrong = F.max((F.col("_told") != F.col("_settled")) | (F.col("_winter_before") & F.col("_summer_after")))
    trusted = ~F.coalesce(wrong.over(night), F.lit(False)) & F.col("_known_place")
    hour = F.coalesce("_settled", F.when(trusted & ~F.col("_never"), F.col("_told")))
    placed = (
        told.withColumn("_hour", hour)
        .withColumn("win_end", F.when(F.col("_hour") == SUMMER, F.col("_summer_end")).when(F.col("_hour") == WINTER, F.col("_winter_end")))
        .withColumn("win_start", F.when(F.col("_hour") == SUMMER, start).when(F.col("_hour") == WINTER, F.col("_later")))
    )
    return plain.select(*results.columns).unionByName(placed.select(*results.columns))
